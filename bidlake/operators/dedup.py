"""First-wins dedup, anti-join against the master, the run cap, and the
append classification (W1..W4, W10, J1, J2, A3).

"First" is defined by an ingest-time arrival ordinal (``ord``), never by
``monotonically_increasing_id`` or ``dropDuplicates`` (arbitrary survivor).

Scale notes:
* ``row_number() = 1`` lets the planner insert a partial ``WindowGroupLimit``
  before the shuffle, so a hot key ships at most one row per map task.
* Master key sets are non-blank, distinct keys: the partial aggregate
  collapses hot keys before the shuffle; AQE then chooses broadcast (only
  when the measured size is under its threshold) or a shuffled join.
* The cap finds the n-th ordinal by counts of ever finer ranges
  (``selection.nth_smallest``), then filters: nothing gathers anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from bidlake.functions import text as T
from bidlake.operators.selection import nth_smallest


def first_wins(df: DataFrame, keys: list[str | Column], order: list[str | Column] | str = "ord") -> DataFrame:
    """Keep the first row (by ``order``) of every key; rows keep their columns."""
    order_cols = [order] if isinstance(order, str) else list(order)
    w = Window.partitionBy(*keys).orderBy(*order_cols)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def first_n(df: DataFrame, keys: list[str | Column], order: list[str | Column], n: int | None) -> DataFrame:
    """At most ``n`` rows per key in ``order`` (no limit when ``n`` is None/0).

    ``row_number() <= n`` gets a partial ``WindowGroupLimit`` before the shuffle.
    """
    if not n:
        return df
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def key_set(master: DataFrame, key_col: str, out_col: str | None = None, strip: bool = True) -> DataFrame:
    """Distinct non-blank keys of a master table (missing column -> empty set)."""
    out = out_col or key_col
    if key_col not in master.columns:
        return master.sparkSession.createDataFrame([], f"`{out}` string")
    if strip:
        return master.select(T.blank(key_col).alias(out)).where(F.col(out) != "").distinct()
    # stored keys used as they are: a bucketed master keeps its partitioning
    k = F.col(key_col)
    return master.where(k.isNotNull() & (k != "")).select(k.alias(out)).distinct()


def anti_join_master(incoming: DataFrame, master: DataFrame, key_col: str, master_key_col: str | None = None,
                     strip: bool = True) -> DataFrame:
    """Rows whose key is not already in the master.

    ``strip=False`` compares the stored keys as they are (they were stripped
    when written), which lets a master bucketed on the key join without a
    shuffle of its own.
    """
    keys = key_set(master, master_key_col or key_col, out_col=key_col, strip=strip)
    return incoming.join(keys, on=key_col, how="left_anti")


def strict_cap(df: DataFrame, n: int | None, order_col: str = "ord", materialize: bool = True) -> DataFrame:
    """The first ``n`` rows by a unique integer ordinal (no cap when ``n`` is None).

    The n-th ordinal comes from range counts, so neither rows nor ordinals
    meet in one task, however large ``n`` is.  With ``materialize`` the
    uncapped rows are first written once to the shared checkpoint folder:
    the counting rounds then read the ordinal column alone.
    """
    if n is None:
        return df
    if n <= 0:
        return df.limit(0)
    if materialize:
        from bidlake.session import stored

        df = stored(df)
    last = nth_smallest(df, order_col, n)
    return df if last is None else df.where(F.col(order_col) <= last)


def stable_order(df: DataFrame, sort_cols: list[Column], position_col: str | None = "row_pos") -> DataFrame:
    """O1: stable sort; with ``position_col`` also the 1-based output position.

    Rows are range-partitioned and sorted by the columns and written once; a
    row's position is its place in its partition plus the rows of the
    partitions before, so no task sees more than its range.  The driver gets
    one count per partition.
    """
    if position_col is None:
        return df.orderBy(*sort_cols)
    from bidlake.session import cut_lineage

    ranged = df.repartitionByRange(*sort_cols).sortWithinPartitions(*sort_cols)
    placed = cut_lineage(ranged.withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", 33)
    sizes = sorted((r["part"], r["n"]) for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    before, rows = [], 0
    for number, n in sizes:
        before.append((number, rows))
        rows += n
    starts = F.broadcast(df.sparkSession.createDataFrame(before, "_part bigint, _start bigint"))
    within = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return (placed.withColumn("_part", part).join(starts, "_part")
            .withColumn(position_col, F.col("_start") + within + 1).drop("_part", "_start", "_place"))


def first_ordinals(df: DataFrame, key_col: str, order_col: str = "ord") -> DataFrame:
    """Smallest ordinal per key (partial + final aggregate: skew-safe)."""
    return df.groupBy(key_col).agg(F.min(order_col).alias(order_col), F.count(F.lit(1)).alias("_copies"))


def classify_append(df: DataFrame, master: DataFrame, key_col: str = "duplicateKey",
                    order_col: str = "ord", materialize: bool = True) -> DataFrame:
    """A3 + W2 + J2: every incoming row tagged ``new`` / ``dup_master`` / ``dup_batch``.

    Batch duplicates are found from per-key first ordinals (aggregated before
    the shuffle) joined back on the unique ordinal, so a key holding a third
    of the batch never lands in one task.  The batch is read twice, so with
    ``materialize`` it is first cut from its lineage (shared checkpoint
    folder) instead of being recomputed.
    """
    if materialize:
        from bidlake.session import cut_lineage

        df = cut_lineage(df)
    firsts = first_ordinals(df, key_col, order_col).select(order_col, F.lit(True).alias("_first"))
    keys = key_set(master, key_col, strip=False).withColumn("_in_master", F.lit(True))
    tagged = df.join(firsts, on=order_col, how="left").join(keys, on=key_col, how="left")
    status = (
        F.when(F.col("_in_master"), F.lit("dup_master"))
        .when(F.col("_first"), F.lit("new"))
        .otherwise(F.lit("dup_batch"))
    )
    return tagged.withColumn("appendStatus", status).drop("_first", "_in_master")


def new_rows(df: DataFrame, master: DataFrame, key_col: str = "duplicateKey", order_col: str = "ord") -> DataFrame:
    """W2 + J2: the rows an append writes: first copy of each key not yet in the master.

    First-wins (partial ``WindowGroupLimit`` before the shuffle, so a hot key
    ships one row per map task) sorts by a hash of the key.  The master then
    sends the hashes of its keys, not the texts; only rows whose hash it knows
    are compared with it by their whole keys.
    """
    from bidlake.session import stored

    firsts = stored(first_wins(df.withColumn("_hash", F.xxhash64(key_col)), ["_hash", key_col], order_col))
    keys = key_set(master, key_col, strip=False).withColumn("_hash", F.xxhash64(key_col))
    return firsts.join(known_rows(firsts, keys, key_col, order_col), on=order_col, how="left_anti").drop("_hash")


def known_rows(firsts: DataFrame, keys: DataFrame, key_col: str, order_col: str) -> DataFrame:
    """The ordinals of the rows (with ``_hash``) whose keys are among ``keys`` (with ``_hash``): by hash first, then whole."""
    perhaps = firsts.select("_hash", key_col, order_col).join(keys.select("_hash").distinct(), "_hash", "left_semi")
    asked = keys.join(perhaps.select("_hash").distinct(), "_hash", "left_semi")
    return perhaps.join(asked, ["_hash", key_col], "left_semi").select(order_col)


def append_summary(df: DataFrame, master: DataFrame, key_col: str = "duplicateKey", order_col: str = "ord") -> DataFrame:
    """A3 counts: appended + skipped = total, from per-key aggregates only."""
    firsts = first_ordinals(df, key_col, order_col)
    keys = key_set(master, key_col, strip=False).withColumn("_in_master", F.lit(True))
    per_key = firsts.join(keys, on=key_col, how="left")
    appended = F.sum(F.when(F.col("_in_master").isNull(), F.lit(1)).otherwise(F.lit(0))).cast("bigint")
    total = F.sum("_copies").cast("bigint")
    return per_key.agg(
        F.coalesce(appended, F.lit(0).cast("bigint")).alias("appended"),
        F.coalesce(total - appended, F.lit(0).cast("bigint")).alias("skipped"),
        F.coalesce(total, F.lit(0).cast("bigint")).alias("total_processed"),
    )


def append_new(df: DataFrame, master: DataFrame, write, key_col: str = "duplicateKey", order_col: str = "ord") -> dict:
    """S14 + S19 + A3: the append and its counts from the writes themselves.

    ``write`` gets the new rows in order and stores them.  The processed rows
    are counted as they enter the first-wins pass and the appended ones as
    they leave the last write, by observations of the two jobs: nothing is
    computed again, and only tasks that took part in a result are counted.
    """
    processed, appended = Observation("processed"), Observation("appended")
    counted = F.count(F.lit(1)).alias("n")
    fresh = new_rows(df.observe(processed, counted), master, key_col, order_col)
    write(fresh.orderBy(order_col).observe(appended, counted))  # above the sort, whose sampling reads its input twice
    total, new = processed.get["n"], appended.get["n"]
    return {"appended": new, "skipped": total - new, "total_processed": total}
