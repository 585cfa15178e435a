"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bidlake.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark alone."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, batch_bytes: int | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    Cuts the lineage like a reliable checkpoint, and keeps column pruning and
    size statistics, from which Spark decides on broadcasts before it runs.
    ``batch_bytes`` bounds the batches that Python functions in ``df`` get
    meanwhile (by default the session's 64 MB, once in the JVM and once or
    twice in each Python worker).
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    before = spark.conf.get(_BATCH_BYTES, None)
    if batch_bytes:
        spark.conf.set(_BATCH_BYTES, str(batch_bytes))
    try:
        df.write.parquet(path)
    finally:
        if batch_bytes:
            spark.conf.set(_BATCH_BYTES, before) if before else spark.conf.unset(_BATCH_BYTES)
    return spark.read.schema(df.schema).parquet(path)


_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
HOT_SHARE = 64


def looked_up(rows: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """``rows`` joined with ``facts``, which has one row a key.

    Keys that hold more than a 64th of the rows (fewer than 64 of them,
    counted first) are joined where their rows lie, by broadcast of their
    facts alone; the others by a shuffle.  So no key's rows meet in one task.
    """
    sizes = rows.groupBy(key).agg(F.count("*").alias("_rows"))
    top = sizes.orderBy(F.desc("_rows")).limit(HOT_SHARE).collect()
    least = rows.count() / HOT_SHARE if top and top[0]["_rows"] > 1 else 0
    hot = [r[key] for r in top if r["_rows"] > max(least, 100) and r[key] is not None]
    if not hot:
        return rows.join(facts, key)
    often = F.col(key).isin(hot)
    return rows.where(often).join(F.broadcast(facts.where(often)), key).unionByName(rows.where(~often).join(facts, key))


def remainder(modulus: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(modulus)).cast("int")


def uniform(*columns: Column) -> Column:
    """A reproducible number in [0, 1) from a hash of the columns."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) / F.lit(float(1 << 30))


def bounded_sample(df: DataFrame, group: Column, order: Column, bound: int) -> DataFrame:
    """About ``bound`` rows of each group at most, chosen by a hash of ``order``.

    Groups are counted over all rows; a group of n rows keeps those whose hash
    lies below bound / n, so no group is sorted or sent to one task.  Groups
    of up to ``bound`` rows stay whole.  The counts are stored, so Spark knows
    their size and broadcasts them unless the groups are very many.
    """
    keyed = df.withColumn("_group", group)
    counts = stored(keyed.groupBy("_group").agg(F.count("*").alias("_rows")).withColumnRenamed("_group", "_key"))
    joined = keyed.join(counts, F.col("_group").eqNullSafe(F.col("_key")))
    return joined.where(uniform(order) * F.col("_rows") < F.lit(float(bound))).drop("_group", "_key", "_rows")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, eligible: Column, bound: int) -> DataFrame:
    """doc_id, text and label of a bounded sample per class (0 and 1) of the labelled rows where ``eligible`` holds.

    ``eligible`` is a condition on doc_id, so the sample is chosen among the
    labels alone; at most about twice ``bound`` ids are broadcast and texts
    are read where they lie.  Of several labels of one id the largest counts.
    """
    truth = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & eligible).groupBy("doc_id").agg(F.max(label).alias(label))
    chosen = bounded_sample(truth, F.col(label), F.col("doc_id"), bound)
    return docs.where("text is not null").select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
