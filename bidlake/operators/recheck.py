"""Feed C: change detection for reviewed high-priority rows.

One set-based join replaces one source request per row:

    master.filter(F14)  --J4 + W8 (first fresh of an id posted at or after)-->
        --J7 null-safe diff--> --S15 upsert

Scale: fresh rows are first reduced to the earliest arrival per
(id, posted date) with a partial aggregate, so a hot id cannot pile up in
one task; reviewed rows and fresh days of an id then go into one order and a
running minimum answers all of them, in place of a join of each with each; rows that are not high priority never shuffle (they bypass the
join and are unioned back untouched).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidlake.functions import text as T
from bidlake.operators import intervals
from bidlake.operators.filters import high_priority
from bidlake.operators.notices import fresh_projection
from bidlake.settings import DIFF_FIELDS, RESCORE_FIELDS

NEEDED = ("noticeId", "fitLabel", "postedDate") + DIFF_FIELDS


def has_needed_columns(master: DataFrame) -> bool:
    """the re-check is a no-op unless every needed column exists."""
    return all(c in master.columns for c in NEEDED)


def high_rows(master: DataFrame) -> DataFrame:
    """reviewed rows labelled high with a present id."""
    return master.where(high_priority())


def matched_fresh(master: DataFrame, fresh_items: DataFrame, run_date: str) -> DataFrame:
    """J4 + W8: for each high row key (id, posted date) the first fresh record
    posted inside [posted date (or run_date - 365), run_date]."""
    fresh = fresh_projection(fresh_items).withColumn("_fposted", F.try_to_date(F.col("postedDate"), "yyyy-MM-dd"))
    fresh = fresh.where(F.col("_fposted") <= F.to_date(F.lit(run_date)))
    # Earliest arrival per (id, posted day): partial aggregation before any shuffle.
    per_day = fresh.groupBy("noticeId", F.col("_fposted").alias("_day")).agg(F.min(F.struct("ord", "title", "naicsCode", "type", "deadline")).alias("_f"))
    keys = high_rows(master).select(
        F.col("noticeId"), F.coalesce(F.col("postedDate"), F.lit("")).alias("_mposted")).distinct()
    keys = keys.withColumn("_day", T.iso_date_or_fallback("_mposted", run_date))
    # keys and days of an id in one order, never multiplied
    first = intervals.first_at_or_after(keys, per_day, ["noticeId"], "_day", F.col("_f"), "_first").where(F.col("_first").isNotNull())
    return first.select(
        "noticeId", "_mposted",
        F.col("_first.ord").alias("fresh_ord"),
        *[F.col(f"_first.{c}").alias(f"fresh_{c}") for c in DIFF_FIELDS],
    )


def diff(master: DataFrame, matches: DataFrame) -> DataFrame:
    """Every high row with its match (if any) and the null-safe changes.

    Unmatched rows (gone from the source, or posted outside the window) have
    ``matched = false`` and no changes.
    """
    high = high_rows(master).withColumn("_mposted", F.coalesce(F.col("postedDate"), F.lit("")))
    m = high.join(matches, on=["noticeId", "_mposted"], how="left")
    matched = F.col("fresh_ord").isNotNull()
    out = m.withColumn("matched", matched)
    for c in DIFF_FIELDS:
        out = out.withColumn(f"_chg_{c}", matched & (F.coalesce(F.col(c), F.lit("")) != F.col(f"fresh_{c}")))
    changed = F.filter(F.array(*[F.when(F.col(f"_chg_{c}"), F.lit(c)) for c in DIFF_FIELDS]), lambda x: x.isNotNull())
    return out.withColumn("changed_fields", changed).withColumn("changed", F.size("changed_fields") > 0)


def upsert(master: DataFrame, fresh_items: DataFrame, run_date: str) -> DataFrame:
    """New master snapshot: changed fields replaced, review columns cleared.

    Column set and order are the master's own; rows that are not high
    priority pass through without a shuffle.
    """
    cols = master.columns
    if not has_needed_columns(master):
        return master
    others = master.where(~high_priority())
    merged = diff(master, matched_fresh(master, fresh_items, run_date))
    updated_cols = []
    for c in cols:
        if c in DIFF_FIELDS:
            e = F.when(F.col(f"_chg_{c}"), F.col(f"fresh_{c}")).otherwise(F.col(c))
        elif c in RESCORE_FIELDS:
            e = F.when(F.col("changed"), F.lit("")).otherwise(F.col(c))
        else:
            e = F.col(c)
        updated_cols.append(e.alias(c))
    return others.select(*cols).unionByName(merged.select(*updated_cols))


def counts(master: DataFrame, fresh_items: DataFrame, run_date: str) -> DataFrame:
    """A4: rows checked (every attempted high row) and rows updated."""
    if not has_needed_columns(master):
        return master.sparkSession.createDataFrame([(0, 0)], "checked bigint, updated bigint")
    d = diff(master, matched_fresh(master, fresh_items, run_date))
    return d.agg(
        F.count(F.lit(1)).cast("bigint").alias("checked"),
        F.count_if(F.col("changed")).cast("bigint").alias("updated"),
    )


