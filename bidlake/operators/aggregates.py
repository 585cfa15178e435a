"""Aggregations of both feeds (A1, A2, A5, A6) and the run-log row.

All are ordinary grouped aggregates with partial (map-side) aggregation;
ordered string folds sort a bounded list (one entry per configured agency
code) instead of relying on ``collect_list`` order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidlake.functions import text as T


def per_agency_counts(accepted: DataFrame, codes: DataFrame, agency_col: str = "agencyCodeQueried") -> DataFrame:
    """A1: accepted rows per queried code; every code present, query order kept.

    ``codes`` is the configured code list ``(code_seq, agencyCode)``.
    """
    counted = accepted.groupBy(F.col(agency_col).alias("agencyCode")).agg(F.count(F.lit(1)).alias("_n"))
    return (
        codes.join(counted, on="agencyCode", how="left")
        .select("code_seq", "agencyCode", F.coalesce(F.col("_n"), F.lit(0)).cast("bigint").alias("newRows"))
    )


def ordered_join(seq: Column, text: Column, sep: str) -> Column:
    """``sep``-joined ``text`` values in ``seq`` order (NULL texts skipped)."""
    entries = F.sort_array(F.collect_list(F.when(text.isNotNull(), F.struct(seq.alias("s"), text.alias("t")))))
    joined = F.array_join(F.transform(entries, lambda e: e["t"]), sep)
    return F.when(F.size(entries) > 0, joined)


def run_log_row(counts: DataFrame, run_date: str, run_ts: str, days_back: int,
                keyword: str | None = None, unrestricted: bool = False) -> DataFrame:
    """S16 + A2 + X2 + X25: one audit row for the run.

    notes = ``code:n`` for codes with n > 0, ``; ``-joined in query order,
    or ``no new rows``.
    """
    note = F.when(F.col("newRows") > 0, F.concat_ws(":", "agencyCode", F.col("newRows").cast("string")))
    agencies = F.lit("ALL") if unrestricted else F.coalesce(
        ordered_join(F.col("code_seq"), F.col("agencyCode"), ","), F.lit("ALL"))
    start = F.date_sub(F.to_date(F.lit(run_date)), days_back)
    return counts.agg(
        F.lit(run_ts).alias("runAtUTC"),
        T.mmddyyyy(start).alias("postedFrom"),
        T.mmddyyyy(F.to_date(F.lit(run_date))).alias("postedTo"),
        agencies.alias("agencies"),
        F.lit(keyword or "").alias("keyword"),
        F.coalesce(F.sum("newRows"), F.lit(0)).cast("bigint").alias("newRows"),
        F.coalesce(ordered_join(F.col("code_seq"), note, "; "), F.lit("no new rows")).alias("notes"),
    )


def per_source_totals(df: DataFrame, source_col: str = "source") -> DataFrame:
    """A5: messages (or opportunities) per source."""
    return df.groupBy(source_col).agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def last_wins_map(df: DataFrame, group_cols: list[str], key: Column, value: Column, pos: Column,
                  out_col: str = "kv") -> DataFrame:
    """Fold (key, value) rows into a map per group; the last position wins.

    Duplicate keys are resolved before the map is built (``max_by`` on the
    position), so no session-level map-key policy is needed.
    """
    pairs = df.select(*group_cols, key.alias("_k"), value.alias("_v"), pos.alias("_p")).where(F.col("_k").isNotNull())
    last = pairs.groupBy(*group_cols, "_k").agg(F.max_by("_v", "_p").alias("_v"))
    return last.groupBy(*group_cols).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("_k", "_v")))).alias(out_col))

