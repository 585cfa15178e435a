"""Notice projections (P1, P2, P4) and the accepted-batch pipeline of feed A."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidlake.functions import text as T
from bidlake.operators import dedup, filters
from bidlake.settings import JobSettings


def project_notice(items: DataFrame, agency_code: Column | str | None, pulled_at: str,
                   keep: tuple[str, ...] = ("ord", "o_orderkey", "organizationCode", "_status", "_priority", "_orderdate")) -> DataFrame:
    """Raw notice item -> the 13 owned columns (plus pass-through helpers).

    id and code are stripped; dates keep their first 10 characters; the page
    URL is built from the id; other fields pass through (NULL stays NULL).
    """
    nid = T.blank("noticeId")
    code = F.lit(None).cast("string") if agency_code is None else (
        F.lit(agency_code) if isinstance(agency_code, str) else agency_code)
    owned = [
        nid.alias("noticeId"),
        F.col("title"),
        F.col("solicitationNumber"),
        T.normalize_date("postedDate").alias("postedDate"),
        F.col("type"),
        F.col("setAside"),
        T.blank("naicsCode").alias("naicsCode"),
        F.col("fullParentPathName"),
        F.col("fullParentPathCode"),
        T.agency_label(code).alias("agencyCodeQueried"),
        F.lit(pulled_at).alias("apiPulledAtUTC"),
        T.opp_url(nid).alias("oppUrl"),
        T.normalize_date("responseDeadLine").alias("deadline"),
    ]
    extra = [F.col(c) for c in keep if c in items.columns]
    return items.select(*owned, *extra)


def fresh_projection(items: DataFrame) -> DataFrame:
    """The re-check view of a fresh notice (blank-coalesced)."""
    return items.select(
        T.blank("noticeId").alias("noticeId"),
        F.coalesce(F.col("title"), F.lit("")).alias("title"),
        T.blank("naicsCode").alias("naicsCode"),
        F.coalesce(F.col("type"), F.lit("")).alias("type"),
        T.normalize_date("responseDeadLine").alias("deadline"),
        T.normalize_date("postedDate").alias("postedDate"),
        F.col("ord"),
    )


def accepted_notices(items: DataFrame, master: DataFrame, settings: JobSettings, pulled_at: str,
                     agency_col: str | None = None) -> DataFrame:
    """Feed A up to the cap: F1..F5 -> W1 -> J1 -> W10 -> P1 (unsorted).

    Filters run first (a repeat whose first copy failed a filter is still
    accepted), then first-wins per id, then the anti-join against the
    master, then the strict cap in arrival order.
    """
    keyed = items.withColumn("_nid", T.blank("noticeId"))
    passed = filters.filter_notices(
        keyed, settings.excluded_prefixes, settings.excluded_codes, settings.excluded_departments)
    firsts = dedup.first_wins(passed, ["_nid"], "ord")
    master_keys = dedup.key_set(master, "noticeId", out_col="_nid")
    fresh = firsts.join(master_keys, on="_nid", how="left_anti")
    capped = dedup.strict_cap(fresh, settings.max_records, "ord")
    agency = F.col(agency_col) if agency_col else None
    return project_notice(capped.drop("_nid"), agency, pulled_at)


def sort_batch(batch: DataFrame, with_position: bool = True) -> DataFrame:
    """O1: newest ``postedDate`` first; ties keep arrival order."""
    return dedup.stable_order(batch, [F.col("postedDate").desc(), F.col("ord").asc()],
                              "row_pos" if with_position else None)
