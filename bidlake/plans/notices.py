"""Feeds A (notices) and C (re-check) as lazy plans over the stand-in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidlake.functions import text as T
from bidlake.operators import dedup, filters, notices, recheck
from bidlake.settings import NOTICE_COLUMNS, JobSettings
from bidlake.sources import standins as S
from bidlake.sources import tables

STANDIN_SETTINGS = JobSettings(excluded_departments=S.STANDIN_DEPARTMENTS)
# Cap used where the cap itself is the feature under test (ten pages of 200).
TEN_PAGES = 2000


def notice_ingest(spark: SparkSession, sf_dir: str, settings: JobSettings = STANDIN_SETTINGS) -> DataFrame:
    """Flagship: F1..F5 -> W1 -> J1 -> W10 -> O1 -> P1, one lazy plan.

    Output: the 13 owned columns in table order plus the 1-based position
    of each row in the inserted batch (newest posting first).
    """
    items = S.notice_items(spark, sf_dir)
    master = S.notice_master(spark, sf_dir)
    batch = notices.accepted_notices(items, master, settings, S.STANDIN_RUN_TS)
    ordered = notices.sort_batch(batch)
    return ordered.select(*NOTICE_COLUMNS, "row_pos")


def _keyed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.notice_items(spark, sf_dir).select(
        "ord", T.blank("noticeId").alias("noticeId"), T.blank("naicsCode").alias("naicsCode"),
        "fullParentPathName", "postedDate", "title", "organizationCode")


def sector_prefix_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 alone: items whose code is blank or outside every excluded sector."""
    items = _keyed_items(spark, sf_dir)
    c = F.col("naicsCode")
    keep = (c == "") | filters.sector_allowed(c, STANDIN_SETTINGS.excluded_prefixes)
    return items.where(keep).select("ord", "noticeId", "naicsCode")


def exact_code_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3 + F4: blank codes kept; exact excluded codes dropped (no prefix match)."""
    items = _keyed_items(spark, sf_dir)
    c = F.col("naicsCode")
    keep = (c == "") | ~c.isin(list(STANDIN_SETTINGS.excluded_codes))
    return items.where(keep).select("ord", "noticeId", "naicsCode")


def department_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F5 + J3: top department anti-joined (broadcast) with the exclusion table."""
    items = _keyed_items(spark, sf_dir)
    excluded = spark.createDataFrame([(d,) for d in STANDIN_SETTINGS.excluded_departments], "department string")
    kept = filters.filter_departments_by_table(items, excluded)
    return kept.select("ord", "noticeId", "fullParentPathName")


def lookback_window(spark: SparkSession, sf_dir: str, days_back: int = STANDIN_SETTINGS.days_back) -> DataFrame:
    """S3: items posted within ``days_back`` days up to the run date."""
    items = _keyed_items(spark, sf_dir)
    return items.where(filters.lookback("postedDate", S.STANDIN_RUN_DATE, days_back)).select(
        "ord", "noticeId", T.normalize_date("postedDate").alias("postedDate"))


SOURCE_QUERY = {"posted_from": "1997-01-01", "posted_to": "1997-12-31", "organization_code": "1", "keyword": "urgent"}


def source_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posted window + organisation code + title keyword."""
    items = _keyed_items(spark, sf_dir)
    out = filters.source_predicates(items, **SOURCE_QUERY)
    return out.select("ord", "noticeId", "title", "organizationCode")


def first_wins_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1..F5 then W1: the first passing copy of every id (late copies win
    when the first copy failed a filter)."""
    items = S.notice_items(spark, sf_dir).withColumn("_nid", T.blank("noticeId"))
    passed = filters.filter_notices(items, STANDIN_SETTINGS.excluded_prefixes, STANDIN_SETTINGS.excluded_codes,
                                    STANDIN_SETTINGS.excluded_departments)
    firsts = dedup.first_wins(passed, ["_nid"], "ord")
    return firsts.select("ord", F.col("_nid").alias("noticeId"), T.blank("naicsCode").alias("naicsCode"))


def anti_join_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with a non-blank id that the master does not hold yet."""
    items = S.notice_items(spark, sf_dir).where(filters.non_blank_id()).withColumn("noticeId", T.blank("noticeId"))
    master = S.notice_master(spark, sf_dir)
    return dedup.anti_join_master(items, master, "noticeId").select("ord", "noticeId")


def strict_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The accepted batch capped at ten pages, in arrival order."""
    settings = JobSettings(excluded_departments=S.STANDIN_DEPARTMENTS, max_records=TEN_PAGES)
    items = S.notice_items(spark, sf_dir)
    master = S.notice_master(spark, sf_dir)
    batch = notices.accepted_notices(items, master, settings, S.STANDIN_RUN_TS)
    return batch.select("ord", "noticeId", "postedDate")


def stable_sort_pages(spark: SparkSession, sf_dir: str, page_size: int = STANDIN_SETTINGS.page_size) -> DataFrame:
    """O1 + O2: the capped batch in insert order, labelled with page and slot."""
    items = S.notice_items(spark, sf_dir)
    master = S.notice_master(spark, sf_dir)
    batch = notices.sort_batch(notices.accepted_notices(items, master, STANDIN_SETTINGS, S.STANDIN_RUN_TS))
    return batch.select(
        "noticeId", "postedDate", "row_pos",
        F.floor((F.col("row_pos") - 1) / page_size).cast("bigint").alias("page"),
        ((F.col("row_pos") - 1) % page_size).cast("bigint").alias("slot"),
    )


def _accepted_by_agency(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = S.notice_items(spark, sf_dir)
    master = S.notice_master(spark, sf_dir)
    return notices.accepted_notices(items, master, STANDIN_SETTINGS, S.STANDIN_RUN_TS, agency_col="organizationCode")


def agency_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: accepted rows per queried agency, every agency present (0 if none)."""
    from bidlake.operators import aggregates

    return aggregates.per_agency_counts(_accepted_by_agency(spark, sf_dir), S.agency_codes(spark, sf_dir))


def run_log_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S16 + A2: the run's audit row (window, agencies, new rows, notes)."""
    from bidlake.operators import aggregates

    codes = S.agency_codes(spark, sf_dir)
    counts = aggregates.per_agency_counts(_accepted_by_agency(spark, sf_dir), codes)
    return aggregates.run_log_row(counts, S.STANDIN_RUN_DATE, S.STANDIN_RUN_TS,
                                  STANDIN_SETTINGS.days_back, keyword=None)


def schema_evolution_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S12 + P2 + S13: an older master (without deadline/oppUrl) evolved by
    name to hold the new batch; foreign columns kept, missing cells ''."""
    old_master = S.notice_master(spark, sf_dir).drop("deadline", "oppUrl")
    items = S.notice_items(spark, sf_dir)
    batch = notices.accepted_notices(items, S.notice_master(spark, sf_dir), STANDIN_SETTINGS, S.STANDIN_RUN_TS)
    header = tables.evolve_header(old_master.columns, NOTICE_COLUMNS)
    return tables.union_aligned(old_master, batch, header)


# --- feed C --------------------------------------------------------------------

def _recheck_inputs(spark: SparkSession, sf_dir: str):
    return S.notice_master(spark, sf_dir), S.fresh_items(spark, sf_dir)


def recheck_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4 + W8: the first in-window fresh record of every high-priority row."""
    master, fresh = _recheck_inputs(spark, sf_dir)
    m = recheck.matched_fresh(master, fresh, S.STANDIN_RUN_DATE)
    return m.select("noticeId", F.col("_mposted").alias("postedDate"), "fresh_ord",
                    *[f"fresh_{c}" for c in ("title", "naicsCode", "type", "deadline")])


def recheck_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per high row, matched flag and the changed fields (comma-joined)."""
    master, fresh = _recheck_inputs(spark, sf_dir)
    d = recheck.diff(master, recheck.matched_fresh(master, fresh, S.STANDIN_RUN_DATE))
    return d.select("noticeId", "postedDate", F.col("matched").cast("int").alias("matched"),
                    F.array_join("changed_fields", ",").alias("changed_fields"))


def recheck_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole master after the re-check (updated rows, cleared reviews)."""
    master, fresh = _recheck_inputs(spark, sf_dir)
    return recheck.upsert(master, fresh, S.STANDIN_RUN_DATE)


def recheck_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: checked / updated."""
    master, fresh = _recheck_inputs(spark, sf_dir)
    return recheck.counts(master, fresh, S.STANDIN_RUN_DATE)



# --- end-to-end runs over landed files ------------------------------------------

def ingest_landed_notices(spark: SparkSession, landing: str, master_path: str, run_log_path: str,
                          settings: JobSettings, run_date: str, run_ts: str, batch_id: int,
                          codes: DataFrame | None = None) -> dict:
    """Feed A end to end: landed pages -> filters/dedup/anti-join/cap -> sorted
    batch appended to the master -> run-log row.  Returns the run's counters.

    The accepted batch is written once; the counts and the log are computed
    from the written partition, so the plan runs once.
    """
    from bidlake.operators import aggregates
    from bidlake.settings import RUN_LOG_COLUMNS
    from bidlake.sources import notices as landed

    master = tables.open_or_create(spark, master_path, NOTICE_COLUMNS)
    if tables.BATCH_COL in master.columns:
        # a retried batch must not see its own earlier attempt
        master = master.where(F.col(tables.BATCH_COL) != batch_id)
    header = tables.evolve_header([c for c in master.columns if c != tables.BATCH_COL], NOTICE_COLUMNS)
    raw = landed.items(landed.read_pages(spark, landing))
    window = raw.where(filters.lookback("postedDate", run_date, settings.days_back))
    if settings.keyword:
        window = window.where(F.lower(F.coalesce(F.col("title"), F.lit(""))).contains(settings.keyword.lower()))
    agency_col = "organizationCode" if settings.agency_codes else None
    batch = notices.accepted_notices(window, master, settings, run_ts, agency_col=agency_col)
    ordered = notices.sort_batch(batch, with_position=settings.max_records is not None)
    tables.append_batch(ordered, master_path, header, batch_id)

    stored = tables.open_or_create(spark, master_path, [*header, tables.BATCH_COL])
    written = stored.where(F.col(tables.BATCH_COL) == batch_id)
    if codes is None:
        seeded = [(i, c) for i, c in enumerate(settings.agency_codes)] or [(0, "ALL")]
        codes = spark.createDataFrame(seeded, "code_seq bigint, agencyCode string")
    counts = aggregates.per_agency_counts(written, codes)
    log = aggregates.run_log_row(counts, run_date, run_ts, settings.days_back, settings.keyword,
                                 unrestricted=not settings.agency_codes)
    tables.append_run_log(log, run_log_path, batch_id)
    row = log.first()
    return {c: row[c] for c in RUN_LOG_COLUMNS}


LANDED_AGENCIES = ("0", "1", "2", "3", "4")


def standin_pages(spark: SparkSession, sf_dir: str, page_size: int = STANDIN_SETTINGS.page_size) -> DataFrame:
    """The stand-in notices as page envelopes."""
    from pyspark.sql import Window

    from bidlake.sources import notices as landed

    items = S.notice_items(spark, sf_dir)
    # arrival order inside each agency's result list = the stand-in ordinal
    pos = F.row_number().over(Window.partitionBy("organizationCode").orderBy("ord")) - 1
    shaped = items.select(F.col("organizationCode").cast("int").alias("agency_seq"),
                          F.col("organizationCode").alias("agency_code"), pos.alias("pos"), *landed.ITEM_FIELDS)
    return landed.landing_pages_from(shaped, page_size)


def land_standin_pages(spark: SparkSession, sf_dir: str, page_size: int = STANDIN_SETTINGS.page_size) -> str:
    """Write the stand-in notices as landed JSON pages (one folder per call,
    under the session's shared checkpoint folder); returns the folder."""
    path = _scratch_path(spark, "landing-notices")
    standin_pages(spark, sf_dir, page_size).write.json(path)
    return path


def _scratch_path(spark: SparkSession, name: str) -> str:
    import os
    import uuid

    from bidlake.session import checkpoint_dir

    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


def lookback_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 + S3 over a landing by posted day: a window of seven days reads eight folders."""
    from datetime import date, timedelta

    from bidlake.sources import notices as landed

    path = _scratch_path(spark, "landing-days")
    raw = S.notice_items(spark, sf_dir).select("ord", "noticeId", "postedDate")
    landed.land_by_day(raw, path)
    start = (date.fromisoformat(S.STANDIN_RUN_DATE) - timedelta(days=STANDIN_SETTINGS.days_back)).isoformat()
    return landed.landed_days(spark, path, raw.schema, start, S.STANDIN_RUN_DATE)


def recheck_table(spark: SparkSession, table_path: str, fresh_items: DataFrame, run_date: str) -> dict:
    """Feed C end to end over a stored table: read, compare, rewrite the touched batches alone, publish.

    Returns checked and updated.  A table without the needed columns is left
    as it is; a second run finds nothing to update.
    """
    from bidlake.session import stored
    from bidlake.sources import tables

    master = tables.open_or_create(spark, table_path, NOTICE_COLUMNS)
    if not recheck.has_needed_columns(master):
        return {"checked": 0, "updated": 0}
    found = stored(recheck.diff(master, recheck.matched_fresh(master, fresh_items, run_date)).select("changed", tables.BATCH_COL))
    per_batch = found.groupBy(tables.BATCH_COL).agg(F.count("*").alias("checked"), F.count_if("changed").alias("updated")).collect()  # a row a batch
    touched = sorted(r[tables.BATCH_COL] for r in per_batch if r["updated"])
    if touched:
        part = master.where(F.col(tables.BATCH_COL).isin(touched))
        tables.rewrite_batches(recheck.upsert(part, fresh_items, run_date), table_path, touched)
    return {"checked": sum(r["checked"] for r in per_batch), "updated": sum(r["updated"] for r in per_batch)}


def recheck_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8 + S11 + S15 + J4 + J7: the re-check run over a stored master (a batch a posted year), read back."""
    from bidlake.sources import tables

    master, fresh = _recheck_inputs(spark, sf_dir)
    path = _scratch_path(spark, "master")
    master.withColumn(tables.BATCH_COL, F.substring("postedDate", 1, 4).cast("bigint")).write.partitionBy(tables.BATCH_COL).parquet(path)
    recheck_table(spark, path, fresh, S.STANDIN_RUN_DATE)
    return tables.open_or_create(spark, path, master.columns).select(*master.columns)


def landed_notice_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + X23 + S3 + feed A: landed JSON pages walked, flattened and run
    through filters, first-wins, anti-join, cap and ordering (per-agency
    counts come from ``organizationCode``)."""
    from bidlake.sources import notices as landed

    path = land_standin_pages(spark, sf_dir)
    raw = landed.items(landed.read_pages(spark, path))
    window = raw.where(filters.lookback("postedDate", S.STANDIN_RUN_DATE, STANDIN_SETTINGS.days_back))
    settings = JobSettings(excluded_departments=S.STANDIN_DEPARTMENTS, agency_codes=LANDED_AGENCIES)
    batch = notices.accepted_notices(window, S.notice_master(spark, sf_dir), settings, S.STANDIN_RUN_TS,
                                     agency_col="organizationCode")
    return notices.sort_batch(batch).select(*NOTICE_COLUMNS, "row_pos")
