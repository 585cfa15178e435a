"""Feed B (alert e-mails), relational half, as lazy plans over the stand-ins."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidlake.functions import normalize as N
from bidlake.operators import dedup, mail
from bidlake.settings import PIPELINE_COLUMNS
from bidlake.sources import standin_mail as SM
from bidlake.sources import standins as S
from bidlake.sources.standin_mail import base64url


def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X5 over whole documents."""
    docs = S.table(spark, sf_dir, "documents")
    return docs.select("doc_id", N.normalize_text("text").alias("normalized"))


def language_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X8 over whole documents."""
    docs = S.table(spark, sf_dir, "documents")
    return docs.select("doc_id", N.infer_language("text").alias("language"))


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mail.enrich(S.mail_opportunities(spark, sf_dir), S.STANDIN_RUN_DATE, S.STANDIN_RUN_TS)


def _mail_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The opportunity table already holding the good-quality documents,
    stored once (a real table is read, not recomputed)."""
    from bidlake.session import cut_lineage

    docs = S.mail_master_docs(spark, sf_dir)
    opps = docs.select(
        F.col("doc_id").alias("ord"),
        F.when(F.col("lang").isin("en", "de"), F.lit("devex")).otherwise(F.lit("developmentaid")).alias("mailSource"),
        F.col("text").alias("opportunityTitle"), F.col("lang").alias("donorClient"),
        F.col("source").alias("countryRegion"))
    return cut_lineage(mail.enrich(opps, S.STANDIN_RUN_DATE, S.STANDIN_RUN_TS).select(*PIPELINE_COLUMNS))


def duplicate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X6 + X7: the duplicate key of every incoming opportunity."""
    e = _enriched(spark, sf_dir)
    return e.select("ord", "source", "duplicateKey")


def mail_append_classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 + J2: each incoming row is new, a repeat of the table, or a repeat within the run."""
    e = _enriched(spark, sf_dir)
    c = dedup.classify_append(e, _mail_master(spark, sf_dir), "duplicateKey", "ord")
    return c.select("ord", "appendStatus")


def mail_new_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3 + S14: the rows the append writes, in the table's 20 columns."""
    e = _enriched(spark, sf_dir)
    return dedup.new_rows(e, _mail_master(spark, sf_dir), "duplicateKey", "ord").select("ord", *PIPELINE_COLUMNS)


def append_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: appended / skipped / total_processed."""
    e = _enriched(spark, sf_dir)
    return dedup.append_summary(e, _mail_master(spark, sf_dir), "duplicateKey", "ord")


# --- end-to-end runs over landed mail -------------------------------------------

def extract_records(recs: DataFrame, run_date: str) -> DataFrame:
    """P5/P6 per record by source, then U2: the extracted opportunities of all
    records with arrival ordinal (source_seq, message_seq, message_id, link_pos)."""
    from bidlake.operators import extract, html
    from bidlake.session import stored

    docs = recs.select(
        F.concat_ws(":", "source", "message_id").alias("doc_id"), "subject",
        F.col("html_body").alias("html"), "source", "message_id", "email_date", "source_seq",
        F.coalesce("message_seq", F.lit((1 << 62))).alias("message_seq"))
    # read four times below (facts, two publishers, context): decode the bodies once
    docs = stored(docs.where(F.col("html") != ""))
    nodes, strings = html.dom_facts(docs)
    devex_docs = docs.where(F.col("source") == "devex")
    da_docs = docs.where(F.col("source") == "developmentaid")
    dx = extract.devex_listings(nodes, strings, devex_docs)
    da = extract.da_listings(nodes, strings, da_docs, run_date)
    opps = dx.unionByName(da, allowMissingColumns=True)
    ctx = docs.select("doc_id", F.col("source").alias("mailSource"), F.col("email_date").alias("emailDate"),
                      F.col("subject").alias("emailSubject"), "source_seq", "message_seq", "message_id").hint("merge")
    out = opps.join(ctx, "doc_id")
    return out.withColumn("ord", F.struct("source_seq", "message_seq", "message_id", "link_pos"))


def ingest_landed_mail(spark: SparkSession, messages_path: str, parts_path: str, table_path: str,
                       run_date: str, run_ts: str, batch_id: int, days: int = 7, limit: int | None = None,
                       source_filter: str = "all", index_path: str | None = None) -> dict:
    """Feed B end to end: search -> fetch -> extract -> enrich -> first-wins
    append against the opportunity table.  Returns appended/skipped/total.

    The counts are observed on the append itself, so the batch is computed once.
    With ``index_path`` phrases are looked up in the word index of the landing.
    """
    from bidlake.sources import mail as mail_src
    from bidlake.sources import mail_index, tables

    index = mail_index.read_index(spark, index_path) if index_path else None
    recs = mail_src.fetch(mail_src.read_messages(spark, messages_path), mail_src.read_parts(spark, parts_path),
                          run_date, days, limit, source_filter, index=index)
    enriched = mail.enrich(extract_records(recs, run_date), run_date, run_ts)
    master = tables.open_or_create(spark, table_path, PIPELINE_COLUMNS)
    if tables.BATCH_COL in master.columns:
        master = master.where(F.col(tables.BATCH_COL) != batch_id)
    header = tables.evolve_header([c for c in master.columns if c != tables.BATCH_COL], PIPELINE_COLUMNS)
    return dedup.append_new(enriched, master, lambda fresh: tables.append_batch(fresh, table_path, header, batch_id))


def dry_run(spark: SparkSession, messages_path: str, parts_path: str, run_date: str, run_ts: str,
            days: int = 7, limit: int | None = None, source_filter: str = "all") -> tuple[dict, DataFrame]:
    """Counts and the 30-row preview; nothing is written."""
    from bidlake.settings import PREVIEW_ROWS
    from bidlake.sources import mail as mail_src

    recs = mail_src.fetch(mail_src.read_messages(spark, messages_path), mail_src.read_parts(spark, parts_path),
                          run_date, days, limit, source_filter)
    enriched = mail.enrich(extract_records(recs, run_date), run_date, run_ts)
    counts = {"emails": recs.count(), "opportunities": enriched.count()}
    counts["more"] = max(counts["opportunities"] - PREVIEW_ROWS, 0)
    from bidlake.functions.text import fixed_width
    from bidlake.plans.parts import PREVIEW_WIDTHS

    first = enriched.orderBy("ord").limit(PREVIEW_ROWS)
    cells = [fixed_width(c, cut, width).alias(c) for c, (cut, width) in PREVIEW_WIDTHS.items()]
    return counts, first.orderBy("ord").select(*cells)


def mail_source_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: messages and extracted opportunities per source."""
    from bidlake.operators import aggregates

    opps = S.mail_opportunities(spark, sf_dir)
    per = aggregates.per_source_totals(opps, "mailSource").withColumnRenamed("n", "opportunities")
    msgs = opps.groupBy("mailSource").agg(
        F.count_distinct(F.col("ord") % F.lit(S.COPY_STRIDE)).cast("bigint").alias("messages"))
    return per.join(msgs, "mailSource").withColumnRenamed("mailSource", "source")


# --- pages landed as alert mail (feed B from files, end to end) --------------------

MAIL_RUN_DATE = "2026-07-16"
MAIL_RUN_TS = "2026-07-16T12:00:00+00:00"
MAIL_DATE_HEADER = "Thu, 16 Jul 2026 08:00:00 -0500"
MAIL_SENDER = "Devex Alerts <alerts@devex.com>"
SUBJECT_PREFIX = "Business Alert: "
TITLE_PATTERN = r"(?is)<title>(.*?)</title>"


def land_pages_as_mail(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Every page as one alert e-mail of the first publisher: headers plus a
    three-part MIME tree (container, plain-text URL, HTML body), landed as
    JSON under the shared checkpoint folder."""
    import os
    import uuid

    from bidlake.session import checkpoint_dir

    pages = S.table(spark, sf_dir, "pages")
    mid = F.col("page_id").cast("string")
    subject = F.concat(F.lit(SUBJECT_PREFIX), F.regexp_extract(F.coalesce("html", F.lit("")), TITLE_PATTERN, 1))
    hdr = lambda n, v: F.struct(F.lit(n).alias("name"), v.alias("value"))
    messages = pages.select(
        F.lit(None).cast("string").alias("source"), mid.alias("id"),
        F.array(hdr("Subject", subject), hdr("From", F.lit(MAIL_SENDER)), hdr("Date", F.lit(MAIL_DATE_HEADER)))
        .alias("headers"))
    part = lambda seq, mime, body: F.struct(
        mid.alias("message_id"), F.lit(seq).alias("part_seq"), F.lit(mime).alias("mime_type"), body.alias("body_b64"))
    parts = pages.select(F.explode(F.array(
        part(0, "multipart/alternative", F.lit("")),
        part(1, "text/plain", base64url(F.col("url"))),
        part(2, "text/html", base64url(F.col("html"))),
    )).alias("p")).select("p.*")
    base = os.path.join(checkpoint_dir(spark), f"landing-mail-{uuid.uuid4().hex}")
    messages.write.json(os.path.join(base, "messages"))
    parts.write.json(os.path.join(base, "parts"))
    return os.path.join(base, "messages"), os.path.join(base, "parts")


def mail_pipeline_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4..S7 + X21/X22 + P5 + P3 + W2/J2: landed mail -> rows appended to an
    empty opportunity table, with their arrival position."""
    from bidlake.sources import mail as mail_src

    mp, pp = land_pages_as_mail(spark, sf_dir)
    recs = mail_src.fetch(mail_src.read_messages(spark, mp), mail_src.read_parts(spark, pp), MAIL_RUN_DATE, 7,
                          None, "devex")
    enriched = mail.enrich(extract_records(recs, MAIL_RUN_DATE), MAIL_RUN_DATE, MAIL_RUN_TS)
    empty = spark.createDataFrame([], "duplicateKey string")
    fresh = dedup.new_rows(enriched, empty, "duplicateKey", "ord")
    return fresh.select(F.col("ord.message_id").alias("message_id"), F.col("ord.link_pos").alias("link_pos"),
                        *PIPELINE_COLUMNS)


# --- the stand-in mailbox: listings of both publishers, known by construction ------

def _landed_records(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    from bidlake.sources import mail as mail_src

    messages, parts = SM.land(spark, sf_dir)
    return mail_src.fetch(mail_src.read_messages(spark, messages), mail_src.read_parts(spark, parts), SM.RUN_DATE, 7, None, source)


def _listing_docs(recs: DataFrame) -> DataFrame:
    from bidlake.session import stored

    return stored(recs.select(F.col("message_id").alias("doc_id"), "subject", F.col("html_body").alias("html")).where("html != ''"))


def mail_listings_devex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4..S7 + P5 (F6, F9..F11, W3, J5, W5, X12, X14, X16, X17): the first publisher's listings."""
    from bidlake.operators import extract, html

    docs = _listing_docs(_landed_records(spark, sf_dir, "devex"))
    return extract.devex_listings(*html.dom_facts(docs), docs).withColumnRenamed("doc_id", "message_id")


def mail_listings_da(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4..S7 + P6 (F7..F9, F13, W4, W6, A8, X12, X13, X15, X18..X20): the second publisher's listings."""
    from bidlake.operators import extract, html

    docs = _listing_docs(_landed_records(spark, sf_dir, "developmentaid"))
    return extract.da_listings(*html.dom_facts(docs), docs, SM.RUN_DATE).withColumnRenamed("doc_id", "message_id")


def _listing_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bidlake.session import stored

    return stored(mail.enrich(extract_records(_landed_records(spark, sf_dir, "all"), SM.RUN_DATE), SM.RUN_DATE, SM.RUN_TS))


def mail_pipeline_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U2 + P3 + X6 + X7 + W2: both sources in one run, the rows appended to an empty table with their place."""
    enriched = _listing_batch(spark, sf_dir)
    fresh = dedup.new_rows(enriched, spark.createDataFrame([], "duplicateKey string"), "duplicateKey", "ord")
    return fresh.select(F.col("ord.message_id").alias("message_id"), F.col("ord.link_pos").alias("link_pos"), *PIPELINE_COLUMNS)


def mail_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S19 + A3 + S14: the whole run over the stand-in mailbox into a new table, counted on the write."""
    import os
    import uuid

    from bidlake.session import checkpoint_dir

    messages, parts = SM.land(spark, sf_dir)
    table = os.path.join(checkpoint_dir(spark), f"opportunities-{uuid.uuid4().hex}")
    counts = ingest_landed_mail(spark, messages, parts, table, SM.RUN_DATE, SM.RUN_TS, 1)
    return spark.createDataFrame([tuple(counts[c] for c in ("appended", "skipped", "total_processed"))], "appended bigint, skipped bigint, total_processed bigint")


# --- phrase search over a word index ------------------------------------------------

PHRASES = ["of the", "De  la", "to be", "the the", "die", "no such phrase of words"]


def land_documents_as_mail(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Every document as a mail of its own: the source as subject, the whole text as one text part, received
    up to nine days before the run; every thirteenth tells no day."""
    docs = S.table(spark, sf_dir, "documents").where("doc_id is not null")
    mid = F.col("doc_id").cast("string")
    day = F.date_sub(F.to_date(F.lit(MAIL_RUN_DATE)), (F.col("doc_id") % 10).cast("int")).cast("string")
    header = lambda n, v: F.struct(F.lit(n).alias("name"), v.alias("value"))
    messages = docs.select(
        F.lit(None).cast("string").alias("source"), mid.alias("id"), F.col("doc_id").alias("message_seq"),
        F.when(F.col("doc_id") % 13 != 0, day).alias("received"), F.array(header("Subject", F.col("source")), header("From", F.lit(""))).alias("headers"))
    parts = docs.select(mid.alias("message_id"), F.lit(1).alias("part_seq"), F.lit("text/plain").alias("mime_type"), base64url(F.col("text")).alias("body_b64"))
    return messages, parts


def mail_phrase_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of a week with each phrase in their whole texts, and how often, from the word index."""
    import os
    import uuid

    from bidlake.session import checkpoint_dir
    from bidlake.sources import mail_index

    path = os.path.join(checkpoint_dir(spark), f"words-{uuid.uuid4().hex}")
    mail_index.land_index(*land_documents_as_mail(spark, sf_dir), path)
    since = (date.fromisoformat(MAIL_RUN_DATE) - timedelta(days=7)).isoformat()
    return mail_index.phrase_places(mail_index.read_index(spark, path), PHRASES, since)
