"""URL and link queries over ``pages`` (feed B's link rules on web pages)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidlake.functions import urls as U
from bidlake.operators import links
from bidlake.sources import standins as S

# --- fixed values -----------------------------------------------------------
# Stand-in bindings: page anchors are short site-relative links, so the
# title minimum is bound to 4 characters here (15 in the mail feed), the
# second publisher's listing section is prefixed to every path, and page
# URLs are wrapped in the first publisher's tracker.
PAGES_MIN_TITLE_LEN = 4
DA_LISTING_BASE = "https://developmentaid.org/tenders"
TRACKER_BASE = "https://track.pstmrk.it/3s/"
# ---------------------------------------------------------------------------


def clean_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X15 on every page URL."""
    pages = S.table(spark, sf_dir, "pages")
    return pages.select("page_id", U.clean_url("url").alias("clean_url"))


def tracking_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracker-wrapped page URLs decoded back."""
    pages = S.table(spark, sf_dir, "pages")
    wrapped = F.concat(F.lit(TRACKER_BASE), F.url_encode("url"))
    return pages.select("page_id", U.decode_tracking_url(wrapped).alias("decoded"))


def url_deny_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F6/F7/F8 verdicts for every page URL (1 = matches)."""
    pages = S.table(spark, sf_dir, "pages")
    return pages.select(
        "page_id",
        U.devex_skip("url").cast("int").alias("devex_skip"),
        U.da_skip("url").cast("int").alias("da_skip"),
        U.da_listing("url").cast("int").alias("da_listing"),
    )


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every anchor of every page, in document order."""
    return links.anchors(S.table(spark, sf_dir, "pages")).select(
        "page_id", "link_pos", "href", F.col("text").alias("title"))


def link_dedup_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F6 + F9..F11 + W3 on page anchors."""
    found = links.devex_listings(links.anchors(S.table(spark, sf_dir, "pages")), PAGES_MIN_TITLE_LEN)
    return found.select("page_id", "link_pos", "url", "title")


def link_dedup_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7 + F8 + F9 + X15 + W4 on page anchors placed under a listing section."""
    a = links.anchors(S.table(spark, sf_dir, "pages"))
    a = a.withColumn("href", F.concat(F.lit(DA_LISTING_BASE), F.col("href")))
    found = links.da_listings(a, PAGES_MIN_TITLE_LEN)
    return found.select("page_id", "link_pos", "url", "title")


def _page_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = S.table(spark, sf_dir, "pages")
    return pages.select(F.col("page_id").cast("string").alias("doc_id"), F.lit("").alias("subject"), F.col("html"))


def dom_page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every anchor via the DOM facts (parser path); must agree with ``page_links``."""
    from bidlake.functions import text as T
    from bidlake.operators import html

    a = html.anchors(html.dom_facts(_page_docs(spark, sf_dir), materialize=False)[0])  # read once
    return a.select(F.col("doc_id").cast("bigint").alias("page_id"), F.col("link_seq").cast("bigint").alias("link_pos"),
                    "href", T.collapse_ws("text").alias("title"))


def dom_devex_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5 over pages through the DOM facts (title row metadata is '' where pages have no tables)."""
    from bidlake.operators import extract, html

    docs = _page_docs(spark, sf_dir)
    out = extract.devex_listings(*html.dom_facts(docs), docs, PAGES_MIN_TITLE_LEN)
    return out.withColumn("doc_id", F.col("doc_id").cast("bigint")).withColumnRenamed("doc_id", "page_id")


def dom_da_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P6 over pages through the DOM facts, anchors placed under a listing section;
    scoping to the "Open" section (F13) applies where a page's text says open."""
    from bidlake.operators import extract, html

    docs = _page_docs(spark, sf_dir)
    nodes, strings = html.dom_facts(docs)
    nodes = nodes.withColumn("href", F.concat(F.lit(DA_LISTING_BASE), "href"))
    out = extract.da_listings(nodes, strings, docs, S.STANDIN_RUN_DATE, PAGES_MIN_TITLE_LEN)
    return out.withColumn("doc_id", F.col("doc_id").cast("bigint")).withColumnRenamed("doc_id", "page_id")
