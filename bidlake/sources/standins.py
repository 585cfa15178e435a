"""Bindings of the driver's tables to the engine's inputs.

There is no notice feed or mailbox offline, so the engine's inputs are
derived, by Spark, from the given tables; every derived view scales with
them.  Each binding is mirrored by SQL in ``bidlake.plans.oracle`` so the
same view can be rebuilt by an independent engine.

* notices      = orders x customer x nation x region (plus a re-sent copy of
                 the open orders, later in arrival order and re-coded)
* master       = the finished orders, already ingested and partly reviewed
* fresh        = what the notice source returns today (amended, moved, gone)
* mail opps    = documents (plus a second alert for the labelled ones)
* links / urls = pages.html anchors / pages.url
* parts        = conversations (message = conv, part = turn, mime = role)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Industry codes assigned to stand-in notices by ``(o_orderkey + 7*copy) % 41``.
# Covers excluded sectors, exact exclusions, the 56211/562112 pair, a blank,
# a NULL and a padded code.
STANDIN_CODES: tuple[str | None, ...] = (
    "541611", "236220", "562111", "562112", "56211", "541330", "", None, "111110", "211120",
    "221310", "311111", "325412", "336411", "423430", "441110", "454110", "484110", "492110", "522110",
    "531120", "551111", "621111", "711110", "722511", "541519", "541512", "561210", "561320", "518210",
    " 541690 ", "611430", "811212", "928110", "541715", "517111", "541810", "488190", "332994", "524210",
    "921190",
)
# Departments excluded in the stand-in (regions play the departments).
STANDIN_DEPARTMENTS: tuple[str, ...] = ("ASIA", "MIDDLE EAST")
# Run instants used by the registered queries over the stand-ins.
STANDIN_RUN_DATE = "1998-08-02"
STANDIN_RUN_TS = "1998-08-02T00:00:00+00:00"
MASTER_PULLED_TS = "1998-01-01T00:00:00+00:00"
COPY_STRIDE = 1_000_000_000_000
# ---------------------------------------------------------------------------

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, read by Spark as it is."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _code_at(idx: Column) -> Column:
    codes = F.array(*[F.lit(c).cast("string") for c in STANDIN_CODES])
    return F.try_element_at(codes, (idx + F.lit(1)).cast("int"))


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders with segment, nation and region (nation/region: fixed 25/5 rows -> broadcast)."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey"))
    region = F.broadcast(table(spark, sf_dir, "region").select("r_regionkey", "r_name"))
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )


def _notice_item(facts: DataFrame, copy_no: int) -> DataFrame:
    """One raw notice item (source field names, un-normalised) per order."""
    key = F.col("o_orderkey")
    prio = F.col("o_orderpriority")
    raw_id = (
        F.when((prio == "5-LOW") & (F.col("o_orderstatus") == "P"), F.lit(""))
        .when(prio == "3-MEDIUM", F.concat(F.lit(" "), key.cast("string"), F.lit(" ")))
        .otherwise(key.cast("string"))
    )
    return facts.select(
        (F.lit(copy_no).cast("bigint") * F.lit(COPY_STRIDE) + key).alias("ord"),
        key.alias("o_orderkey"),
        raw_id.alias("noticeId"),
        F.concat_ws(" ", "c_mktsegment", "o_orderpriority").alias("title"),
        F.concat(F.lit("SOL-"), F.col("o_custkey").cast("string")).alias("solicitationNumber"),
        F.col("o_orderdate").cast("string").alias("postedDate"),
        (F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")).cast("string").alias("responseDeadLine"),
        F.col("o_orderstatus").alias("type"),
        F.when(prio == "1-URGENT", F.lit("SBA")).otherwise(F.lit(None).cast("string")).alias("setAside"),
        _code_at((key + F.lit(7 * copy_no)) % 41).alias("naicsCode"),
        F.concat_ws(".", "r_name", "n_name").alias("fullParentPathName"),
        F.concat_ws(".", F.col("n_regionkey").cast("string"), F.col("n_nationkey").cast("string")).alias("fullParentPathCode"),
        F.col("n_regionkey").cast("string").alias("organizationCode"),
        F.col("o_orderstatus").alias("_status"),
        prio.alias("_priority"),
        F.col("o_orderdate").alias("_orderdate"),
    )


def notice_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw notice items in arrival order ``ord``; open orders arrive twice."""
    facts = order_facts(spark, sf_dir)
    first = _notice_item(facts, 0)
    resent = _notice_item(facts.where(F.col("o_orderstatus") == "O"), 1)
    return first.unionByName(resent)


def notice_master(spark: SparkSession, sf_dir: str, materialize: bool = False) -> DataFrame:
    """The already-ingested master: finished orders, 13 owned + review columns.

    A real master is a stored table; ``materialize`` stores the stand-in once
    (shared checkpoint folder).  Off by default: rebuilding it is a scan plus
    broadcast joins, cheaper than the extra write job at these scales.
    """
    from bidlake.operators.notices import project_notice

    items = _notice_item(order_facts(spark, sf_dir).where(F.col("o_orderstatus") == "F"), 0)
    owned = project_notice(items, agency_code=F.lit(""), pulled_at=MASTER_PULLED_TS)
    prio = F.col("_priority")
    fit = F.when(prio == "1-URGENT", F.lit(" High ")).when(prio == "2-HIGH", F.lit("high")).otherwise(F.lit(""))
    master = owned.select(
        "*",
        fit.alias("fitLabel"),
        F.lit("reviewed").alias("reviewSummary"),
        F.lit("").alias("deadlineNote"),
        F.lit("").alias("deadlineISO"),
        F.lit(MASTER_PULLED_TS).alias("reviewedAtUTC"),
        F.lit("").alias("emailedAtUTC"),
    ).drop("ord", "_priority", "_status", "_orderdate", "o_orderkey", "organizationCode")
    if materialize:
        from bidlake.session import cut_lineage

        master = cut_lineage(master)
    return master


def fresh_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the source returns on a re-check, in arrival order.

    Unspecified-priority orders are gone; high ones are retitled; urgent
    ones have a moved deadline; medium ones were re-posted a day earlier;
    urgent finished orders come back twice (the later copy re-typed).
    """
    facts = order_facts(spark, sf_dir).where(F.col("o_orderpriority") != "4-NOT SPECIFIED")
    base = _notice_item(facts, 0)
    prio = F.col("_priority")
    out = base.select(
        "ord", "o_orderkey",
        F.col("noticeId"),
        F.when(prio == "2-HIGH", F.concat(F.col("title"), F.lit(" (amended)"))).otherwise(F.col("title")).alias("title"),
        "solicitationNumber",
        F.when(prio == "3-MEDIUM", (F.col("_orderdate") - F.expr("INTERVAL 1 DAYS")).cast("string"))
        .otherwise(F.col("postedDate")).alias("postedDate"),
        F.when(prio == "1-URGENT", (F.col("_orderdate") + F.expr("INTERVAL 44 DAYS")).cast("string"))
        .otherwise(F.col("responseDeadLine")).alias("responseDeadLine"),
        "type", "setAside", "naicsCode", "fullParentPathName", "fullParentPathCode",
        "_status", "_priority",
    )
    again = out.where((F.col("_status") == "F") & (prio == "1-URGENT")).select(
        (F.col("ord") + F.lit(COPY_STRIDE)).alias("ord"), "o_orderkey", "noticeId", "title",
        "solicitationNumber", "postedDate", "responseDeadLine", F.lit("X").alias("type"), "setAside",
        "naicsCode", "fullParentPathName", "fullParentPathCode", "_status", "_priority",
    )
    return out.unionByName(again)


def agency_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queried agency codes in query order (regions play the agencies)."""
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("bigint").alias("code_seq"),
        F.col("r_regionkey").cast("string").alias("agencyCode"),
    )


def mail_opportunities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed e-mail opportunities: one per document, a second alert for labelled ones.

    source: en/de documents come from the first publisher, fr/es from the
    second; title = the whole text; donor = language; country = source tag.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    labels = table(spark, sf_dir, "labels").select("doc_id").distinct()
    src = F.when(F.col("lang").isin("en", "de"), F.lit("devex")).otherwise(F.lit("developmentaid"))

    def shape(df: DataFrame, alert_no: int) -> DataFrame:
        return df.select(
            (F.lit(alert_no).cast("bigint") * F.lit(COPY_STRIDE) + F.col("doc_id")).alias("ord"),
            F.col("doc_id"),
            src.alias("mailSource"),
            F.col("text").alias("opportunityTitle"),
            F.col("lang").alias("donorClient"),
            F.col("source").alias("countryRegion"),
        )

    first = shape(docs, 0)
    second = shape(docs.join(labels, "doc_id", "left_semi"), 1)
    return first.unionByName(second)


def mail_master_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents already in the opportunity table: those labelled good quality."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    good = table(spark, sf_dir, "labels").where(F.col("quality") == 1).select("doc_id").distinct()
    return docs.join(good, "doc_id", "left_semi")
