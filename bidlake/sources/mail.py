"""Landed alert e-mails (S4..S7): messages and their flattened MIME parts.

Landing layout (JSON lines, one file set per fetch):

* messages: ``{"source", "id", "message_seq", "received", "headers": [{"name", "value"}, ...]}``
  with ``message_seq`` the place in the mailbox's answer and ``received`` an ISO
  date; both may be missing (then the id orders and the Date header dates)
* parts:    ``{"message_id", "part_seq", "mime_type", "body_b64"}`` with
  ``part_seq`` the depth-first pre-order position of the part in the MIME
  tree (the tree is flattened when landing; Spark has no recursive types).

``records`` produces the six-column e-mail record
``(source, message_id, subject, email_date, sender, html_body)``.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from bidlake.functions import dates as D
from bidlake.functions import text as T
from bidlake.operators import siblings

MESSAGE_SCHEMA = StructType([
    StructField("source", StringType()),
    StructField("id", StringType()),
    StructField("message_seq", LongType()),
    StructField("received", StringType()),
    StructField("headers", ArrayType(StructType([
        StructField("name", StringType()), StructField("value", StringType())]))),
])
PART_SCHEMA = StructType([
    StructField("message_id", StringType()),
    StructField("part_seq", IntegerType()),
    StructField("mime_type", StringType()),
    StructField("body_b64", StringType()),
])

# --- fixed values -----------------------------------------------------------
# Search rules per source: sender and/or phrase (a blank sender means phrase only).
SOURCE_RULES = {
    "devex": {"sender": "alerts@devex.com", "phrase": None},
    "developmentaid": {"sender": "", "phrase": "DevelopmentAid"},
}
HTML_MIME = "text/html"
# ---------------------------------------------------------------------------


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MESSAGE_SCHEMA).json(path)


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PART_SCHEMA).json(path)


def header(headers: Column | str, name: str) -> Column:
    """Value of the last header called ``name`` (case-insensitive), else ''."""
    matching = F.filter(T.col_(headers), lambda h: F.lower(h["name"]) == F.lit(name.lower()))
    return F.coalesce(F.try_element_at(matching, F.lit(-1))["value"], F.lit(""))


def received_day() -> Column:
    """The day of receipt, else of the Date header; null if a message tells neither."""
    return F.try_to_date(F.coalesce(F.substring("received", 1, 10), D.mail_date(header("headers", "date"))), "yyyy-MM-dd")


def search(messages: DataFrame, source: str, run_date: str, days: int, parts: DataFrame | None = None,
           rules: dict[str, dict] = SOURCE_RULES, index: DataFrame | None = None) -> DataFrame:
    """The messages a source's search returns (sender / phrase, ``newer_than:Nd``).

    The phrase may stand in the subject, the sender or, with ``parts``, in any
    text part.  The window tests the day of receipt, else the Date header; a
    message that tells neither is returned.  With ``index``
    (``mail_index.read_index``) the phrase is looked up word by word and no
    body is read.
    """
    rule = rules[source]
    sender = F.lower(header("headers", "from"))
    recent = F.coalesce(received_day() >= F.date_sub(F.to_date(F.lit(run_date)), days), F.lit(True))
    found = messages.where(recent & sender.contains(rule["sender"].lower()) if rule["sender"] else recent)
    if rule["phrase"] and index is not None:
        from bidlake.sources.mail_index import phrase_holders

        since = (date.fromisoformat(run_date) - timedelta(days=days)).isoformat()
        found = found.join(phrase_holders(index, rule["phrase"], since).withColumnRenamed("message_id", "id"), "id", "left_semi").select(*messages.columns)
    elif rule["phrase"]:
        phrase = rule["phrase"].lower()
        named = F.lower(F.concat_ws(" ", header("headers", "subject"), sender)).contains(phrase)
        if parts is None:
            found = found.where(named)
        else:
            asked = found.where(~named).select(F.col("id").alias("message_id"))  # bodies of these alone are decoded
            texts = parts.where(F.col("mime_type").startswith("text/")).join(asked, "message_id", "left_semi")
            holders = texts.where(F.lower(D.base64url_text("body_b64")).contains(phrase)).select(F.col("message_id").alias("id"), F.lit(True).alias("_held")).distinct()
            found = found.join(holders, "id", "left").where(named | F.coalesce("_held", F.lit(False))).select(*messages.columns)
    return found.withColumn("source", F.lit(source))


def first_html_bodies(parts: DataFrame) -> DataFrame:
    """S7 + W7 + X22: first non-empty ``text/html`` part per message; only that part is decoded."""
    qualifies = (F.col("mime_type") == HTML_MIME) & (F.coalesce(F.col("body_b64"), F.lit("")) != "")
    first = siblings.first_part(parts.where(qualifies), "message_id", "part_seq", F.col("body_b64"), F.lit(True), "_b64")
    return first.select("message_id", D.base64url_text("_b64").alias("html_body"))


def records(messages: DataFrame, parts: DataFrame) -> DataFrame:
    """S5 + S6 + J6: messages -> (source, message_id, subject, email_date, sender, html_body)."""
    order = [c for c in ("source_seq", "message_seq") if c in messages.columns]
    meta = messages.select(
        "source", *order,
        F.col("id").alias("message_id"),
        header("headers", "subject").alias("subject"),
        D.mail_date(header("headers", "date")).alias("email_date"),
        header("headers", "from").alias("sender"),
    )
    bodies = first_html_bodies(parts.join(messages.select(F.col("id").alias("message_id")), "message_id", "left_semi"))
    return meta.join(bodies, "message_id", "left").select(
        "source", "message_id", "subject", "email_date", "sender",
        F.coalesce(F.col("html_body"), F.lit("")).alias("html_body"), *order)


def fetch(messages: DataFrame, parts: DataFrame, run_date: str, days: int = 7, limit: int | None = None,
          source_filter: str = "all", rules: dict[str, dict] = SOURCE_RULES, index: DataFrame | None = None) -> DataFrame:
    """S4 + S5 + F16 + W9 + U2: records of every selected source (a message matching
    both searches appears once per source), at most ``limit`` per source in order of arrival."""
    from bidlake.operators.dedup import first_n

    sources = list(rules) if source_filter == "all" else [source_filter]
    found = None
    for seq, src in enumerate(sources):
        part = search(messages, src, run_date, days, parts, rules, index).withColumn("source_seq", F.lit(seq))
        found = part if found is None else found.unionByName(part)
    return records(first_n(found, ["source"], [F.col("message_seq").asc_nulls_last(), F.col("id")], limit), parts)
