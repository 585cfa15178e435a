"""Queries over ``conversations`` (message = conv_id, part / row = turn,
mime = role) and ``events``: sibling rows, first body part, header maps,
label/value maps, per-source limits, plus date rendering round trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidlake.functions import dates as D
from bidlake.functions import text as T
from bidlake.operators import aggregates, dedup, siblings
from bidlake.sources import standins as S

# --- fixed values -----------------------------------------------------------
# Stand-in bindings.  The body part is the first non-empty assistant turn;
# header names are the roles (user -> subject, assistant -> date, system ->
# sender); the label synonyms are event types; the per-source limit is the
# mail search page size.
BODY_MIME = "assistant"
HEADER_ROLES = {"subject": "user", "date_header": "assistant", "sender": "system"}
EVENT_SYNONYMS: tuple[str, ...] = ("purchase", "signup", "click")
PER_SOURCE_LIMIT = 100
RFC_TIME_SUFFIX = " 23:30:00 -0500"
# ---------------------------------------------------------------------------


def sibling_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W5 + X17: each user turn with the next three turns as donor, country,
    deadline ('' when missing; does not stop at the next user turn) and its
    second line as status."""
    conv = S.table(spark, sf_dir, "conversations")
    nxt = siblings.next_values(conv, ["conv_id"], "turn", T.trim_ws("text"), 3, keep=F.col("role") == "user")
    status_src = conv.where(F.col("role") == "user").select(
        "conv_id", "turn", T.trim_ws(T.second_cell(F.split(F.col("text"), "\n"))).alias("status"))
    out = nxt.join(status_src, ["conv_id", "turn"])
    return out.select(
        "conv_id", "turn",
        F.coalesce(F.col("next_1"), F.lit("")).alias("donor"),
        F.coalesce(F.col("next_2"), F.lit("")).alias("country"),
        F.coalesce(F.col("next_3"), F.lit("")).alias("deadline"),
        "status",
    )


def base64url(c) -> F.Column:
    """Unpadded URL-safe base64 of a string's UTF-8 bytes (landing encoding of mail parts)."""
    std = F.base64(F.encode(c, "UTF-8"))
    return F.regexp_replace(F.translate(std, "+/", "-_"), "=+$", "")


def first_body_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7 + W7 + X22: each message's first non-empty body part of the body
    type, decoded from URL-safe base64; '' when there is none."""
    conv = S.table(spark, sf_dir, "conversations")
    parts = conv.select(
        F.col("conv_id").alias("message_id"), F.col("turn").alias("part_seq"),
        F.col("role").alias("mime_type"), base64url(F.col("text")).alias("body_b64"))
    qualifies = (F.col("mime_type") == BODY_MIME) & (F.coalesce(F.col("body_b64"), F.lit("")) != "")
    return siblings.first_part(parts, "message_id", "part_seq", D.base64url_text("body_b64"), qualifies)


def header_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 + A6: header list -> map (names lower-cased, last duplicate wins) ->
    subject / date / from with '' defaults."""
    conv = S.table(spark, sf_dir, "conversations")
    m = aggregates.last_wins_map(conv, ["conv_id"], F.lower(F.col("role")), F.col("text"), F.col("turn"), "headers")
    return m.select(
        "conv_id",
        *[F.coalesce(F.try_element_at("headers", F.lit(role)), F.lit("")).alias(name)
          for name, role in HEADER_ROLES.items()],
        F.size("headers").cast("bigint").alias("n_headers"),
    )


def _label_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = S.table(spark, sf_dir, "events")
    cells = F.array(F.concat(F.lit(" "), F.initcap("event_type"), F.lit(":")), F.get_json_object("props", "$.k"))
    return ev.select("user_id", "ts", "event_id", cells.alias("cells"))


def _label_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _label_rows(spark, sf_dir).where(F.size("cells") >= 2)
    key = T.label_key(F.col("cells")[0])
    rows = rows.withColumn("_key", key).where(F.col("_key") != "")
    return aggregates.last_wins_map(rows, ["user_id"], F.col("_key"), F.col("cells")[1],
                                    F.struct("ts", "event_id"), "fields")


def label_value_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X19 + A6: label cells -> keys; per user a key -> value map, last row wins."""
    m = _label_map(spark, sf_dir)
    return m.select("user_id", F.explode("fields").alias("label", "value"))


def synonym_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First synonym present in the map (even if blank), cut to 100 chars."""
    m = _label_map(spark, sf_dir)
    return m.select("user_id", T.first_present("fields", EVENT_SYNONYMS).alias("value"))


def per_source_limit(spark: SparkSession, sf_dir: str, n: int = PER_SOURCE_LIMIT) -> DataFrame:
    """At most ``n`` messages per source, in arrival order (event type = source)."""
    ev = S.table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    return dedup.first_n(ev, ["event_type"], [F.col("ts"), F.col("event_id")], n).select("event_type", "event_id")


def mail_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RFC-2822 date headers rendered from order dates, parsed back in the sender's offset."""
    orders = S.table(spark, sf_dir, "orders")
    header = F.concat(F.date_format("o_orderdate", "EEE, d MMM yyyy"), F.lit(RFC_TIME_SUFFIX))
    return orders.select("o_orderkey", header.alias("date_header")).select(
        "o_orderkey", "date_header", D.mail_date("date_header").alias("email_date"))


def deadline_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deadline strings as publishers write them (one layout per priority)."""
    orders = S.table(spark, sf_dir, "orders")
    p = F.col("o_orderpriority")
    d = F.col("o_orderdate")
    text = (F.when(p == "1-URGENT", F.date_format(d, "MMMM d, yyyy"))
            .when(p == "2-HIGH", F.date_format(d, "dd MMM, yyyy"))
            .when(p == "3-MEDIUM", F.date_format(d, "d/M/yyyy"))
            .when(p == "4-NOT SPECIFIED", F.date_format(d, "yyyy-MM-dd"))
            .otherwise(F.lit("")))
    publisher_iso = F.when(F.col("o_orderstatus") == "P", F.date_format(d, "yyyy-MM-dd")).otherwise(F.lit(""))
    return orders.select("o_orderkey", text.alias("deadline"), publisher_iso.alias("publisherISO"))


def deadline_iso(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X9 + X10: publisher ISO when present, else the parsed deadline text."""
    t = deadline_text(spark, sf_dir)
    return t.select("o_orderkey", "deadline",
                    D.deadline_fallback("publisherISO", "deadline", S.STANDIN_RUN_DATE).alias("deadlineISO"))


def deadline_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X9 + K3: order dates written in free forms, read back (a form per order key)."""
    orders = S.table(spark, sf_dir, "orders")
    d, form = F.col("o_orderdate"), F.col("o_orderkey") % 12
    as_ = lambda layout: F.date_format(d, layout)
    text = (
        F.when(form == 0, F.concat(as_("EEEE"), F.lit(", "), as_("d MMMM yyyy"), F.lit(" 17:00 UTC")))
        .when(form == 1, F.concat(as_("d"), F.lit("th of "), as_("MMMM, yyyy")))
        .when(form == 2, as_("yyyy MMM d"))
        .when(form == 3, F.concat(as_("MMM. d yyyy"), F.lit(" at 5pm")))
        .when(form == 4, as_("yyyyMMdd"))
        .when(form == 5, as_("d-MMM-yy"))
        .when(form == 6, as_("MM/dd/yyyy"))
        .when(form == 7, as_("d . M . yyyy"))
        .when(form == 8, as_("MMMM yyyy"))
        .when(form == 9, as_("d MMMM"))
        .when(form == 10, F.concat(F.lit("closes "), as_("d MMMM yyyy")))
        .otherwise(F.concat(as_("d MMMM yyyy"), F.lit(" 12 13"))))
    return orders.select("o_orderkey", text.alias("deadline")).select("o_orderkey", "deadline", D.deadline_iso("deadline", S.STANDIN_RUN_DATE).alias("deadlineISO"))


PREVIEW_WIDTHS = {"source": (15, 15), "emailDate": (12, 12), "alertName": (18, 20),
                  "opportunityTitle": (38, 40), "url": (28, 30)}


def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S18 + X26 + O3: dry-run preview of the first 30 extracted opportunities,
    each field cut and padded to its column width."""
    from bidlake.operators import mail
    from bidlake.settings import PREVIEW_ROWS

    e = mail.enrich(S.mail_opportunities(spark, sf_dir), S.STANDIN_RUN_DATE, S.STANDIN_RUN_TS)
    first = e.orderBy("ord").limit(PREVIEW_ROWS)
    cells = [T.fixed_width(c, cut, width).alias(c) for c, (cut, width) in PREVIEW_WIDTHS.items()]
    return dedup.stable_order(first.select("ord", *cells), [F.col("ord")], "row_pos").drop("ord")


def preview_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S18 + A5: e-mails found, opportunities extracted, rows beyond the preview."""
    from bidlake.operators import mail
    from bidlake.settings import PREVIEW_ROWS

    e = mail.enrich(S.mail_opportunities(spark, sf_dir), S.STANDIN_RUN_DATE, S.STANDIN_RUN_TS, lenient_dates=False)
    n = F.count(F.lit(1))
    return e.agg(
        F.count_distinct(F.col("ord") % F.lit(S.COPY_STRIDE)).cast("bigint").alias("emails_found"),
        n.cast("bigint").alias("opportunities"),
        F.greatest(n - F.lit(PREVIEW_ROWS), F.lit(0)).cast("bigint").alias("more"),
    )
