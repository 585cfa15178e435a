"""A stand-in mailbox: alert mails of both publishers written from orders.

Every order is a listing, every customer a subscriber.  Customers of nations
with an even key get the first publisher's mails, the others the second's; a
mail holds a customer's orders of one block of order keys, so its size is
bounded.  The key of an order decides how its listing looks: a tracker link,
a stable report id, a link that is no listing, a title that is too short or
stands in the mail before, markup inside the title, missing rows, repeated
labels, marks that say "open".  So the rows that an extraction must return
follow from the keys alone (``bidlake.plans.oracle_mail`` states them in SQL)
and nothing there parses HTML.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bidlake.session import checkpoint_dir
from bidlake.sources.standins import table

# --- fixed values -----------------------------------------------------------
BLOCK_KEYS = 65536              # order keys of one mail
RUN_DATE = "2026-07-16"
RUN_TS = "2026-07-16T12:00:00+00:00"
DEVEX_FROM = "Devex Alerts <alerts@devex.com>"
DA_FROM = "Weekly desk <desk@developmentaid.org>"
TRACKER = "https://track.pstmrk.it/3s/"
DEVEX_HOME = "<p><a href='https://www.devex.com/home'>Devex home page for members</a></p>"
DA_HOME = "<p><a href='https://developmentaid.org/login'>Sign in to your own account</a></p>"
# Labels of the second publisher's tables, by order key modulo 3.
LABELS = (("Funding agency:", "Location:", "Deadline:"), ("Donor", "Countries", "Closing :"), ("Organización:", "País:", "Fecha límite:"))
FILE_ROWS = 100_000             # of a landed file at most
HEADINGS = ("Tender Alert", "grant alert", "Weekly list")   # by customer key modulo 3
# ---------------------------------------------------------------------------


def key() -> Column:
    return F.col("o_orderkey")


def cust() -> Column:
    return F.col("o_custkey")


def _case(*branches: tuple[Column, Column | str], otherwise: Column | str) -> Column:
    value = lambda v: v if isinstance(v, Column) else F.lit(v)
    out = F.when(branches[0][0], value(branches[0][1]))
    for condition, result in branches[1:]:
        out = out.when(condition, value(result))
    return out.otherwise(value(otherwise))


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with its mail (source, message_id, message_seq) and what its listing is written from."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")  # 25 and 5 rows
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    rows = (orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey")))
    block = F.floor(key() / BLOCK_KEYS)
    source = F.when(F.col("n_nationkey") % 2 == 0, F.lit("devex")).otherwise(F.lit("developmentaid"))
    return rows.select(
        "*", source.alias("source"), _text(source, "-", cust(), "-", block).alias("message_id"), (cust() * 1_000_000 + block).alias("message_seq"),
        F.date_add("o_orderdate", 30).alias("due"))


def _devex_listing() -> Column:
    """The rows of one listing of the first publisher, as a table in a row of the mail."""
    v, r = key() % 8, key() % 5
    title = _case(
        (v == 4, _text("Lot ", key())),
        (v == 5, _text("Framework agreement for ", F.lower("c_mktsegment"), " supplies")),
        (v == 6, _text(F.col("c_mktsegment"), " &amp; <b>transport</b>\n   of goods, lot ", key())),
        (v == 7, _text("Adquisición de equipos para ", F.col("n_name"), ", lote ", key())),
        otherwise=_text(F.col("c_mktsegment"), " procurement of ", F.lower(F.substring("o_orderpriority", 3, 50)), " stock, lot ", key()))
    url = _case(
        (v == 1, _text(TRACKER, F.url_encode(_text("https://www.devex.com/funding/r?report=tender-", key() % 500)))),
        (v == 2, _text("https://www.devex.com/funding/r?id=", key(), "&report=grant-", key())),
        (v == 3, _text("https://www.devex.com/jobs/", key())),
        otherwise=_text("https://www.devex.com/en/opportunity/lot-", key()))
    status = _case((F.col("o_orderstatus") == "O", "<td><b> OPEN </b></td>"), (F.col("o_orderstatus") == "F", "<td>CLOSED</td>"), otherwise="")
    row = lambda c: _text("<tr><td><i>", c, "</i>\n</td></tr>")
    after = _case(
        (r == 1, ""), (r == 0, row(F.col("n_name"))),
        otherwise=_text(row(F.col("n_name")), row(_text(F.col("r_name"), " (", F.col("n_name"), ")")), row(F.date_format("due", "MMMM d, yyyy"))))
    return _text("<tr><td><table><tr><td><p><a href=\"", url, "\">\n ", title, "\n</a></p></td>", status, "</tr>", after, "</table></td></tr>")


def _da_listing() -> Column:
    """The two rows of one listing of the second publisher: title table, then label table."""
    v = key() % 8
    title = _case(
        (v == 4, _text("Lote ", key())), (key() % 3 == 0, _text("Servicios de consultoría en ", F.lower("c_mktsegment"), ", lote ", key())),
        otherwise=_text(F.lower("c_mktsegment"), " equipment for ", F.col("n_name"), " districts, lot ", key()))
    href = _case(
        (v == 1, _text("https://example.org/tenders/view/", key())),
        (v == 2, _text("https://www.developmentaid.info/grants/view/", key(), "?ref=mail&id=", key())),
        (v == 3, "https://developmentaid.org/news/list"),
        (v == 5, _text("https://developmentaid.org/tenders/view/c", cust(), "?utm_source=mail", key())),
        otherwise=_text("https://developmentaid.org/tenders/view/lot-", key()))
    open_order = F.col("o_orderstatus") == "O"
    mark = _case((open_order & (key() % 7 == 0), " (open for bids)"), otherwise="")
    badge = _case((open_order & (key() % 7 == 1), "Open now"), otherwise="new")
    donor, country, deadline = (_case((key() % 3 == 0, LABELS[0][i]), (key() % 3 == 1, LABELS[1][i]), otherwise=LABELS[2][i]) for i in range(3))
    row = lambda label, value: _text("<tr><td>", label, "</td><td> ", value, " </td></tr>")
    rows = _text(
        _case((key() % 4 == 0, row(donor, "Unknown")), otherwise=""), row(donor, F.col("n_name")),
        row(country, F.when(key() % 9 == 0, F.repeat(_text(F.col("n_name"), ", "), 30)).otherwise(F.col("r_name"))),
        row(deadline, _case((key() % 5 == 0, ""), otherwise=F.date_format("due", "dd MMM, yyyy"))))
    labels = _case((key() % 10 == 7, ""), otherwise=_text("<tr><td><table>", rows, "</table></td></tr>"))
    return _text("<tr><td><table><tr><td><a href='", href, "'> ", title, " </a>", mark, "</td><td>", badge, "</td></tr></table></td></tr>", labels)


def _mails(rows: DataFrame, listing: Column, section: Column, *keep: str) -> DataFrame:
    """One row per mail: its listings as HTML by section (0, 1), in order of their keys."""
    per = rows.groupBy("source", "message_id", "message_seq", "o_custkey", *keep).agg(
        F.array_sort(F.collect_list(F.struct(section.alias("section"), key().alias("k"), listing.alias("html")))).alias("_l"))  # one bounded mail
    of = lambda n: F.array_join(F.transform(F.filter("_l", lambda x: x["section"] == n), lambda x: x["html"]), "")
    return per.withColumns({"n": F.size("_l"), "first": of(0), "second": of(1)}).drop("_l")


def mails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """source, message_id, message_seq, received (days before the run), subject, sender, html of every mail."""
    rows = listings(spark, sf_dir)
    devex = _mails(rows.where("source = 'devex'"), _devex_listing(), F.lit(0), "c_name").select(
        "source", "message_id", "message_seq", "o_custkey", F.lit(DEVEX_FROM).alias("sender"),
        _text(F.col("n"), " new reports for your Business Alert: ", F.col("c_name")).alias("subject"),
        _text("<html><body>", DEVEX_HOME, "<h1><a href='https://www.devex.com/en/alerts/", cust(), "'>", F.col("c_name"), "</a></h1><table><tbody>", F.col("first"),
              "</tbody></table><![if !mso]><p>You get this mail every week<br>as a member.</p></body></html>").alias("html"))
    sectioned = cust() % 2 == 0
    section = F.when(sectioned & (F.col("o_orderstatus") != "F"), 1).otherwise(0)
    heading = _case((cust() % 3 == 0, HEADINGS[0]), (cust() % 3 == 1, HEADINGS[1]), otherwise=HEADINGS[2])
    beacon = _case((cust() % 5 == 3, "<div><!-- open beacon --></div><p>Your list of the week</p>"), otherwise="")
    body = F.when(sectioned, _text("<h3>Forecast</h3><table>", F.col("first"), "</table><h3>Open</h3><table>", F.col("second"), "</table>")).otherwise(
        _text("<table>", F.col("first"), "</table>"))
    da = _mails(rows.where("source = 'developmentaid'"), _da_listing(), section, "c_mktsegment").select(
        "source", "message_id", "message_seq", "o_custkey", F.lit(DA_FROM).alias("sender"),
        _text(F.col("n"), " Funding opportunities from DevelopmentAid: ", F.lower("c_mktsegment"), " list").alias("subject"),
        _text("<html><body>", beacon, DA_HOME, "<h2>", heading, "</h2>", body, "<p>Written by the desk.</p></body></html>").alias("html"))
    return devex.unionByName(da).withColumn("received", F.date_sub(F.to_date(F.lit(RUN_DATE)), (cust() % 10).cast("int"))).drop("o_custkey")


def base64url(c: Column) -> Column:
    return F.regexp_replace(F.translate(F.base64(F.encode(c, "UTF-8")), "+/", "-_"), "=+$", "")


def land(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """The mailbox as landed JSON (paths of messages and parts); each mail is a container, a text part and two HTML parts."""
    rows = mails(spark, sf_dir)
    header = lambda name, value: F.struct(F.lit(name).alias("name"), value.alias("value"))
    messages = rows.select(
        F.lit(None).cast("string").alias("source"), F.col("message_id").alias("id"), "message_seq", F.lit(None).cast("string").alias("received"),
        F.array(header("Subject", F.lit("(no subject)")), header("SUBJECT", F.col("subject")), header("From", F.col("sender")),
                header("Date", _text(F.date_format("received", "EEE, d MMM yyyy"), " 08:00:00 -0500"))).alias("headers"))
    part = lambda seq, mime, body: F.struct(F.col("message_id"), F.lit(seq).alias("part_seq"), F.lit(mime).alias("mime_type"), body.alias("body_b64"))
    parts = rows.select(F.explode(F.array(
        part(0, "multipart/alternative", F.lit("")), part(1, "text/html", F.lit("")), part(2, "text/plain", base64url(F.col("subject"))),
        part(3, "text/html", base64url(F.col("html"))), part(4, "text/html", base64url(F.lit("<p>a later part</p>"))))).alias("p")).select("p.*")
    base = os.path.join(checkpoint_dir(spark), f"landing-mail-{uuid.uuid4().hex}")
    for rows, name in ((messages, "messages"), (parts, "parts")):  # compressed files are read whole by one task each: keep them small
        rows.write.option("compression", "gzip").option("maxRecordsPerFile", FILE_ROWS).json(os.path.join(base, name))
    return os.path.join(base, "messages"), os.path.join(base, "parts")
