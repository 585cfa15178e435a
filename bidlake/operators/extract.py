"""Listing extraction from DOM facts for both publishers.

Inputs are the ``nodes``/``strings`` fact tables of ``bidlake.operators.html``
and a per-document table ``docs(doc_id, subject, html)``.  Everything here is
joins, aggregates and filters; the tree axes are columns of the facts:

* nearest ancestor ``tr``/``table``   -> ``tr_id`` / ``table_id``
* next ``tr`` sibling(s)              -> same parent, ``tag_pos + i``
* next element sibling                -> same parent, ``child_pos + 1``
* descendant test                     -> ``node_id < x <= last_id``
* text                                -> the element's range of strings

Texts are fetched only for the rows and cells that a found listing points to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidlake.functions import text as T
from bidlake.functions import dates as D
from bidlake.functions import urls as U
from bidlake.operators import aggregates, intervals, links
from bidlake.operators.html import ROOT_ID, anchors, texts_of

# --- fixed values -----------------------------------------------------------
DEVEX_ALERT_MARKER = "Business Alert"
DA_ALERT_MARKER = "DevelopmentAid"
DEVEX_TYPE = "Tenders & Grants"
OPEN_STATUS = "Open"
# Label synonyms (English / Spanish), tried in order.
DONOR_KEYS: tuple[str, ...] = ("funding agency", "donor", "client", "organización", "financiado por")
COUNTRY_KEYS: tuple[str, ...] = ("location", "country", "countries", "país", "países", "region", "región")
DEADLINE_KEYS: tuple[str, ...] = ("deadline", "closing", "cierre", "fecha límite", "fecha limite")
# ---------------------------------------------------------------------------


def _rows(nodes: DataFrame) -> DataFrame:
    return nodes.where(F.col("tag") == "tr")


def devex_listings(nodes: DataFrame, strings: DataFrame, docs: DataFrame, min_len: int = 15) -> DataFrame:
    """P5: first publisher's listings with status, donor, country, deadline.

    Status is the second cell of the row around the link; donor, country and
    deadline are the next three rows beside it.

    Output: doc_id, link_pos, opportunityTitle, url, donorClient,
    countryRegion, deadline, opportunityType, status, alertName.
    """
    alert = docs.select("doc_id", T.alert_name("subject", DEVEX_ALERT_MARKER).alias("alertName")).hint("merge")  # as many rows as documents
    a = anchors(nodes).select("doc_id", F.col("link_seq").cast("bigint").alias("link_pos"), "href", "text", "tr_id")
    found = links.devex_listings(a.join(alert, "doc_id"), min_len, alert=F.col("alertName"), id_col="doc_id")

    rows = _rows(nodes)
    title_rows = found.where("tr_id is not null").select("doc_id", "tr_id").distinct().join(
        rows.select("doc_id", F.col("node_id").alias("tr_id"), "parent_id", "tag_pos", F.try_element_at("cells", F.lit(2)).alias("_cell")), ["doc_id", "tr_id"])
    after = title_rows.select("doc_id", "tr_id", "parent_id", "tag_pos", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("place")).select(
        "doc_id", "tr_id", "place", "parent_id", (F.col("tag_pos") + F.col("place")).alias("tag_pos"))
    ranges = after.join(rows.select("doc_id", "parent_id", "tag_pos", "first_seq", "end_seq"), ["doc_id", "parent_id", "tag_pos"]).select(
        "doc_id", "tr_id", "place", F.lit(" ").alias("separator"), "first_seq", "end_seq")
    status = title_rows.where("_cell is not null").select(
        "doc_id", "tr_id", F.lit(0).alias("place"), F.lit("").alias("separator"), F.col("_cell.first").alias("first_seq"), F.col("_cell.end").alias("end_seq"))
    rest = texts_of(strings, ranges, ["tr_id", "place"]).unionByName(texts_of(strings, status, ["tr_id", "place"], separator=""))
    facts = rest.groupBy("doc_id", "tr_id").agg(*[F.max(F.when(F.col("place") == i, F.col("text"))).alias(c) for i, c in enumerate(("status", "donorClient", "countryRegion", "deadline"))])
    out = found.join(facts, ["doc_id", "tr_id"], "left")
    return out.select(
        "doc_id", "link_pos", F.col("title").alias("opportunityTitle"), "url",
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("donorClient", "countryRegion", "deadline")],
        F.lit(DEVEX_TYPE).alias("opportunityType"), F.coalesce("status", F.lit("")).alias("status"), "alertName")


def open_section(nodes: DataFrame, strings: DataFrame) -> DataFrame:
    """per document, the element that the "Open" section is: doc_id, first_id, last_id, section_has_opp.

    The first string node containing the word ``open`` whose parent is an
    element decides: that parent's next element sibling when it contains a
    link, else the parent's parent (the root stands for the whole document).
    Two elements a document come into question; its links are tested against
    their ranges.
    """
    el = nodes.select("doc_id", "node_id", "last_id", "parent_id", "child_pos")
    first = (
        strings.where(T.contains_word("text", "open") & (F.col("parent_id") != ROOT_ID))
        .groupBy("doc_id").agg(F.min_by("parent_id", "seq").alias("node_id"))
    )
    parent = first.join(el, ["doc_id", "node_id"]).select(
        "doc_id", F.col("parent_id").alias("_outer"), (F.col("child_pos") + 1).alias("child_pos"))
    beside = parent.join(el.withColumnRenamed("parent_id", "_outer"), ["doc_id", "_outer", "child_pos"]).select("doc_id", F.lit(0).alias("turn"), "node_id", "last_id")
    outer = parent.select("doc_id", F.col("_outer").alias("node_id")).join(el.select("doc_id", "node_id", "last_id"), ["doc_id", "node_id"]).select("doc_id", F.lit(1).alias("turn"), "node_id", "last_id")
    choices = beside.unionByName(outer)
    inside = anchors(nodes).select("doc_id", F.col("node_id").alias("_link"), U.da_listing("href").cast("int").alias("_opp"))
    holds = choices.join(inside, "doc_id").where((F.col("_link") > F.col("node_id")) & (F.col("_link") <= F.col("last_id"))).groupBy("doc_id", "turn").agg(F.max("_opp").alias("_opp"))
    judged = choices.join(holds, ["doc_id", "turn"], "left").where((F.col("turn") == 1) | F.col("_opp").isNotNull())
    return judged.groupBy("doc_id").agg(F.min_by(F.struct("node_id", "last_id", "_opp"), "turn").alias("_s")).select(
        "doc_id", F.col("_s.node_id").alias("first_id"), F.col("_s.last_id").alias("last_id"), (F.coalesce("_s._opp", F.lit(0)) == 1).alias("section_has_opp"))


def label_rows(nodes: DataFrame, strings: DataFrame, tables: DataFrame) -> DataFrame:
    """W6 + X19 + A6: (doc_id, table_id) -> label/value map of the row after the one around each title table.

    The rows inside that row are named by their numbers, so the join that
    finds them makes one row per element inside.
    """
    rows = _rows(nodes)
    title_tables = nodes.where(F.col("tag") == "table").select("doc_id", F.col("node_id").alias("table_id"), F.col("tr_id").alias("_around")).join(tables, ["doc_id", "table_id"])
    around = title_tables.where("_around is not null").join(
        rows.select("doc_id", F.col("node_id").alias("_around"), "parent_id", (F.col("tag_pos") + 1).alias("tag_pos")), ["doc_id", "_around"])
    after = around.join(rows.select("doc_id", "parent_id", "tag_pos", "node_id", "last_id"), ["doc_id", "parent_id", "tag_pos"]).select(
        "doc_id", "table_id", F.col("node_id").alias("_meta"), "last_id")
    metas = after.select("doc_id", "_meta", "last_id").distinct()
    inside = metas.where("_meta < last_id").select("doc_id", "_meta", F.explode(F.sequence(F.col("_meta") + 1, F.col("last_id"))).alias("node_id"))
    pairs = inside.join(rows.where(F.size("cells") >= 2).select("doc_id", "node_id", "cells"), ["doc_id", "node_id"])
    cells = pairs.select("doc_id", "_meta", "node_id", F.posexplode("cells").alias("place", "_cell")).select(
        "doc_id", "_meta", "node_id", "place", F.col("_cell.first").alias("first_seq"), F.col("_cell.end").alias("end_seq"))
    texts = texts_of(strings, cells, ["_meta", "node_id", "place"], separator="")
    labelled = texts.groupBy("doc_id", "_meta", "node_id").agg(
        F.max(F.when(F.col("place") == 0, T.label_key("text"))).alias("_label"), F.max(F.when(F.col("place") == 1, F.col("text"))).alias("_value"))
    fields = aggregates.last_wins_map(labelled.where("_label != ''"), ["doc_id", "_meta"], F.col("_label"), F.coalesce("_value", F.lit("")), F.col("node_id"), "fields")
    return after.select("doc_id", "table_id", "_meta").join(fields, ["doc_id", "_meta"]).drop("_meta")


def says_open(nodes: DataFrame, strings: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, parent_id) of the links in ``found`` whose parent or grandparent text has the word "open".

    An element says open if the first such string at or after its first one
    lies before its end: one ordered pass a document.
    """
    el = nodes.select("doc_id", "node_id", F.col("parent_id").alias("_outer"), "first_seq", "end_seq")
    parents = found.select("doc_id", F.col("parent_id").alias("node_id")).distinct().join(el, ["doc_id", "node_id"])
    grand = parents.select("doc_id", F.col("node_id").alias("parent_id"), F.col("_outer").alias("node_id")).where("node_id is not null").join(
        el.drop("_outer"), ["doc_id", "node_id"]).select("doc_id", "parent_id", "first_seq", "end_seq")
    around = parents.select("doc_id", F.col("node_id").alias("parent_id"), "first_seq", "end_seq").unionByName(grand).withColumnRenamed("first_seq", "seq")
    opens = strings.where((F.col("kind") == "text") & T.contains_word("text", "open")).select("doc_id", "seq")
    following = intervals.first_at_or_after(around, opens, ["doc_id"], "seq", F.col("seq"), "_open")
    return following.where(F.col("_open") < F.col("end_seq")).select("doc_id", "parent_id").distinct()


def da_listings(nodes: DataFrame, strings: DataFrame, docs: DataFrame, run_date: str,
                min_len: int = 15) -> DataFrame:
    """Second publisher's listings, scoped to the "Open" section when it holds listings.

    Output: doc_id, link_pos, opportunityTitle, url, donorClient,
    countryRegion, deadline, deadlineISO, opportunityType, status, alertName.
    """
    meta = docs.select(
        "doc_id",
        T.alert_name("subject", DA_ALERT_MARKER).alias("alertName"),
        T.opportunity_type("html").alias("opportunityType")).hint("merge")
    section = open_section(nodes, strings).where("section_has_opp").drop("section_has_opp").withColumnsRenamed({"first_id": "_first", "last_id": "_last"})
    a = anchors(nodes).select("doc_id", "node_id", F.col("link_seq").cast("bigint").alias("link_pos"), "href", "text", "parent_id", "table_id").join(section, "doc_id", "left")
    in_scope = F.col("_first").isNull() | ((F.col("node_id") > F.col("_first")) & (F.col("node_id") <= F.col("_last")))
    found = links.da_listings(a.where(in_scope).drop("_first", "_last"), min_len, id_col="doc_id")

    fields = label_rows(nodes, strings, found.where("table_id is not null").select("doc_id", "table_id").distinct())
    status = says_open(nodes, strings, found).withColumn("status", F.lit(OPEN_STATUS))
    near = found.join(fields, ["doc_id", "table_id"], "left").join(status, ["doc_id", "parent_id"], "left")
    deadline = T.first_present("fields", DEADLINE_KEYS)
    return near.join(meta, "doc_id").select(
        "doc_id", "link_pos",
        F.col("title").alias("opportunityTitle"),
        "url",
        T.first_present("fields", DONOR_KEYS).alias("donorClient"),
        T.first_present("fields", COUNTRY_KEYS).alias("countryRegion"),
        deadline.alias("deadline"),
        D.deadline_iso(deadline, run_date).alias("deadlineISO"),
        "opportunityType",
        F.coalesce("status", F.lit("")).alias("status"),
        "alertName",
    )


__all__ = ["devex_listings", "da_listings", "open_section", "label_rows", "says_open"]
