"""Listing extraction from alert HTML via DOM facts (P5, P6, F6..F13, W3..W6, X12..X20)."""

from pyspark.sql import functions as F

from bidlake.functions import text as T
from bidlake.operators import extract, html
from tests.fixtures import FIRST, FIRST_HTML, FIRST_SUBJECT, SECOND, SECOND_HTML, SECOND_SUBJECT, Listing, first_alert

RUN_DATE = "2026-07-16"


def _docs(spark, body, subject):
    return spark.createDataFrame([("m1", subject, body)], "doc_id string, subject string, html string")


def _first(spark, body=FIRST_HTML, subject=FIRST_SUBJECT):
    docs = _docs(spark, body, subject)
    return [r.asDict() for r in extract.devex_listings(*html.dom_facts(docs, materialize=False), docs).orderBy("link_pos").collect()]


def _second(spark):
    docs = _docs(spark, SECOND_HTML, SECOND_SUBJECT)
    out = extract.da_listings(*html.dom_facts(docs, materialize=False), docs, RUN_DATE)
    return [r.asDict() for r in out.orderBy("link_pos").collect()]


def test_alert_names(spark):
    subjects = {FIRST_SUBJECT: "Island Water", "Business Alert:  Roads, Rail ": "Roads, Rail", "Weekly digest": ""}
    df = spark.createDataFrame([(s,) for s in subjects], "s string")
    assert [r[0] for r in df.select(T.alert_name("s", "Business Alert")).collect()] == list(subjects.values())
    assert spark.createDataFrame([(SECOND_SUBJECT,)], "s string").select(T.alert_name("s", "DevelopmentAid")).first()[0] == "Works and Goods"


def test_first_publisher_rows(spark):
    rows = _first(spark)
    assert [(r["opportunityTitle"], r["url"], r["donorClient"], r["countryRegion"], r["deadline"], r["status"]) for r in rows] == [
        (x.title, x.url, x.donor, x.country, x.deadline, x.status) for x in FIRST]
    assert {(r["opportunityType"], r["alertName"]) for r in rows} == {("Tenders & Grants", "Island Water")}


def test_first_publisher_missing_rows_and_quotes(spark):
    lone = Listing("Evaluation of seed banks in three provinces", "https://www.devex.com/en/opportunity/seed-banks-1")
    body = first_alert(FIRST[:1], quote="'") + f"<table><tr><td><a href={lone.url}>{lone.title}</a></td></tr><tr><td>Seed Trust</td></tr></table>"
    rows = _first(spark, body)
    assert [(r["url"], r["donorClient"], r["countryRegion"], r["deadline"], r["status"]) for r in rows] == [
        (FIRST[0].url, FIRST[0].donor, FIRST[0].country, FIRST[0].deadline, FIRST[0].status), (lone.url, "Seed Trust", "", "", "")]


def test_first_publisher_status_is_the_second_cell_in_document_order(spark):
    x = FIRST[0]
    body = f"<table><tr><td><table><tr><td><a href='{x.url}'>{x.title}</a></td><td>SOON</td></tr></table></td><td>LATER</td></tr></table>"
    assert [r["status"] for r in _first(spark, body)] == ["SOON"]
    f = html.flatten("<table><tr><td>A<table><tr><td>B</td></tr></table></td><td>C</td></tr></table>")
    outer = f.tag.index("tr")
    assert [f.text_of(c, "") for c in f.cells[outer]] == ["AB", "B"]


def test_second_publisher_rows(spark):
    rows = _second(spark)
    assert [(r["opportunityTitle"], r["url"], r["donorClient"], r["countryRegion"], r["deadline"], r["deadlineISO"]) for r in rows] == [
        (x.title, x.url, x.donor, x.country, x.deadline, x.iso) for x in SECOND]
    assert {(r["opportunityType"], r["alertName"], r["status"]) for r in rows} == {("Tender", "Works and Goods", "")}


def test_da_open_section_scopes_links(spark):
    body = ("<html><body><p>Closed</p><div><a href='https://developmentaid.org/tenders/view/x-1'>"
            "Closed listing number one here</a></div><h3>Open</h3><div><a href="
            "'https://developmentaid.org/tenders/view/y-2'>Open listing number two here</a></div></body></html>")
    docs = _docs(spark, body, SECOND_SUBJECT)
    out = extract.da_listings(*html.dom_facts(docs, materialize=False), docs, RUN_DATE).collect()
    assert [r["url"] for r in out] == ["https://developmentaid.org/tenders/view/y-2"]


def test_da_open_section_without_listings_searches_everything(spark):
    body = ("<html><body><h3>Open</h3><div><a href='https://example.org/x'>not a listing link at all</a></div>"
            "<a href='https://developmentaid.org/grants/view/z?utm_source=m&id=3'>Grant listing outside section</a>"
            "</body></html>")
    docs = _docs(spark, body, SECOND_SUBJECT)
    out = extract.da_listings(*html.dom_facts(docs, materialize=False), docs, RUN_DATE).collect()
    assert [r["url"] for r in out] == ["https://developmentaid.org/grants/view/z&id=3"]
    assert out[0]["opportunityType"] == "Opportunity"


def test_dom_text_rules():
    f = html.flatten("<div> a <script>x</script><!-- c --><b>b </b>\n<p>c</p></div>")
    div = f.tag.index("div")
    assert f.text_of(div) == "a b c" and f.text_of(div, "") == "abc"
    assert [(kind, text) for _, kind, text in f.strings] == [("text", "a"), ("script", "x"), ("comment", "c"), ("text", "b"), ("text", "c")]


def test_dom_survives_malformed_markup(spark):
    for bad in ["<a href='x'>unclosed <b>bold", "</td></tr><p>stray end tags</p>", "<![if", "<div " * 3, "<", None, ""]:
        html.flatten(bad)
    link = "<a href='/after'>a link after it</a>"
    for bad in ["<![x", "<!foo[", "<![if !mso]>", "<![x y>", "<!foo[bar]>", "<!", "<!-", "</", "<![CDATA[ x ]]>", "<!ELEMENT br EMPTY>", "<?php x", "<a b=\"c"]:
        body = f"<p>before</p>{bad}<p>between</p>{link}"
        docs = spark.createDataFrame([("d", body)], "doc_id string, html string")
        found = [r["href"] for r in html.anchors(html.dom_facts(docs, materialize=False)[0]).collect()]
        if bad not in ("<?php x", "<a b=\"c"):  # these swallow what follows up to their own ends, as for any reader
            assert found == ["/after"], bad


def test_facts_are_nested_sets_and_linear(spark):
    depth = 3000
    f = html.flatten("<div>" * depth + "<a href=x>deep</a>" + "</div>" * depth)
    assert len(f.tag) == depth + 1 and f.last == [depth] * (depth + 1)
    docs = spark.createDataFrame([("deep", "<div>" * depth + "text" + "</div>" * depth), ("none", None)], "doc_id string, html string")
    nodes, strings = html.dom_facts(docs, materialize=False)
    assert nodes.groupBy("doc_id").count().orderBy("doc_id").collect() == [("deep", depth + 1), ("none", 1)] and strings.count() == 1
    assert not any(t.startswith("array<int>") for _, t in nodes.dtypes)  # no list of ancestors per element


def test_ranges_match_a_walk_of_the_tree(spark):
    from tests.conftest import SF001

    for r in spark.read.parquet(f"{SF001}/pages.parquet").select("html").collect()[:40]:
        f = html.flatten(r["html"])
        chain: dict[int, set[int]] = {-1: set()}
        for i, parent in enumerate(f.parent):
            chain[i] = chain[parent] | ({parent} - {-1})
        for i in range(len(f.tag)):
            assert {j for j in range(len(f.tag)) if j < i <= f.last[j]} == chain[i]
            near = [j for j in sorted(chain[i]) if f.tag[j] == "table"]
            assert f.table[i] == (near[-1] if near else None)
        for seq, (parent, _, _) in enumerate(f.strings):
            assert {j for j in range(len(f.tag)) if f.first_seq[j] <= seq < f.end_seq[j]} == (chain[parent] | {parent} if parent >= 0 else set())


def test_native_anchors_take_every_quote_form(spark):
    from bidlake.operators import links

    body = """<p><a href="/d?x=1">Double</a> <a class=k href='/s'>Single <i>one</i></a> <a href=/b>Bare</a> <a name=n>None</a> <A HREF = "">Empty</A></p>"""
    pages = spark.createDataFrame([(1, body), (2, None)], "page_id int, html string")
    got = [(r["href"], r["text"]) for r in links.anchors(pages).orderBy("link_pos").collect()]
    docs = pages.selectExpr("cast(page_id as string) as doc_id", "'' as subject", "html")
    dom = [r["href"] for r in html.anchors(html.dom_facts(docs, materialize=False)[0]).orderBy("link_seq").collect()]
    assert got == [("/d?x=1", "Double"), ("/s", "Single one"), ("/b", "Bare"), ("", "Empty")] and [h for h, _ in got] == dom


def test_stored_facts_are_joined_where_they_lie(spark):
    docs = spark.createDataFrame([(str(i), "", f"<table><tr><td><a href='/{i}'>one</a></td></tr></table>" * (i % 4)) for i in range(300)] + [("x", "", None)], "doc_id string, subject string, html string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        nodes, strings = html.dom_facts(docs)
        rows = nodes.where("tag = 'tr'").select("doc_id", F.col("node_id").alias("tr_id"), "first_seq", "end_seq")
        found = html.texts_of(strings, html.anchors(nodes).select("doc_id", "tr_id").join(rows, ["doc_id", "tr_id"]), ["tr_id"])
        assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
        assert found.count() == sum(i % 4 for i in range(300))
        plain_nodes, plain_strings = html.dom_facts(docs, materialize=False)
        assert sorted(map(str, nodes.collect())) == sorted(map(str, plain_nodes.collect()))
        assert sorted(map(str, strings.collect())) == sorted(map(str, plain_strings.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_the_mailbox_is_landed_compressed(spark):
    import os

    from bidlake.sources import standin_mail

    for path in standin_mail.land(spark, "/root/testdata/sf0.001"):
        files = [f for f in os.listdir(path.removeprefix("file:")) if f.startswith("part-")]
        assert files and all(f.endswith(".json.gz") for f in files)
