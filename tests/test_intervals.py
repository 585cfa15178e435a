"""Ordered range questions against plain loops."""

import random

from pyspark.sql import functions as F

from bidlake.operators import html, intervals


def test_first_at_or_after(spark):
    pick = random.Random(3)
    probes = [(pick.randrange(3), pick.randrange(30), n) for n in range(60)] + [(9, 5, 60), (None, 1, 61), (0, 100, 62)]
    events = [(pick.randrange(3), p, pick.randrange(50)) for p in range(0, 40, 2)] + [(None, 3, 7)]
    p = spark.createDataFrame(probes, "k int, at int, n int")
    e = spark.createDataFrame(events, "k int, at int, v int")
    got = {r["n"]: r["best"] for r in intervals.first_at_or_after(p, e, ["k"], "at", F.col("v"), "best").collect()}
    want = {n: min((v for k2, a2, v in events if k2 == k and a2 >= a), default=None) for k, a, n in probes}
    assert got == want


def test_first_at_or_after_never_multiplies(spark):
    probes = spark.range(20_000).selectExpr("1 as k", "id as at", "id as n")
    events = spark.range(20_000).selectExpr("1 as k", "id as at", "id as v")
    found = intervals.first_at_or_after(probes, events, ["k"], "at", F.col("v"), "best")
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.where("best = at").count() == 20_000
    assert intervals.first_at_or_after(probes.limit(0), events, ["k"], "at", F.col("v"), "best").count() == 0


def test_texts_of_ranges(spark):
    docs = spark.createDataFrame([("d", "<p> a <b>b</b><script>s</script></p><p>c</p><p> </p>")], "doc_id string, html string")
    nodes, strings = html.dom_facts(docs, materialize=False)
    got = html.texts_of(strings, nodes.select("doc_id", "node_id", "first_seq", "end_seq"), ["node_id"], "+")
    assert {r["node_id"]: r["text"] for r in got.collect()} == {-1: "a+b+c", 0: "a+b", 1: "b", 3: "c"}
