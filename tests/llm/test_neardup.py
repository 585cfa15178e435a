import random
import re
from itertools import combinations

import numpy as np
import pytest

from bidlake.llm import neardup
from bidlake.llm.common import looked_up
from bidlake.llm.components import components
from bidlake.llm.wordhash import shingle_set, word_hashes
from tests.conftest import SF001
from tests.llm import awkward

CASE = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, words):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(CASE))
    if len(found) < words:
        return {tuple(found)} if found else set()
    return {tuple(found[i:i + words]) for i in range(len(found) - words + 1)}


def brute(rows, words, percent):
    """Smallest id reachable over all pairs of documents."""
    sets = [(d, shingles(t, words)) for d, t in rows if d is not None]
    parent = {d: d for d, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (d, x), (e, y) in combinations(sets, 2):
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            a, b = root(d), root(e)
            parent[max(a, b)] = min(a, b)
    return {d: root(d) for d, _ in sets}


def crafted(seed):
    pick = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for family in range(12):
        base = [pick.choice(vocabulary) for _ in range(pick.choice([2, 5, 40, 120, 300]))]
        for copy in range(pick.choice([1, 2, 6, 25])):
            words = list(base)
            for _ in range(pick.choice([0, 0, 1, 2, 6])):
                words[pick.randrange(len(words))] = pick.choice(vocabulary)
            rows.append((len(rows), " ".join(w.upper() if pick.random() < 0.1 else w for w in words)))
    pick.shuffle(rows)
    return rows


@pytest.mark.parametrize("words,percent", [(3, 85), (5, 80)])
def test_components_of_crafted_families(spark, words, percent):
    rows = crafted(words)
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), neardup.DedupSettings(words, percent)).collect()
    want = brute(rows, words, percent)
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert {r["doc_id"]: r["n_shingles"] for r in got} == {d: len(shingles(t, words)) for d, t in rows}
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_components_of_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    got = neardup.near_duplicates(docs, neardup.DedupSettings(3, 85)).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == brute([tuple(r) for r in docs.collect()], 3, 85)


def test_bins_agree_as_often_as_the_sets_overlap():
    orders, pick = neardup.bin_orders(), np.random.default_rng(3)
    for size, shared in ((1000, 800), (60, 50)):
        agree = []
        for _ in range(40):
            pool = pick.integers(0, 2 ** 63, 2 * size, dtype=np.uint64)
            x, y = np.unique(pool[:size]), np.unique(np.concatenate([pool[:shared], pool[size:2 * size - shared]]))
            agree.append((neardup.signature(x, orders) == neardup.signature(y, orders)).mean())
        assert abs(np.mean(agree) - shared / (2 * size - shared)) < 0.05


def test_word_hashes():
    assert len(word_hashes(b"a b\tc\x0bd\r\ne\x1cf")) == 5
    assert (word_hashes("Über ABC".encode()) == word_hashes("Über abc".encode())).all()
    assert len(set(word_hashes(b"ab ba a b aa bb abc cab"))) == 8
    assert len(shingle_set(b"", 3)) == 0 and len(shingle_set(b"x y", 3)) == 1 and len(shingle_set(b"x y z x y z x", 3)) == 3


def test_components(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, 101), (101, 102), (200, 200), (300, 250), (250, 275), (102, 100)]
    got = {r["vertex"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, 100: 100, 101: 100, 102: 100, 250: 250, 275: 250, 300: 250}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_vertex_and_a_bucket_that_hold_most_rows(spark):
    star = [(0, i) for i in range(1, 900)] + [(1000 + i, 1001 + i) for i in range(0, 20, 2)] + [(5, 2000)]
    got = {r["vertex"]: r["root"] for r in components(spark.createDataFrame(star, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(900)) and got[2000] == 0 and got[1003] == 1002
    rows = spark.createDataFrame([(i if i < 30 else 7, i) for i in range(1000)] + [(None, -1)], "k long, n long")
    facts = spark.createDataFrame([(i, f"fact {i}") for i in range(20)], "k long, fact string")
    found = looked_up(rows, facts, "k")
    assert "BroadcastHashJoin" in found._jdf.queryExecution().executedPlan().toString()
    assert sorted((r["n"], r["fact"]) for r in found.collect()) == sorted((n, f"fact {n if n < 30 else 7}") for n in range(1000) if n < 20 or n >= 30)


def test_columns_with_dots(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, text, "x"), (1, text, "x"), (2, text, "y")], ["doc_id", "text", "a.b"])
    assert [tuple(r) for r in neardup.deduplicated(docs).collect()] == [(1, text, "x")]


def test_awkward_rows(spark):
    rows = neardup.near_duplicates(awkward.documents(spark)).collect()
    assert len(rows) == len(awkward.ROWS)
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by[2]["component_id"] == 1 and not by[2]["kept"] and by[6]["kept"]
    assert by[3]["n_shingles"] == by[4]["n_shingles"] == by[5]["n_shingles"] == 0 and by[9]["n_shingles"] == 1
    assert all(r["kept"] and r["component_id"] is None for r in rows if r["doc_id"] is None)
    assert neardup.near_duplicates(awkward.no_documents(spark)).count() == 0
    kept = neardup.deduplicated(awkward.documents(spark))
    assert kept.columns == awkward.documents(spark).columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["1", "3", "4", "5", "None", "None", "6", "7", "8", "9", "10"])


def test_links_in_a_bucket_whose_best_members_link_nothing(spark):
    """One bucket of texts around a long template: the members with most company are alone, and pairs are further down."""
    template = [f"t{i}" for i in range(300)]
    texts = [" ".join(template + [f"lone{k}x{i}" for i in range(56)]) for k in range(12)]
    texts += [" ".join(template + [f"p{k}x{i}" for i in range(50)] + [f"p{k}c{copy}y{i}" for i in range(6)]) for k in range(10) for copy in range(2)]
    settings = neardup.DedupSettings(3, 85)
    found = [shingle_set(t.encode(), 3) for t in texts]
    sets = spark.createDataFrame([(k, bytearray(x.tobytes())) for k, x in enumerate(found)], "set_id long, shingles binary")
    nodes = spark.createDataFrame([(k, k, 1) for k in range(len(texts))], "set_id long, least_id long, reach long")
    ranked = spark.createDataFrame([(7, (len(texts) - k, k, len(x))) for k, x in enumerate(found)], "bucket long, rank struct<reach: long, set_id: long, n_shingles: long>")
    roots = {r["set_id"]: r["root"] for r in neardup._labels(nodes, ranked, sets, settings).collect()}
    want = brute(list(enumerate(texts)), 3, 85)
    assert len(set(want.values())) == 22
    assert all((roots[a] == roots[b]) == (want[a] == want[b]) for a, b in combinations(roots, 2))


def test_different_texts_of_one_id_are_dropped_each_by_itself(spark):
    one, two, three, four = (" ".join(f"{name}{i}" for i in range(20)) for name in "abcd")
    rows = [(3, one), (5, one), (3, two), (2, two), (7, three), (7, four), (7, four)]
    kept = neardup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, kept.collect())) == sorted([(3, one), (2, two), (7, three), (7, four)])
