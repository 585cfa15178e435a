from collections import Counter, defaultdict

import pytest

from bidlake.llm import mixing
from tests.conftest import SF001
from tests.llm import awkward


def poured(sizes: dict, weights: dict, cap: float = 3.0) -> dict:
    """Targets by sharing round after round until none passes its limit."""
    held: dict = {}
    while True:
        free = [s for s in sizes if s not in held]
        left = sum(sizes.values()) - sum(held.values())
        share = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        over = [s for s in free if share[s] >= cap * sizes[s]]
        if not over:
            return held | share
        held |= {s: cap * sizes[s] for s in over}
        if len(held) == len(sizes):
            return held


@pytest.mark.parametrize("sizes", [{"a": 5, "b": 900, "c": 40, None: 7}, {"a": 10}, {"a": 0, "b": 12}, {"a": 100, "b": 100, "c": 100, "d": 1, "e": 2}])
def test_targets_match_sharing_in_rounds(spark, sizes):
    rows = [(i, s, n) for i, (s, n) in enumerate(sizes.items())]
    got = {r["source"]: r["target"] for r in mixing.source_targets(spark.createDataFrame(rows, "doc_id int, source string, size long")).collect()}
    names = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    want = poured(sizes, {s: i % 3 + 1 for i, s in enumerate(names)})
    assert got == pytest.approx(want)


def test_mix_of_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    taken, target = Counter(), {}
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source_size"]] += r["taken"]
        target[r["source_size"]] = r["target"]
    for size, t in target.items():
        assert abs(taken[size] - t) <= max(100, 0.02 * t)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixing.mix(docs.repartition(5)).collect()))


def test_blocks_hold_what_the_digest_says(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    words = defaultdict(int)
    for r in mixing.mixed_blocks(docs).collect():
        words[r["doc_id"]] += r["words"]
    assert {k: v for k, v in words.items() if v} == {r["doc_id"]: r["taken"] for r in mixing.mix(docs).collect() if r["taken"]}


def test_every_pass_visits_each_block_once(spark):
    from pyspark.sql import functions as F
    for blocks in (1, 2, 7, 1000, 4096):
        draws = spark.range(2 * blocks).select(mixing.permuted(F.col("id"), F.lit(blocks).cast("long"), F.lit(3), 17).alias("b"), "id")
        rows = draws.collect()
        for turn in range(2):
            assert sorted(r["b"] for r in rows if r["id"] // blocks == turn) == list(range(blocks))


def test_awkward_rows(spark):
    rows = mixing.mix(awkward.documents(spark)).collect()
    assert len(rows) == len(awkward.ROWS)
    sizes = Counter((r["doc_id"], r["size"]) for r in rows)
    assert sizes[(1, 16)] == 2 and sizes[(3, 0)] == 1 and sizes[(5, 0)] == 1
    assert all(r["taken"] == 0 for r in rows if r["size"] == 0)
    assert mixing.mix(awkward.no_documents(spark)).count() == 0
