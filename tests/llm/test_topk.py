import math
import random

import numpy as np

from pyspark.sql import functions as F

from bidlake.llm import topk


def brute(rows, k, scale=64):
    usable = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    usable = [(i, list(v)) for i, v in sorted({(i, tuple(v)) for i, v in usable})]
    found = set()
    for q, qv in usable:
        if q % 5:
            continue
        scores = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in usable if i != q and len(v) == len(qv))
        found |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])}
    return found


def test_against_every_pair(spark):
    pick = random.Random(9)
    rows = [(i, [pick.choice([-1.5, -0.25, 0.0, 0.5, 1.25]) for _ in range(6)]) for i in range(300)]  # many ties
    rows += [(300 + i, list(rows[i][1])) for i in range(40)] + [(7, rows[7][1]), (None, [1.0] * 6), (400, None), (405, []), (410, [1.0, None, 0.0, 0.0, 0.0, 0.0]),
             (415, [float("nan")] * 6), (420, [float("inf")] * 6), (425, [1.0, 2.0]), (430, [3.0, -1.0]), (435, [1e7] * 6), (440, [-1e7] * 6)]
    table = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, label int, score string")
    got = topk.top_neighbours(table, F.col("vec_id") % 5 == 0, topk.TopkSettings(k=7, shard_rows=60, block_queries=9, leaf_rows=8))
    assert {tuple(r) for r in got.collect()} == brute(rows, 7)


def test_few_rows(spark):
    table = spark.createDataFrame([(0, [1.0]), (5, [2.0])], "vec_id long, embedding array<float>")
    assert {tuple(r) for r in topk.top_neighbours(table, F.col("vec_id") % 5 == 0).collect()} == {(0, 1, 5, 8192), (5, 1, 0, 8192)}
    assert topk.top_neighbours(table.limit(0), F.col("vec_id") % 5 == 0).count() == 0


def clustered(spark, n=6000):
    pick = np.random.default_rng(5)
    centres = pick.normal(0, 1, (12, 8))
    rows = [(i, [float(x) for x in 2 * centres[i % 12] + 0.05 * pick.normal(0, 1, 8)]) for i in range(n)]
    rows += [(n + i, [0.5] * 8) for i in range(n // 2)]  # one vector holds a third of all rows
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def test_shards_are_bounded_and_boxes_spare_queries(spark, monkeypatch):
    rows, table = clustered(spark)
    seen, reached = [], topk.reached

    def counted(blocks, boxes, numbers, settings):
        out = reached(blocks, boxes, numbers, settings)
        seen.append((out.agg(F.sum(F.size("rows"))).first()[0] or 0, blocks.agg(F.sum(F.size("rows"))).first()[0] * (boxes.count() - 1)))
        return out

    monkeypatch.setattr(topk, "reached", counted)
    settings = topk.TopkSettings(k=5, shard_rows=200, block_queries=50, leaf_rows=32, box_block=7, span_blocks=2)
    vectors = topk.dealt(topk.whole_vectors(table, settings), settings)
    sizes = [r["count"] for r in vectors.groupBy("shard").count().collect()]
    assert sum(sizes) == len(rows) and max(sizes) <= 2 * 200 and len(sizes) >= 40
    got = {tuple(r) for r in topk.top_neighbours(table, F.col("vec_id") % 60 == 0, settings).collect()}
    whole = np.floor(64 * np.array([v for _, v in rows])).astype(np.int64)
    expected = set()
    for q in range(0, len(rows), 60):
        scores = whole @ whole[q]
        order = [j for j in np.lexsort((np.arange(len(rows)), -scores)) if j != q][:5]
        expected |= {(q, n + 1, int(j), int(scores[j])) for n, j in enumerate(order)}
    assert got == expected
    sent, every = seen[0]
    print("sent", sent, "of", every)
    assert sent < every / 2


def test_a_query_is_sent_where_its_bound_reaches(spark):
    trees = spark.createDataFrame([("2:0:0", [(1, [9, 9], 0.0), (2, [8, 9], 0.0)]), ("2:1:0", [(3, [1, 0], 0.0)]), ("2:2:0", [(4, [0, 7], 0.0)])],
                                  "shard string, rows array<struct<vec_id: long, v: array<bigint>, kth: double>>")
    boxes = topk.shard_boxes(trees)
    assert {(r["shard"], tuple(r["low"]), tuple(r["high"])) for r in boxes.collect()} == {("2:0:0", (8, 9), (9, 9)), ("2:1:0", (1, 0), (1, 0)), ("2:2:0", (0, 7), (0, 7))}
    blocks = spark.createDataFrame([(2, 0, [(10, [1, 1], 7.0, "2:1:0"), (11, [1, 0], float("nan"), "2:0:0"), (12, [-1, 0], 0.0, "2:0:0")])],
                                   "dims int, block int, rows array<struct<vec_id: long, v: array<bigint>, kth: double, home: string>>")
    sent = {(r["shard"], m["vec_id"]) for r in topk.reached(blocks, boxes, 1, topk.TopkSettings(box_block=2)).collect() for m in r["rows"]}
    assert sent == {("2:0:0", 10), ("2:2:0", 10), ("2:1:0", 11), ("2:2:0", 11), ("2:2:0", 12)}


def test_splits_keep_equal_rows_together():
    rows = np.array([[0, 5]] * 50 + [[i, 5] for i in range(50)], dtype=np.int64)
    splits = topk.fitted_splits(rows, 8, least=4)
    where = splits.place(rows)
    assert len(set(where[:51].tolist())) == 1 and 4 <= len(set(where.tolist())) <= 8
    assert set(topk.fitted_splits(rows[:50], 8).place(rows).tolist()) == {0}


def test_nothing_is_stored_as_a_list_of_a_shard_or_block(spark, monkeypatch):
    """Readers take thousands of rows at once, so a row may hold a vector but no shard's or block's vectors."""
    kinds, stored = [], topk.stored
    monkeypatch.setattr(topk, "stored", lambda df, *more: kinds.append(df.dtypes) or stored(df, *more))
    _, table = clustered(spark, 600)
    topk.top_neighbours(table, F.col("vec_id") % 60 == 0, topk.TopkSettings(k=5, shard_rows=100, block_queries=5)).collect()
    assert len(kinds) >= 6 and not any("struct" in kind or "array<array" in kind for columns in kinds for _, kind in columns)


def test_boxes_of_a_shard_in_several_lists(spark):
    trees = spark.createDataFrame([("2:0:0", [(1, [9, 1])]), ("2:0:0", [(2, [8, 3]), (3, [7, 2])])], "shard string, rows array<struct<vec_id: long, v: array<bigint>>>")
    assert [tuple(r) for r in topk.shard_boxes(trees).collect()] == [("2:0:0", [7, 1], [9, 3])]
