import math
import random

import numpy as np
from pyspark.sql import functions as F

from bidlake.llm import angular

SMALL = angular.MiningSettings(positives=3, negatives=2, references=3, sampled=50, group_rows=8, shard_bytes=1500, block_anchors=4)


def usable(rows):
    return sorted({(i, label, tuple(math.floor(256 * x) for x in v)) for i, v, label in rows
                   if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v)})


def brute(rows, settings=SMALL):
    found, kept = [], usable(rows)
    for a, label, v in kept:
        if a % 5:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, other, w in kept if i != a and len(w) == len(v))
        for p, i, other in [s for s in scored if s[2] == label][:settings.positives]:
            fits = [(j, -n) for n, j, o in scored if o != label and 50 * -p <= 100 * -n <= 95 * -p]
            found += [(a, i, k + 1, j, -p, n) for k, (j, n) in enumerate(fits[:settings.negatives])]
    return sorted(found)


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").select("*", F.lit("x").alias("score"), F.lit(1).alias("row"), F.lit(2).alias("shard"))


def test_against_every_pair(spark):
    pick = random.Random(4)
    centres = [[pick.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = [(i, [round(x + pick.gauss(0, 0.4), 1) for x in pick.choice(centres)], pick.randrange(3)) for i in range(260)]
    rows += [(300 + i, list(rows[i][1]), rows[i + 1][2]) for i in range(40)]          # the same vector under other labels
    rows += [(400 + i, [0.5] * 6, 1) for i in range(60)]                               # one very frequent vector
    rows += [(7, rows[7][1], rows[7][2]), (10, [1.0] * 6, 2), (500, [0.0] * 6, 1), (505, [1.0, 2.0], 1), (506, [1.0, 1.9], 1), (507, [1.0, 1.0], 0)]
    rows += [(None, [1.0] * 6, 1), (510, None, 1), (515, [], 1), (520, [1.0, None] + [0.0] * 4, 1), (525, [float("nan")] * 6, 1), (530, [float("inf")] * 6, 1), (535, [1.0] * 6, None)]
    got = angular.hard_negatives(table(spark, rows), F.col("vec_id") % 5 == 0, SMALL)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


def test_few_and_extreme_rows(spark):
    rows = [(0, [1e30, 1.0], 1), (1, [1e30, 0.0], 1), (2, [1.0, 1.0], 2), (3, [-1e30, 0.0], 2)]
    assert angular.hard_negatives(table(spark, rows), F.col("vec_id") % 5 == 0).collect() == []
    rows = [(0, [2.0], 1), (1, [2.0], 1), (2, [1.5], 2)]
    assert [tuple(r) for r in angular.hard_negatives(table(spark, rows), F.col("vec_id") % 5 == 0).collect()] == [(0, 1, 1, 2, 512 * 512, 512 * 384)]
    assert angular.hard_negatives(table(spark, rows).limit(0), F.col("vec_id") % 5 == 0).count() == 0


def test_bounds_enclose_scores_and_rule_out():
    pick = np.random.default_rng(2)
    centres = pick.normal(size=(6, 12))
    rows = np.floor(256 * (centres[pick.integers(6, size=400)] + 0.05 * pick.normal(size=(400, 12))))
    references = centres / np.linalg.norm(centres, axis=1, keepdims=True)
    norms, found = angular.angles(rows, references)
    ruled_out = 0
    for k in range(0, 400, 40):
        low, high = angular.score_bounds(norms[k], found[k].astype(float), norms, norms, found, found)
        scores = rows @ rows[k]
        assert (low <= scores).all() and (scores <= high).all()
        group = angular.score_bounds(norms[k], found[k].astype(float), norms[:1] * 0 + norms.min(), norms[:1] * 0 + norms.max(), found.min(axis=0)[None], found.max(axis=0)[None])
        assert group[0][0] <= scores.min() and scores.max() <= group[1][0]
        ruled_out += int((high < 0.8 * scores.max()).sum())
    assert ruled_out > 2000  # most rows of other clusters are never scored
