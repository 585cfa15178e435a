import hashlib
import math
import random

import numpy as np
from pyspark.sql import functions as F

from bidlake.llm import simplex

SMALL = simplex.ClusterSettings(dims=5, centroids=6, rounds=3, pivots=4)


def brute(rows, settings=SMALL):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == settings.dims and all(x is not None and math.isfinite(x) for x in v)]
    seeds = sorted((hashlib.sha256(f"{settings.seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centroids = [v for _, v in seeds[:settings.centroids]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids)) for _, v in kept]

    for _ in range(settings.rounds):
        found = assign()
        for k in range(len(centroids)):
            own = [v for (_, v), (_, n) in zip(kept, found) if n == k]
            if own:
                centroids[k] = [sum(x) // len(own) for x in zip(*own)]
    found = assign()
    sums = [sum(d for d, n in found if n == k) for k in range(len(centroids))]
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i is None, i or 0), n, d, sums[n], sum(sums), shas[n]) for (i, _), (d, n) in zip(kept, found))


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").select("*", F.lit("x").alias("cluster"), F.lit(1).alias("v"))


def rows_of(df):
    return sorted(((r[0] is None, r[0] or 0), *r[1:]) for r in df.collect())


def test_against_plain_rounds(spark):
    pick = random.Random(8)
    rows = [(i, [pick.choice([-1.0, -0.5, 0.25, 0.5, 1.75]) + (i % 3) for _ in range(5)]) for i in range(300)]  # many ties
    rows += [(300 + i, [0.5] * 5) for i in range(150)] + [(4, rows[4][1]), (4, [9.0] * 5), (None, [1.0] * 5)]
    rows += [(500, None), (501, []), (502, [1.0] * 4), (503, [1.0, None, 0.0, 0.0, 0.0]), (504, [float("nan")] * 5), (505, [float("-inf")] * 5)]
    assert rows_of(simplex.clusters(table(spark, rows), SMALL)) == brute(rows)


def test_few_flat_and_extreme_rows(spark):
    same = [(i, [1.0] * 5) for i in range(9)]
    assert rows_of(simplex.clusters(table(spark, same), SMALL)) == brute(same)
    line = [(i, [float(i), 0.0, 0.0, 0.0, 0.0]) for i in range(4)]
    assert rows_of(simplex.clusters(table(spark, line), SMALL)) == brute(line)
    assert simplex.clusters(table(spark, line).limit(0), SMALL).count() == 0
    assert simplex.clusters(table(spark, [(None, [1.0] * 5)]), SMALL).count() == 0
    far = simplex.clusters(table(spark, [(1, [1e300] * 5), (2, [-1e300] * 5), (3, [1e5] * 5)]), SMALL)
    assert {r["vec_id"]: r["distance"] for r in far.collect()} == {1: 0, 2: 0, 3: 0}


def test_bounds_enclose_distances_and_rule_out():
    pick = np.random.default_rng(3)
    points = np.floor(256 * (pick.normal(size=(20, 16))[pick.integers(20, size=500)] + 0.05 * pick.normal(size=(500, 16)))).astype(np.int64)
    pivots = simplex.Simplex.spanning(points[:60], 9)
    apexes, centres = pivots.apexes(points), pivots.apexes(points[:40])
    exact = simplex.squared(points, points[:40])
    flat = ((apexes[:, None, :-1] - centres[None, :, :-1]) ** 2).sum(axis=2)
    lower, upper = (flat + (apexes[:, None, -1] + sign * centres[None, :, -1]) ** 2 for sign in (-1, 1))
    assert (lower <= exact + 1e-3 * (1 + exact)).all() and (upper >= exact - 1e-3 * (1 + exact)).all()
    may = simplex.possible(apexes, centres)
    assert may[np.arange(500), exact.argmin(axis=1)].all() and may.mean() < 0.3
