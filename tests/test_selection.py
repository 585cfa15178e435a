"""Selection by rank against sorted values."""

import random

from pyspark.sql import functions as F

from bidlake.operators import dedup, selection

WIDE = [-(1 << 63), (1 << 63) - 1, 0, -1, 1, 5, 5, 5, None, None, 1 << 40, -(1 << 40)]


def check(spark, values, ranks, ranges):
    df = spark.createDataFrame([(v,) for v in values], "`a.b` long")
    ordered = sorted(v for v in values if v is not None)
    expected = {r: ordered[r - 1] if 1 <= r <= len(ordered) else None for r in ranks}
    assert selection.quantiles(df, "a.b", ranks, ranges) == expected


def test_ranks_equal_sorted_values(spark):
    pick = random.Random(4)
    check(spark, WIDE, list(range(0, 13)), 4)
    check(spark, [pick.randrange(-50, 50) for _ in range(400)], [1, 2, 57, 200, 399, 400, 401], 3)
    check(spark, [pick.getrandbits(60) for _ in range(300)], [1, 150, 300], 16)
    check(spark, [7] * 20, [1, 20, 21], 5)
    check(spark, [], [1], 5)


def test_hot_value_and_single_rank(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 11).otherwise(F.col("id")).alias("v"))
    assert selection.nth_smallest(df, "v", 5000) == 11 and selection.nth_smallest(df, "v", 30001) is None
    assert selection.nth_smallest(df, "v", 30000, 2) == 29999


def test_cap_gathers_nothing(spark):
    rows = spark.range(5000).select((F.col("id") * 37 % 5000).alias("ord"), F.lit("x").alias("wide"))
    capped = dedup.strict_cap(rows, 1234)
    plan = capped._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "TakeOrdered" not in plan and "PushedFilters: [IsNotNull(ord), LessThanOrEqual(ord,1233)]" in plan
    assert sorted(r["ord"] for r in capped.collect()) == list(range(1234))
    assert dedup.strict_cap(rows, 9000).count() == 5000 and dedup.strict_cap(rows, 0).count() == 0 and dedup.strict_cap(rows, None).count() == 5000
