"""Selection by rank without a sort: the n-th smallest values of integer columns.

A round counts the rows of equal ranges of the values still in question (a
partial aggregate per task, at most ``ranges`` rows to the driver) and keeps
the one range that holds the rank.  With 4,096 ranges a 64-bit column takes at
most seven rounds; a round ends the search as soon as a range ends exactly at
the rank.  No task holds more than the counters, whatever the rank is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANGES = 4096


def nth_smallest(df: DataFrame, column: str, n: int, ranges: int = RANGES) -> int | None:
    """The n-th smallest non-null value (from 1; equal values count each), None if there are fewer."""
    return quantiles(df, column, [n], ranges)[n]


def quantiles(df: DataFrame, column: str, ranks: list[int], ranges: int = RANGES) -> dict[int, int | None]:
    """The values at several ranks (from 1), found together: each round is one pass for all ranks still open.

    Ranks below 1 or beyond the non-null rows give None.  ``df`` is read once
    a round, so it should be a table or cut from its lineage.
    """
    value = F.col(f"`{column}`").cast("long")
    ends = df.agg(F.min(value).alias("low"), F.max(value).alias("high"), F.count(value).alias("n")).first()
    found: dict[int, int | None] = {r: None for r in ranks}
    open_ranks = {r: (ends["low"], ends["high"], r) for r in ranks if 1 <= r <= ends["n"]}
    while open_ranks:
        spans = sorted({(low, high) for low, high, _ in open_ranks.values()})
        counted = df.select(value.alias("v"), _span_of(value, spans).alias("span")).where("span is not null")
        rows = counted.groupBy("span", _range_start(spans, ranges).alias("k")).agg(F.count("*").alias("n"), F.min("v").alias("least"), F.max("v").alias("most")).collect()
        by_span: dict[int, list] = {}
        for r in sorted(rows, key=lambda r: (r["span"], r["k"])):
            by_span.setdefault(r["span"], []).append(r)
        for rank, (low, high, left) in list(open_ranks.items()):
            for r in by_span[spans.index((low, high))]:
                if left > r["n"]:
                    left -= r["n"]
                    continue
                if left == r["n"] or r["least"] == r["most"]:
                    found[rank] = r["most"]
                    del open_ranks[rank]
                else:
                    open_ranks[rank] = (r["least"], r["most"], left)
                break
    return found


def _span_of(value: Column, spans: list[tuple[int, int]]) -> Column:
    """The number of the span a value lies in (null: in none); spans are equal or apart."""
    out = F.lit(None).cast("int")
    for number, (low, high) in enumerate(spans):
        out = F.when(value.between(low, high), F.lit(number)).otherwise(out)
    return out


def _range_start(spans: list[tuple[int, int]], ranges: int) -> Column:
    """The first value of a value's range within its span; a span wider than a long is cut at zero first."""
    v, out = F.col("v"), F.lit(None).cast("long")
    for number, (low, high) in enumerate(spans):
        if high - low < 1 << 63:
            width = -(-(high - low + 1) // ranges)
            start = v - F.pmod(v - F.lit(low).cast("long"), F.lit(width).cast("long"))
        else:
            start = F.when(v < 0, F.lit(low)).otherwise(F.lit(0)).cast("long")
        out = F.when(F.col("span") == number, start).otherwise(out)
    return out
