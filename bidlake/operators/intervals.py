"""Range questions answered by order instead of pairwise comparison.

``first_at_or_after`` finds, for each probe, the best event at or after the
probe's position under the same keys: probes and events are put into one
order and a running minimum runs backwards over it.  Probes and events are
never multiplied, so a key with many of both costs a sort, not a product.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_at_or_after(probes: DataFrame, events: DataFrame, keys: list[str], position: str, value: Column, out_col: str) -> DataFrame:
    """The probes with the least ``value`` of the events at or after their ``position`` (null if none).

    ``value`` is a column over ``events``; structs order by their first field.
    Both tables hold the keys and ``position``; events of one position should
    be aggregated before.  Rows of one set of keys meet in one task: keys
    should say whose positions they are (a document, a notice).
    """
    own = [c for c in probes.columns if c not in (*keys, position)]
    asked = probes.select(*keys, position, F.lit(0).alias("_kind"), F.struct(*own).alias("_own") if own else F.lit(None).alias("_own"))
    seen = events.select(*keys, position, F.lit(1).alias("_kind"), value.alias("_value"))
    both = asked.unionByName(seen, allowMissingColumns=True)
    backwards = Window.partitionBy(*keys).orderBy(F.col(position).desc(), F.col("_kind").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    best = both.withColumn(out_col, F.min("_value").over(backwards)).where("_kind = 0")
    return best.select(*keys, position, *[F.col(f"_own.{c}").alias(c) for c in own], out_col)
