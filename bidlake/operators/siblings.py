"""Sibling-row access (W5, W6) and first-part selection (W7) without
funnelling a whole group into one task.

``next_values`` answers "the value of the 1st..k-th following sibling" for
rows whose positions are dense (0, 1, 2, ... per parent — the DOM facts and
the conversation turns are numbered that way).  Each row emits itself and k
"I am your i-th next sibling" records keyed by (parent, position - i); one
aggregate on that key gathers them.  The shuffle key includes the position,
so a parent holding a third of all rows still spreads over every task (a
``lead`` window would put that parent in a single task).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def next_values(df: DataFrame, group_cols: list[str], pos_col: str, value: Column, k: int,
                keep: Column | None = None, out_prefix: str = "next_") -> DataFrame:
    """Rows selected by ``keep`` with ``{out_prefix}1..k`` = value of the i-th next sibling (NULL if none).

    Output columns: group_cols, pos_col, ``_self`` (the row's own value) and the k next values.
    """
    keep_flag = (keep if keep is not None else F.lit(True)).cast("boolean")
    offsets = F.array(*[
        F.struct(F.lit(i).alias("i"), (F.col(pos_col) - F.lit(i)).alias("target"),
                 (keep_flag if i == 0 else F.lit(False)).alias("keep"))
        for i in range(k + 1)
    ])
    emitted = df.select(*group_cols, value.alias("_v"), F.explode(offsets).alias("_o")).select(
        *group_cols, F.col("_o.target").alias(pos_col), F.col("_o.i").alias("_i"),
        F.col("_o.keep").alias("_keep"), "_v")
    emitted = emitted.where(F.col(pos_col) >= 0)
    aggs = [F.max(F.col("_keep").cast("int")).alias("_keep"),
            F.max(F.when(F.col("_i") == 0, F.col("_v"))).alias("_self")]
    aggs += [F.max(F.when(F.col("_i") == i, F.col("_v"))).alias(f"{out_prefix}{i}") for i in range(1, k + 1)]
    gathered = emitted.groupBy(*group_cols, pos_col).agg(*aggs)
    return gathered.where(F.col("_keep") == 1).drop("_keep")


def first_part(parts: DataFrame, group_col: str, seq_col: str, value: Column, qualifies: Column,
               out_col: str = "body") -> DataFrame:
    """Value of the lowest-``seq`` qualifying part of each group; '' when none.

    One aggregate (partial + final), so a message with many parts never
    gathers in one task; groups without a qualifying part still appear.
    """
    return parts.groupBy(group_col).agg(
        F.coalesce(F.min_by(value, F.when(qualifies, F.col(seq_col))), F.lit("")).alias(out_col))
