"""The training-data pipeline: language, toxicity, near-duplicates, benchmark passages, source mix.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; ``run`` writes every stage's rows as Parquet and reads them for the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidlake.llm import decontam, langid, mixing, neardup, toxicity
from bidlake.llm.common import remainder, stored, table


def _rows(docs: DataFrame) -> DataFrame:
    """Whole rows as one column beside what an operator reads, so that no column of theirs clashes."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "text")


def bounded(spark: SparkSession) -> None:
    """Texts pass through Python in batches of 8 MB (the session's setting is 64 MB, held several times over by each task)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; learned from the rows outside the held-out fold of 5."""
    bounded(spark)
    model = langid.train(docs, remainder(5) != 0)
    return langid.identify(_rows(docs), model).where(~F.col("rejected")).select("_row.*")


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic; learned from labelled rows outside the held-out fold of 4."""
    bounded(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), remainder(4) != 2)
    return toxicity.score_texts(_rows(docs), model).where("predicted = 0").select("_row.*")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8 or more)."""
    bounded(spark)
    return neardup.deduplicated(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    bounded(spark)
    return decontam.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of what is left: doc_id, size, source_size, target, taken."""
    return mixing.mix(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", keep_identified),
    ("toxicity", keep_clean),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
