"""Persistent tables (S8..S16): open-or-create, additive schema evolution,
name-aligned appends, copy-on-write rewrites of batches and the run log.

Tables are Parquet directories (or catalog tables); every column is a string.
Rows are always aligned to the live header by *name* (``unionByName`` /
``select``), never by position.  Appends land as a ``batch_id=<n>`` partition
written with dynamic partition overwrite, so a retried batch replaces itself
instead of duplicating rows.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from bidlake.settings import RUN_LOG_COLUMNS

BATCH_COL = "batch_id"


def string_schema(columns) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def path_exists(spark: SparkSession, path: str) -> bool:
    """Does the folder hold a data file (on whatever file system the path names)?"""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    try:
        return not files.load(path).select("path").isEmpty()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def open_or_create(spark: SparkSession, path: str, columns) -> DataFrame:
    """S8 + S11: the table's rows, or an empty table with ``columns`` (also when only empty batches were written).

    ``mergeSchema`` reunites batches written under older headers.  Batches
    that an upsert rewrote are read from the latest published version.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], string_schema(columns))
    written = spark.read.option("mergeSchema", "true").parquet(path)
    for version, batches in sorted(rewritten(spark, path).items()):
        folder = rewrites_path(path, version)
        fresh = spark.read.option("basePath", folder).option("mergeSchema", "true").parquet(*[f"{folder}/{BATCH_COL}={b}" for b in batches])
        written = written.where(~F.col(BATCH_COL).isin(batches)).unionByName(fresh, allowMissingColumns=True)
    return written


def rewrites_path(path: str, version: int) -> str:
    return f"{path.rstrip('/')}.rewrites/v{version}"


def published_version(spark: SparkSession, path: str) -> int:
    """The latest published version of a table (0: as appended)."""
    version = 0
    while path_exists(spark, f"{path.rstrip('/')}.manifest/v{version + 1}"):
        version += 1
    return version


def rewritten(spark: SparkSession, path: str) -> dict[int, list[int]]:
    """The batches that are read from rewrites, by the version that holds them (one small row a batch)."""
    version = published_version(spark, path)
    found: dict[int, list[int]] = {}
    if version:
        for row in spark.read.schema("batch bigint, version bigint").parquet(f"{path.rstrip('/')}.manifest/v{version}").collect():
            found.setdefault(row["version"], []).append(row["batch"])
    return {v: sorted(b) for v, b in found.items()}


def rewrite_batches(rows: DataFrame, path: str, batches: list[int]) -> int:
    """S15 target, copy on write: the whole new contents of ``batches`` become the next version; other batches stay where they are.

    The rewritten folders are written first, then a small manifest publishes
    them: readers see the old version until it is there, and a run that died
    in between is overwritten by the next.  One writer per table.
    """
    spark = rows.sparkSession
    current = rewritten(spark, path)
    version = published_version(spark, path) + 1
    (rows.write.mode("overwrite").partitionBy(BATCH_COL).parquet(rewrites_path(path, version)))
    entries = [(b, v) for v, held in current.items() for b in held if b not in batches] + [(b, version) for b in batches]
    spark.createDataFrame(entries, "batch bigint, version bigint").coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}.manifest/v{version}")
    return version


def evolve_header(existing, required) -> list[str]:
    """S12 + U3: existing order kept, missing required columns appended, nothing dropped."""
    existing = list(existing)
    return existing + [c for c in required if c not in existing]


def align(df: DataFrame, header) -> DataFrame:
    """Columns by name in header order; a missing column is ''."""
    return df.select(*[F.col(h) if h in df.columns else F.lit("").alias(h) for h in header])


def union_aligned(master: DataFrame, batch: DataFrame, header) -> DataFrame:
    """Master and batch both aligned to ``header`` by name, then unioned."""
    return align(master, header).unionByName(align(batch, header))


def append_batch(batch: DataFrame, path: str, header, batch_id: int) -> None:
    """Write one batch as partition ``batch_id`` (idempotent retry)."""
    out = align(batch, header).withColumn(BATCH_COL, F.lit(batch_id).cast("bigint"))
    (out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BATCH_COL)
        .parquet(path))


def ordered_view(master: DataFrame, sort_cols) -> DataFrame:
    """S13: "prepend" semantics on read: newest batch first, then its own order."""
    if BATCH_COL not in master.columns:
        return master.orderBy(*sort_cols)
    return master.orderBy(F.col(BATCH_COL).desc(), *sort_cols)


def append_run_log(row: DataFrame, path: str, batch_id: int) -> None:
    """The run's audit row as its batch's partition, so a retried run replaces its row; read newest first via ``runAtUTC``."""
    append_batch(row, path, RUN_LOG_COLUMNS, batch_id)


def save_bucketed_master(df: DataFrame, table: str, key_col: str, buckets: int) -> None:
    """A master that no longer broadcasts, stored bucketed and sorted by its key.

    Anti-joins and key-set aggregates on ``key_col`` then read the master
    already hash-partitioned: only the (much smaller) incoming batch is
    shuffled, into the same ``buckets`` partitions.
    """
    (df.write.mode("overwrite").format("parquet")
       .bucketBy(buckets, key_col).sortBy(key_col)
       .saveAsTable(table))
