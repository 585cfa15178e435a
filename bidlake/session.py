"""Session helpers: a tuned local session for tests/bench and the
checkpoint-directory contract for lineage cuts.

On a cluster the session is created by the platform; the library only reads
``spark.checkpoint.dir`` from it.  A directory of our own is set only when
none is configured and the master is local (tests, bench).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Session settings every job relies on (all plain Spark SQL confs).
JOB_CONFS: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # HTML bodies are large rows: keep Arrow batches small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "bidlake") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="bidlake-warehouse-"))
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BIDLAKE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for k, v in JOB_CONFS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def sizing(input_bytes: int, total_cores: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Shuffle and scan sizing for a run over ``input_bytes`` on ``total_cores``.

    Partitions target ``partition_bytes`` (spill-safe for executors with a
    few GB per core) and never fall below two waves of the cluster; AQE then
    coalesces small ones and splits skewed ones at run time.
    """
    partitions = max(2 * total_cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared lineage-cut folder named by the cluster.

    Reads the session's setting; only a local master may fall back to a
    fresh scratch folder (tests).  A cluster without the setting is an error:
    a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if sc.master.startswith("local"):
        path = tempfile.mkdtemp(prefix="bidlake-ckpt-")
        sc.setCheckpointDir(path)
        return sc.getCheckpointDir() or path
    raise RuntimeError("spark.checkpoint.dir is not set; configure a shared (HDFS/S3) folder for checkpoints")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never local)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """``df`` written as Parquet into the shared checkpoint folder and read back.

    Cuts the lineage like ``cut_lineage`` and survives lost executors the same
    way; unlike a checkpoint the files keep column pruning, filters that skip
    folders (``partition_by``) and size statistics, from which Spark decides
    on broadcasts.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_buckets(df: DataFrame, key: str, buckets: int, partition_by: str) -> DataFrame:
    """Like ``stored``, with the rows dealt to ``buckets`` by ``key``.

    Spark joins and groups such files by any columns that hold ``key`` without
    a shuffle.  ``df`` should be partitioned by ``key`` into as many parts, so
    that a bucket is one file.
    """
    name = f"table_{uuid.uuid4().hex}"
    path = f"{checkpoint_dir(df.sparkSession)}/{name}"
    df.write.option("path", path).partitionBy(partition_by).bucketBy(buckets, key).saveAsTable(name)
    return df.sparkSession.table(name)
