"""Incremental ingest with Structured Streaming (T1..T3).

* T1  new landing files are picked up by a file-stream source
      (``trigger(availableNow=True)`` for scheduled runs, checkpointed).
* T2  exactly-once first-wins append into the master: each micro-batch keeps
      the first row per key (arrival order within the batch), anti-joins the
      master *excluding its own partition* (so a replayed batch sees the same
      master) and overwrites partition ``batch_id=<epoch>``.
* T3  bounded-state variant: ``withWatermark`` + ``dropDuplicatesWithinWatermark``;
      the survivor within a batch is arrival-dependent, so it is only for keys
      whose copies carry identical payloads.

Checkpoints and sink tables live under the session's shared checkpoint
folder unless explicit paths are given.
"""

from __future__ import annotations

import os
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bidlake.operators import dedup
from bidlake.session import checkpoint_dir

BATCH_COL = "batch_id"


def _scratch(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


def file_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """A file-stream source over a landing folder or file pattern (explicit schema).

    The file source wants a folder or a pattern; ``exactly`` makes a pattern of
    a single file's path.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def exactly(path: str) -> str:
    """A pattern that matches this path and no other."""
    return f"{path[:-1]}[{path[-1]}]"


def first_wins_batch_writer(master_path: str, key_cols: list[str], order_cols: list[str | Column]):
    """The ``foreachBatch`` function (idempotent per epoch)."""

    def write(batch: DataFrame, epoch_id: int) -> None:
        from bidlake.sources.tables import path_exists

        spark = batch.sparkSession
        firsts = dedup.first_wins(batch, key_cols, order_cols)
        if path_exists(spark, master_path):
            master = spark.read.parquet(master_path).where(F.col(BATCH_COL) != epoch_id)
            fresh = firsts.join(master.select(*key_cols).distinct(), key_cols, "left_anti")
        else:  # first epoch: no master yet
            fresh = firsts
        (fresh.withColumn(BATCH_COL, F.lit(epoch_id).cast("bigint"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BATCH_COL).parquet(master_path))

    return write


def run_first_wins_stream(spark: SparkSession, source: DataFrame, master_path: str, key_cols: list[str],
                          order_cols: list[str | Column], checkpoint: str) -> None:
    """T1 + T2: drain everything available into the master, exactly once.

    ``checkpoint`` belongs to the master: a fresh one for an existing master
    would number epochs from 0 again and overwrite its first batches.
    """
    q = (source.writeStream.foreachBatch(first_wins_batch_writer(master_path, key_cols, order_cols))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def run_watermark_dedup(spark: SparkSession, source: DataFrame, out_path: str, key_cols: list[str],
                        event_time: str, delay: str, checkpoint: str) -> None:
    """Bounded-state dedup appended to ``out_path`` (parquet).

    A key's repeats within ``delay`` of its last kept row are dropped, and so
    are rows that come later than the watermark.  A key that comes back after
    its state has gone is written again, how often depends on the triggers;
    ``first_rows`` reads one row per key whatever they were.
    """
    deduped = source.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(key_cols)
    q = (deduped.writeStream.format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()


def first_rows(spark: SparkSession, out_path: str, schema: StructType, key_cols: list[str], order_cols: list[str | Column]) -> DataFrame:
    """T3 read side: the first kept row of each key."""
    return dedup.first_wins(spark.read.schema(schema).parquet(out_path), key_cols, order_cols)


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_JSON = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


KEY_GROUPS = 1 << 12  # states; a trigger reads and writes those of its own keys


def keyed_first_wins(source: DataFrame, key_cols: list[str], order_cols: list[str]) -> DataFrame:
    """T2 with keyed state: the first row of each key (by ``order_cols`` within a trigger), once for all triggers.

    Keys are dealt to groups by hash, and a group's state holds its keys seen
    so far, so one call of Python serves many keys and a trigger touches the
    groups of its own rows and nothing else; the master is never read.  Of a
    group's rows in one trigger a batch and the best row of each new key are
    held.  Rows and keys travel as JSON, which keeps every type of the source.
    """
    names = [f"_order{i}" for i in range(len(order_cols))]
    sent = source.select(
        F.pmod(F.xxhash64(*key_cols), F.lit(KEY_GROUPS)).alias("_group"), F.to_json(F.struct(*key_cols), _JSON).alias("_key"),
        *[F.col(c).alias(n) for c, n in zip(order_cols, names)], F.to_json(F.struct(*source.columns), _JSON).alias("_row"))

    def first(key: tuple, frames, state):
        seen = set(state.get[0]) if state.exists else set()
        best = None
        for frame in frames:
            fresh = frame[~frame["_key"].isin(seen)]
            if len(fresh):
                both = fresh if best is None else pd.concat([best, fresh])
                best = both.sort_values([*names, "_row"], kind="stable").drop_duplicates("_key")
        if best is not None:
            state.update(([*seen, *best["_key"]],))
            yield best[["_row"]]

    found = sent.groupBy("_group").applyInPandasWithState(first, "_row string", "seen array<string>", "append", "NoTimeout")
    return found.select(F.from_json("_row", source.schema, {"timestampFormat": _JSON["timestampFormat"]}).alias("_r")).select("_r.*")


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def run_stateful(stream: DataFrame, out_path: str, checkpoint: str, batch_rows: int | None = None) -> None:
    """Drain a stateful stream into Parquet, exactly once, with its state in RocksDB beside the checkpoint.

    ``batch_rows`` bounds the rows that its Python functions get at once (for large rows).
    """
    spark = stream.sparkSession
    wanted = {PROVIDER: ROCKSDB, **({BATCH_ROWS: str(batch_rows)} if batch_rows else {})}
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        query = stream.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value else spark.conf.unset(name)
