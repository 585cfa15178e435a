"""Landed notice pages (S1..S3).

Landing layout: JSON lines, one object per fetched page:
``{"run_seq", "agency_seq", "agency_code", "offset", "totalRecords", "opportunitiesData": [...]}``.
A run walks an agency's pages until the first empty page or once ``offset >=
totalRecords`` of its own first page; pages past either point are ignored,
exactly as the walk would never have fetched them, and other runs are not
concerned.  Pages without ``run_seq`` belong to run 0.  The arrival ordinal of
an item is ``(run_seq, agency_seq, offset + position in page)`` packed into one
bigint.
"""

from __future__ import annotations

import json
import tempfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from bidlake.session import stored

ITEM_FIELDS = ("noticeId", "title", "solicitationNumber", "postedDate", "responseDeadLine", "type",
               "setAside", "naicsCode", "fullParentPathName", "fullParentPathCode")
ITEM_SCHEMA = StructType([StructField(f, StringType()) for f in ITEM_FIELDS])
PAGE_SCHEMA = StructType([
    StructField("run_seq", IntegerType()),
    StructField("agency_seq", IntegerType()),
    StructField("agency_code", StringType()),
    StructField("offset", LongType()),
    StructField("totalRecords", LongType()),
    StructField("opportunitiesData", ArrayType(ITEM_SCHEMA)),
])
AGENCY_STRIDE = 1_000_000_000_000
RUN_STRIDE = 1000 * AGENCY_STRIDE


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Raw page envelopes (explicit schema: no inference, codes stay strings)."""
    return spark.read.schema(PAGE_SCHEMA).json(path).withColumn("run_seq", F.coalesce("run_seq", F.lit(0)))


def walked_pages(pages: DataFrame) -> DataFrame:
    """The pages a walk would have consumed, per run and agency."""
    per_agency = pages.groupBy("run_seq", "agency_seq").agg(
        F.max(F.when(F.col("offset") == 0, F.col("totalRecords"))).alias("_total"),
        F.min(F.when(F.coalesce(F.size("opportunitiesData"), F.lit(0)) <= 0, F.col("offset"))).alias("_empty_at"),
    )
    # a few numbers per run and agency: stored, so their size decides whether the pages stay where they are
    kept = pages.join(stored(per_agency), ["run_seq", "agency_seq"])
    cond = (F.col("offset") < F.coalesce(F.col("_total"), F.lit(0))) & (
        F.col("_empty_at").isNull() | (F.col("offset") < F.col("_empty_at")))
    return kept.where(cond).drop("_total", "_empty_at")


def items(pages: DataFrame) -> DataFrame:
    """Items of the walked pages, flattened, with their arrival ordinal."""
    return flattened(walked_pages(pages))


def flattened(walked: DataFrame) -> DataFrame:
    """Items of pages with their arrival ordinal (batch or stream)."""
    exploded = walked.select("run_seq", "agency_seq", "agency_code", "offset",
                             F.posexplode("opportunitiesData").alias("_pos", "_item"))
    ordinal = (F.col("run_seq").cast("bigint") * F.lit(RUN_STRIDE) + F.col("agency_seq").cast("bigint") * F.lit(AGENCY_STRIDE)
               + F.col("offset") + F.col("_pos"))
    return exploded.select(ordinal.alias("ord"), F.col("agency_code").alias("organizationCode"), "_item.*")


def landing_pages_from(items_df: DataFrame, page_size: int) -> DataFrame:
    """Shape item rows into page envelopes (used to land stand-in data and in tests).

    ``items_df`` needs ``agency_seq``, ``agency_code``, ``pos`` (0-based within
    the agency) and the item fields.
    """
    fields = [F.col(f) for f in ITEM_FIELDS]
    grouped = items_df.groupBy("agency_seq", "agency_code", (F.floor(F.col("pos") / page_size) * page_size)
                               .cast("bigint").alias("offset")).agg(
        F.sort_array(F.collect_list(F.struct(F.col("pos"), F.struct(*fields).alias("item")))).alias("_items"))
    totals = items_df.groupBy("agency_seq").agg(F.count(F.lit(1)).cast("bigint").alias("totalRecords"))
    return grouped.join(totals, "agency_seq").select(
        "agency_seq", "agency_code", "offset", "totalRecords",
        F.transform("_items", lambda x: x["item"]).alias("opportunitiesData"))


NO_EMPTY_PAGE = 1 << 62
WALK_PAGES = 64  # pages that pass through Python at once
WALK_STATE = "total bigint, empty_at bigint, waiting string"
WALKED = "run_seq int, agency_seq int, agency_code string, offset bigint, payload string"


def walk_step(key: tuple, frames, state):
    """S1 for one run and agency and the pages that arrived in one trigger: the pages that the walk takes.

    State: the total its first page told (-1 before), the offset of its first
    empty page, and pages that came before the first one.
    """
    total, empty_at, waiting = state.get if state.exists else (-1, NO_EMPTY_PAGE, "[]")
    pages: list[tuple[int, str, int, int]] = []  # offset, code, place and size of the payload in the file
    with tempfile.TemporaryFile() as payloads:

        def keep(code: str, offset: int, payload: str) -> None:
            data = payload.encode()
            pages.append((offset, code, payloads.tell(), len(data)))
            payloads.write(data)

        def payload_of(page: tuple[int, str, int, int]) -> str:
            payloads.seek(page[2])
            return payloads.read(page[3]).decode()

        for code, offset, payload in json.loads(waiting):
            keep(code, offset, payload)
        for frame in frames:
            for code, offset, told, size, payload in zip(frame["agency_code"], frame["offset"], frame["told"], frame["size"], frame["payload"]):
                if offset == 0:
                    total = max(total, int(told))
                if size <= 0:
                    empty_at = min(empty_at, int(offset))
                else:
                    keep(code, int(offset), payload)
        state.update((total, empty_at, json.dumps([] if total >= 0 else [(p[1], p[0], payload_of(p)) for p in pages])))
        taken = sorted((p for p in pages if p[0] < min(total, empty_at)), key=lambda p: p[0])
        for at in range(0, len(taken), WALK_PAGES):
            some = taken[at:at + WALK_PAGES]
            yield pd.DataFrame({"run_seq": [key[0]] * len(some), "agency_seq": [key[1]] * len(some), "agency_code": [p[1] for p in some],
                                "offset": [p[0] for p in some], "payload": [payload_of(p) for p in some]})


def walked_stream(pages: DataFrame) -> DataFrame:
    """S1 + T1: the pages a walk takes, from a stream of landed pages, as soon as they are known to belong to it.

    One small state per (run, agency).  Pages of an agency arrive in the order
    of their offsets (the walk fetches them so); a page past the total or past
    an empty page is left out, as in ``walked_pages``.
    """
    sent = pages.select(
        F.coalesce("run_seq", F.lit(0)).alias("run_seq"), "agency_seq", "agency_code", "offset", F.coalesce("totalRecords", F.lit(0).cast("long")).alias("told"),
        F.coalesce(F.size("opportunitiesData"), F.lit(0)).alias("size"), F.to_json("opportunitiesData", {"ignoreNullFields": "false"}).alias("payload"))
    taken = sent.groupBy("run_seq", "agency_seq").applyInPandasWithState(walk_step, WALKED, WALK_STATE, "append", "NoTimeout")
    return taken.select("run_seq", "agency_seq", "agency_code", "offset", F.from_json("payload", ArrayType(ITEM_SCHEMA)).alias("opportunitiesData"))


def page_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Landed pages as a file stream."""
    reader = spark.readStream.schema(PAGE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)


DAY_COL = "posted_day"


def land_by_day(items_df: DataFrame, path: str) -> None:
    """S2 + S3: items landed in one folder per posted day (the first ten characters; blank ones under a folder of their own)."""
    day = F.substring(F.coalesce(F.col("postedDate").cast("string"), F.lit("")), 1, 10)
    days = items_df.withColumn(DAY_COL, F.when(day.rlike(r"^[\w-]+$"), day).otherwise(F.lit("none")))
    # by range, so that a day stands in few files and one with very many items in several
    tasks = int(items_df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = days.repartitionByRange(tasks, DAY_COL, F.xxhash64(*[F.col(f"`{c}`") for c in items_df.columns]))
    ranged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY_COL).parquet(path)


def landed_days(spark: SparkSession, path: str, schema: StructType, start: str, end: str) -> DataFrame:
    """S2 + S3: the items posted from ``start`` to ``end``; only the folders of those days are read."""
    whole = StructType([*schema.fields, StructField(DAY_COL, StringType())])
    return spark.read.schema(whole).parquet(path).where(F.col(DAY_COL).between(start, end)).drop(DAY_COL)
