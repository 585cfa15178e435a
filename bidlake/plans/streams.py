"""Streaming queries over ``events`` (landing = the events table files)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampType

from bidlake.session import stored
from bidlake.streaming import ingest

# ``ts`` is read as TIMESTAMP (event time for watermarks); the files hold it as
# a timestamp without time zone, and sessions run in UTC.
EVENTS_SCHEMA = StructType([
    StructField("event_id", LongType()), StructField("ts", TimestampType()), StructField("user_id", LongType()),
    StructField("event_type", StringType()), StructField("value", DoubleType()), StructField("props", StringType()),
])
KEY = ["user_id", "event_type"]
WATERMARK_DELAY = "7 days"


def stream_dedup_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 + T2: first event per (user, type) appended exactly once into a master table."""
    src = ingest.file_stream(spark, ingest.exactly(f"{sf_dir.rstrip('/')}/events.parquet"), EVENTS_SCHEMA)
    master = ingest._scratch(spark, "events-master")
    ingest.run_first_wins_stream(spark, src, master, KEY, [F.col("ts"), F.col("event_id")], f"{master}-checkpoint")
    return spark.read.parquet(master).select("event_id", "user_id", "event_type")


CHUNKS = 4
WHOLE_SPAN = "10000 days"  # longer than the events reach, so what the stream writes does not depend on when triggers fall


def land_in_chunks(spark: SparkSession, sf_dir: str) -> str:
    """The events landed as files that arrive one after the other, by event_id."""
    events = spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    last = events.agg(F.max("event_id")).first()[0] or 0
    path = ingest._scratch(spark, "events-landing")
    for k in range(CHUNKS):
        events.where(F.floor(F.col("event_id") * CHUNKS / (last + 1)) == k).coalesce(1).write.mode("append").parquet(path)
    return path


def stream_dedup_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounded-state dedup over several triggers: how often the stream itself wrote each key."""
    src = ingest.file_stream(spark, land_in_chunks(spark, sf_dir), EVENTS_SCHEMA, max_files_per_trigger=1)
    out = ingest._scratch(spark, "events-dedup")
    ingest.run_watermark_dedup(spark, src, out, KEY, "ts", WHOLE_SPAN, f"{out}-checkpoint")
    return spark.read.schema(EVENTS_SCHEMA).parquet(out).groupBy(*KEY).agg(F.count("*").alias("written"))


def stream_keyed_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 + T2 with keyed state: the stream's own output over several triggers, the first chunk's first event of each key."""
    src = ingest.file_stream(spark, land_in_chunks(spark, sf_dir), EVENTS_SCHEMA, max_files_per_trigger=1)
    out = ingest._scratch(spark, "events-first")
    ingest.run_stateful(ingest.keyed_first_wins(src, KEY, ["ts", "event_id"]), out, f"{out}-checkpoint")
    return spark.read.schema(EVENTS_SCHEMA).parquet(out).select("event_id", "user_id", "event_type")


def stream_page_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + T1: the page walk as a stream over pages that arrive in three landings.

    Agencies with an even number tell 250 items less than they have; the page
    in the middle of the others is empty.
    """
    from bidlake.plans.notices import standin_pages
    from bidlake.sources import notices as landed

    total = F.col("totalRecords")
    whole = standin_pages(spark, sf_dir, PAGE_SIZE)
    even = F.col("agency_seq") % 2 == 0
    middle = F.floor(total / 2 / PAGE_SIZE) * PAGE_SIZE
    pages = stored(whole.withColumns({
        "part": F.least(F.floor(F.col("offset") * 3 / total), F.lit(2)),
        "opportunitiesData": F.when(~even & (F.col("offset") == middle), F.slice("opportunitiesData", 1, 0)).otherwise(F.col("opportunitiesData")),
        "totalRecords": F.when(even, F.greatest(total - 250, F.lit(0))).otherwise(total)}))
    path = ingest._scratch(spark, "pages-landing")
    for k in range(3):
        pages.where(F.col("part") == k).drop("part").coalesce(1).write.mode("append").json(path)
    out = ingest._scratch(spark, "walked-items")
    items = landed.flattened(landed.walked_stream(landed.page_stream(spark, path, 1)))
    ingest.run_stateful(items, out, f"{out}-checkpoint", batch_rows=landed.WALK_PAGES)
    return spark.read.schema(items.schema).parquet(out).select("ord", "organizationCode", "noticeId")


PAGE_SIZE = 200
