"""Incremental ingest: micro-batches equal the batch result, replays are idempotent."""

import os
import tempfile

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from bidlake.operators import dedup
from bidlake.plans.streams import EVENTS_SCHEMA, KEY
from bidlake.streaming import ingest
from tests.conftest import SF001


def _land_by_day(folder):
    table = pq.read_table(f"{SF001}/events.parquet").to_pandas().sort_values(["ts", "event_id"])
    table["day"] = table["ts"].dt.strftime("%Y-%m-%d")
    for i, (day, part) in enumerate(table.groupby("day", sort=True)):
        part.drop(columns=["day"]).to_parquet(os.path.join(folder, f"{i:03d}-{day}.parquet"), index=False)
    return table["day"].nunique()


def test_stream_equals_batch_and_replays_cleanly(spark):
    base = tempfile.mkdtemp(prefix="bidlake-stream-")
    landing, master, ckpt = (os.path.join(base, n) for n in ("landing", "master", "ckpt"))
    os.makedirs(landing)
    n_files = _land_by_day(landing)
    src = ingest.file_stream(spark, landing, EVENTS_SCHEMA, max_files_per_trigger=5)
    ingest.run_first_wins_stream(spark, src, master, KEY, [F.col("ts"), F.col("event_id")], checkpoint=ckpt)
    got = spark.read.parquet(master)
    assert n_files > 5 and got.select("batch_id").distinct().count() >= 2   # several micro-batches
    events = spark.read.schema(EVENTS_SCHEMA).parquet(f"{SF001}/events.parquet")
    want = dedup.first_wins(events, KEY, [F.col("ts"), F.col("event_id")])
    assert sorted(r[0] for r in got.select("event_id").collect()) == sorted(
        r[0] for r in want.select("event_id").collect())
    # restart on the same checkpoint: nothing new
    ingest.run_first_wins_stream(spark, ingest.file_stream(spark, landing, EVENTS_SCHEMA), master, KEY,
                                 [F.col("ts"), F.col("event_id")], checkpoint=ckpt)
    assert spark.read.parquet(master).count() == got.count()
    # replaying an epoch overwrites its own partition only
    writer = ingest.first_wins_batch_writer(master, KEY, [F.col("ts"), F.col("event_id")])
    epoch0 = spark.read.parquet(master).where(F.col("batch_id") == 0).drop("batch_id")
    before = spark.read.parquet(master).count()
    writer(epoch0, 0)
    assert spark.read.parquet(master).count() == before


def test_watermark_dedup_over_many_triggers(spark):
    base = tempfile.mkdtemp(prefix="bidlake-wm-")
    landing, out = os.path.join(base, "landing"), os.path.join(base, "out")
    os.makedirs(landing)
    assert _land_by_day(landing) > 5
    src = ingest.file_stream(spark, landing, EVENTS_SCHEMA, max_files_per_trigger=1)
    ingest.run_watermark_dedup(spark, src, out, KEY, "ts", "1 hour", os.path.join(base, "ckpt"))
    kept = spark.read.schema(EVENTS_SCHEMA).parquet(out).count()
    got = ingest.first_rows(spark, out, EVENTS_SCHEMA, KEY, [F.col("ts"), F.col("event_id")])
    events = spark.read.schema(EVENTS_SCHEMA).parquet(f"{SF001}/events.parquet")
    want = dedup.first_wins(events, KEY, [F.col("ts"), F.col("event_id")])
    assert sorted(r["event_id"] for r in got.collect()) == sorted(r["event_id"] for r in want.collect())
    assert got.count() <= kept <= events.count()


def test_pattern_of_one_file(spark):
    base = tempfile.mkdtemp(prefix="bidlake-one-")
    table = pq.read_table(f"{SF001}/events.parquet")
    for name in ("events.parquet", "events.parquet2"):
        pq.write_table(table, os.path.join(base, name))
    out = os.path.join(base, "master")
    src = ingest.file_stream(spark, ingest.exactly(os.path.join(base, "events.parquet")), EVENTS_SCHEMA)
    ingest.run_first_wins_stream(spark, src, out, ["event_id"], [F.col("ts")], os.path.join(base, "ckpt"))
    assert spark.read.parquet(out).count() == table.num_rows


def test_keyed_state_is_first_wins_and_replays_cleanly(spark):
    base = tempfile.mkdtemp(prefix="bidlake-keyed-")
    landing, out, ckpt = (os.path.join(base, n) for n in ("landing", "out", "ckpt"))
    os.makedirs(landing)
    assert _land_by_day(landing) > 5
    events = spark.read.schema(EVENTS_SCHEMA).parquet(f"{SF001}/events.parquet")
    want = sorted(map(tuple, dedup.first_wins(events, KEY, [F.col("ts"), F.col("event_id")]).collect()))
    for _ in range(2):  # the second run finds nothing new
        src = ingest.file_stream(spark, landing, EVENTS_SCHEMA, max_files_per_trigger=8)
        ingest.run_stateful(ingest.keyed_first_wins(src, KEY, ["ts", "event_id"]), out, ckpt)
        assert sorted(map(tuple, spark.read.schema(EVENTS_SCHEMA).parquet(out).collect())) == want  # every column, every type
    assert any(name.startswith("state") for name in os.listdir(ckpt))
    # a replay of an epoch: its commit is lost, its rows are written once
    commits = sorted((f for f in os.listdir(os.path.join(ckpt, "commits")) if f.isdigit()), key=int)
    assert len(commits) > 2
    os.remove(os.path.join(ckpt, "commits", commits[-1]))
    if os.path.exists(os.path.join(ckpt, "commits", f".{commits[-1]}.crc")):
        os.remove(os.path.join(ckpt, "commits", f".{commits[-1]}.crc"))
    ingest.run_stateful(ingest.keyed_first_wins(ingest.file_stream(spark, landing, EVENTS_SCHEMA), KEY, ["ts", "event_id"]), out, ckpt)
    assert sorted(map(tuple, spark.read.schema(EVENTS_SCHEMA).parquet(out).collect())) == want


def test_page_walk_stream_equals_the_batch_walk(spark):
    import json
    import random
    import time

    from bidlake.sources import notices as landed

    pick = random.Random(4)
    base = tempfile.mkdtemp(prefix="bidlake-walk-")
    landing, out = os.path.join(base, "landing"), os.path.join(base, "out")
    os.makedirs(landing)
    files: list[list[dict]] = [[], [], [], []]
    for run in (None, 1):
        for agency in range(6):
            total = pick.choice([0, 3, 10, 25, None])
            empty = pick.choice([None, None, 5, 15])
            at = 0
            for offset in range(0, 40, 5):
                at = max(at, min(3, pick.randrange(0, 4)))  # pages of an agency arrive in order, over several landings
                items = [] if offset == empty else [{"noticeId": f"{run}-{agency}-{offset + i}", "title": pick.choice([None, "a \"b\"", "ü"])} for i in range(5)]
                files[at].append({"run_seq": run, "agency_seq": agency, "agency_code": str(agency), "offset": offset, "totalRecords": total if offset == 0 else 999, "opportunitiesData": items})
    for i, pages in enumerate(files):
        with open(os.path.join(landing, f"{i}.json"), "w") as f:
            f.write("\n".join(map(json.dumps, pages)))
        time.sleep(0.05)
    want = landed.items(landed.read_pages(spark, landing))
    stream = landed.flattened(landed.walked_stream(landed.page_stream(spark, landing, 1)))
    ingest.run_stateful(stream, out, os.path.join(base, "ckpt"))
    got = spark.read.schema(stream.schema).parquet(out)
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() > 20


def test_keys_of_a_group_share_a_state(spark):
    """Many keys in few groups, null keys and order values among them: each key's first row once, whatever the batches."""
    base = tempfile.mkdtemp(prefix="bidlake-groups-")
    landing, out = os.path.join(base, "landing"), os.path.join(base, "out")
    first = [(i % 400 if i % 11 else None, f"t{i % 3}", i * 7919 % 1000 if i % 5 else None, i) for i in range(2000)]
    later = [(i % 500, f"t{i % 3}", 0, 5000 + i) for i in range(1000)]
    schema = "user_id long, event_type string, at long, event_id long"
    for rows in (first, later):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)
    src = ingest.file_stream(spark, landing, spark.read.parquet(landing).schema, max_files_per_trigger=1)
    found = ingest.keyed_first_wins(src, ["user_id", "event_type"], ["at", "event_id"])
    assert ingest.KEY_GROUPS < 10_000 and "_group" in found._jdf.queryExecution().logical().toString()
    ingest.run_stateful(found, out, os.path.join(base, "ckpt"), batch_rows=50)
    want = {}
    for rows in (first, later):
        new = {}
        for user, kind, at, event in rows:
            if (user, kind) not in want:
                new[user, kind] = min(new.get((user, kind), (True, 0, 1 << 40)), (at is None, at or 0, event))
        want.update(new)
    assert {(r["user_id"], r["event_type"]): r["event_id"] for r in spark.read.parquet(out).collect()} == {k: v[2] for k, v in want.items()}
    assert spark.read.parquet(out).count() == len(want)


def test_walked_pages_leave_a_few_at_a_time():
    import pandas as pd

    from bidlake.sources import notices as landed

    class State:
        exists, value = False, None

        def update(self, value):
            self.exists, self.value = True, value

    def frame(offsets):
        return pd.DataFrame({"agency_code": "a", "offset": offsets, "told": 1900, "size": [5 if o != 1500 else 0 for o in offsets], "payload": [f"é{o}" for o in offsets]})

    state = State()
    offsets = list(range(0, 2000, 5))
    frames = list(landed.walk_step((0, 1), iter([frame(offsets[200:]), frame(offsets[:200])]), state))
    assert max(map(len, frames)) <= 64 and state.value[:2] == (1900, 1500)
    rows = pd.concat(frames)
    assert rows["offset"].tolist() == list(range(0, 1500, 5)) and rows["payload"].tolist() == [f"é{o}" for o in range(0, 1500, 5)]
