"""Filters, dedup, cap, append invariants, re-check, tables and both feeds end to end."""

import base64
import json
import os
import tempfile

from pyspark.sql import Window
from pyspark.sql import functions as F

from bidlake.operators import dedup, filters, notices, recheck
from bidlake.plans import mail as PM
from bidlake.plans import notices as PN
from bidlake.settings import EXCLUDED_CODES, EXCLUDED_DEPARTMENTS, EXCLUDED_SECTOR_PREFIXES, NOTICE_COLUMNS, JobSettings
from bidlake.sources import notices as landed
from bidlake.sources import standins as S
from bidlake.functions import text as T
from bidlake.sources import tables
from tests.conftest import SF001
from tests.fixtures import COASTAL, FIRST_HTML, FIRST_SUBJECT, RURAL_WATER, SCHOOLS, SECOND_HTML, SECOND_SUBJECT, VACCINES


def scratch():
    return tempfile.mkdtemp(prefix="bidlake-test-")


def test_code_filter_goldens(spark):
    df = spark.createDataFrame([("",), (None,), ("541611",), ("236220",), ("562111",), ("562112",), (" 56211 ",)],
                               "c string")
    keep = [r[0] for r in df.where(filters.code_allowed("c", EXCLUDED_SECTOR_PREFIXES, EXCLUDED_CODES)).collect()]
    assert keep == ["", None, "541611", "562112"]


def test_department_filter_goldens(spark):
    df = spark.createDataFrame([("DEPT OF DEFENSE.DEPT OF THE ARMY",), ("dept of defense.x",), ("",), (None,),
                                (" VETERANS AFFAIRS, DEPARTMENT OF .x",)], "p string")
    keep = [r[0] for r in df.where(filters.department_allowed("p", EXCLUDED_DEPARTMENTS)).collect()]
    assert keep == ["dept of defense.x", "", None]
    table = spark.createDataFrame([(d,) for d in EXCLUDED_DEPARTMENTS], "d string")
    keep2 = sorted("<null>" if r[0] is None else r[0] for r in filters.filter_departments_by_table(
        df.withColumnRenamed("p", "fullParentPathName"), table).collect())
    assert keep2 == sorted(["dept of defense.x", "", "<null>"])


def test_filter_before_dedup_and_cap(spark):
    items = spark.createDataFrame([
        (1, "A", "236220", "X.y"),   # first copy fails the code rule
        (2, "A", "541611", "X.y"),   # later copy passes: accepted
        (3, "B", "541611", "X.y"),
        (4, "B", "541611", "X.y"),   # repeat of an accepted id
        (5, " ", "541611", "X.y"),   # blank id
        (6, "C", "", "X.y"),         # blank code kept
        (7, "D", "541611", "X.y"),   # already in master
    ], "ord bigint, noticeId string, naicsCode string, fullParentPathName string")
    items = items.select("*", *[F.lit(None).cast("string").alias(c) for c in
                                ("title", "solicitationNumber", "postedDate", "responseDeadLine", "type", "setAside",
                                 "fullParentPathCode")])
    master = spark.createDataFrame([("D",)], "noticeId string")
    s = JobSettings(max_records=None)
    got = sorted((r["ord"], r["noticeId"]) for r in notices.accepted_notices(items, master, s, "ts").collect())
    assert got == [(2, "A"), (3, "B"), (6, "C")]
    capped = notices.accepted_notices(items, master, JobSettings(max_records=2), "ts").collect()
    assert sorted(r["ord"] for r in capped) == [2, 3]


def test_classify_invariants(spark):
    df = spark.createDataFrame([(1, "k1"), (2, "k2"), (3, "k1"), (4, "k3"), (5, "k3"), (6, "k3")],
                               "ord bigint, duplicateKey string")
    master = spark.createDataFrame([("k2",), ("",)], "duplicateKey string")
    c = {r["ord"]: r["appendStatus"] for r in dedup.classify_append(df, master).collect()}
    assert c == {1: "new", 2: "dup_master", 3: "dup_batch", 4: "new", 5: "dup_batch", 6: "dup_batch"}
    s = dedup.append_summary(df, master).first()
    assert (s["appended"], s["skipped"], s["total_processed"]) == (2, 4, 6)
    assert sorted(r["ord"] for r in dedup.new_rows(df, master).collect()) == [1, 4]


def test_recheck_is_idempotent(spark):
    master, fresh = S.notice_master(spark, SF001), S.fresh_items(spark, SF001)
    once = recheck.upsert(master, fresh, S.STANDIN_RUN_DATE)
    twice = recheck.upsert(once, fresh, S.STANDIN_RUN_DATE)
    assert once.columns == master.columns
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, twice.collect()), key=str)
    c = recheck.counts(master, fresh, S.STANDIN_RUN_DATE).first()
    assert c["checked"] >= c["updated"] > 0
    assert recheck.counts(once, fresh, S.STANDIN_RUN_DATE).first()["updated"] == 0


def test_schema_evolution_by_name(spark):
    assert tables.evolve_header(["b", "x", "a"], ["a", "b", "c"]) == ["b", "x", "a", "c"]
    master = spark.createDataFrame([("1", "f")], "b string, x string")
    batch = spark.createDataFrame([("2", "3")], "c string, b string")
    out = tables.union_aligned(master, batch, ["b", "x", "c"]).collect()
    assert [tuple(r) for r in out] == [("1", "f", ""), ("3", "", "2")]


def _land_notices(spark, path):
    items = S.notice_items(spark, SF001).select(
        F.col("organizationCode").cast("int").alias("agency_seq"), F.col("organizationCode").alias("agency_code"),
        (F.row_number().over(Window.partitionBy("organizationCode").orderBy("ord")) - 1).alias("pos"),
        *landed.ITEM_FIELDS)
    landed.landing_pages_from(items, 200).write.mode("overwrite").json(path)


def test_landed_notice_ingest_end_to_end(spark):
    base = scratch()
    landing, master, log = (os.path.join(base, n) for n in ("landing", "master", "run_log"))
    _land_notices(spark, landing)
    pages = landed.read_pages(spark, landing)
    n_items = S.notice_items(spark, SF001).count()
    assert landed.items(pages).count() == n_items
    settings = JobSettings(excluded_departments=S.STANDIN_DEPARTMENTS, days_back=400,
                           agency_codes=("0", "1", "2", "3", "4"))
    r1 = PN.ingest_landed_notices(spark, landing, master, log, settings, "1998-08-02", "1998-08-02T00:00:00+00:00", 1)
    assert r1["newRows"] > 0 and r1["agencies"] == "0,1,2,3,4"
    assert "2:" not in r1["notes"] and "4:" not in r1["notes"]   # excluded departments
    # a rerun of the same landing adds nothing; a retried batch id replaces itself
    r2 = PN.ingest_landed_notices(spark, landing, master, log, settings, "1998-08-02", "1998-08-02T00:00:00+00:00", 2)
    assert r2["newRows"] == 0 and r2["notes"] == "no new rows"
    r1b = PN.ingest_landed_notices(spark, landing, master, log, settings, "1998-08-02", "1998-08-02T00:00:00+00:00", 1)
    assert r1b["newRows"] == r1["newRows"]
    table = spark.read.parquet(master)
    assert table.count() == r1["newRows"]
    assert table.select("noticeId").distinct().count() == r1["newRows"]
    assert sorted(r["batch_id"] for r in spark.read.parquet(log).collect()) == [1, 2]  # a retried run replaces its row
    assert [c for c in table.columns if c != "batch_id"] == list(NOTICE_COLUMNS)


def test_walk_stops_at_empty_page_and_total(spark):
    rows = [
        {"agency_seq": 0, "agency_code": "A", "offset": 0, "totalRecords": 3,
         "opportunitiesData": [{"noticeId": "1"}, {"noticeId": "2"}]},
        {"agency_seq": 0, "agency_code": "A", "offset": 2, "totalRecords": 3, "opportunitiesData": [{"noticeId": "3"}]},
        {"agency_seq": 0, "agency_code": "A", "offset": 4, "totalRecords": 9, "opportunitiesData": [{"noticeId": "9"}]},
        {"agency_seq": 1, "agency_code": "B", "offset": 0, "totalRecords": 9, "opportunitiesData": [{"noticeId": "4"}]},
        {"agency_seq": 1, "agency_code": "B", "offset": 1, "totalRecords": 9, "opportunitiesData": []},
        {"agency_seq": 1, "agency_code": "B", "offset": 2, "totalRecords": 9, "opportunitiesData": [{"noticeId": "5"}]},
    ]
    path = os.path.join(scratch(), "pages.json")
    with open(path, "w") as f:
        f.write("\n".join(json.dumps(r) for r in rows))
    got = [r["noticeId"] for r in landed.items(landed.read_pages(spark, path)).orderBy("ord").collect()]
    assert got == ["1", "2", "3", "4"]


def _b64(s):
    return base64.urlsafe_b64encode(s.encode()).decode().rstrip("=")


def _land_mail(base):
    msgs = [
        {"source": None, "id": "m1", "headers": [
            {"name": "Subject", "value": FIRST_SUBJECT}, {"name": "From", "value": "Devex <alerts@devex.com>"},
            {"name": "Date", "value": "Thu, 16 Jul 2026 23:30:00 -0500"}]},
        {"source": None, "id": "m2", "headers": [
            {"name": "subject", "value": "old"}, {"name": "Subject", "value": SECOND_SUBJECT},
            {"name": "From", "value": "alerts@developmentaid.org"}, {"name": "Date", "value": "Wed, 15 Jul 2026 08:00:00 +0000"}]},
        {"source": None, "id": "m3", "headers": [
            {"name": "Subject", "value": FIRST_SUBJECT}, {"name": "From", "value": "alerts@devex.com"},
            {"name": "Date", "value": "Mon, 01 Jun 2026 08:00:00 +0000"}]},   # outside the look-back
    ]
    parts = [
        {"message_id": "m1", "part_seq": 0, "mime_type": "multipart/alternative", "body_b64": ""},
        {"message_id": "m1", "part_seq": 1, "mime_type": "text/plain", "body_b64": _b64("plain")},
        {"message_id": "m1", "part_seq": 2, "mime_type": "text/html", "body_b64": _b64(FIRST_HTML)},
        {"message_id": "m2", "part_seq": 0, "mime_type": "text/html", "body_b64": ""},
        {"message_id": "m2", "part_seq": 1, "mime_type": "text/html", "body_b64": _b64(SECOND_HTML)},
        {"message_id": "m3", "part_seq": 0, "mime_type": "text/html", "body_b64": _b64(FIRST_HTML)},
    ]
    mp, pp = os.path.join(base, "messages.json"), os.path.join(base, "parts.json")
    with open(mp, "w") as f:
        f.write("\n".join(json.dumps(m) for m in msgs))
    with open(pp, "w") as f:
        f.write("\n".join(json.dumps(p) for p in parts))
    return mp, pp


def test_mail_records(spark):
    from bidlake.sources import mail

    mp, pp = _land_mail(scratch())
    recs = {r["message_id"]: r for r in mail.fetch(mail.read_messages(spark, mp), mail.read_parts(spark, pp),
                                                   "2026-07-16", 7).collect()}
    assert set(recs) == {"m1", "m2"}
    assert recs["m1"]["source"] == "devex" and recs["m1"]["email_date"] == "2026-07-16"
    assert recs["m2"]["subject"] == SECOND_SUBJECT   # last duplicate header wins
    assert recs["m2"]["source"] == "developmentaid" and "Tender Alert" in recs["m2"]["html_body"]


def test_mail_search_order_and_dates(spark):
    from bidlake.sources import mail

    def message(i, seq, date, sender="desk@example.org", subject="Weekly list", received=None):
        return {"id": str(i), "message_seq": seq, "received": received, "headers": [{"name": "From", "value": sender}, {"name": "Subject", "value": subject}, {"name": "Date", "value": date}]}

    rows = [message(10, 2, "Thu, 16  Jul 2026 10:00:00 +0000"), message(2, 3, "16 Jul 26 10:00:00 GMT"), message(3, 1, "not a date"), message(4, 4, "not a date", received="2026-01-01T00:00:00Z"),
            message(5, 5, "Thu, 16 Jul 2026 10:00:00 +0000", subject="from DEVELOPMENTAID today"), message(6, 6, "Thu, 16 Jul 2026 10:00:00 +0000"), message(7, 0, "Wed, 15 Jul 2026 10:00:00 +0000", sender="News <alerts@devex.com>")]
    parts = [(str(i), 0, "text/plain", _b64("sent by DevelopmentAid")) for i in (10, 2, 3, 4, 7)] + [("6", 0, "image/png", _b64("DevelopmentAid"))]
    messages = spark.read.schema(mail.MESSAGE_SCHEMA).json(spark.sparkContext.parallelize([json.dumps(r) for r in rows]))
    part_rows = spark.createDataFrame(parts, mail.PART_SCHEMA)
    fetch = lambda **k: sorted((r["source"], r["message_seq"], r["message_id"], r["email_date"]) for r in mail.fetch(messages, part_rows, "2026-07-17", 7, **k).collect())
    aid = [("developmentaid", 0, "7", "2026-07-15"), ("developmentaid", 1, "3", ""), ("developmentaid", 2, "10", "2026-07-16"), ("developmentaid", 3, "2", "2026-07-16"), ("developmentaid", 5, "5", "2026-07-16")]
    assert fetch() == aid + [("devex", 0, "7", "2026-07-15")]
    assert fetch(limit=2) == aid[:2] + [("devex", 0, "7", "2026-07-15")]
    assert fetch(source_filter="desk", rules={"desk": {"sender": "desk@example.org", "phrase": "today"}}) == [("desk", 5, "5", "2026-07-16")]


def test_mail_ingest_end_to_end(spark):
    base = scratch()
    mp, pp = _land_mail(base)
    table = os.path.join(base, "pipeline")
    r1 = PM.ingest_landed_mail(spark, mp, pp, table, "2026-07-16", "2026-07-16T12:00:00+00:00", 1)
    assert (r1["appended"], r1["skipped"], r1["total_processed"]) == (4, 0, 4)
    rows = {r["opportunityTitle"]: r for r in spark.read.parquet(table).collect()}
    assert set(rows) == {x.title for x in (RURAL_WATER, COASTAL, SCHOOLS, VACCINES)}
    water, schools = rows[RURAL_WATER.title], rows[SCHOOLS.title]
    assert water["duplicateKey"] == "devex | rural water supply design services for the upper valley districts | nordic green fund | bhutan"
    assert (water["deadlineISO"], water["language"], water["pipelineStatus"]) == (RURAL_WATER.iso, "English", "New")
    assert (schools["language"], schools["deadlineISO"]) == ("Spanish", SCHOOLS.iso) and "supervisio n de obras" in schools["duplicateKey"]
    assert rows[VACCINES.title]["language"] == "English"
    r2 = PM.ingest_landed_mail(spark, mp, pp, table, "2026-07-16", "2026-07-16T12:00:00+00:00", 2)
    assert (r2["appended"], r2["skipped"], r2["total_processed"]) == (0, 4, 4)
    assert spark.read.parquet(table).count() == 4
    counts, preview = PM.dry_run(spark, mp, pp, "2026-07-16", "2026-07-16T12:00:00+00:00")
    assert counts == {"emails": 2, "opportunities": 4, "more": 0}
    assert all(len(r["opportunityTitle"]) == 40 for r in preview.collect())


def test_snapshot_and_prepend_view(spark):
    base = scratch()
    path = os.path.join(base, "t")
    first = spark.createDataFrame([("a", "2026-01-02"), ("b", "2026-01-03")], "id string, postedDate string")
    second = spark.createDataFrame([("c", "2026-01-01"), ("d", "2026-01-05")], "id string, postedDate string")
    tables.append_batch(first, path, ["id", "postedDate"], 1)
    tables.append_batch(second, path, ["id", "postedDate"], 2)
    view = tables.ordered_view(spark.read.parquet(path), [F.col("postedDate").desc()])
    assert [r["id"] for r in view.collect()] == ["d", "c", "b", "a"]   # newest batch on top
    assert tables.published_version(spark, path) == 0


def test_bucketed_master_anti_join_shuffles_only_the_batch(spark):
    master = S.notice_master(spark, SF001).select("noticeId", "title")
    tables.save_bucketed_master(master, "master_bucketed", "noticeId", 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        incoming = S.notice_items(spark, SF001).select("ord", T.blank("noticeId").alias("noticeId"))
        out = dedup.anti_join_master(incoming, spark.table("master_bucketed"), "noticeId", strip=False)
        lines = out._jdf.queryExecution().executedPlan().toString().split("\n")
        assert any("master_bucketed" in l and "Bucketed: true" in l for l in lines)
        # no exchange has the bucketed master below it: only the batch shuffles
        for i, line in enumerate(lines):
            if "Exchange" in line and "Broadcast" not in line:
                depth = len(line) - len(line.lstrip(" :+-"))
                below = []
                for nxt in lines[i + 1:]:
                    if len(nxt) - len(nxt.lstrip(" :+-")) <= depth:
                        break
                    below.append(nxt)
                assert not any("master_bucketed" in b for b in below), line
        want = incoming.join(master.select(T.blank("noticeId").alias("noticeId")).distinct(), "noticeId", "left_anti")
        assert out.count() == want.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sizing():
    from bidlake.session import sizing

    conf = sizing(100 * 10**12, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) >= 16000
    assert sizing(10**6, 8)["spark.sql.shuffle.partitions"] == "16"


def test_recheck_precondition_is_a_noop(spark):
    master, fresh = S.notice_master(spark, SF001), S.fresh_items(spark, SF001)
    partial = master.drop("fitLabel")
    assert recheck.upsert(partial, fresh, S.STANDIN_RUN_DATE) is partial
    c = recheck.counts(partial, fresh, S.STANDIN_RUN_DATE).first()
    assert (c["checked"], c["updated"]) == (0, 0)


def _write_lines(path, rows):
    os.makedirs(path)
    with open(os.path.join(path, "pages.json"), "w") as f:
        f.write("\n".join(json.dumps(r) for r in rows))


def _page(run, agency, offset, total, ids):
    return {"run_seq": run, "agency_seq": agency, "agency_code": str(agency), "offset": offset, "totalRecords": total,
            "opportunitiesData": [{"noticeId": i, "title": f"Notice {i}", "postedDate": "2026-07-15"} for i in ids]}


def test_page_walks_of_several_runs_do_not_mix(spark):
    path = os.path.join(scratch(), "pages")
    _write_lines(path, [_page(0, 0, 0, 0, []), _page(1, 0, 0, 3, ["a", "b"]), _page(1, 0, 2, 3, ["c"]), _page(1, 0, 4, 3, ["never"]),
                        _page(2, 0, 0, 9, ["d"]), _page(2, 0, 1, 9, []), _page(2, 0, 2, 9, ["never"]), _page(0, 1, 0, 1, ["e"])])
    got = [r["noticeId"] for r in landed.items(landed.read_pages(spark, path)).orderBy("ord").collect()]
    assert got == ["e", "a", "b", "c", "d"]


def test_quiet_first_run_leaves_a_usable_table(spark):
    base = scratch()
    quiet, busy, master, log = (os.path.join(base, n) for n in ("quiet", "busy", "master", "run_log"))
    _write_lines(quiet, [_page(0, 0, 0, 0, [])])
    _write_lines(busy, [_page(1, 0, 0, 2, ["n1", "n2"])])
    run = lambda landing, batch: PN.ingest_landed_notices(spark, landing, master, log, JobSettings(), "2026-07-16", f"2026-07-16T0{batch}:00:00+00:00", batch)
    assert run(quiet, 1)["newRows"] == 0
    assert run(quiet, 2)["newRows"] == 0
    assert run(busy, 3)["newRows"] == 2
    assert run(busy, 4)["newRows"] == 0
    assert spark.read.parquet(master).count() == 2
    assert sorted(r["newRows"] for r in spark.read.parquet(log).collect()) == [0, 0, 0, 2]


def test_positions_over_many_partitions(spark):
    rows = [(i, f"2026-01-{i * 7 % 28 + 1:02d}") for i in range(500)]
    df = spark.createDataFrame(rows, "ord bigint, postedDate string").repartition(9)
    out = dedup.stable_order(df, [F.col("postedDate").desc(), F.col("ord").asc()])
    got = [(r["ord"], r["postedDate"]) for r in sorted(out.collect(), key=lambda r: r["row_pos"])]
    assert got == sorted(sorted(rows), key=lambda r: r[1], reverse=True)
    assert sorted(r["row_pos"] for r in out.collect()) == list(range(1, 501))


def test_copy_on_write_touches_only_the_batches_that_change(spark, tmp_path):
    from bidlake.plans import notices as PN
    from bidlake.settings import NOTICE_COLUMNS

    path = str(tmp_path / "master")
    row = lambda i, title, fit: (str(i), title, "1998-01-01", "F", "541611", "1998-02-01", fit, "text", "note", "at")
    cols = ["noticeId", "title", "postedDate", "type", "naicsCode", "deadline", "fitLabel", "reviewSummary", "deadlineNote", "reviewedAtUTC"]
    for batch, rows in {1: [row(1, "old", "high"), row(2, "same", "high")], 2: [row(3, "same", "High")], 3: [row(4, "old", "low")]}.items():
        tables.append_batch(spark.createDataFrame(rows, cols), path, cols, batch)
    fresh = spark.createDataFrame([(i, str(i), "new" if i in (1, 4) else "same", "1998-01-02", "541611", "F", "1998-02-01") for i in (1, 2, 3, 4)],
                                  "ord long, noticeId string, title string, postedDate string, naicsCode string, type string, responseDeadLine string")
    assert PN.recheck_table(spark, path, fresh, "1998-08-02") == {"checked": 3, "updated": 1}
    after = tables.open_or_create(spark, path, NOTICE_COLUMNS)
    got = {r["noticeId"]: (r["title"], r["fitLabel"], r["reviewSummary"], r["batch_id"]) for r in after.collect()}
    assert got == {"1": ("new", "", "", 1), "2": ("same", "high", "text", 1), "3": ("same", "High", "text", 2), "4": ("old", "low", "text", 3)}
    files = {r["noticeId"]: r["f"] for r in after.select("noticeId", F.input_file_name().alias("f")).collect()}
    assert ".rewrites/v1/" in files["1"] and ".rewrites/v1/" in files["2"] and not any(".rewrites" in files[i] for i in "34")
    assert tables.rewritten(spark, path) == {1: [1]}
    assert PN.recheck_table(spark, path, fresh, "1998-08-02") == {"checked": 2, "updated": 0}  # the changed row lost its label
    assert tables.published_version(spark, path) == 1
    tables.append_batch(spark.createDataFrame([row(5, "later", "high")], cols), path, cols, 4)
    again = fresh.unionByName(fresh.limit(1).selectExpr("9 as ord", "'5' as noticeId", "'moved' as title", "postedDate", "naicsCode", "type", "responseDeadLine"))
    assert PN.recheck_table(spark, path, again, "1998-08-02") == {"checked": 3, "updated": 1}
    assert tables.rewritten(spark, path) == {1: [1], 2: [4]}
    assert {r["noticeId"]: r["title"] for r in tables.open_or_create(spark, path, NOTICE_COLUMNS).collect()} == {"1": "new", "2": "same", "3": "same", "4": "old", "5": "moved"}
    # an unpublished rewrite is not read
    spark.createDataFrame([row(1, "lost", "high")], cols).selectExpr("*", "cast(1 as bigint) as batch_id").write.partitionBy("batch_id").parquet(tables.rewrites_path(path, 3))
    assert "lost" not in {r["title"] for r in tables.open_or_create(spark, path, NOTICE_COLUMNS).collect()}
    bare = str(tmp_path / "bare")
    tables.append_batch(spark.createDataFrame([("1",)], "noticeId string"), bare, ["noticeId"], 1)
    assert PN.recheck_table(spark, bare, fresh, "1998-08-02") == {"checked": 0, "updated": 0}


def test_a_window_reads_the_folders_of_its_days(spark, tmp_path):
    from bidlake.sources import notices as landed

    path = str(tmp_path / "days")
    raw = spark.range(400).selectExpr("id as ord", "cast(date_add(date'1998-01-01', cast(id % 100 as int)) as string) as postedDate").unionByName(
        spark.createDataFrame([(900, None), (901, ""), (902, "no / day")], "ord long, postedDate string"))
    landed.land_by_day(raw, path)
    window = landed.landed_days(spark, path, raw.schema, "1998-02-01", "1998-02-08")
    assert window.count() == 32 and window.columns == raw.columns
    plan = window._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [isnotnull(posted_day" in plan.toString() and "PushedFilters: []" in plan.toString()
    assert len(window.collect()) == 32
    assert plan.collectLeaves().head().metrics().apply("numPartitions").value() == 8  # folders read
    landed.land_by_day(raw.where("postedDate = '1998-02-01'").limit(1), path)  # a day that is landed again replaces itself
    assert landed.landed_days(spark, path, raw.schema, "1998-02-01", "1998-02-08").count() == 29
    assert landed.landed_days(spark, path, raw.schema, "none", "none").count() == 3


def test_counts_come_from_the_append_itself(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id as ord", "cast(id % 300 as string) as duplicateKey")
    master = spark.range(250, 400).selectExpr("cast(id as string) as duplicateKey")
    written = []
    counts = dedup.append_new(rows, master, lambda fresh: written.append(fresh.write.parquet(str(tmp_path / "out"))))
    assert counts == dedup.append_summary(rows, master, "duplicateKey", "ord").first().asDict() == {"appended": 250, "skipped": 750, "total_processed": 1000}
    assert spark.read.parquet(str(tmp_path / "out")).count() == 250 and len(written) == 1
