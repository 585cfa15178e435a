"""Phrase search over the word index, against word lists compared place by place."""

import base64
import random
import re

import pytest
from pyspark.sql import functions as F

from bidlake.sources import mail, mail_index, standin_mail
from tests.conftest import SF001

PHRASES = ["ab", "ab ab", "ab, cd-ab", "ÉTÉ", "ef ab", "zz", "...", ""]


def split(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def mailbox(spark):
    pick = random.Random(3)
    messages, parts, texts = [], [], {}
    for i in range(40):
        day = ["2026-07-16T09:00:00", "2026-07-08", None, "2026-07-09"][i % 4]
        subject = " ".join(pick.choices(["ab", "cd", "ef", "Été"], k=3))
        messages.append((None, f"m{i}", i, day, [("Subject", subject)] if i % 5 else None))
        texts[f"m{i}", -2], texts[f"m{i}", -1] = subject if i % 5 else "", ""
        for seq in range(3):
            text = pick.choice([" ", ", ", "\n", "_"]).join(pick.choices(["ab", "AB", "cd", "ef", "abcd", "été"], k=pick.randrange(60))) if i else "ab " * 20000
            mime = "text/html" if seq else pick.choice(["text/plain", "image/png", None])
            parts.append((f"m{i}", seq, mime, base64.urlsafe_b64encode(text.encode()).decode().rstrip("=") if i % 7 else None))
            if (mime or "").startswith("text/"):
                texts[f"m{i}", seq] = text if i % 7 else ""
    messages.append((None, None, 99, None, None))
    parts.append(("other", 0, "text/plain", "YWI"))
    days = {m[1]: (m[3] or "")[:10] for m in messages}
    return (spark.createDataFrame(messages, mail.MESSAGE_SCHEMA), spark.createDataFrame(parts, mail.PART_SCHEMA), texts, days)


@pytest.mark.parametrize("file_bytes", [200, 1 << 20])
def test_places_equal_word_lists(spark, tmp_path, file_bytes):
    messages, parts, texts, days = mailbox(spark)
    mail_index.land_index(messages, parts, str(tmp_path), file_bytes)
    index = mail_index.read_index(spark, str(tmp_path))
    for since in (None, "2026-07-09"):
        expected = set()
        for (mid, seq), text in texts.items():
            if since and days[mid] and days[mid] < since:
                continue
            have = split(text)
            for p in PHRASES:
                w = split(p)
                n = sum(have[i:i + len(w)] == w for i in range(len(have))) if w else 0
                if n:
                    expected.add((p, mid, seq, n))
        assert {tuple(r) for r in mail_index.phrase_places(index, PHRASES + PHRASES[:2], since).collect()} == expected


def test_empty_mailbox(spark, tmp_path):
    messages, parts, _texts, _days = mailbox(spark)
    mail_index.land_index(messages.limit(0), parts, str(tmp_path))
    assert mail_index.phrase_places(mail_index.read_index(spark, str(tmp_path)), ["ab"]).count() == 0


def test_search_by_index_equals_search_by_text(spark, tmp_path):
    landed = standin_mail.land(spark, SF001)
    messages, parts = mail.read_messages(spark, landed[0]), mail.read_parts(spark, landed[1])
    mail_index.land_index(messages, parts, str(tmp_path))
    index = mail_index.read_index(spark, str(tmp_path))
    ids = lambda df: sorted(r["id"] for r in df.collect())
    plain = ids(mail.search(messages, "developmentaid", standin_mail.RUN_DATE, 7, parts))
    found = mail.search(messages, "developmentaid", standin_mail.RUN_DATE, 7, parts, index=index)
    assert plain and ids(found) == plain and found.columns == mail.search(messages, "devex", standin_mail.RUN_DATE, 7).columns


def test_a_search_opens_its_days_and_words_alone(spark, tmp_path):
    messages, parts, _texts, _days = mailbox(spark)
    mail_index.land_index(messages, parts, str(tmp_path), 500)
    found = mail_index.phrase_places(mail_index.read_index(spark, str(tmp_path)), ["ab cd"], "2026-07-16")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "In(token, [ab,cd])" in plan and "PartitionFilters: [(isnull(day" in plan and "SortMergeJoin" not in plan
    opened = {f.split("day=")[1].split("/")[0] for f in found.inputFiles()}
    assert {"2026-07-16", "__HIVE_DEFAULT_PARTITION__"} <= opened
    read = mail_index.read_index(spark, str(tmp_path)).where(F.col("day") >= F.lit("2026-07-16").cast("date"))
    assert len(mail_index.read_index(spark, str(tmp_path)).inputFiles()) > 3 and read.select(F.min("day").cast("string")).first()[0] == "2026-07-16"


def test_a_run_by_index_appends_the_same_rows(spark, tmp_path):
    from bidlake.plans import mail as plans

    messages, parts = standin_mail.land(spark, SF001)
    index = str(tmp_path / "words")
    mail_index.land_index(mail.read_messages(spark, messages), mail.read_parts(spark, parts), index)
    run = lambda name, **more: plans.ingest_landed_mail(
        spark, messages, parts, str(tmp_path / name), standin_mail.RUN_DATE, standin_mail.RUN_TS, 1, source_filter="developmentaid", **more)
    counts = run("plain")
    assert counts["appended"] > 0 and run("by_index", index_path=index) == counts
    keys = [{r["duplicateKey"] for r in spark.read.parquet(str(tmp_path / name)).select("duplicateKey").collect()} for name in ("plain", "by_index")]
    assert keys[0] == keys[1] and len(keys[0]) == counts["appended"]
