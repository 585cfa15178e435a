import random
import time
from collections import Counter

import numpy as np

from bidlake.llm import decontam
from tests.conftest import SF001
from tests.llm import awkward


def least_edits(item, text):
    """Edits of the whole item against its best stretch of the text, by the full table."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        above, row = row, [i]
        for j, d in enumerate(text, 1):
            row.append(min(above[j - 1] + (c != d), above[j] + 1, row[j - 1] + 1))
    return min(row)


def edited(text, edits, pick):
    letters = list(text)
    for _ in range(edits):
        at, kind = pick.randrange(len(letters)), pick.randrange(3)
        if kind == 0:
            letters[at] = pick.choice("abcxyz ")
        elif kind == 1:
            del letters[at]
        else:
            letters.insert(at, pick.choice("abcxyz"))
    return "".join(letters)


def test_every_match_within_the_budget_is_found():
    pick = random.Random(4)
    words = ["the", "other", "an", "ration", "ed", "ing", "where", "of", "tion"]
    items = [(i, decontam.normalised(" ".join(pick.choice(words) for _ in range(pick.randrange(12, 60))))) for i in range(25)]
    index = decontam.ItemIndex(items, decontam.DecontamSettings())
    filler = lambda n: " ".join(pick.choice(words) for _ in range(n))
    for n in range(120):
        i, item = pick.choice(items)
        budget = int(index.budget[i])
        text = decontam.normalised(filler(pick.randrange(30)) + " " + edited(item, pick.randrange(budget + 3), pick) + " " + filler(pick.randrange(30)))
        found = {m["item_id"]: m for m in sorted(index.search(text), key=lambda m: -m["distance"])}
        for j, other in items:
            edits = least_edits(other, text)
            assert (j in found) == (edits <= index.budget[j]), (n, j, edits, index.budget[j])
            if j in found:
                assert edits <= found[j]["distance"] <= index.budget[j]
                stretch = text[found[j]["first"]:found[j]["last"] + 1]
                assert least_edits(other, stretch) <= found[j]["distance"]


def test_banded_match_agrees_inside_a_wide_band():
    pick = random.Random(8)
    for _ in range(40):
        item, text = "".join(pick.choice("ab") for _ in range(12)), "".join(pick.choice("ab") for _ in range(30))
        got = decontam.banded_match(decontam.code_points(item), decontam.code_points(text), -13, 60)
        assert got[0] == least_edits(item, text)


def test_every_copy_is_reported():
    pick = random.Random(5)
    item = decontam.normalised(" ".join(pick.choice(["river", "stone", "cloud", "lamp", "field"]) + str(pick.randrange(99)) for _ in range(30)))
    index = decontam.ItemIndex([(1, item)], decontam.DecontamSettings())
    other = lambda: " ".join(f"x{pick.randrange(10 ** 6)}" for _ in range(pick.randrange(1, 40)))
    copies = [edited(item, pick.randrange(0, 4), pick) for _ in range(20)]
    text = decontam.normalised(" ".join(part for c in copies for part in (other(), c)))
    found = index.search(text)
    assert len(found) == 20 and all(a["last"] < b["first"] for a, b in zip(found, found[1:]))
    assert index.search(item + item) and [m["first"] for m in index.search(item + item)] == [0, len(item)]


def test_repetitive_items():
    """Items with few different q-grams: found as the full table says, in bounded time and memory."""
    pick = random.Random(6)
    items = [(1, "-" * 60), (2, "ab" * 40), (3, "abcdefghijkl " * 6 + "end"), (4, ". " * 30 + "and then a sentence that is like no other one here")]
    items = [(i, decontam.normalised(t)) for i, t in items]
    index = decontam.ItemIndex(items, decontam.DecontamSettings())
    assert set(index.repetitive) >= {0, 1}
    for n in range(60):
        i, item = pick.choice(items)
        middle = edited(item, pick.randrange(int(index.budget[i - 1]) + 3), pick)
        text = decontam.normalised(pick.choice(["", "some words ", "-" * 30 + " x "]) + middle + pick.choice(["", " more", " " + "-" * 45 + " ab ab"]))
        found = {m["item_id"] for m in index.search(text)}
        assert found == {j for j, t in items if least_edits(t, text) <= index.budget[j - 1]}, (n, text)
    index = decontam.ItemIndex([(1, "-" * 400), (2, "_ " * 150), (3, "=" * 300)], decontam.DecontamSettings())
    began = time.time()
    found = index.search("start " + "-" * 100_000 + " end " + "= " * 5000)
    assert time.time() - began < 20 and len(found) == 250 and all(m["distance"] == 0 and m["item_id"] == 1 for m in found)


def test_planted_passages_of_documents(spark):
    docs, benchmark = spark.read.parquet(f"{SF001}/documents.parquet"), spark.read.parquet(f"{SF001}/benchmark.parquet")
    items = {r["item_id"]: decontam.normalised(r["text"]) for r in benchmark.collect()}
    exact = {(r["doc_id"], i) for r in docs.collect() for i, t in items.items() if t in decontam.normalised(r["text"])}
    got = decontam.contaminated(docs, benchmark).collect()
    assert exact == {(r["doc_id"], r["item_id"]) for r in got if r["distance"] == 0}
    places = Counter((r["doc_id"], r["item_id"]) for r in got if r["distance"] == 0)
    assert places == {(r["doc_id"], i): n for r in docs.collect() for i, t in items.items() if (n := decontam.normalised(r["text"]).count(t))}
    kept = decontam.decontaminated(docs, benchmark)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in got}


def test_blocks_of_items_give_the_same(spark):
    docs, benchmark = spark.read.parquet(f"{SF001}/documents.parquet"), spark.read.parquet(f"{SF001}/benchmark.parquet")
    one, many = (decontam.contaminated(docs, benchmark, decontam.DecontamSettings(block_chars=n)) for n in (4_000_000, 1500))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))


def test_awkward_rows(spark):
    docs = awkward.documents(spark)
    items = spark.createDataFrame([(1, "Quick brown  FOX jumps over the lazy dog"), (1, "Quick brown  FOX jumps over the lazy dog"), (2, None), (3, ""), (4, "short"), (None, "x" * 50), (5, awkward.LONG[:500])], "item_id long, text string")
    got = decontam.contaminated(docs, items).collect()
    repeats = decontam.normalised(awkward.LONG).count(decontam.normalised(awkward.LONG[:500]))
    assert repeats > 30 and sorted((r["doc_id"], r["item_id"]) for r in got) == [(1, 1), (1, 1), (2, 1)] + [(7, 5)] * repeats
    kept = decontam.decontaminated(docs, items)
    assert kept.columns == docs.columns and kept.count() == len(awkward.ROWS) - 4
    assert decontam.decontaminated(docs, items.limit(0)).count() == len(awkward.ROWS)
    assert decontam.contaminated(awkward.no_documents(spark), items).count() == 0
    assert np.array_equal(decontam.qgram_hashes(decontam.code_points("short")), np.zeros(0, dtype=np.uint64))
