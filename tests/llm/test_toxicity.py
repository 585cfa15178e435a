import random

from bidlake.llm import toxicity
from tests.conftest import SF01
from tests.llm import awkward


def all_maximal(values):
    """Maximal-scoring segments by definition: the best segment first, then left and right of it."""
    best = None
    for i in range(len(values)):
        for j in range(i, len(values)):
            s = sum(values[i:j + 1])
            if s > 0 and (best is None or (s, i - j) > best[0]):
                best = ((s, i - j), i, j)
    if best is None:
        return []
    _, i, j = best
    return [(a, b) for a, b in all_maximal(values[:i])] + [(i, j)] + [(a + j + 1, b + j + 1) for a, b in all_maximal(values[j + 1:])]


def test_segments_match_their_definition():
    pick = random.Random(5)
    for _ in range(300):
        values = [pick.choice([-1, -1, -1, 2.5, 4.25, -3.1, 1.7]) + pick.random() * 1e-3 for _ in range(pick.randrange(14))]
        values = [-1 if v < 0 and v > -1.5 else v for v in values]
        scored = [(i, v) for i, v in enumerate(values) if v != -1]
        got = [(a, b) for a, b, _ in toxicity.maximal_segments(scored, 1)]
        assert got == all_maximal(values)


def test_held_out_accuracy(spark):
    docs, truth = spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")
    rows = toxicity.toxicity(docs, truth).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    known = {r["doc_id"]: r["toxic"] for r in truth.collect()}
    held = [(r["predicted"], known[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in known]
    assert sum(p == t for p, t in held) / len(held) > 0.9
    assert sum(p for p, t in held if not t) <= 0.05 * len(held)
    named = next(r for r in rows if r["passages"])
    assert named["passages"][0]["first"] <= named["passages"][0]["last"]


def test_awkward_rows(spark):
    docs = awkward.documents(spark)
    rows = toxicity.toxicity(docs, awkward.labels(spark)).collect()
    assert len(rows) == len(awkward.ROWS)
    empty = {r["score"] for r in rows if r["doc_id"] in (3, 4, 5)}
    assert len(empty) == 1
    assert toxicity.toxicity(awkward.no_documents(spark), awkward.labels(spark).limit(0)).count() == 0
    model = toxicity.ToxicityModel(toxicity.ToxicitySettings())
    assert set(toxicity.score_texts(docs, model).columns) == set(docs.columns) - {"_judged"}


def test_stems_score_unseen_forms():
    model = toxicity.ToxicityModel(toxicity.ToxicitySettings(), words={"badly": 4.0}, stems={"vex": 3.0})
    drift = model.settings.drift
    assert model.token_score("vexation") == 3.0 - drift and model.token_score("ve") == -drift and model.token_score("badly") == 4.0 - drift
