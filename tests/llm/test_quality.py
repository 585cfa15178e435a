import zlib

import numpy as np

from pyspark.sql import functions as F

from bidlake.llm import quality
from tests.conftest import SF01
from tests.llm import awkward


def test_held_out_accuracy(spark):
    docs, truth = spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")
    rows = quality.quality(docs, truth).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    known = {r["doc_id"]: r["quality"] for r in truth.collect()}
    held = [(r["predicted"], known[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in known]
    assert sum(p == t for p, t in held) / len(held) > 0.95


def test_dual_descent_reaches_the_primal_optimum():
    """On a tiny problem the fitted objective is as low as that of many random and perturbed weights."""
    pick = np.random.default_rng(2)
    rows = [np.unique(pick.integers(0, 12, 5)) for _ in range(60)]
    y = np.array([1.0 if 3 in r or 7 in r else -1.0 for r in rows])
    settings, scale = quality.QualitySettings(rounds=300), np.ones(12)
    w, b = quality.dual_descent(rows, scale, y, settings)
    x = np.zeros((60, 13))
    for i, r in enumerate(rows):
        x[i, r], x[i, 12] = 1 / np.sqrt(len(r)), 1
    cost = settings.cost * 0.5 / np.array([(y == t).mean() for t in y])

    def objective(v):
        return 0.5 * v @ v + (cost * np.maximum(0, 1 - y * (x @ v))).sum()

    best = objective(np.append(w, b))
    for _ in range(300):
        assert best <= objective(np.append(w, b) + pick.normal(0, 0.02, 13)) + 1e-3


def test_shapes():
    assert quality.shape_of("Word") == "Ul" and quality.shape_of("STOP!!!") == "U!!" and quality.shape_of("a1-b") == "ld-l" and quality.shape_of("") == ""


def test_awkward_rows(spark):
    docs = awkward.documents(spark)
    rows = quality.quality(docs, awkward.labels(spark)).collect()
    assert len(rows) == len(awkward.ROWS) and len({r["score"] for r in rows if r["doc_id"] in (3, 4, 5)}) == 1
    assert {r["score"] for r in quality.quality(docs, awkward.labels(spark).limit(0)).collect()} == {0.5}
    assert quality.quality(awkward.no_documents(spark), awkward.labels(spark)).count() == 0


def kinds_of(text):
    """The indicators of a text as tuples, from the definition."""
    words = (text or "").split()
    if not words:
        return set()
    low = [w.lower() for w in words]
    shape = [(quality.shape_of(w), i > 0 and low[i] == low[i - 1]) for i, w in enumerate(words)]
    found = {("word", w) for w in low} | {("pair", *p) for p in zip(low, low[1:])} | {("shape", s) for s in shape}
    found |= {("shapes", *p) for p in zip(shape, shape[1:])} | {("three", *p) for p in zip(shape, shape[1:], shape[2:])}
    found |= {("share", s, 10 * shape.count(s) // len(shape)) for s in set(shape)}
    return found | {("size", min(len(words).bit_length(), 12), 10 * len(set(low)) // len(words))}


def texts(n, seed):
    pick = np.random.default_rng(seed)
    vocabulary = ["Sun", "sun", "rain!", "a-b", "x1", "10", "WIND", "the", "...", "été", "of"]
    return [" ".join(pick.choice(vocabulary, int(pick.integers(0, 30)), p=None)) for _ in range(n)]


def test_indicators_equal_their_definition():
    make = quality.Indicators(quality.QualitySettings(bits=52))
    rows = [*texts(60, 1), "", None, "one", "one one one"]
    hashed = [set(make(t).tolist()) for t in rows]
    named = [kinds_of(t) for t in rows]
    for a, x in zip(hashed, named):
        for b, y in zip(hashed, named):
            assert len(a & b) == len(x & y) and len(a | b) == len(x | y)


def test_scores_equal_a_brute_force_fit(spark):
    """Ratios by counting, the hinge loss by projected gradients over a dense kernel, the margins by definition."""
    rows = list(enumerate([*texts(45, 2), "", None]))
    label = {i: int("sun" in (t or "") or (t or "").count("the") > 2) for i, t in rows if i % 4}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    settings = quality.QualitySettings(bits=22, rounds=3000)
    got = {r["doc_id"]: r for r in quality.quality(docs, spark.createDataFrame(list(label.items()), "doc_id long, quality int"), settings).collect()}
    held = {i: zlib.crc32(str(i).encode()) % 3 == 1 for i, _ in rows}
    learned = [(i, t) for i, t in rows if t is not None and i in label and not held[i]]
    y = np.array([1.0 if label[i] else -1.0 for i, _ in learned])
    every = sorted(set().union(*(kinds_of(t) for _, t in learned)), key=repr)
    at = {k: n for n, k in enumerate(every)}
    x = np.zeros((len(learned), len(every)))
    for n, (_, t) in enumerate(learned):
        x[n, [at[k] for k in kinds_of(t)]] = 1
    size = 1 << settings.bits  # the prior counts for each dimension, seen or not
    counts = [settings.prior + x[y == side].sum(axis=0) for side in (1, -1)]
    whole = [x[y == side].sum() + settings.prior * size for side in (1, -1)]
    ratio = np.log(counts[0] / whole[0]) - np.log(counts[1] / whole[1])
    unseen = np.log(1 / whole[0]) - np.log(1 / whole[1])
    z = x * ratio / np.maximum(np.linalg.norm(x * ratio, axis=1, keepdims=True), 1e-9)
    kernel = (z @ z.T + 1) * np.outer(y, y)
    bound = settings.cost * 0.5 / np.where(y > 0, (y > 0).mean(), (y < 0).mean())
    alpha, step = np.zeros(len(y)), 1 / np.linalg.eigvalsh(kernel)[-1]
    for _ in range(60000):
        alpha = np.clip(alpha + step * (1 - kernel @ alpha), 0, bound)
    w, bias = z.T @ (alpha * y), float(alpha @ y)

    def margin(t):
        kinds = kinds_of(t)
        if not kinds:
            return bias
        values = np.array([ratio[at[k]] if k in at else unseen for k in kinds])
        return sum(w[at[k]] * ratio[at[k]] for k in kinds if k in at) / max(np.linalg.norm(values), 1e-9) + bias

    inside = np.array([margin(t) for _, t in learned])
    slope = 6 / max(np.median(inside[y > 0]) - np.median(inside[y < 0]), 1e-3)
    for i, t in rows:
        assert got[i]["held_out"] == held[i] and abs(got[i]["score"] - 1 / (1 + np.exp(-slope * margin(t)))) < 2e-3, (i, t)


def test_fitted_indicators_are_bounded(spark):
    rows = list(enumerate(["good words here " * 40, "BAD bad" * 5] * 100))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    truth = spark.createDataFrame([(i, 1 - i % 2) for i, _ in rows], "doc_id long, quality int")
    model = quality.train(docs, truth, F.lit(True), quality.QualitySettings(fitted=400))
    assert model.weights is not None
    assert quality.train(docs, truth, F.lit(True), quality.QualitySettings(fitted=0)).weights is None
