"""Toxic passages by maximum-scoring segments of token log-odds.

A word's log-odds compare the labelled toxic and clean documents that hold it.
The estimate has a Dirichlet prior centred on the word's beginning (its first
6, 5, 4 and 3 letters, each with the shorter one as prior), so unseen forms of
a known stem score like the stem.  Other words score below zero.  One linear
scan finds all maximal-scoring segments of a text.  As the odds count documents,
the k-th use of a word in a text adds 1 / k^2 of its score.  Chance segments of clean
documents have an exponential tail: the expected number with score s or more
in n words is K n exp(-lambda s).  Segments that beat it are the significant
passages, and their summed excess, put on a probability scale, is the score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidlake.llm.common import labelled_sample, remainder, stored

TOKEN = re.compile(r"[^\W_]+")
STEMS = (3, 4, 5, 6)


@dataclass(frozen=True)
class ToxicitySettings:
    """``sample`` bounds the labelled documents per class; ``drift`` is what a word without evidence costs."""
    sample: int = 60000
    prior: float = 2.0
    drift: float = 0.25
    least_documents: int = 3
    least_ratio: float = 3.0
    tail_from: float = 1.0
    significant: float = 0.05
    threshold: float = 0.3
    memo: int = 200_000


@dataclass
class ToxicityModel:
    settings: ToxicitySettings
    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    rate: float = 1.0        # lambda
    constant: float = 1e-6   # K
    slope: float = 0.0
    offset: float = -3.0

    def token_score(self, word: str) -> float:
        found = self.words.get(word)
        if found is None:
            for n in reversed(STEMS):
                if len(word) >= n and (found := self.stems.get(word[:n])) is not None:
                    break
        return -self.settings.drift if found is None else found - self.settings.drift


def maximal_segments(scores: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, last, score) of a text in one pass.

    ``scores`` holds position and score of the words that have evidence; the
    words between cost ``drift`` each.  Candidates are kept with the sums
    before and after them; a new one joins the nearest earlier candidate with
    a smaller sum before it, unless that one ends at least as high.
    """
    total, place = 0.0, -1
    kept: list[tuple[int, int, float, float]] = []
    for position, score in scores:
        total -= drift * (position - place - 1)
        before, total, place = total, total + score, position
        if score <= 0:
            continue
        first, after = position, total
        while kept:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= before:
                j -= 1
            if j < 0 or kept[j][3] >= after:
                break
            first, before = kept[j][0], kept[j][2]
            del kept[j:]
        kept.append((first, position, before, after))
    return [(first, last, after - before) for first, last, before, after in kept]


class Scanner:
    """Scores of whole texts under a model; remembers words up to a bound."""

    def __init__(self, model: ToxicityModel):
        self.model, self.memo = model, {}

    def segments(self, text: str | None) -> tuple[int, list[tuple[int, int, float]]]:
        """The number of words and all maximal segments."""
        words = TOKEN.findall((text or "").lower())
        memo, score, drift = self.memo, self.model.token_score, self.model.settings.drift
        if len(memo) > self.model.settings.memo:
            memo.clear()
        found, times = [], {}
        for i, w in enumerate(words):
            s = memo.get(w)
            if s is None:
                s = memo[w] = score(w)
            if s != -drift:
                times[w] = k = times.get(w, 0) + 1
                found.append((i, s / k / k if s > 0 else s))
        return len(words), maximal_segments(found, drift)

    def excess(self, words: int, segments: list[tuple[int, int, float]]) -> float:
        m = self.model
        chance = np.log(max(m.constant * max(words, 1), 1e-12))
        return float(sum(max(0.0, m.rate * s - chance) for _, _, s in segments))

    def probability(self, excess: float) -> float:
        return float(1 / (1 + np.exp(-(self.model.slope * excess + self.model.offset))))

    def passages(self, words: int, segments: list[tuple[int, int, float]]) -> list[tuple[int, int, float]]:
        """Significant segments: first and last word, and the expected number of chance segments as good."""
        m = self.model
        rated = ((a, b, float(m.constant * words * np.exp(-m.rate * s))) for a, b, s in segments)
        return [x for x in rated if x[2] <= m.settings.significant]


def fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 60) -> tuple[float, float]:
    """Slope and offset of a lightly penalised logistic fit by Newton steps."""
    if not len(y):
        return 0.0, -3.0
    data, beta = np.stack([x, np.ones(len(x))], axis=1), np.array([0.0, np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(data @ beta, -30, 30)))
        gradient = data.T @ (y - p) - 1e-2 * beta
        step = np.linalg.solve(data.T @ (data * (p * (1 - p))[:, None]) + 1e-2 * np.eye(2), gradient)
        beta = beta + np.clip(step, -1, 1)
    return float(max(beta[0], 0.0)), float(beta[1])


HELD_UNITS = 300_000  # different words and beginnings that a task holds before it sends them on


def train(docs: DataFrame, labels: DataFrame, eligible: Column, settings: ToxicitySettings = ToxicitySettings()) -> ToxicityModel:
    """Fit on labelled rows where ``eligible`` holds.

    A bounded sample per class is split by a hash: three quarters give the
    word counts (summed per task, then by word), the rest the tail and the
    probability scale.  Only words with evidence reach the driver.
    """
    model = ToxicityModel(settings)
    rows = labelled_sample(docs, labels, "toxic", eligible, settings.sample)
    sample = stored(rows.withColumn("part", (F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(4)) == 0).cast("int")))
    sizes = {(r["toxic"], r["part"]): r["n"] for r in sample.groupBy("toxic", "part").agg(F.count("*").alias("n")).collect()}
    bad, good = sizes.get((1, 0), 0), sizes.get((0, 0), 0)
    if not bad or not good:
        return model

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())

        def sent() -> pa.RecordBatch:
            units = list(seen[0].keys() | seen[1].keys())
            return pa.RecordBatch.from_arrays([pa.array(units, pa.string()), pa.array([seen[1][u] for u in units], pa.int64()), pa.array([seen[0][u] for u in units], pa.int64())], names=["unit", "bad", "good"])

        for batch in batches:
            for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist()):
                words = set(TOKEN.findall(text.as_py().lower()))
                seen[int(toxic == 1)].update(words)
                seen[int(toxic == 1)].update({w[:n] + "*" for w in words for n in STEMS if len(w) >= n})
                if len(seen[0]) + len(seen[1]) > HELD_UNITS:
                    yield sent()
                    seen = (Counter(), Counter())
        if seen[0] or seen[1]:
            yield sent()

    counted = stored(sample.where("part = 0").select("text", "toxic").mapInArrow(count, "unit string, bad long, good long")
                     .groupBy("unit").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).where(F.col("bad") >= 1))
    expected = F.col("good") * (bad / good)
    telling = counted.where((F.col("bad") >= settings.least_documents) & (F.col("bad") + settings.prior >= settings.least_ratio * (expected + settings.prior)))
    found = {r["unit"]: (r["bad"], r["good"] * bad / good) for r in telling.collect()}
    stems = {u[:-1] for u in found if u.endswith("*")}
    ratio: dict[str, float] = {}
    for n in STEMS:
        for stem in (s for s in stems if len(s) == n):
            a, b = found[stem + "*"]
            ratio[stem] = (a + settings.prior * ratio.get(stem[:-1], 1.0)) / (b + settings.prior)
    model.stems = {s: float(np.log(r)) for s, r in ratio.items() if r >= settings.least_ratio}

    def parent(word: str) -> float:
        return next((ratio[word[:n]] for n in reversed(STEMS) if word[:n] in ratio and len(word) >= n), 1.0)

    under = [F.substring("unit", 1, n).isin(*[s for s in model.stems if len(s) == n]) for n in STEMS if any(len(s) == n for s in model.stems)]
    own = dict(found)
    if under:  # words of a telling stem whose own counts say otherwise
        also = under[0]
        for u in under[1:]:
            also = also | u
        own |= {r["unit"]: (r["bad"], r["good"] * bad / good) for r in counted.where(~F.col("unit").endswith("*") & also).collect()}
    for unit, (a, b) in own.items():
        if not unit.endswith("*"):
            r = (a + settings.prior * parent(unit)) / (b + settings.prior)
            if r >= settings.least_ratio or parent(unit) >= settings.least_ratio:
                model.words[unit] = float(np.log(r))
    calibrate(model, sample.where("part = 1").select("text", "toxic"))
    return model


def calibrate(model: ToxicityModel, sample: DataFrame) -> None:
    """Set the chance tail from clean texts of the sample and the probability scale from all of it."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(model)
        for frame in batches:
            rows = [scanner.segments(t) for t in frame["text"]]
            yield pd.DataFrame({"toxic": frame["toxic"].astype("int32"), "words": [n for n, _ in rows], "scores": [[s for _, _, s in seg] for _, seg in rows]})

    seen = sample.mapInPandas(scan, "toxic int, words long, scores array<double>").collect()
    clean = [(r["words"], r["scores"]) for r in seen if r["toxic"] != 1]
    low = model.settings.tail_from
    tail = [s - low for _, scores in clean for s in scores if s >= low]
    words = sum(n for n, _ in clean)
    if words:
        model.rate = min(3.0, (len(tail) + 1) / (sum(tail) + 1.0))
        model.constant = (len(tail) + 1) / words * float(np.exp(model.rate * low))
    scanner = Scanner(model)
    x = np.array([scanner.excess(r["words"], [(0, 0, s) for s in r["scores"]]) for r in seen])
    model.slope, model.offset = fit_logistic(np.minimum(x, 50.0), np.array([float(r["toxic"] == 1) for r in seen]))


def score_texts(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` with score (0 to 1), predicted and passages (first and last word, expected chance count).

    Null and empty texts score like a text without evidence.  Repeated rows
    are scored each by itself; an empty table gives an empty result; columns
    named like an added one are replaced.
    """

    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(model)
        for texts in batches:
            scores, passages = [], []
            for text in texts:
                words, segments = scanner.segments(text)
                scores.append(scanner.probability(min(scanner.excess(words, segments), 50.0)))
                passages.append([{"first": a, "last": b, "chance": e} for a, b, e in scanner.passages(words, segments)])
            yield pd.DataFrame({"score": scores, "passages": passages})

    judged = F.pandas_udf(judge, "score double, passages array<struct<first: int, last: int, chance: double>>")
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("score", "predicted", "passages", "_judged")]
    return docs.select(*kept, judged("text").alias("_judged")).select(
        *kept, "_judged.score", (F.col("_judged.score") >= model.settings.threshold).cast("int").alias("predicted"), "_judged.passages")


def toxicity(docs: DataFrame, labels: DataFrame, settings: ToxicitySettings = ToxicitySettings(), folds: int = 4, held_out: int = 2) -> DataFrame:
    """doc_id, held_out, score, predicted, passages; learned from labelled rows outside the held-out fold."""
    out_of_fold = remainder(folds) == held_out
    model = train(docs, labels, ~out_of_fold, settings)
    return score_texts(docs.select("doc_id", "text"), model).select("doc_id", out_of_fold.alias("held_out"), "score", "predicted", "passages")
