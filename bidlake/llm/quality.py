"""Quality classifier: naive Bayes support vectors on n-gram indicators.

Indicators are hashed 1- and 2-grams of words, 1- to 3-grams of word shapes
(runs of capitals, small letters and digits, and each other sign, closed by a
mark if the word repeats the one before), and the shares of each shape and of
distinct words in steps.  Each indicator is scaled by its log-count ratio
between the classes; dual coordinate descent fits a linear hinge loss on the
scaled, normalised indicators; a logistic fit puts the margin on a scale from
0 to 1.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidlake.llm.common import labelled_sample, remainder, stored, uniform
from bidlake.llm.wordhash import U64, mix

_RUNS = re.compile(r"(?P<U>[A-ZÀ-ÖØ-Þ]+)|(?P<l>[^\W\d_A-ZÀ-ÖØ-Þ]+)|(?P<d>\d+)|(?P<s>([\W_])\5*)")


@dataclass(frozen=True)
class QualitySettings:
    """``sample`` bounds the labelled documents per class that are fitted, ``fitted`` their indicators together; ``bits`` sizes the indicator space."""
    sample: int = 6000
    fitted: int = 40_000_000
    bits: int = 18
    prior: float = 1.0
    cost: float = 1.0
    rounds: int = 12
    threshold: float = 0.5
    memo: int = 300_000


@dataclass
class QualityModel:
    settings: QualitySettings
    weights: np.ndarray | None = None  # scaled: log-count ratio times the fitted weight
    ratio: np.ndarray | None = None
    bias: float = 0.0
    slope: float = 1.0
    offset: float = 0.0


def shape_of(word: str) -> str:
    """Runs of a word by kind; a run of a sign keeps the sign, doubled if repeated."""
    return "".join(m.lastgroup if m.lastgroup != "s" else m.group()[:2] for m in _RUNS.finditer(word))


def _hash(text: str) -> int:
    value = 1469598103934665603
    for b in text.encode("utf-8", "surrogatepass"):
        value = ((value ^ b) * 1099511628211) & 0xFFFFFFFFFFFFFFFF
    return value


class Indicators:
    """Hashed indicators of whole texts; remembers words up to a bound."""

    def __init__(self, settings: QualitySettings):
        self.settings, self.words, self.shapes, self.lift = settings, {}, {}, U64(64 - settings.bits)

    def _numbers(self, word: str) -> tuple[int, int]:
        shape = shape_of(word)
        if shape not in self.shapes:
            self.shapes[shape] = _hash(shape)
        found = self.words[word] = (_hash(word.lower()), self.shapes[shape])
        return found

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").split()
        if not words:
            return np.zeros(0, dtype=np.int64)
        if len(self.words) > self.settings.memo:
            self.words.clear()
            self.shapes.clear()
        memo, make = self.words, self._numbers
        pairs = np.array([memo.get(w) or make(w) for w in words], dtype=np.uint64)
        word, shape = pairs[:, 0], pairs[:, 1]
        repeats = np.zeros(len(words), dtype=np.uint64)
        repeats[1:] = word[1:] == word[:-1]
        shape = mix(shape + repeats)
        grams = [word, mix(word[:-1] * U64(3) + word[1:]), shape + U64(1), mix(shape[:-1] * U64(5) + shape[1:]),
                 mix(shape[:-2] * U64(7) + shape[1:-1] * U64(11) + shape[2:])]
        kinds, counts = np.unique(shape, return_counts=True)
        steps = np.floor(10 * counts / len(words)).astype(np.uint64)
        size = U64(min(len(words).bit_length(), 12))
        distinct = U64(10 * len(np.unique(word)) // len(words))
        grams += [mix(kinds * U64(13) + steps), mix(np.array([size * U64(101) + distinct + U64(7919)], dtype=np.uint64))]
        return np.unique(mix(np.concatenate(grams)) >> self.lift).astype(np.int64)


def dual_descent(rows: list[np.ndarray], scale: np.ndarray, y: np.ndarray, settings: QualitySettings) -> tuple[np.ndarray, float]:
    """Weights and bias of the hinge loss by coordinate descent over the dual variables.

    Row i has the value scale[j] / norm_i at its indicators j.  One pass visits
    the rows in a fixed pseudorandom order; a rare class gets a larger bound.
    """
    w, bias = np.zeros(len(scale)), 0.0
    values = [scale[r] / max(np.linalg.norm(scale[r]), 1e-9) for r in rows]
    alpha = np.zeros(len(rows))
    share = np.where(y > 0, (y > 0).mean(), (y < 0).mean())
    bound = settings.cost * 0.5 / np.maximum(share, 1e-9)
    order = np.random.default_rng(7)
    for _ in range(settings.rounds):
        for i in order.permutation(len(rows)):
            gradient = y[i] * (values[i] @ w[rows[i]] + bias) - 1
            new = min(max(alpha[i] - gradient / (values[i] @ values[i] + 1.0), 0.0), bound[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[rows[i]] += step * values[i]
                bias += step
                alpha[i] = new
    return w, bias


def margin(found: np.ndarray, model: QualityModel) -> float:
    if not len(found):
        return model.bias
    return float(model.weights[found].sum() / max(np.linalg.norm(model.ratio[found]), 1e-9) + model.bias)


def train(docs: DataFrame, labels: DataFrame, eligible: Column, settings: QualitySettings = QualitySettings()) -> QualityModel:
    """Fit on a bounded sample of the labelled rows where ``eligible`` holds; the driver gets its indicators.

    Where the sample's whole texts have more than ``fitted`` indicators, fewer
    of its documents are fitted (chosen by a hash), so the driver holds about
    that many at most (4 bytes each), however long the texts are.
    """
    model = QualityModel(settings)
    sample = labelled_sample(docs, labels, "quality", eligible, settings.sample)

    def indicators(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        make = Indicators(settings)
        for frame in batches:
            yield pd.DataFrame({"doc_id": frame["doc_id"], "quality": frame["quality"].astype("int32"), "found": [make(t).astype("int32").tobytes() for t in frame["text"]]})

    made = stored(sample.select("doc_id", "quality", "text").mapInPandas(indicators, "doc_id long, quality int, found binary"))
    total = made.agg(F.sum(F.octet_length("found") / 4)).first()[0] or 0
    got = made.where(uniform(F.lit("fitted"), F.col("doc_id")) * total < settings.fitted).collect()
    got = sorted((r["doc_id"], r["quality"], bytes(r["found"])) for r in got)
    found = [np.frombuffer(x[2], dtype=np.int32).astype(np.int64) for x in got]
    y = np.array([1.0 if x[1] == 1 else -1.0 for x in got])
    if not (y == 1).any() or not (y == -1).any():
        return model
    size = 1 << settings.bits
    sums = [settings.prior + sum((np.bincount(f, minlength=size) for f, t in zip(found, y) if t == side), np.zeros(size)) for side in (1, -1)]
    model.ratio = np.log(sums[0] / sums[0].sum()) - np.log(sums[1] / sums[1].sum())
    weights, model.bias = dual_descent(found, model.ratio, y, settings)
    model.weights = weights * model.ratio
    margins = np.array([margin(f, model) for f in found])
    model.slope, model.offset = _scale(margins, y > 0)
    return model


def _scale(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """A logistic scale that is 0.5 at the separating margin and steeper where the classes are farther apart."""
    spread = max(float(np.median(margins[good]) - np.median(margins[~good])), 1e-3)
    return 6.0 / spread, 0.0


def score_texts(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted.

    Null and empty texts have no indicator and get the score of the bias; all
    rows get 0.5 if nothing could be learned.  Repeated rows are scored each
    by itself; an empty table gives an empty result; columns named like an
    added one are replaced.
    """

    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        make = Indicators(model.settings)
        for texts in batches:
            if model.weights is None:
                yield pd.Series(np.full(len(texts), 0.5))
            else:
                margins = np.array([margin(make(t), model) for t in texts], dtype=float)
                yield pd.Series(1 / (1 + np.exp(-np.clip(model.slope * margins + model.offset, -30, 30))))

    judged = F.pandas_udf(judge, "double")
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("score", "predicted")]
    return docs.select(*kept, judged("text").alias("score")).withColumn("predicted", (F.col("score") >= model.settings.threshold).cast("int"))


def quality(docs: DataFrame, labels: DataFrame, settings: QualitySettings = QualitySettings(), folds: int = 3, held_out: int = 1) -> DataFrame:
    """doc_id, held_out, score, predicted; learned from labelled rows outside the held-out fold."""
    out_of_fold = remainder(folds) == held_out
    model = train(docs, labels, ~out_of_fold, settings)
    return score_texts(docs.select("doc_id", "text"), model).select("doc_id", out_of_fold.alias("held_out"), "score", "predicted")
