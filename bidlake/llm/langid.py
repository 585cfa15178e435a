"""Language identification by nearest centroids of TF-IDF character n-grams.

A text's n-grams (2 and 3 bytes of its lower-cased letters, other ASCII as
one space) are counted into hashed dimensions, damped, weighted by inverse
document frequency and normalised.  Each language has several centroids from
spherical k-means; the nearest one by cosine names the language.  A text is
rejected if it is farther from it than all but a few in a thousand of the
training texts of that length and language which no centroid was fitted on.
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

from bidlake.llm.common import bounded_sample, remainder, stored, uniform

UNDETERMINED = "und"
HAS_LETTER = re.compile(r"[^\W\d_]")
_FOLD = np.full(256, 32, dtype=np.uint32)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


@dataclass(frozen=True)
class LanguageSettings:
    """``sample`` bounds the documents per language that centroids are fitted on; document frequencies count all.

    ``lengths`` are the least bytes of the length classes, ``quantile`` the
    share of held-back texts below a floor, ``least`` the texts it needs.
    """
    dimensions: int = 8192
    centroids: int = 4
    sample: int = 800
    rounds: int = 6
    windows: tuple[int, ...] = (40, 160, 640)
    lengths: tuple[int, ...] = (8, 20, 50, 125, 312, 780)
    quantile: float = 0.003
    least: int = 300


@dataclass
class LanguageModel:
    languages: list[str]
    centroids: np.ndarray  # one row per centroid
    owner: np.ndarray      # index of its language
    floor: np.ndarray      # least cosine accepted, one row per centroid and one column per length class
    weight: np.ndarray     # inverse document frequency
    lengths: tuple[int, ...] = LanguageSettings.lengths

    def least_cosine(self, centroid: int, size: int) -> float:
        """The floor of a text of ``size`` bytes; none for texts below the first class."""
        k = length_class(size, self.lengths)
        return self.floor[centroid, k] if k >= 0 else 0.0


def length_class(size: int, lengths: tuple[int, ...]) -> int:
    """The last class whose least length is reached, -1 if none is."""
    return int(np.searchsorted(lengths, size, side="right")) - 1


def ngram_counts(data: bytes, dimensions: int) -> np.ndarray:
    x = _FOLD[np.frombuffer(data, dtype=np.uint8)]
    keep = np.ones(len(x), dtype=bool)
    keep[1:] = (x[1:] != 32) | (x[:-1] != 32)
    x = np.concatenate([[32], x[keep], [32]]).astype(np.uint32)
    two = x[:-1] * np.uint32(0x9E3779B1) + x[1:] * np.uint32(0x85EBCA77)
    three = two[:-1] * np.uint32(0xC2B2AE3D) + x[2:] * np.uint32(0x27D4EB2F)
    shift = np.uint32(32 - dimensions.bit_length() + 1)
    return (np.bincount((two * np.uint32(0x165667B1)) >> shift, minlength=dimensions)
            + np.bincount((three * np.uint32(0x165667B1)) >> shift, minlength=dimensions))


def unit_vector(data: bytes, weight: np.ndarray) -> np.ndarray:
    v = np.log1p(ngram_counts(data, len(weight))).astype(np.float32) * weight
    return v / max(float(np.linalg.norm(v)), 1e-9)


def windows_of(data: bytes, settings: LanguageSettings) -> list[bytes]:
    """The whole text and a short piece of each length from its middle, so that centroids know short texts too."""
    half = len(data) // 2
    return [data, *(data[half - n // 2:half + n // 2] for n in settings.windows if n < len(data))]


class Vectors:
    """Unit vectors of a bounded sample, held by their non-zero components; ``BLOCK`` of them are whole at a time."""

    BLOCK = 128

    def __init__(self, rows: Iterator[np.ndarray], dims: int):
        self.dims = dims
        self.rows = [(np.flatnonzero(v).astype(np.int32), v[v != 0]) for v in rows]

    def __len__(self) -> int:
        return len(self.rows)

    def whole(self, i: int) -> np.ndarray:
        return self.block(i, i + 1)[0]

    def block(self, begin: int, end: int) -> np.ndarray:
        found = np.zeros((min(end, len(self.rows)) - begin, self.dims), dtype=np.float32)
        for v, (at, values) in zip(found, self.rows[begin:end]):
            v[at] = values
        return found

    def cosines(self, centres: np.ndarray) -> np.ndarray:
        return np.concatenate([self.block(i, i + self.BLOCK) @ centres.T for i in range(0, len(self), self.BLOCK)])

    def sums(self, members: np.ndarray) -> np.ndarray:
        """The sum of the vectors of each row of ``members``, weighted by it."""
        return sum(members[:, i:i + self.BLOCK] @ self.block(i, i + self.BLOCK) for i in range(0, len(self), self.BLOCK))


def cluster(vectors: Vectors, settings: LanguageSettings) -> np.ndarray:
    """Centroids by spherical k-means from farthest-first starts."""
    centres = [vectors.sums(np.ones((1, len(vectors)), dtype=np.float32))[0] / len(vectors)]
    while len(centres) < min(settings.centroids, len(vectors)):
        normed = np.stack([c / max(np.linalg.norm(c), 1e-9) for c in centres])
        centres.append(vectors.whole(int(vectors.cosines(normed).max(axis=1).argmin())))
    c = np.stack(centres)
    for _ in range(settings.rounds):
        c = c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
        nearest = vectors.cosines(c).argmax(axis=1)
        members = (nearest == np.arange(len(c))[:, None]).astype(np.float32)
        c = np.where(members.any(axis=1)[:, None], vectors.sums(members), c)
    c = c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    return c.astype(np.float32)


def train(docs: DataFrame, eligible: Column, settings: LanguageSettings = LanguageSettings()) -> LanguageModel:
    """Fit on the rows of ``docs`` where ``eligible`` holds and text and lang are usable.

    Document frequencies come from all of them, summed per task before they
    are shuffled; centroids from a bounded sample per language of four fifths
    of the rows, one language per task; floors from all rows outside the
    sample.  The driver receives frequencies, centroids and histograms alone.
    """
    dims = settings.dimensions
    usable = docs.where(eligible & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(
        "doc_id", "lang", F.col("text").cast("binary").alias("data"))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(dims, dtype=np.int64), 0
        for batch in batches:
            for data in batch.column("data").to_pylist():
                total += ngram_counts(data, dims) > 0
                rows += 1
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(seen, -1)), pa.array(np.append(total[seen], rows))], names=["dim", "n"])

    sums = {r["dim"]: r["n"] for r in usable.select("data").mapInArrow(frequencies, "dim long, n long").groupBy("dim").agg(F.sum("n").alias("n")).collect()}
    rows = sums.pop(-1, 0)
    if not rows:
        return LanguageModel([], np.zeros((0, dims), np.float32), np.zeros(0, int), np.zeros((0, len(settings.lengths))), np.ones(dims, np.float32), settings.lengths)
    frequency = np.zeros(dims)
    frequency[list(sums)] = list(sums.values())
    weight = np.log(1 + (1 + rows) / (1 + frequency)).astype(np.float32)

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        texts = [frame["data"].iloc[i] for i in np.argsort(frame["order"].to_numpy(), kind="stable")]
        centres = cluster(Vectors((unit_vector(x, weight) for data in texts for x in windows_of(data, settings)), dims), settings)
        return pd.DataFrame({"lang": frame["lang"].iloc[0], "centroid": [c.tobytes() for c in centres]})

    keyed = usable.withColumn("order", F.xxhash64("doc_id", "data"))
    sample = stored(bounded_sample(keyed.where(uniform(F.col("order")) < 0.8), F.col("lang"), F.col("doc_id"), settings.sample))
    fitted = sorted(map(tuple, sample.groupBy("lang").applyInPandas(fit, "lang string, centroid binary").collect()))
    languages = sorted({r[0] for r in fitted})
    centroids = np.stack([np.frombuffer(r[1], np.float32) for r in fitted]) if fitted else np.zeros((0, dims), np.float32)
    owner = np.array([languages.index(r[0]) for r in fitted], dtype=int)
    held_back = keyed.join(F.broadcast(sample.select("order").distinct()), "order", "left_anti")
    return LanguageModel(languages, centroids, owner, _floors(held_back, languages, centroids, owner, weight, settings), weight, settings.lengths)


STEPS = 1000  # cosines are counted in thousandths


def _floors(rows: DataFrame, languages: list[str], centroids: np.ndarray, owner: np.ndarray, weight: np.ndarray, settings: LanguageSettings) -> np.ndarray:
    """Per centroid and length class a low quantile of the cosines of ``rows`` whose nearest centroid is one of their language.

    Each text counts as a whole and by a piece of each shorter class.  A
    centroid with few of them takes the quantile of its language, a language
    with few the one of all; with nothing held back every text is accepted.
    """
    lengths, classes = settings.lengths, len(settings.lengths)
    known = {name: i for i, name in enumerate(languages)}
    shape = (len(owner), classes, STEPS + 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, dtype=np.int64)
        for batch in batches:
            for lang, data in zip(batch.column("lang").to_pylist(), batch.column("data").to_pylist()):
                half = len(data) // 2
                for piece in (data, *(data[half - n // 2:half - n // 2 + n] for n in lengths if n < len(data))):
                    k = length_class(len(piece), lengths)
                    if k < 0 or not (_FOLD[np.frombuffer(piece, dtype=np.uint8)] != 32).any():
                        continue
                    cosine = centroids @ unit_vector(piece, weight)
                    best = int(cosine.argmax()) if len(cosine) else -1
                    if best >= 0 and owner[best] == known.get(lang, -1):
                        total[best, k, int(min(max(cosine[best], 0.0), 1.0) * STEPS)] += 1
        flat = total.ravel()
        seen = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(flat[seen])], names=["cell", "n"])

    total = np.zeros(shape, dtype=np.int64)
    for row in rows.select("lang", "data").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        total.flat[row["cell"]] = row["n"]
    floor = np.zeros(shape[:2])
    for c in range(len(owner)):
        for k in range(classes):
            groups = total[c, k], total[owner == owner[c], k].sum(axis=0), total[:, k].sum(axis=0)
            counts = next((g for g in groups if g.sum() >= settings.least), groups[-1])
            if counts.any():
                floor[c, k] = int((np.cumsum(counts) > settings.quantile * counts.sum()).argmax()) / STEPS
    return floor


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with lang_pred, score (cosine to the nearest centroid, 0 to 1) and rejected.

    Ties go to the smaller language.  Texts that are null or without a letter
    get ``und``, score 0 and rejected true, as does every text if nothing was
    learned.  Repeated rows are judged each by itself; an empty table gives an
    empty result; columns named like an added one are replaced.
    """

    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            names, scores, rejected = [], [], []
            for text in texts:
                if text is None or not len(model.languages) or not HAS_LETTER.search(text):
                    names.append(UNDETERMINED), scores.append(0.0), rejected.append(True)
                    continue
                data = text.encode()
                cosine = model.centroids @ unit_vector(data, model.weight)
                best = int(cosine.argmax())
                names.append(model.languages[model.owner[best]])
                scores.append(float(min(max(cosine[best], 0.0), 1.0)))
                rejected.append(bool(cosine[best] < model.least_cosine(best, len(data))))
            yield pd.DataFrame({"lang_pred": names, "score": scores, "rejected": rejected})

    predicted = F.pandas_udf(predict, "lang_pred string, score double, rejected boolean")
    added = ("lang_pred", "score", "rejected", "_judged")
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in added]
    return docs.select(*kept, predicted("text").alias("_judged")).select(*kept, "_judged.*")


def language_ids(docs: DataFrame, settings: LanguageSettings = LanguageSettings(), folds: int = 5, held_out: int = 0) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected; learned from the rows outside the held-out fold."""
    out_of_fold = remainder(folds) == held_out
    model = train(docs, ~out_of_fold, settings)
    return identify(docs.select("doc_id", "text"), model).select("doc_id", out_of_fold.alias("held_out"), "lang_pred", "score", "rejected")
