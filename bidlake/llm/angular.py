"""Hard negatives by angular triangle filtering.

Every vector keeps its angles to a few reference directions.  Angles obey the
triangle inequality, so the angles of an anchor and of a row to the same
references enclose the angle between the two; its cosine interval times the
norms bounds their score from both sides.  Only rows whose bounds overlap a
window of wanted scores are scored, in integers.

Rows are dealt by range (length, label, nearest reference, angle to it) into
shards of bounded bytes, and lie there in small groups with the range of each
angle and norm, so that bounds rule out shards, then groups, then rows.
Anchors travel in blocks, and only to shards that can hold something for them:
first to one, whose finds narrow the windows, then to the others.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bidlake.llm.common import stored

LIMIT = 1 << 24  # scaled components are held within this
SLACK = 1e-5     # room for the rounding of stored angles
OPEN = 1 << 62   # an open window reaches from -OPEN to OPEN


@dataclass(frozen=True)
class MiningSettings:
    """Scale of components; positives of an anchor; negatives of a positive and their window in percent of its score;
    reference directions (chosen among a bounded sample); rows of a group, bytes of a shard, anchors of a block."""
    scale: int = 256
    positives: int = 5
    negatives: int = 3
    least_percent: int = 50
    most_percent: int = 95
    references: int = 8
    sampled: int = 1024
    group_rows: int = 512
    shard_bytes: int = 16 << 20
    block_anchors: int = 256


def usable_rows(embeddings: DataFrame, settings: MiningSettings) -> DataFrame:
    """row (a number), vec_id, label, v (scaled, rounded down, as double) and dims; unusable rows are left out."""
    x = F.col("embedding")
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    scaled = F.transform(x, lambda e: F.floor(F.least(F.greatest(F.lit(float(settings.scale)) * e.cast("double"), F.lit(float(-LIMIT))), F.lit(float(LIMIT)))).cast("int"))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & (F.size(x) > 0) & ~F.coalesce(bad, F.lit(True))
    rows = embeddings.where(usable).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), scaled.alias("v"))
    return stored(rows.distinct().withColumn("row", F.monotonically_increasing_id())).withColumn("dims", F.size("v"))


def reference_directions(rows: DataFrame, settings: MiningSettings) -> np.ndarray:
    """Unit vectors, each the sampled row farthest in angle from those before; of the most frequent length."""
    lengths = rows.groupBy("dims").count().orderBy(F.desc("count"), "dims").first()
    if lengths is None:
        return np.zeros((0, 1))
    sample = rows.where(F.col("dims") == lengths["dims"]).orderBy(F.xxhash64("row"), "row").limit(settings.sampled).select("v").collect()
    points = np.array([r["v"] for r in sample], dtype=np.float64)
    points = points[np.linalg.norm(points, axis=1) > 0]
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    if not len(points):
        return np.zeros((0, lengths["dims"]))
    chosen = [0]
    near = points @ points[0]
    while len(chosen) < min(settings.references, len(points)):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, points @ points[chosen[-1]])
    return points[chosen]


def angles(rows: np.ndarray, references: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norm of each row and its angles to the references; a zero vector has the angle 0 to all.

    Rows of another length than the references get no angles: their bounds are those of the norms alone.
    """
    norms = np.sqrt(np.einsum("ij,ij->i", rows, rows))
    if rows.shape[1] != references.shape[1]:
        return norms, np.zeros((len(rows), 0), dtype=np.float32)
    cosines = rows @ references.T / np.where(norms > 0, norms, 1)[:, None]
    found = np.arccos(np.clip(cosines, -1, 1))
    found[norms == 0] = 0
    return norms, found.astype(np.float32)


def score_bounds(norm: float, angle: np.ndarray, least_norm: np.ndarray, most_norm: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of an anchor's scores with rows whose angles to the references lie in [low, high] (a row of angles each).

    Rounded outward to whole numbers, with room for the rounding of the angles.
    """
    nearest, farthest = np.zeros(len(least_norm)), np.full(len(least_norm), np.pi)
    if low.shape[1]:
        nearest = np.maximum(low - angle, angle - high).max(axis=1)
        around = np.where(angle + high <= np.pi, angle + high, np.where(angle + low >= np.pi, 2 * np.pi - angle - low, np.pi))
        farthest = around.min(axis=1)
    best = np.cos(np.clip(nearest - SLACK, 0, np.pi)) * norm
    worst = np.cos(np.clip(farthest + SLACK, 0, np.pi)) * norm
    upper = np.where(best >= 0, best * most_norm, best * least_norm)
    lower = np.where(worst >= 0, worst * least_norm, worst * most_norm)
    room = 1e-9 * norm * most_norm + 1
    return np.floor(lower - room), np.ceil(upper + room)


def _lists(column: pa.Array, kind=None) -> np.ndarray:
    """A list column with lists of equal length as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    found = flat.reshape(len(column), -1) if len(flat) else np.zeros((len(column), 0))
    return found if kind is None else found.astype(kind)


def _list_array(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(rows).ravel(), kind))


def measured(rows: DataFrame, references: np.ndarray) -> DataFrame:
    """The rows with norm, angles, and the nearest reference with the angle to it."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dims").to_numpy()
            for n in np.unique(dims):
                part = batch.filter(pa.array(dims == n))
                norms, found = angles(_lists(part.column("v"), np.float64), references)
                nearest = found.argmin(axis=1) if found.shape[1] else np.zeros(len(norms), dtype=np.int64)
                angle = found[np.arange(len(norms)), nearest] if found.shape[1] else np.zeros(len(norms), dtype=np.float32)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("row", "vec_id", "label", "dims", "v")), pa.array(norms), _list_array(found, pa.float32()),
                     pa.array(nearest.astype(np.int32)), pa.array(angle, pa.float32())],
                    names=["row", "vec_id", "label", "dims", "v", "norm", "angles", "nearest", "angle"])

    return rows.select("row", "vec_id", "label", "dims", "v").mapInArrow(
        measure, "row long, vec_id long, label long, dims int, v array<int>, norm double, angles array<float>, nearest int, angle float")


_GROUP = ("shard int, part int, label long, dims int, least_norm double, most_norm double, low array<float>, high array<float>, "
          "ids array<long>, rows array<int>, norms array<double>, angles array<float>")


def grouped(table: DataFrame, shards: int, settings: MiningSettings) -> DataFrame:
    """Groups of neighbouring rows of one length and label, each with its ranges; a shard is a range of groups.

    Equal rows are parted by a hash, so a very frequent vector fills several shards.
    """

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, part = TaskContext.get().partitionId(), 0
        waiting: list[pa.RecordBatch] = []

        def made() -> pa.RecordBatch:
            nonlocal part, waiting
            rows = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
            waiting, part = [], part + 1
            found, norms = _lists(rows.column("angles"), np.float32), rows.column("norm").to_numpy()
            values = [shard, part, rows.column("label")[0].as_py(), rows.column("dims")[0].as_py(), norms.min(), norms.max(), found.min(axis=0), found.max(axis=0),
                      rows.column("vec_id").to_numpy(), rows.column("v").flatten().to_numpy(), norms, found.ravel()]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _GROUP_SCHEMA)], schema=_GROUP_SCHEMA)

        for batch in batches:
            keys = np.stack([batch.column("dims").to_numpy().astype(np.int64), batch.column("label").to_numpy()])
            starts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1), batch.num_rows]
            for start, end in zip(starts, starts[1:]):
                if start < end and waiting and (waiting[0].column("dims")[0].as_py(), waiting[0].column("label")[0].as_py()) != tuple(keys[:, start]):
                    yield made()
                at = start
                while at < end:
                    have = sum(w.num_rows for w in waiting)
                    take = min(settings.group_rows - have, end - at)
                    waiting.append(batch.slice(at, take))
                    at += take
                    if have + take == settings.group_rows:
                        yield made()
        if waiting:
            yield made()

    dealt = table.repartitionByRange(shards, "dims", "label", "nearest", "angle", F.xxhash64("row")).sortWithinPartitions("dims", "label", "nearest", "angle", "row")
    return stored(dealt.select("vec_id", "label", "dims", "v", "norm", "angles").mapInArrow(group, _GROUP))


_GROUP_SCHEMA = pa.schema([
    ("shard", pa.int32()), ("part", pa.int32()), ("label", pa.int64()), ("dims", pa.int32()), ("least_norm", pa.float64()), ("most_norm", pa.float64()),
    ("low", pa.list_(pa.float32())), ("high", pa.list_(pa.float32())), ("ids", pa.list_(pa.int64())), ("rows", pa.list_(pa.int32())),
    ("norms", pa.list_(pa.float64())), ("angles", pa.list_(pa.float32()))])


class Shards:
    """What bounds need of each shard: ranges of norms and angles of its rows of one length and label.

    A few dozen numbers a shard (and label in it), where a shard holds ``shard_bytes`` of vectors.
    """

    def __init__(self, groups: DataFrame, references: int):
        sides = [F.array(*[f(F.get(side, j)) for j in range(references)]).alias(side) for f, side in ((F.min, "low"), (F.max, "high"))] if references else [F.first(s).alias(s) for s in ("low", "high")]
        found = groups.groupBy("shard", "dims", "label").agg(F.min("least_norm").alias("least_norm"), F.max("most_norm").alias("most_norm"), *sides).orderBy("shard", "dims", "label").toArrow()
        self.shard, self.dims, self.label, self.least, self.most = (found.column(c).to_numpy() for c in ("shard", "dims", "label", "least_norm", "most_norm"))
        self.low, self.high = ([x if x is not None and None not in x else [] for x in found.column(side).to_pylist()] for side in ("low", "high"))

    def reached(self, dims: int, label: int, same: bool, norm: float, angle: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[int]:
        """Shards that may hold scores within one of the windows, those with the highest bound first."""
        at = np.flatnonzero((self.dims == dims) & ((self.label == label) == same))
        if not len(at):
            return []
        lows, highs = (np.array([side[i] for i in at], dtype=np.float64).reshape(len(at), -1) for side in (self.low, self.high))
        worst, best = score_bounds(norm, angle, self.least[at], self.most[at], lows, highs)
        fits = ((worst[:, None] <= high) & (best[:, None] >= low)).any(axis=1)
        order = np.argsort(-best[fits], kind="stable")
        return list(dict.fromkeys(self.shard[at[fits]][order].tolist()))


_ANCHOR = "row long, vec_id long, label long, dims int, v array<int>, norm double, angles array<float>, low array<long>, high array<long>"


def routed(anchors: DataFrame, shards: Shards, same: bool) -> DataFrame:
    """The anchors with the shards that can hold something for their windows."""
    parts = (shards.shard, shards.dims, shards.label, shards.least, shards.most, shards.low, shards.high)
    shared = anchors.sparkSession.sparkContext.broadcast(parts)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Shards.__new__(Shards)
        table.shard, table.dims, table.label, table.least, table.most, table.low, table.high = shared.value
        for batch in batches:
            to = [table.reached(d, l, same, n, np.array(a, dtype=np.float64), np.array(low), np.array(high))
                  for d, l, n, a, low, high in zip(*(batch.column(c).to_pylist() for c in ("dims", "label", "norm", "angles", "low", "high")))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(to, pa.list_(pa.int32()))], names=[*batch.schema.names, "shards"])

    return anchors.mapInArrow(route, _ANCHOR + ", shards array<int>")


class Windows:
    """The best scores of an anchor in each of its windows; a full window rises to its last place."""

    def __init__(self, low: list[int], high: list[int], most: int):
        self.low, self.high, self.most = np.array(low), np.array(high), most
        self.best: list[list[tuple[int, int]]] = [[] for _ in low]

    def overlap(self, lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        """Which bounds overlap a window."""
        found = np.zeros(len(lower), dtype=bool)
        for low, high in zip(self.low, self.high):
            found |= (upper >= low) & (lower <= high)
        return found

    def take(self, ids: np.ndarray, scores: np.ndarray) -> None:
        for k, best in enumerate(self.best):
            for j in np.flatnonzero((scores >= self.low[k]) & (scores <= self.high[k])):
                entry = (int(scores[j]), -int(ids[j]))
                if len(best) < self.most:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
            if len(best) == self.most:
                self.low[k] = max(self.low[k], best[0][0])


def _exact(rows: np.ndarray, dims: int, largest: int) -> np.ndarray:
    """The matrix in the narrowest type in which no product sum is rounded: single, double, 64-bit integers."""
    reach = largest * int(np.abs(rows).max(initial=0)) * dims
    return rows.astype(np.float32 if reach < 1 << 24 else np.float64 if reach < 1 << 52 else np.int64)


def searched(groups: DataFrame, anchors: DataFrame, shards: int, same: bool, most: int, settings: MiningSettings) -> DataFrame:
    """row (the anchor's), window, vec_id and score: the best of each window in the shard that an anchor was sent to.

    ``anchors`` has a column ``shard``.  A task reads the groups of its shard, then the anchors one block after the other.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held = None, []
        for batch in batches:
            kinds, names = batch.column("kind").to_pylist(), batch.column("shard").to_pylist()
            for i in range(batch.num_rows):
                if names[i] != name:
                    name, held = names[i], []
                if kinds[i] == 0:
                    held.append(_Group(batch.column("grouped")[i]))
                    continue
                if not held:
                    continue
                block = batch.column("block")[i].values
                yield _block(held, block, same, most)

    both = groups.select("shard", F.lit(0).alias("kind"), F.col("part").alias("at"), F.struct("label", "dims", "least_norm", "most_norm", "low", "high", "ids", "rows", "norms", "angles").alias("grouped"))
    block = F.pmod(F.xxhash64("row"), F.ceil(F.col("_anchors") / settings.block_anchors)).cast("int")
    sizes = anchors.groupBy("shard").agg(F.count("*").alias("_anchors"))
    blocks = anchors.join(sizes, "shard").withColumn("at", block).groupBy("shard", "at").agg(
        F.collect_list(F.struct("row", "vec_id", "label", "dims", "v", "norm", "angles", "low", "high")).alias("block"))
    placed = both.unionByName(blocks.withColumn("kind", F.lit(1)), allowMissingColumns=True).repartition(shards, "shard").sortWithinPartitions("shard", "kind", "at")
    return placed.select("shard", "kind", "grouped", "block").mapInArrow(search, "row long, window int, vec_id long, score long")


class _Group:
    """A group of rows in memory; its matrix in a type that the anchors' products need."""

    def __init__(self, value: pa.StructScalar):
        def numbers(name: str) -> np.ndarray:
            return value[name].values.to_numpy(zero_copy_only=False)

        self.label, self.dims = value["label"].as_py(), value["dims"].as_py()
        self.least, self.most = np.array([value["least_norm"].as_py()]), np.array([value["most_norm"].as_py()])
        self.low, self.high = numbers("low")[None].astype(np.float64), numbers("high")[None].astype(np.float64)
        self.ids, self.norms = numbers("ids"), numbers("norms")
        self.rows = numbers("rows").reshape(len(self.ids), self.dims).astype(np.int64)
        self.angles = numbers("angles").reshape(len(self.ids), -1)
        self._typed: dict[int, np.ndarray] = {}

    def typed(self, largest: int) -> np.ndarray:
        step = max(largest, 1).bit_length()  # a type serves all anchors up to the next power of two
        if step not in self._typed:
            self._typed[step] = _exact(self.rows, self.dims, 1 << step)
        return self._typed[step]


def _block(held: list[_Group], block: pa.StructArray, same: bool, most: int) -> pa.RecordBatch:
    """The finds of one block of anchors in the groups of a shard."""
    columns = {c: block.field(c).to_pylist() for c in ("row", "vec_id", "label", "dims", "v", "norm", "angles", "low", "high")}
    out: list[tuple] = []
    for row, vec_id, label, dims, v, norm, angle, low, high in zip(*columns.values()):
        windows, angle = Windows(low, high, most), np.array(angle, dtype=np.float64)
        query, largest = np.array(v, dtype=np.int64), max(map(abs, v))
        fitting = [g for g in held if g.dims == dims and (g.label == label) == same]
        if not fitting:
            continue
        lower, upper = score_bounds(norm, angle, *(np.concatenate([getattr(g, x) for g in fitting]) for x in ("least", "most", "low", "high")))
        for k in np.argsort(-upper, kind="stable"):  # the most promising first
            group = fitting[k]
            if not windows.overlap(lower[k:k + 1], upper[k:k + 1])[0]:
                continue
            bounds = score_bounds(norm, angle, group.norms, group.norms, group.angles, group.angles)
            may = np.flatnonzero(windows.overlap(*bounds) & (group.ids != vec_id))
            if len(may):
                matrix = group.typed(largest)
                windows.take(group.ids[may], (matrix[may] @ query.astype(matrix.dtype)).astype(np.int64))
        out.extend((row, k, -other, score) for k, best in enumerate(windows.best) for score, other in best)
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, kinds)], names=["row", "window", "vec_id", "score"])


def best_in_windows(groups: DataFrame, table: Shards, anchors: DataFrame, shards: int, same: bool, most: int, settings: MiningSettings) -> DataFrame:
    """row, window, vec_id, score, rank: the first ``most`` rows of each anchor's windows (``low`` to ``high``), among
    rows of the same label or of others, ties to the smaller vec_id."""
    first = stored(routed(anchors, table, same).where("size(shards) > 0"))
    started = stored(searched(groups, first.withColumn("shard", F.col("shards")[0]).drop("shards"), shards, same, most, settings))
    ends = started.groupBy("row", "window").agg(F.count("*").alias("n"), F.min("score").alias("score")).where(F.col("n") >= most)
    ends = ends.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("ends"))  # a few windows a row
    raised = first.withColumnRenamed("shards", "before").join(ends, "row", "left").withColumn(
        "low", F.when(F.col("ends").isNull(), F.col("low")).otherwise(F.transform("low", lambda x, k: F.greatest(x, F.coalesce(F.try_element_at("ends", k), x)))))
    again = routed(raised.select("row", "vec_id", "label", "dims", "v", "norm", "angles", "low", "high"), table, same)
    others = again.join(raised.select("row", F.col("before")[0].alias("done")), "row").select("*", F.explode("shards").alias("shard")).where("shard != done").drop("shards", "done")
    found = started.unionByName(searched(groups, others, shards, same, most, settings))
    order = Window.partitionBy("row", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def hard_negatives(embeddings: DataFrame, is_anchor: Column, settings: MiningSettings = MiningSettings()) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    An anchor (``is_anchor`` holds; a condition on vec_id) has as positives its
    best other rows of the same label, and per positive the best rows of other
    labels whose score lies in the percent window of the positive's, ties to
    the smaller vec_id; fewer rows give fewer results, and a negative positive
    score has an empty window.  Rows of the anchor's vec_id are its own.  Rows
    with a null id, label or vector, an empty vector or a null or non-finite
    component take no part; only vectors of one length are compared; rows that
    repeat id, label and vector count once.  Scaled components beyond 2^24
    count as 2^24 (below: -2^24).  An empty table gives an empty result; other
    columns are not read.
    """
    spark = embeddings.sparkSession
    rows = usable_rows(embeddings, settings)
    references = reference_directions(rows, settings)
    table = stored(measured(rows, references))
    weight = table.agg(F.count("*").alias("n"), F.sum(F.col("dims").cast("long") * 4 + 4 * settings.references + 16).alias("bytes")).first()
    cores = spark.sparkContext.defaultParallelism
    shards = max(1, -(-(weight["bytes"] or 0) // settings.shard_bytes), min(cores, weight["n"] // settings.group_rows))
    groups = grouped(table, shards, settings)
    summary = Shards(groups, len(references))
    anchors = stored(table.where(is_anchor).drop("nearest", "angle").withColumns({"low": F.array(F.lit(-OPEN)), "high": F.array(F.lit(OPEN))}))
    positives = stored(best_in_windows(groups, summary, anchors, shards, True, settings.positives, settings).select("row", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))
    # the percentages rounded up and down, in integers
    least = -F.expr(f"(-({settings.least_percent} * positive_score) - pmod(-({settings.least_percent} * positive_score), 100L)) div 100")
    most = F.expr(f"({settings.most_percent} * positive_score - pmod({settings.most_percent} * positive_score, 100L)) div 100")
    scored = positives.select("row", "positive_score").distinct().withColumns({"low": least, "high": most}).where("low <= high")
    windows = scored.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("positive_score", "low", "high"))).alias("windows"))  # at most ``positives``
    windowed = stored(anchors.drop("low", "high").join(windows, "row"))
    seeking = windowed.withColumns({"low": F.transform("windows", lambda w: w["low"]), "high": F.transform("windows", lambda w: w["high"])}).drop("windows")
    found = best_in_windows(groups, summary, seeking, shards, False, settings.negatives, settings)
    named = windowed.select("row", F.col("vec_id").alias("anchor_id"), F.posexplode("windows").alias("window", "_w")).select("row", "anchor_id", "window", F.col("_w.positive_score").alias("positive_score"))
    negatives = found.select("row", "window", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return named.join(negatives, ["row", "window"]).join(positives, ["row", "positive_score"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
