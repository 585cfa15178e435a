"""Exact top-k by inner product with a KD-tree per shard.

Rows are dealt into shards by median splits of the whole table (the planes come
from a bounded sample, every row is dealt; a region that holds more rows than a
shard is divided by a hash).  A shard's KD-tree splits at medians of its widest
dimension and keeps the tight box of every node.  A query walks the tree best
first: the box bounds the inner product from above, and nodes whose bound is
below the query's k-th score so far are left out.  A first round searches each
query in its own shard; the k-th score found there decides by the boxes of the
other shards which of them the query is sent to.

Vectors are stored and sent one a row; a task gathers one shard's rows, or one
block's, as they stream by, sorted, so its memory does not grow with the table.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from copy import copy
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bidlake.llm.common import stored, uniform


@dataclass(frozen=True)
class TopkSettings:
    k: int = 20
    scale: int = 64
    shard_rows: int = 4096
    block_queries: int = 512
    leaf_rows: int = 128
    sample: int = 4_000_000   # components of the rows that the splits between shards are fitted on
    box_block: int = 1024     # shard boxes that a task compares with a block of queries at once
    span_blocks: int = 64     # blocks of queries that one copy of a shard answers for


def whole_vectors(embeddings: DataFrame, settings: TopkSettings) -> DataFrame:
    """vec_id, v (floor of the scaled components, as long) and dims; unusable vectors are left out."""
    x = F.col("embedding")
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    usable = F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0) & ~F.coalesce(bad, F.lit(True))
    return embeddings.where(usable).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(x, lambda e: F.floor(F.lit(float(settings.scale)) * e.cast("double")).cast("long")).alias("v"), F.size(x).alias("dims"))


class KDTree:
    """Median splits along the widest dimension, tight boxes, leaves as row ranges of one reordered matrix."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, leaf_rows: int):
        self.low, self.high, self.children, self.span = [], [], [], []
        self.order = order = np.argsort(ids, kind="stable")
        self._rows = rows
        self._build(0, len(order), leaf_rows)
        self.ids, self.rows = ids[self.order], rows[self.order]
        self.low, self.high = np.stack(self.low), np.stack(self.high)
        self.largest = int(np.abs(self.rows).max(initial=0))
        self._doubles: KDTree | None = None

    def suited(self, queries: np.ndarray) -> tuple["KDTree", np.ndarray]:
        """Tree and queries as doubles, whose products are fast, where no sum can pass 2^52; else as they are."""
        if self.largest * int(np.abs(queries).max(initial=0)) * queries.shape[1] >= 2 ** 52:
            return self, queries
        if self._doubles is None:
            self._doubles = copy(self)
            for name in ("rows", "low", "high"):
                setattr(self._doubles, name, getattr(self, name).astype(np.float64))
        return self._doubles, queries.astype(np.float64)

    def _build(self, start: int, end: int, leaf_rows: int) -> int:
        node, part = len(self.span), self._rows[self.order[start:end]]
        self.low.append(part.min(axis=0))
        self.high.append(part.max(axis=0))
        self.children.append(None)
        self.span.append((start, end))
        widest = int((self.high[node] - self.low[node]).argmax())
        if end - start > leaf_rows and self.high[node][widest] > self.low[node][widest]:
            half = (end - start) // 2
            self.order[start:end] = self.order[start:end][np.argpartition(part[:, widest], half)]
            self.children[node] = (self._build(start, start + half, leaf_rows), self._build(start + half, end, leaf_rows))
        return node

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Upper bound of the inner product per query and node box."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T

    def search(self, query_id: int, query: np.ndarray, bounds: np.ndarray, k: int, kth: float) -> list[tuple[int, int]]:
        """The best k (score, -id) at or above ``kth`` in the shard, best first; the query's own id is left out."""
        best: list[tuple[int, int]] = []
        queue = [(-bounds[0], 0)]
        while queue:
            bound, node = heapq.heappop(queue)
            if -bound < kth:
                break
            if self.children[node] is not None:
                for child in self.children[node]:
                    if bounds[child] >= kth:
                        heapq.heappush(queue, (-bounds[child], child))
                continue
            start, end = self.span[node]
            scores = self.rows[start:end] @ query
            for j in np.flatnonzero(scores >= kth):
                vec = int(self.ids[start + j])
                if vec == query_id:
                    continue
                entry = (int(scores[j]), -vec)
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
                if len(best) == k:
                    kth = max(kth, best[0][0])
        return sorted(best, reverse=True)


@dataclass(frozen=True)
class Splits:
    """Planes between regions of the vectors of one length: inner nodes send v[dim] >= cut to ``high``; leaves have dim -1."""
    dim: np.ndarray
    cut: np.ndarray
    low: np.ndarray
    high: np.ndarray
    region: np.ndarray

    def place(self, rows: np.ndarray) -> np.ndarray:
        node = np.zeros(len(rows), dtype=np.int64)
        while (inner := np.flatnonzero(self.dim[node] >= 0)).size:
            at = node[inner]
            node[inner] = np.where(rows[inner, self.dim[at]] >= self.cut[at], self.high[at], self.low[at])
        return self.region[node]


def fitted_splits(rows: np.ndarray, regions: int, least: int = 16) -> Splits:
    """Median splits of the sample along its widest dimension until it has about ``regions`` parts or ``least`` rows a part."""
    nodes: list[list[int]] = []
    regions_made = 0

    def build(part: np.ndarray, wanted: int) -> int:
        nonlocal regions_made
        number = len(nodes)
        nodes.append([-1, 0, 0, 0, 0])
        spread = part.max(axis=0) - part.min(axis=0) if len(part) else np.zeros(1)
        widest = int(spread.argmax())
        if wanted > 1 and len(part) >= 2 * least and spread[widest] > 0:
            values = part[:, widest]
            cut = int(np.partition(values, len(values) // 2)[len(values) // 2])
            if cut == values.min():
                cut = int(values[values > cut].min())
            up = values >= cut
            nodes[number][:2] = [widest, cut]
            nodes[number][2] = build(part[~up], wanted // 2)
            nodes[number][3] = build(part[up], wanted - wanted // 2)
        else:
            nodes[number][4] = regions_made
            regions_made += 1
        return number

    build(rows, regions)
    return Splits(*np.array(nodes, dtype=np.int64).T)


def dealt(vectors: DataFrame, settings: TopkSettings) -> DataFrame:
    """``vectors`` with shard: the region of their length that their place falls in, divided by a hash where it is too full.

    Equal vectors share a region, so a region's rows are counted first; a shard
    holds about ``shard_rows`` rows at most.
    """
    sizes = {r["dims"]: r["n"] for r in vectors.groupBy("dims").agg(F.count("*").alias("n")).where(F.col("n") > settings.shard_rows).collect()}
    components = sum(dims * n for dims, n in sizes.items())
    sample = vectors.where(F.col("dims").isin(list(sizes)) & (uniform(F.lit("split"), F.col("vec_id")) * components < settings.sample)) if sizes else vectors.limit(0)
    rows: dict[int, list] = {}
    for r in sample.select("dims", "v").toLocalIterator():
        rows.setdefault(r["dims"], []).append(r["v"])
    planes = {dims: fitted_splits(np.array(part, dtype=np.int64), -(-sizes[dims] // settings.shard_rows)) for dims, part in rows.items()}

    def regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v, dims = batch.column("v"), batch.column("dims").to_numpy()
            found = np.zeros(batch.num_rows, dtype=np.int64)
            for length in set(dims.tolist()) & set(planes):
                at = np.flatnonzero(dims == length)
                found[at] = planes[length].place(_matrix(v.take(pa.array(at))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=["vec_id", "v", "dims", "region"])

    placed = stored(vectors.mapInArrow(regions, "vec_id long, v array<bigint>, dims int, region long"))
    full = stored(placed.groupBy("dims", "region").agg(F.ceil(F.count("*") / settings.shard_rows).alias("parts")))
    part = F.pmod(F.xxhash64(F.lit("shard"), "vec_id"), F.col("parts"))
    return placed.join(full, ["dims", "region"]).select("vec_id", "v", "dims", F.concat_ws(":", "dims", "region", part).alias("shard"))


def searched(members: DataFrame, asked: DataFrame, settings: TopkSettings) -> DataFrame:
    """query_id, vec_id and score of the vectors in ``members`` (shard, vec_id, v) for the queries (shard, block, vec_id, v, kth) sent to each shard.

    A task reads a shard's vectors, then its queries block by block; it holds
    one tree, one block and one batch of rows.  A shard that many blocks ask is
    copied, once per ``span_blocks`` numbers of blocks, so that no task answers
    them all.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, tree = None, None
        for (shard, span, kind, _block), parts in _gathered(batches, ["shard", "span", "kind", "block"]):
            ids, matrix = (np.concatenate([p[c] for p in parts]) for c in ("vec_id", "v"))
            if kind == 0:
                name, tree = (shard, span), KDTree(ids, matrix, settings.leaf_rows)
                continue
            if (shard, span) != name:
                continue
            kth = np.concatenate([p["kth"] for p in parts])
            own, matrix = tree.suited(matrix)
            bounds = own.bounds(matrix)
            found = [(int(q), -v, s) for j, q in enumerate(ids) for s, v in own.search(int(q), matrix[j], bounds[j], settings.k, -np.inf if np.isnan(kth[j]) else kth[j])]
            if found:
                q, v, s = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.int64())], names=["query_id", "vec_id", "score"])

    blocks = asked.withColumn("span", F.floor(F.col("block") / settings.span_blocks))
    copies = members.join(blocks.select("shard", "span").distinct(), "shard")
    both = copies.select("shard", "span", F.lit(0).alias("kind"), F.lit(0).alias("block"), "vec_id", "v", F.lit(float("nan")).alias("kth")).unionByName(
        blocks.select("shard", "span", F.lit(1).alias("kind"), "block", "vec_id", "v", "kth"))
    placed = both.repartition("shard", "span").sortWithinPartitions("shard", "span", "kind", "block")
    return placed.mapInArrow(search, "query_id long, vec_id long, score long")


def _runs(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """Where runs of equal keys begin, and the number of rows."""
    change = np.zeros(batch.num_rows, dtype=bool)
    change[:1] = True
    for c in keys:
        codes = batch.column(c).dictionary_encode().indices.to_numpy()
        change[1:] |= codes[1:] != codes[:-1]
    return np.append(np.flatnonzero(change), batch.num_rows)


def _gathered(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, list[dict[str, np.ndarray]]]]:
    """The rows of each key, which follow each other, as parts: vec_id, v (a matrix) and kth."""
    at, parts = None, []
    for batch in batches:
        ends = _runs(batch, keys)
        for start, end in zip(ends[:-1].tolist(), ends[1:].tolist()):
            rows = batch.slice(start, end - start)
            key = tuple(rows.column(c)[0].as_py() for c in keys)
            if key != at:
                if parts:
                    yield at, parts
                at, parts = key, []
            parts.append({"vec_id": rows.column("vec_id").to_numpy(), "v": _matrix(rows.column("v")), "kth": rows.column("kth").to_numpy(zero_copy_only=False)})
    if parts:
        yield at, parts


def pieces(members: DataFrame) -> DataFrame:
    """``members`` (shard, vec_id, v, in order of their shards) as lists: shard, rows, several of them a shard."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ends = _runs(batch, ["shard"])
                rows = pa.StructArray.from_arrays([batch.column("vec_id"), batch.column("v")], names=["vec_id", "v"])
                yield pa.RecordBatch.from_arrays([batch.column("shard").take(pa.array(ends[:-1])), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)], names=["shard", "rows"])

    return members.select("shard", "vec_id", "v").mapInArrow(gather, "shard string, rows array<struct<vec_id: long, v: array<bigint>>>")


def shard_boxes(trees: DataFrame) -> DataFrame:
    """shard, low, high: the tight box of each shard's vectors, from the boxes of its lists (shard, rows)."""

    def box(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrices = [_matrix(rows.values.field("v")) for rows in batch.column("rows")]
            ends = [pa.array([list(f(axis=0)) for f in fs], pa.list_(pa.int64())) for fs in ([m.min for m in matrices], [m.max for m in matrices])]
            yield pa.RecordBatch.from_arrays([batch.column("shard"), *ends], names=["shard", "low", "high"])

    parts = trees.select("shard", "rows").mapInArrow(box, "shard string, low array<bigint>, high array<bigint>")
    both = parts.groupBy("shard").agg(F.collect_list("low").alias("lows"), F.collect_list("high").alias("highs"))  # few a shard
    joined = lambda c, f: F.aggregate(c, F.element_at(c, 1), lambda a, x: F.zip_with(a, x, f))
    return both.select("shard", joined("lows", lambda x, y: F.least(x, y)).alias("low"), joined("highs", lambda x, y: F.greatest(x, y)).alias("high"))


def reached(blocks: DataFrame, boxes: DataFrame, numbers: int, settings: TopkSettings) -> DataFrame:
    """shard, block, rows: the queries of each block (dims, block, rows) that a shard's box lets hope for a place, their own shard left out.

    ``boxes`` meet each of the ``numbers`` blocks in groups of ``box_block``;
    that is one box, not its rows, per shard and block.
    """
    shards = boxes.count()
    grouped = boxes.groupBy(F.substring_index("shard", ":", 1).cast("int").alias("dims"), F.pmod(F.xxhash64("shard"), F.lit(-(-shards // settings.box_block) or 1)).alias("group")).agg(
        F.collect_list(F.struct("shard", "low", "high")).alias("boxes"))
    meeting = grouped.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(numbers - 1)))).join(blocks, ["dims", "block"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block, rows, near = batch.column("block")[i].as_py(), batch.column("rows")[i].values, batch.column("boxes")[i].values
                queries, kth, home = _matrix(rows.field("v")), rows.field("kth").to_numpy(zero_copy_only=False), rows.field("home").to_pylist()
                low, high, names = _matrix(near.field("low")), _matrix(near.field("high")), near.field("shard").to_pylist()
                if max(int(np.abs(queries).max()), 1) * max(int(np.abs(low).max()), int(np.abs(high).max()), 1) * queries.shape[1] < 2 ** 52:
                    queries, low, high = (x.astype(np.float64) for x in (queries, low, high))
                bounds = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
                hope = np.isnan(kth)[:, None] | (bounds >= kth[:, None])
                hope &= np.array(home, dtype=object)[:, None] != np.array(names, dtype=object)[None, :]
                for j in np.flatnonzero(hope.any(axis=0)):
                    sent = rows.take(pa.array(np.flatnonzero(hope[:, j])))
                    kept = pa.StructArray.from_arrays([sent.field(c) for c in ("vec_id", "v", "kth")], names=["vec_id", "v", "kth"])
                    lists = pa.ListArray.from_arrays(pa.array([0, len(kept)], pa.int32()), kept)
                    yield pa.RecordBatch.from_arrays([pa.array([names[j]]), pa.array([block], pa.int32()), lists], names=["shard", "block", "rows"])

    return meeting.select("block", "rows", "boxes").mapInArrow(send, "shard string, block int, rows array<struct<vec_id: long, v: array<bigint>, kth: double>>")


BATCH_BYTES = 8 << 20  # of rows in one batch of a Python function


def _matrix(lists: pa.ListArray) -> np.ndarray:
    """Rows of equal length as integers."""
    return lists.flatten().to_numpy().reshape(len(lists), -1)


def top_neighbours(embeddings: DataFrame, is_query: Column, settings: TopkSettings = TopkSettings()) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows per query, ties to the smaller vec_id.

    ``is_query`` is a condition on vec_id.  Rows are known by vec_id: a
    query's own row is every row of its id, and rows that repeat id and vector
    count once.  Vectors that are null, empty or hold a null or non-finite
    component, and null ids, take no part; only vectors of one length are
    compared.  Fewer candidates than k give fewer rows; an empty table gives
    an empty result; other columns are not read.
    """
    vectors = dealt(stored(whole_vectors(embeddings, settings).distinct()), settings)
    none = F.lit(float("nan"))
    members = stored(vectors.select("shard", "dims", "vec_id", "v").repartition("shard").sortWithinPartitions("shard"))
    queries = stored(members.where(is_query))
    numbers = max(1, -(-queries.count() // settings.block_queries))
    block = F.pmod(F.xxhash64(F.lit("block"), "vec_id"), F.lit(numbers)).cast("int").alias("block")
    started = stored(searched(members, queries.select("shard", block, "vec_id", "v", none.alias("kth")), settings), BATCH_BYTES)
    kth = started.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").cast("double").alias("least")).select(
        F.col("query_id").alias("vec_id"), F.when(F.col("n") >= settings.k, F.col("least")).otherwise(none).alias("kth"))
    known = queries.join(kth, "vec_id", "left").withColumn("kth", F.coalesce("kth", none)).select("dims", block, "vec_id", "v", "kth", F.col("shard").alias("home"))
    blocks = known.groupBy("dims", "block").agg(F.collect_list(F.struct("vec_id", "v", "kth", "home")).alias("rows"))
    boxes = stored(shard_boxes(pieces(members)), BATCH_BYTES)
    sent = stored(reached(blocks, boxes, numbers, settings).select("shard", "block", F.inline("rows")), BATCH_BYTES)
    found = started.unionByName(searched(members, sent, settings))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= settings.k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
