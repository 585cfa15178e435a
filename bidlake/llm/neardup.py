"""Near-duplicate detection by one-permutation MinHash with optimal densification.

One hash of every shingle of a text fills all bins of its signature; an empty
bin copies the value of a full one along a pseudorandom order of bins that is
the same for all texts.  Bands of bins give buckets.  Texts with the same
shingle set are one vertex from the start.  In a bucket, links are star
shaped: every member is compared with one centre, on full shingle sets.
Buckets that still hold several components get further centres for a few
turns, while a turn links something.  What is still apart in a shared bucket
then goes through an exact prefix-filter join on the full shingle sets, so no
link depends on which members became centres.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidlake.llm.common import looked_up, stored, uniform
from bidlake.llm.components import components
from bidlake.llm.wordhash import U64, mix, shingle_set

BINS = 256
BATCH_BYTES = 8 << 20  # of texts and shingle sets in one batch of a Python function
SLICE = 250            # sets that a batch gives back at once


@dataclass(frozen=True)
class DedupSettings:
    """Shingle length, link threshold in percent, bins per band, components of a bucket compared in one turn (and turns).

    With 6 of 256 bins a band, two texts at similarity 0.85 share no bucket
    with probability 3e-9, at 0.8 with 3e-6.
    """
    words: int = 5
    percent: int = 80
    band_rows: int = 6
    centres: int = 8

    @property
    def bands(self) -> int:
        return BINS // self.band_rows


def bin_orders() -> np.ndarray:
    """For each bin, the order in which it looks for a full one."""
    keys = mix(np.arange(BINS * BINS, dtype=np.uint64) + U64(0xA5A5A5A5)).reshape(BINS, BINS)
    return np.argsort(keys, axis=1).astype(np.int64)


def signature(shingles: np.ndarray, orders: np.ndarray) -> np.ndarray:
    """The least shingle hash of each bin, empty bins densified; ``shingles`` is sorted and not empty."""
    bins = (shingles >> U64(56)).astype(np.int64)
    full, first = np.unique(bins, return_index=True)
    values = np.zeros(BINS, dtype=np.uint64)
    values[full] = shingles[first]
    if len(full) < BINS:
        present = np.zeros(BINS, dtype=bool)
        present[full] = True
        empty = np.flatnonzero(~present)
        look = orders[empty]
        values[empty] = values[look[np.arange(len(empty)), present[look].argmax(axis=1)]]
    return values


def set_hash(shingles: np.ndarray) -> int | None:
    """A 64-bit hash of a shingle set; None for the empty one."""
    if not len(shingles):
        return None
    return int(mix(mix(shingles).sum(keepdims=True) + U64(len(shingles))).view(np.int64)[0])


def band_keys(values: np.ndarray, settings: DedupSettings) -> np.ndarray:
    rows = values[:settings.bands * settings.band_rows].reshape(settings.bands, settings.band_rows)
    key = np.arange(1, settings.bands + 1, dtype=np.uint64)
    for j in range(settings.band_rows):
        key = mix(key * U64(0xD6E8FEB86659FD93) + rows[:, j])
    return key


_SIGNED = "doc_id long, set_id long, n_shingles long, buckets array<long>"


def signed_documents(docs: DataFrame, settings: DedupSettings) -> DataFrame:
    """doc_id, set_id (hash of the shingle set, null if empty), n_shingles and the buckets of each whole text."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders = bin_orders()
        for batch in batches:
            sets, sizes, keys = [], [], []
            for data in batch.column("data"):
                shingles = shingle_set(data.as_py() or b"", settings.words)
                sizes.append(len(shingles))
                if len(shingles):
                    sets.append(set_hash(shingles))
                    keys.append(band_keys(signature(shingles, orders), settings).view(np.int64))
                else:
                    sets.append(None)
                    keys.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sets, pa.int64()), pa.array(sizes, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "set_id", "n_shingles", "buckets"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("data")).mapInArrow(sign, _SIGNED)


FILTER_BITS = 26


def _probes(h: Column, bits: int) -> list[Column]:
    """Three places of a hash in a filter of 2^bits bits."""
    one, two = h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32).bitwiseOR(F.lit(1))
    return [(one + two * i).bitwiseAND(F.lit((1 << bits) - 1)) for i in range(3)]


def id_filter(ids: DataFrame) -> np.ndarray:
    """A Bloom filter of the doc_ids: about ten bits each, 2^26 bits (8 MB) at most; a full one lets more through."""
    bits = min(FILTER_BITS, max(10, (10 * ids.count()).bit_length()))
    places = ids.select(F.explode(F.array(*_probes(F.xxhash64("doc_id"), bits))).alias("place"))
    words = places.groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("place").bitwiseAND(F.lit(63)).cast("int"))).alias("bits"))
    table = np.zeros(1 << (bits - 6), dtype=np.int64)
    for row in words.collect():
        table[row["word"]] = row["bits"]
    return table.view(np.uint64)


def _hits(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which hashes (of doc_ids) may be in a filter."""
    mask, one, two = U64(64 * len(table) - 1), h & U64(0xFFFFFFFF), (h >> U64(32)) | U64(1)
    hit = np.ones(len(h), dtype=bool)
    for i in range(3):
        place = (one + two * U64(i)) & mask
        hit &= (table[place >> U64(6)] >> (place & U64(63)) & U64(1)) == 1
    return hit


def _passes(shared):
    """The filter's test as a column function of the hash."""

    def test(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for h in batches:
            yield pd.Series(_hits(shared.value, h.to_numpy(dtype=np.int64).view(np.uint64)))

    return F.pandas_udf(test, "boolean")


def shingle_table(docs: DataFrame, wanted: DataFrame, settings: DedupSettings, repeated: bool) -> DataFrame:
    """set_id and shingles (8 bytes each, sorted) of the sets in ``wanted`` (set_id, doc_id of one holder).

    Texts are hashed again where they lie: a bounded Bloom filter of the
    wanted ids passes few others, and an exact join takes those out.
    ``repeated``: an id and set occur on several rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(id_filter(wanted))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = batch.filter(pa.array(_hits(shared.value, batch.column("h").to_numpy().view(np.uint64))))
            for i in range(0, some.num_rows, SLICE):
                part = some.slice(i, SLICE)
                sets = [shingle_set(data.as_py() or b"", settings.words) for data in part.column("data")]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([set_hash(x) for x in sets], pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary())], names=["doc_id", "set_id", "shingles"])

    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("data")).withColumn("h", F.xxhash64("doc_id"))
    found = texts.mapInArrow(cut, "doc_id long, set_id long, shingles binary").join(wanted.hint("merge"), ["set_id", "doc_id"]).select("set_id", "shingles")
    return found.groupBy("set_id").agg(F.first("shingles").alias("shingles")) if repeated else found


def confirmed(pairs: DataFrame, sets: DataFrame, settings: DedupSettings) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the threshold."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, other in zip(batch.column("one"), batch.column("other")):
                x, y = np.frombuffer(one.as_buffer(), dtype=np.uint64), np.frombuffer(other.as_buffer(), dtype=np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= settings.percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = sets.select(F.col("set_id").alias("a"), F.col("shingles").alias("one"))
    other = sets.select(F.col("set_id").alias("b"), F.col("shingles").alias("other"))
    return pairs.select("a", "b").join(one, "a").join(other, "b").select("a", "b", "one", "other").mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, settings: DedupSettings = DedupSettings()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Documents are linked when their shingle sets reach the threshold;
    component_id is the smallest doc_id reachable, kept marks that document.
    A text of fewer words than a shingle is one shingle as a whole.  Null and
    empty texts and those without words have 0 shingles, are linked with
    nothing and kept.  Rows with a null doc_id are linked with nothing, with
    component_id null and kept true.  Repeated rows of one id and text share a
    component; each comes back.  Different texts of one id are judged each by
    itself; if the id is the smallest of both their groups, both groups bear
    it.  An empty table gives an empty result; other columns of ``docs`` are
    not read.
    """
    return _grouped(docs, settings).drop("set_id")


def _grouped(docs: DataFrame, settings: DedupSettings) -> DataFrame:
    """The rows of ``near_duplicates`` with their set_id."""
    signed = stored(signed_documents(docs, settings), BATCH_BYTES)
    linked = signed.where("set_id is not null and doc_id is not null")
    vertices = stored(linked.groupBy("set_id").agg(F.min("doc_id").alias("least_id"), F.first("n_shingles").alias("n_shingles"), F.first("buckets").alias("buckets")))
    entries = vertices.select("set_id", "least_id", "n_shingles", F.explode("buckets").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = stored(entries.join(shared, "bucket"))
    nodes = stored(members.groupBy("set_id").agg(F.first("least_id").alias("least_id"), F.sum("n").alias("reach")))
    repeated = not linked.groupBy("doc_id", "set_id").count().where("count > 1").isEmpty()
    sets = stored(shingle_table(docs, nodes.select("set_id", F.col("least_id").alias("doc_id")), settings, repeated), BATCH_BYTES)
    ranked = stored(members.join(nodes.select("set_id", "reach"), "set_id").select("bucket", F.struct("reach", "set_id", "n_shingles").alias("rank")))
    labels = _labels(nodes, ranked, sets, settings)
    smallest = labels.groupBy("root").agg(F.min("least_id").alias("component_id"))
    classes = labels.join(smallest, "root").select("set_id", "component_id")
    classes = vertices.select("set_id", "least_id").join(classes, "set_id", "left").select("set_id", F.coalesce("component_id", "least_id").alias("component_id"))
    named = linked.select("doc_id", "n_shingles", "set_id").join(classes, "set_id").select("doc_id", "set_id", "n_shingles", "component_id")
    alone = signed.where("set_id is null or doc_id is null").select("doc_id", "set_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return named.unionByName(alone).select("doc_id", "set_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _labels(nodes: DataFrame, ranked: DataFrame, sets: DataFrame, settings: DedupSettings) -> DataFrame:
    """set_id, least_id and root (the same for linked sets) of all members of shared buckets.

    The first centre of a bucket is its member with the most company over all
    bands: copies of one text, however they differ among each other, have that
    text as the centre.  Later turns look at buckets that hold several
    components: up to ``centres`` of them are all compared with the other
    members, in more divided buckets the best one not tried before, while a
    turn links something, for ``centres`` turns at most.  They only save work:
    ``_closed`` finds every link that is left.
    """
    first = ranked.groupBy("bucket").agg(F.max("rank").alias("centre"))
    links = stored(confirmed(_pairs(looked_up(ranked, first, "bucket").where("rank.set_id != centre.set_id"), settings), sets, settings), BATCH_BYTES)
    root = components(links).withColumnRenamed("vertex", "set_id")
    labels = stored(nodes.select("set_id", "least_id").join(root, "set_id", "left").withColumn("root", F.coalesce("root", "set_id")))
    tried = first.select("bucket", F.col("centre.set_id").alias("tried"))
    for _turn in range(settings.centres):
        labelled = ranked.join(labels.select("set_id", "root"), F.col("rank.set_id") == F.col("set_id")).select("bucket", "root", "rank")
        parts = labelled.groupBy("bucket", "root").agg(F.max("rank").alias("centre")).withColumnRenamed("root", "centre_root")
        divided = parts.groupBy("bucket").agg(F.count("*").alias("_parts")).where("_parts > 1")
        untried = parts.join(divided, "bucket").join(tried, (parts["bucket"] == tried["bucket"]) & (F.col("centre.set_id") == F.col("tried")), "left_anti")
        several = untried.where(F.col("_parts") <= settings.centres).select("bucket", "centre_root", "centre")
        best = untried.where(F.col("_parts") > settings.centres).groupBy("bucket").agg(F.max(F.struct("centre", "centre_root")).alias("_best"))
        chosen = stored(several.unionByName(best.select("bucket", "_best.centre_root", "_best.centre")))
        tried = tried.unionByName(chosen.select("bucket", F.col("centre.set_id").alias("tried")))
        new = stored(confirmed(_pairs(labelled.join(chosen, "bucket").where("root != centre_root"), settings), sets, settings), BATCH_BYTES)
        if new.isEmpty():
            break
        labels = _merged(labels, new)
    return _closed(labels, ranked, sets, settings)


def _merged(labels: DataFrame, new: DataFrame) -> DataFrame:
    """``labels`` after the links in ``new`` have joined components."""
    ends = [labels.select(F.col("set_id").alias(x), F.col("root").alias(f"root_{x}")) for x in ("a", "b")]
    joined = components(new.join(ends[0], "a").join(ends[1], "b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b")))
    joined = stored(joined.select(F.col("vertex").alias("root"), F.col("root").alias("_joined")))
    return stored(labels.join(joined, "root", "left").select("set_id", "least_id", F.coalesce("_joined", "root").alias("root")))


def _closed(labels: DataFrame, ranked: DataFrame, sets: DataFrame, settings: DedupSettings) -> DataFrame:
    """``labels`` after every remaining link among the members of buckets that hold several components.

    The candidates are exact (see ``_candidates``).  They are compared in
    growing shares, each only while its ends are apart, so a large group is
    joined from few of its pairs and no pair is left out.
    """
    labelled = ranked.select("bucket", "rank.set_id").join(labels.select("set_id", "root"), "set_id")
    divided = labelled.groupBy("bucket").agg(F.min("root").alias("_one"), F.max("root").alias("_other")).where("_one != _other").select("bucket")
    apart = stored(labelled.join(divided, "bucket").select("set_id", "root").distinct())
    if apart.isEmpty():
        return labels
    candidates = stored(_candidates(apart, sets, settings), BATCH_BYTES)
    low = 0.0
    for high in (1 / 64, 1 / 8, 1.0):
        share = uniform(F.col("a"), F.col("b"))
        roots = [labels.select(F.col("set_id").alias(x), F.col("root").alias(f"root_{x}")) for x in ("a", "b")]
        pairs = candidates.where((share >= low) & (share < high)).join(roots[0], "a").join(roots[1], "b").where("root_a != root_b").select("a", "b")
        new = stored(confirmed(pairs, sets, settings), BATCH_BYTES)
        if not new.isEmpty():
            labels = _merged(labels, new)
        low = high
    return labels


ORDER_BITS = 20


def _frequencies(sets: DataFrame) -> np.ndarray:
    """How many shingles of all sets fall into each of 2^20 hash places (4 MB); only used as an order, rare ones first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << ORDER_BITS, dtype=np.int64)
        for batch in batches:
            for data in batch.column("shingles"):
                np.add.at(total, _places(np.frombuffer(data.as_buffer(), dtype=np.uint64)), 1)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["place", "n"])

    found = sets.select("shingles").mapInArrow(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(1 << ORDER_BITS, dtype=np.int64)
    table[found.column("place").to_numpy()] = found.column("n").to_numpy()
    return table


def _places(shingles: np.ndarray) -> np.ndarray:
    return (mix(shingles) >> U64(64 - ORDER_BITS)).astype(np.int64)


def _candidates(apart: DataFrame, sets: DataFrame, settings: DedupSettings) -> DataFrame:
    """Distinct pairs (a, b) of sets of different roots that may reach the threshold; every pair that does is there.

    With shingles of all sets in one order, two sets of x and y shingles that
    share the needed p (x + y) / (100 + p) or more have their first common one
    with at least that many left in both; the order by frequency makes the
    first ones rare, so texts that differ around a common template rarely meet.
    """
    p = settings.percent
    shared = sets.sparkSession.sparkContext.broadcast(_frequencies(sets))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in (batch.slice(i, SLICE) for i in range(0, batch.num_rows, SLICE)):
                sizes, tokens = [], []
                for data in piece.column("shingles"):
                    shingles = np.frombuffer(data.as_buffer(), dtype=np.uint64)
                    frequency = shared.value[_places(shingles)]
                    ordered = np.lexsort((shingles, frequency))[:(100 - p) * len(shingles) // 100 + 1]
                    sizes.append(len(shingles))
                    tokens.append(shingles[ordered].view(np.int64))
                yield pa.RecordBatch.from_arrays([piece.column("set_id"), pa.array(sizes, pa.int64()), pa.array(tokens, pa.list_(pa.int64()))], names=["set_id", "n", "tokens"])

    heads = sets.select("set_id", "shingles").mapInArrow(cut, "set_id long, n long, tokens array<long>").join(apart, "set_id")
    entries = stored(heads.select("set_id", "root", "n", F.posexplode("tokens").alias("place", "token")), BATCH_BYTES)
    shared_tokens = entries.groupBy("token").agg(F.min("root").alias("_one"), F.max("root").alias("_other")).where("_one != _other").select("token")
    entries = stored(entries.join(shared_tokens, "token"))
    one, other = (entries.select("token", *[F.col(c).alias(f"{c}_{x}") for c in ("set_id", "root", "n", "place")]) for x in ("a", "b"))
    needed = p * (F.col("n_a") + F.col("n_b"))
    room = (100 + p) * F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
    met = one.join(other.hint("merge"), "token").where((F.col("set_id_a") > F.col("set_id_b")) & (F.col("root_a") != F.col("root_b")) & (needed <= room))
    return met.select(F.col("set_id_a").alias("a"), F.col("set_id_b").alias("b")).distinct()


def _pairs(compared: DataFrame, settings: DedupSettings) -> DataFrame:
    """Distinct pairs (a, b) of a member and its centre whose set sizes allow the threshold."""
    mine, other = F.col("rank"), F.col("centre")
    sizes = F.least(mine["n_shingles"], other["n_shingles"]) * 100 >= F.greatest(mine["n_shingles"], other["n_shingles"]) * settings.percent
    return compared.where(sizes).select(F.greatest(mine["set_id"], other["set_id"]).alias("a"), F.least(mine["set_id"], other["set_id"]).alias("b")).distinct()


def _set_ids(settings: DedupSettings):
    """The hash of a text's shingle set as a column function of its bytes."""

    def read(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([set_hash(shingle_set(data or b"", settings.words)) for data in texts], dtype="Int64")

    return F.pandas_udf(read, "long")


def deduplicated(docs: DataFrame, settings: DedupSettings = DedupSettings()) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: the smallest doc_id's.

    Rows that a bounded Bloom filter of the dropped ids rules out are kept where
    they lie; only the others are shuffled, for an exact join by id and shingle
    set.  Of repeated rows of one id and shingle set, the one with the smallest
    hash of its text stays; other texts of the id are judged by themselves.
    Rows without words or with a null doc_id have no duplicates and all stay.
    """
    found = stored(_grouped(docs, settings))
    dropped = stored(found.where("not kept").select("doc_id", "set_id").distinct())
    set_id = _set_ids(settings)(F.col("text").cast("binary"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    perhaps = _passes(docs.sparkSession.sparkContext.broadcast(id_filter(dropped.select("doc_id"))))(F.xxhash64(F.col("doc_id").cast("long")))
    marked = docs.select(F.struct(*columns).alias("row"), F.coalesce(F.col("doc_id").isNotNull() & perhaps, F.lit(False)).alias("perhaps"))
    sure = marked.where("not perhaps").select("row.*")
    named = docs.select(F.struct(*columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(F.col("doc_id").isNotNull() & perhaps, F.lit(False)).alias("perhaps"))
    checked = named.where("perhaps").select("row", "doc_id", set_id.alias("set_id")).join(dropped.hint("merge"), ["doc_id", "set_id"], "left_anti").select("row.*")
    rest = sure.unionByName(checked)
    repeated = found.where("kept and n_shingles > 0 and doc_id is not null").groupBy("doc_id", "set_id").count().where("count > 1").select("doc_id").distinct()
    repeated = stored(repeated)
    if repeated.isEmpty():
        return rest
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    single = rest.join(repeated, "doc_id", "left_anti").select(*columns).unionByName(rest.where(~worded).join(repeated, "doc_id", "left_semi").select(*columns))
    several = rest.where(worded).join(repeated, "doc_id", "left_semi").select(F.struct(*[F.col(f"`{c}`") for c in rest.columns]).alias("row"), F.xxhash64("text").alias("order"), set_id.alias("set_id"))
    return single.unionByName(several.groupBy("row.doc_id", "set_id").agg(F.min_by("row", "order").alias("row")).select("row.*"))
