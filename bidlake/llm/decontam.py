"""Benchmark decontamination by q-gram filtering and banded alignment.

A text that holds an item of m characters with at most k edits shares at least
m - q + 1 - k q of its q-grams with it, all on k + 1 neighbouring diagonals
(text position minus item position).  Shared q-grams are counted in bands of
2 (k + 1) diagonals that overlap by half, so one band holds them all; bands
that reach the bound are verified by an alignment inside the band.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidlake.llm.common import stored

Q = 10
FOUND = "array<struct<item_id: long, first: int, last: int, distance: int>>"


@dataclass(frozen=True)
class DecontamSettings:
    """``rate``: edits allowed per character of an item; ``block_chars`` bounds one broadcast index.

    The budget is at most what the q-gram bound can bear ((m - q) / q edits);
    items of fewer than q characters cannot be told from chance and are not
    searched for.
    """
    rate: float = 0.08
    block_chars: int = 4_000_000


def normalised(text: str | None) -> str:
    """Lower case, white space runs as one space."""
    return " ".join((text or "").lower().split())


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def qgram_hashes(points: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each q-gram (q = 10 = 8 + 2), by doubling."""
    if len(points) < Q:
        return np.zeros(0, dtype=np.uint64)
    p = points.astype(np.uint64)
    two = p[:-1] * np.uint64(0x9E3779B97F4A7C15) + p[1:]
    four = two[:-2] * np.uint64(0xC2B2AE3D27D4EB4F) + two[2:]
    eight = four[:-4] * np.uint64(0x165667B19E3779F9) + four[4:]
    return (eight[:len(p) - Q + 1] * np.uint64(0xD6E8FEB86659FD93) + two[8:]) * np.uint64(0x9E3779B97F4A7C15)


REPEATED = 8      # places of one q-gram in an item from which on it is left out of the counts
CHUNK = 1 << 16   # diagonals that are aligned at once


class ItemIndex:
    """q-gram postings of a bounded block of items.

    A q-gram that stands often in one item would be paired with each of its
    places in a text.  Such places are left out of the postings and taken off
    the item's bound; an item with nothing left to count (a rule of dashes) is
    aligned against the whole stretches of a text that hold its q-grams.
    """

    BITS = 22

    def __init__(self, items: list[tuple[int, str]], settings: DecontamSettings):
        self.ids, self.texts = [i for i, _ in items], [t for _, t in items]
        lengths = np.array([len(t) for t in self.texts], dtype=np.int64)
        self.budget = np.minimum((lengths * settings.rate).astype(np.int64), (lengths - Q) // Q)
        grams = [qgram_hashes(code_points(t)) for t in self.texts]
        light = [_times(g) < REPEATED for g in grams]
        self.least = lengths - Q + 1 - self.budget * Q - np.array([int((~x).sum()) for x in light], dtype=np.int64)
        whole = np.flatnonzero(self.least < 1)
        self.repetitive = {int(i): np.unique(grams[i]) for i in whole}
        light = [np.zeros(len(x), bool) if i in self.repetitive else x for i, x in enumerate(light)]
        hashes = np.concatenate([*(g[x] for g, x in zip(grams, light)), np.zeros(0, np.uint64)])
        item = np.repeat(np.arange(len(grams)), [int(x.sum()) for x in light])
        place = np.concatenate([*map(np.flatnonzero, light), np.zeros(0, np.int64)])
        order = np.argsort(hashes, kind="stable")
        self.hashes, first, count = np.unique(hashes[order], return_index=True, return_counts=True)
        self.item, self.place, self.first, self.count = item[order], place[order].astype(np.int64), first, count
        self.maybe = np.zeros(1 << self.BITS, dtype=bool)
        for known in (self.hashes, *self.repetitive.values()):
            self.maybe[known >> np.uint64(64 - self.BITS)] = True

    def candidates(self, hashes: np.ndarray, spots: np.ndarray) -> list[tuple[int, int]]:
        """(item, first diagonal of the band) of the bands that reach the bound; ``spots`` are the places to look at."""
        if not len(spots) or not len(self.hashes):
            return []
        at = np.minimum(np.searchsorted(self.hashes, hashes[spots]), len(self.hashes) - 1)
        same = self.hashes[at] == hashes[spots]
        spots, at = spots[same], at[same]
        if not len(spots):
            return []
        count = self.count[at]
        within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        posting = np.repeat(self.first[at], count) + within
        item, place = self.item[posting], self.place[posting]
        diagonal = np.repeat(spots, count) - place
        step = self.budget[item] + 1
        band = np.floor_divide(diagonal, step)
        keys = np.stack([np.concatenate([item, item]), np.concatenate([band, band - 1]), np.concatenate([place, place])], axis=1)
        keys = np.unique(keys, axis=0)
        bands, shared = np.unique(keys[:, :2], axis=0, return_counts=True)
        return [(int(i), int(b * (self.budget[i] + 1))) for (i, b), n in zip(bands, shared) if n >= self.least[i]]

    def stretches(self, hashes: np.ndarray, spots: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, first diagonal, number of diagonals) that hold every match of the repetitive items."""
        for i, known in self.repetitive.items():
            hit = spots[np.isin(hashes[spots], known)]
            if not len(hit):
                continue
            reach = len(self.texts[i]) + int(self.budget[i])
            cut = np.flatnonzero(np.diff(hit) > reach) + 1
            for part in np.split(hit, cut):
                low, high = int(part[0]) - reach, int(part[-1]) + reach
                for start in range(low, high, CHUNK):  # a match keeps to budget + 1 diagonals: parts overlap by twice as many
                    yield i, start, min(CHUNK + 2 * (int(self.budget[i]) + 1), high - start)

    def search(self, text: str | None) -> list[dict]:
        """Every item found in the text with its places in the normalised text: the best ones that do not overlap, in order."""
        flat = normalised(text)
        points = code_points(flat)
        hashes = qgram_hashes(points)
        spots = np.flatnonzero(self.maybe[hashes >> np.uint64(64 - self.BITS)])
        found: dict[int, set[tuple[int, int, int]]] = {}
        for item, diagonal in self.candidates(hashes, spots):
            budget, sought = int(self.budget[item]), self.texts[item]
            at = flat.find(sought, max(diagonal, 0), max(diagonal + 2 * (budget + 1) + len(sought), 0))
            match = (0, at, at + len(sought) - 1) if at >= 0 else banded_match(code_points(sought), points, diagonal, 2 * (budget + 1))
            if match[0] <= budget:
                found.setdefault(item, set()).add(match)
        for item, diagonal, width in self.stretches(hashes, spots):
            cost, first, last = banded_ends(code_points(self.texts[item]), points, diagonal, width)
            good = np.flatnonzero(cost <= self.budget[item])
            found.setdefault(item, set()).update(zip(cost[good].tolist(), first[good].tolist(), last[good].tolist()))
        return [{"item_id": self.ids[i], "first": f, "last": t, "distance": d} for i in sorted(found) for d, f, t in apart(found[i])]


def _times(grams: np.ndarray) -> np.ndarray:
    """How often each q-gram of an item stands in it."""
    if not len(grams):
        return np.zeros(0, dtype=np.int64)
    _, place, count = np.unique(grams, return_inverse=True, return_counts=True)
    return count[place]


def apart(matches: set[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The matches (edits, first, last) without those that overlap a better one, in the text's order."""
    starts: list[int] = []
    kept: list[tuple[int, int, int]] = []
    for match in sorted(matches):
        k = bisect_left(starts, match[1])
        if (k == 0 or kept[k - 1][2] < match[1]) and (k == len(kept) or match[2] < kept[k][1]):
            starts.insert(k, match[1])
            kept.insert(k, match)
    return kept


def banded_match(item: np.ndarray, text: np.ndarray, diagonal: int, width: int) -> tuple[int, int, int]:
    """Least edits of the whole item against any stretch of the text inside a band of diagonals; with the stretch."""
    cost, first, last = banded_ends(item, text, diagonal, width)
    best = int(cost.argmin())
    return int(cost[best]), int(first[best]), int(last[best])


def banded_ends(item: np.ndarray, text: np.ndarray, diagonal: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per end of a stretch inside a band of diagonals, the least edits of the whole item, and the stretch (first, last).

    Row i holds, per diagonal d, the edits of the item's first i characters
    against a stretch that ends before text position i + d; ends are free.
    """
    far = len(item) + width + 1
    steps = np.arange(width)
    start = steps + diagonal
    cost = np.where((start >= 0) & (start <= len(text)), 0, far)
    begin = start.copy()
    padded = np.concatenate([text, [0]])
    for i in range(1, len(item) + 1):
        place = i + diagonal + steps - 1
        inside = (place >= 0) & (place < len(text))
        kept = cost + np.where(inside, padded[np.clip(place, 0, len(text))] != item[i - 1], far)
        dropped = np.append(cost[1:] + 1, far)
        row = np.minimum(kept, dropped)
        origin = np.where(kept <= dropped, begin, np.append(begin[1:], 0))
        lowest = np.minimum.accumulate(row - steps) + steps
        source = np.maximum.accumulate(np.where(row - steps == lowest - steps, steps, -1))
        cost, begin = np.minimum(lowest, far), origin[np.maximum(source, 0)]
    return cost, np.maximum(begin, 0), np.minimum(len(item) + diagonal + steps, len(text)) - 1


def item_blocks(benchmark: DataFrame, settings: DecontamSettings) -> Iterator[ItemIndex]:
    """Indexes of all items, one block of bounded size after the other."""
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = 1 + chars // settings.block_chars
    if blocks > 1:
        items = stored(items.withColumn("_block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).cast("int")))
    for b in range(blocks):
        rows = (items.where(F.col("_block") == b) if blocks > 1 else items).collect()
        texts = sorted({(r["item_id"], normalised(r["text"])) for r in rows})
        yield ItemIndex([x for x in texts if len(x[1]) >= Q], settings)


def _searched(index: ItemIndex):
    """The search of one block's items as a column function of the text."""

    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([index.search(t) for t in texts], dtype=object)

    return F.pandas_udf(search, FOUND)


def with_matches(docs: DataFrame, benchmark: DataFrame, settings: DecontamSettings = DecontamSettings()) -> DataFrame:
    """``docs`` with ``matches``: per place of an item, item_id, first and last character in the normalised text, edits.

    Of an item's places that overlap, the best one is given.  Only the items
    travel, a block of bounded size at a time: a benchmark of several blocks
    takes a pass over the texts for each, whose rows are stored before the
    next block is read, so neither the driver nor a task holds two.  Each text
    is searched whole where it lies.  Null and empty texts match nothing, as
    does an empty benchmark.  Repeated rows are searched each by itself; items
    with the same id and text count once; an empty table gives an empty
    result; a column named ``matches`` is replaced.
    """
    kept = [F.col(f"`{c}`") for c in docs.columns if c != "matches"]
    found = None
    for index in item_blocks(benchmark, settings):
        if found is None:
            found = docs.select(*kept, _searched(index)("text").alias("matches"))
        else:
            found = stored(found).select(*kept, F.concat("matches", _searched(index)("text")).alias("matches"))
    return found


def contaminated(docs: DataFrame, benchmark: DataFrame, settings: DecontamSettings = DecontamSettings()) -> DataFrame:
    """doc_id, item_id, first, last, distance of every place of a benchmark item in a document."""
    found = None
    for index in item_blocks(benchmark, settings):
        block = docs.select("doc_id", _searched(index)("text").alias("matches")).select("doc_id", F.inline("matches"))
        found = block if found is None else stored(found).unionByName(stored(block))
    return found


def decontaminated(docs: DataFrame, benchmark: DataFrame, settings: DecontamSettings = DecontamSettings()) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; each block of items takes its rows out before the next is read."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    left = None
    for index in item_blocks(benchmark, settings):
        rows = docs if left is None else stored(left)
        left = rows.select(F.struct(*columns).alias("_row"), _searched(index)("text").alias("matches")).where(F.size("matches") == 0).select("_row.*")
    return left
