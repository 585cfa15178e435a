"""Vectorised hashes of words and word shingles of one text (numpy, inside a task)."""

from __future__ import annotations

import numpy as np

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15
_STATE: dict[str, np.ndarray] = {}

# Byte value + 1 of word bytes, A-Z lower-cased; 0 for the white space 0x20, 0x09-0x0D.
_LETTER = np.arange(1, 257, dtype=np.uint64)
_LETTER[65:91] += U64(32)
_LETTER[[32, 9, 10, 11, 12, 13]] = U64(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64, at least n of them."""
    have = _STATE.get("powers")
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        for name, base in (("powers", BASE | 1), ("inverses", pow(BASE | 1, -1, 1 << 64))):
            table = np.ones(size, dtype=np.uint64)
            done = 1
            while done < size:
                step = U64(pow(base, done, 1 << 64))
                table[done:2 * done] = table[:done] * step
                done *= 2
            _STATE[name] = table
    return _STATE["powers"], _STATE["inverses"]


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of each word, in order."""
    if not data:
        return np.empty(0, dtype=np.uint64)
    value = _LETTER[np.frombuffer(data, dtype=np.uint8)]
    inside = value != 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    powers, inverses = _powers(len(data))
    value *= powers[:len(data)]
    return mix(np.add.reduceat(value, starts) * inverses[starts])


def shingle_set(data: bytes, words: int) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles; a shorter text is one shingle, one without words none."""
    hashes = word_hashes(data)
    if not len(hashes):
        return hashes
    width = min(words, len(hashes))
    count = len(hashes) - width + 1
    total = np.full(count, U64(width * 0x51ED27), dtype=np.uint64)
    for j in range(width):
        total = mix(total * U64(0xD6E8FEB86659FD93) + hashes[j:j + count])
    return np.unique(total)


PART = 1 << 20  # bytes that are hashed at once


def hashed_words(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of each word, in order; long data is taken in parts that end between words."""
    found, at = [], 0
    while at < len(data):
        end = at + PART
        if end < len(data):
            blank = max(data.rfind(c, at, end) for c in _BLANKS)
            if blank <= at:  # a word longer than a part
                blank = min((x for c in _BLANKS if (x := data.find(c, end)) >= 0), default=len(data))
            end = blank
        value = _LETTER[np.frombuffer(data, dtype=np.uint8, count=min(end, len(data)) - at, offset=at)]
        inside = np.zeros(len(value) + 2, dtype=np.int8)
        inside[1:-1] = value != 0
        edges = np.flatnonzero(np.diff(inside))
        starts = edges[::2]
        if len(starts):
            powers, inverses = _powers(len(value))
            value *= powers[:len(value)]
            found.append((mix(np.add.reduceat(value, starts) * inverses[starts]), starts + at, edges[1::2] + at))
        at = end
    if not found:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


_BLANKS = [bytes([b]) for b in (32, 9, 10, 11, 12, 13)]


class HashIndex:
    """Numbers of known hashes: an open table that looks up many at once."""

    def __init__(self, hashes: np.ndarray, numbers: np.ndarray):
        self.bits = max(4, (4 * len(hashes) + 1).bit_length())
        self.keys, self.numbers = np.zeros(1 << self.bits, dtype=np.uint64), np.zeros(1 << self.bits, dtype=np.int64)
        left, spot, self.tries = np.arange(len(hashes)), self._spot(hashes), 0
        while len(left):
            free = self.numbers[spot] == 0
            _, first = np.unique(spot[free], return_index=True)
            taken = np.flatnonzero(free)[first]
            self.keys[spot[taken]], self.numbers[spot[taken]] = hashes[left[taken]], numbers[left[taken]]
            rest = np.ones(len(left), dtype=bool)
            rest[taken] = False
            left, spot = left[rest], (spot[rest] + 1) & ((1 << self.bits) - 1)
            self.tries += 1

    def _spot(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> U64(64 - self.bits)).astype(np.int64)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash; 0 if it is not known."""
        spot = self._spot(hashes)
        found = np.where(self.keys[spot] == hashes, self.numbers[spot], 0)
        open_ = np.flatnonzero((found == 0) & (self.numbers[spot] != 0))
        spot = spot[open_]
        for _ in range(self.tries):
            if not len(open_):
                break
            spot = (spot + 1) & ((1 << self.bits) - 1)
            hit = self.keys[spot] == hashes[open_]
            found[open_[hit]] = self.numbers[spot[hit]]
            more = ~hit & (self.numbers[spot] != 0)
            open_, spot = open_[more], spot[more]
        return found
