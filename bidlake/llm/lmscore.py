"""Language-model scores by logistic context mixing over counts of the whole corpus.

Texts are lower-cased words and an end mark.  The words of all training
documents are counted; the most frequent ones, with an escape for the rest,
get a binary code, and an escaped word is spelled in coded bytes.  Every
decision of a code, to its end, is predicted by several contexts: the counts
of the whole corpus below the code's node, and hashed contexts (the word
before, the last frequent word; for spelled bytes the one, three and five
before) whose outcomes are counted over all training documents.  Logits are
added with weights chosen by a gate, and a table refines the result; both are
fitted to all decisions of all training documents, counted by gate and rounded
logits.

Beside the words stands what the corpus says again: texts are cut into
passages where the words themselves say so, the passages of all training
documents are counted in Spark, and a passage that stands elsewhere may be
named by its count in place of being spelled out, whichever takes fewer bits.
The bits of all decisions make the text's total.

A training text's own share is taken off all counts before it is scored.
Every count is a sum over rows, so scores do not depend on how the rows are
dealt to tasks, and texts are read where they lie.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidlake.llm.common import remainder, stored
from bidlake.llm.wordhash import HashIndex, hashed_words

END = b""
END_HASH = np.uint64(0x5851F42D4C957F2D)
ESCAPE = 0
WHOLE_CODE = 96  # decisions; weights that add up to 64 bits make no code longer


@dataclass(frozen=True)
class ScoreSettings:
    """``lexicon``, ``longest`` and the ``bits`` bound a task's model: at most 2^18 frequent words of at most 48 bytes
    (words of one step of counts are in or out together, so their number may fall short by a step), and hashed tables
    of 2^bits pairs of counts.  ``depth``: decisions of a word that contexts predict, by default all.  ``passage``: words
    of a passage on average, cut at ``longest_passage``."""
    lexicon: int = 1 << 18
    longest: int = 48
    depth: int = WHOLE_CODE
    bits: int = 21
    topic_bits: int = 16
    byte_bits: tuple[int, int, int] = (16, 18, 19)
    frequent: int = 200
    passage: int = 16
    longest_passage: int = 48
    block_bytes: int = 1 << 15
    add: float = 0.1


class Codes:
    """Prefix codes by symbol weight: per symbol the first ``depth`` nodes and bits of its path, each node's odds from
    the weights, and the bits of the rest of the path under those odds (``tail``)."""

    ARRAYS = ("length", "first", "nodes", "bits", "odds", "tail")

    def __init__(self, weights: list[int], depth: int):
        n = len(weights)
        heap = [(max(w, 1), i) for i, w in enumerate(weights)]
        heapq.heapify(heap)
        parent, side, mass = np.zeros(2 * n, dtype=np.int64), np.zeros(2 * n, dtype=np.uint8), np.zeros(2 * n)
        for w, i in heap:
            mass[i] = w
        fresh = n
        while len(heap) > 1:
            (w0, a), (w1, b) = heapq.heappop(heap), heapq.heappop(heap)
            parent[a], parent[b], side[b], mass[fresh] = fresh, fresh, 1, w0 + w1
            heapq.heappush(heap, (w0 + w1, fresh))
            fresh += 1
        root = fresh - 1
        # odds of the bit 1 at each inner node, numbered from 0
        odds = np.zeros((2 * n, 2))
        inner = np.arange(root)
        odds[parent[inner], side[inner]] = mass[inner]
        level = np.zeros(2 * n, dtype=np.int64)
        for v in range(root - 1, -1, -1):
            level[v] = level[parent[v]] + 1
        self.length = np.minimum(level[:n], depth).astype(np.int32)
        self.first = np.concatenate([[0], np.cumsum(self.length)[:-1]]).astype(np.int64)
        total = int(self.length.sum())
        nodes, bits = np.zeros(total, dtype=np.int32), np.zeros(total, dtype=np.uint8)
        self.tail = np.zeros(n, dtype=np.float32)
        at, symbol = np.arange(n), np.arange(n)
        while len(at):
            open_ = at != root
            at, symbol = at[open_], symbol[open_]
            cut = level[at] == depth
            self.tail[symbol[cut]] = np.log2(mass[at[cut]] / mass[symbol[cut]])
            kept = level[at] <= depth
            place = self.first[symbol[kept]] + level[at[kept]] - 1
            nodes[place], bits[place] = parent[at[kept]] - n, side[at[kept]]
            at = parent[at]
        self.nodes, self.bits = nodes, bits
        with np.errstate(divide="ignore", invalid="ignore"):
            logit = np.log(odds[n:, 1] / odds[n:, 0])
        self.odds = np.where(np.isfinite(logit), logit, 0.0).astype(np.float32)

    @cached_property
    def logit(self) -> np.ndarray:
        """Of each decision under the weights; laid out in the tasks, so that it does not travel."""
        return self.odds.take(self.nodes)

    @cached_property
    def level(self) -> np.ndarray:
        """Of each decision: how many came before it, 15 at most."""
        return np.minimum(np.arange(len(self.nodes), dtype=np.int32) - np.repeat(self.first.astype(np.int32), self.length), 15).astype(np.int8)

    def state(self) -> dict[str, np.ndarray]:
        return {name: getattr(self, name) for name in self.ARRAYS}

    @classmethod
    def of(cls, state: dict[str, np.ndarray]) -> "Codes":
        codes = cls.__new__(cls)
        codes.__dict__.update(state)
        return codes

    def expand(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of all decisions of the symbols in order: which symbol, and the place in the flat paths."""
        length = self.length[symbols]
        which = np.repeat(np.arange(len(symbols)), length)
        place = np.repeat(self.first[symbols] - (np.cumsum(length) - length), length)
        place += np.arange(len(place))
        return which, place


@dataclass
class Lexicon:
    """What all tasks share: the frequent words with their counts and codes, and the corpus totals."""
    words: list[bytes]
    logs: np.ndarray   # log10 of count + add, per symbol
    codes: Codes
    spelling: Codes
    total: int
    distinct: int
    texts: int         # training texts
    floor: float       # log10 of add
    scale: float       # log10 of the base model's denominator

    def state(self) -> dict:
        """Plain values, for a broadcast that needs no copy of this package to be read."""
        return self.__dict__ | {"words": b" ".join(self.words[1:]), "codes": self.codes.state(), "spelling": self.spelling.state()}

    @classmethod
    def of(cls, state: dict) -> "Lexicon":
        words = [END, *state["words"].split(b" ")] if state["words"] else [END]
        return cls(**(state | {"words": words, "codes": Codes.of(state["codes"]), "spelling": Codes.of(state["spelling"])}))


def build_lexicon(counts: DataFrame, settings: ScoreSettings) -> Lexicon:
    """The most frequent words, at most ``lexicon`` of them, with totals over all words.

    A histogram of counts (single counts up to 4096, then 64 steps per
    doubling) tells from which count on the words fit; only those reach the
    driver, and words of one step are all in or all out.
    Words seen once are left to the escape, whose weight so estimates that of
    words not seen at all.
    """
    total, distinct = counts.agg(F.sum("n"), F.count("*")).first()
    total, distinct = total or 0, distinct or 0
    step = F.when(F.col("n") <= 4096, F.col("n")).otherwise(4096 + F.floor(64 * F.log2(F.col("n") / 4096))).cast("long")
    repeated = counts.where((F.length("word") <= settings.longest) & (F.length("word") > 0) & (F.col("n") > 1)).withColumn("step", step)
    least, room = 1 << 62, settings.lexicon
    for row in sorted(repeated.groupBy("step").agg(F.count("*").alias("words")).collect(), reverse=True):
        if row["words"] > room:
            break
        least, room = row["step"], room - row["words"]
    found = repeated.where(F.col("step") >= least).select("word", "n").toArrow().to_pydict()
    top = sorted(zip(found["word"], found["n"]), key=lambda x: (-x[1], x[0]))
    ends = counts.where(F.length("word") == 0).agg(F.sum("n")).first()[0] or 0
    words, sizes = [END, *(w for w, _ in top)], [ends, *(n for _, n in top)]
    rest = total - sum(sizes)
    letters = Counter()
    for w in words:
        letters.update(w)
    spelled = [letters[b] + 1 for b in range(256)] + [len(words)]
    return Lexicon(words, np.log10(np.array([1.0, *sizes]) + settings.add), Codes([max(rest, 1), *sizes], settings.depth), Codes(spelled, WHOLE_CODE), total, distinct, ends,
                   math.log10(settings.add), math.log10(total + settings.add * (distinct + 1)))


STEPS = 128  # logits are rounded to 1/128, so probabilities and costs come from a table
_GRID = np.arange(-12 * STEPS, 12 * STEPS + 1) / STEPS
_COST = (np.logaddexp(0, -_GRID) / math.log(2)).astype(np.float32)  # bits of an outcome by the logit in its favour
_MIDDLE = 12 * STEPS


# logits are counted rounded to these; 0 is what a context says that has not been seen
_LEVELS = np.array([-9, -6.5, -4.5, -3.2, -2.2, -1.5, -0.9, -0.4, 0, 0.4, 0.9, 1.5, 2.2, 3.2, 4.5, 6.5, 9])
_LEVEL = np.abs(np.arange(-96, 97)[:, None] / 8 - _LEVELS).argmin(axis=1).astype(np.int32)  # by eighths of a logit
FINE = 512  # steps of a logit in a code of evidence
_CODES = np.arange(1 << 16).astype(np.uint16).view(np.int16).astype(np.int64)
# what a code adds to the place of a count, as the input 0, 1 or 2
_PLACES = [(_LEVEL[np.clip(np.round((_CODES >> 2) * (8 / FINE)).astype(np.int64) + 96, 0, 192)] * len(_LEVELS) ** (2 - k)
            + (_CODES & 3) * (len(_LEVELS) ** 3 * (0, 4, 1)[k])).astype(np.int32) for k in range(3)]
_CORNERS = np.stack(np.meshgrid(_LEVELS, _LEVELS, _LEVELS, indexing="ij")).reshape(3, -1)


class Mixer:
    """Gated logistic mixing of three logits with a refinement, both fitted to outcomes counted by gate and rounded logits."""

    CELLS = 24
    ROUNDS = 12
    HELD = 50  # outcomes that the start weighs as much as

    def __init__(self, gates: int, start: list[float]):
        self.start = np.tile(np.array(start, dtype=np.float32)[:, None], (1, gates))
        self.weights, self.gates = self.start, gates
        self.seen = np.zeros(0, dtype=np.uint32)
        self.refined = self.unrefined()

    def unrefined(self) -> np.ndarray:
        p = 1 / (1 + np.exp((11.5 - np.arange(self.CELLS)) / 1.5))
        return np.tile(np.stack([1 - p, p], axis=1) * 30, (self.gates, 1, 1)).reshape(-1)

    def cells(self, dot: np.ndarray) -> np.ndarray:
        return ((dot + 12) * np.float32((self.CELLS - 1) / 24)).astype(np.int32)

    def bits(self, level: np.ndarray, first: np.ndarray | None, evidence: list[np.ndarray], y: np.ndarray) -> np.ndarray:
        """Bits that each outcome ``y`` costs, by the level of the decision, the first logit (or none) and the evidence of
        two contexts, or three without the first logit."""
        gate = (level.astype(np.intp) * 4 + (evidence[-2] & 3)) * 4 + (evidence[-1] & 3)
        logits = [first] if first is not None else []
        logits += [(code >> 2).astype(np.float32) * np.float32(1 / FINE) for code in evidence]
        dot = self.weights[0].take(gate) * logits[0]
        for k in (1, 2):
            dot += self.weights[k].take(gate) * logits[k]
        np.clip(dot, -11.9, 11.9, out=dot)
        gate *= self.CELLS
        gate += self.cells(dot)
        adapted = np.log(self.refined[1::2] / self.refined[::2]).astype(np.float32)
        dot += adapted.take(gate)
        dot *= np.where(y, np.float32(STEPS / 2), np.float32(-STEPS / 2))
        dot += np.float32(_MIDDLE + 0.5)
        return _COST.take(dot.astype(np.intp), mode="clip")

    def count(self, level: np.ndarray, first: np.ndarray | None, evidence: list[np.ndarray], y: np.ndarray) -> None:
        """Adds outcomes to what ``fit`` fits."""
        n = len(_LEVELS)
        if not len(self.seen):
            self.seen = np.zeros(2 * self.gates * n ** 3, dtype=np.uint32)
        spot = level * np.int32(16 * n ** 3)
        if first is not None:
            spot += _LEVEL.take((first * np.float32(8) + np.float32(96.5)).astype(np.intp), mode="clip") * np.int32(n * n)
        for k, code in enumerate(evidence, 3 - len(evidence)):
            spot += _PLACES[k].take(code, mode="wrap")
        spot *= np.int32(2)
        spot += y
        np.add.at(self.seen, spot, np.uint32(1))

    def fit(self) -> None:
        """Weights by Newton's method on the logistic loss of all counted outcomes, then the table at these weights."""
        zeros, ones = (self.seen[y::2].reshape(self.gates, -1).astype(np.float64) for y in (0, 1))
        both, pairs = zeros + ones, (_CORNERS[:, None] * _CORNERS).reshape(9, -1)
        start = self.start.astype(np.float64)
        weights = start.copy()
        for _ in range(self.ROUNDS):
            p = 1 / (1 + np.exp(-np.clip(weights.T @ _CORNERS, -11.9, 11.9)))
            slope = (ones - both * p) @ _CORNERS.T - self.HELD * (weights - start).T
            curve = ((both * p * (1 - p)) @ pairs.T).reshape(-1, 3, 3) + self.HELD * np.eye(3)
            weights += np.clip(np.linalg.solve(curve, slope[:, :, None])[:, :, 0].T, -0.5, 0.5)
        self.weights = weights.astype(np.float32)
        cell = np.arange(self.gates)[:, None] * self.CELLS + self.cells(np.clip(weights.T @ _CORNERS, -11.9, 11.9))
        counted = [np.bincount(cell.reshape(-1), weights=n.reshape(-1), minlength=self.gates * self.CELLS) for n in (zeros, ones)]
        self.refined = self.unrefined() + np.stack(counted, axis=1).reshape(-1)

    def state(self) -> dict[str, np.ndarray]:
        return {"weights": self.weights, "refined": self.refined}


_STEP = np.array([0, 1, 1, 2, 2, 2, 2, 2, 2, 2, 3], dtype=np.int32)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIXED = np.array([0x8CB92BA72F3D8DD7, 0xABF4D7B65E1D2C39, 0xE7037ED1A0B428DB], dtype=np.uint64)


def evidence_codes(pairs: np.ndarray, prior: float) -> np.ndarray:
    """Of each pair of counts, as it is and less one 0 or one 1: the logit in steps of 1 / FINE, times 4, plus the
    outcomes seen in steps (0, then from 1, 3 and 10)."""
    log = np.log(np.arange(MOST + 1) + prior).astype(np.float32)
    zeros, ones = (pairs & np.uint32(MOST)).view(np.int32), (pairs >> np.uint32(16)).view(np.int32)
    codes = np.empty((len(pairs), 3), dtype=np.int16)
    for state, (z, o) in enumerate(((zeros, ones), (np.maximum(zeros - 1, 0), ones), (zeros, np.maximum(ones - 1, 0)))):
        codes[:, state] = np.round((log.take(o) - log.take(z)) * np.float32(FINE)).astype(np.int16) * 4 + _STEP.take(z + o, mode="clip")
    return codes.reshape(-1)


def slots(context: np.ndarray, node: np.ndarray, bits: int) -> np.ndarray:
    """Places in a table of 2^bits pairs for well mixed contexts, each with the number of a code's node."""
    h = node.astype(np.uint64)
    h *= _GOLDEN
    h += context
    h ^= h >> np.uint64(29)
    h *= _MIXED[0]
    h >>= np.uint64(64 - bits)
    return h.view(np.int64)


def lexicon_index(lexicon: Lexicon) -> HashIndex:
    """Symbols of the lexicon's words by their hashes."""
    return HashIndex(hashed_words(b" ".join(lexicon.words[1:]))[0], np.arange(2, len(lexicon.words) + 1))


@dataclass
class Words:
    """The words of a block of whole texts (lower-cased A-Z, between the white space 0x20, 0x09-0x0D) and their end marks."""
    sizes: np.ndarray      # words of each text
    n_bytes: np.ndarray    # bytes of each text's words, and one for each word
    symbol: np.ndarray     # code of each word (ESCAPE if not in the lexicon)
    hash: np.ndarray       # the word as a number, also outside the lexicon
    first: np.ndarray      # whether it starts a text
    text: np.ndarray       # which text it is of
    rare: list[bytes]      # the escaped words in order

    @classmethod
    def of(cls, texts: list[bytes], index: HashIndex) -> "Words":
        data = b"\n".join(texts)
        begins = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
        h, starts, ends = hashed_words(data)
        of = np.searchsorted(begins, starts, side="right") - 1
        counts = np.bincount(of, minlength=len(texts))
        sizes = counts + 1
        place = np.arange(len(h)) + of  # an end mark stands after each text before
        marks = np.cumsum(sizes) - 1
        found = index(h)
        hashes, symbol = np.full(len(h) + len(texts), END_HASH, dtype=np.uint64), np.ones(len(h) + len(texts), dtype=np.int64)
        hashes[place], symbol[place] = h, found
        first = np.zeros(len(symbol), dtype=bool)
        first[marks - counts] = True
        rare = [data[i:j].lower() for i, j in zip(starts[found == ESCAPE].tolist(), ends[found == ESCAPE].tolist())]
        n_bytes = np.bincount(of, weights=ends - starts, minlength=len(texts)).astype(np.int64) + counts
        return cls(sizes, n_bytes, symbol, hashes, first, np.repeat(np.arange(len(texts)), sizes), rare)


@dataclass
class Decisions:
    """All decisions of a block's words, or of its escaped words' bytes: outcome, owner and the places of the contexts."""
    which: np.ndarray
    place: np.ndarray
    outcome: np.ndarray
    slots: dict[str, np.ndarray]


def word_decisions(words: Words, lexicon: Lexicon, settings: ScoreSettings) -> Decisions:
    codes = lexicon.codes
    which, place = codes.expand(words.symbol)
    node = codes.nodes[place]
    before = np.zeros(len(words.hash), dtype=np.uint64)
    before[1:] = words.hash[:-1]
    before[words.first] = np.uint64(0)
    spot = np.arange(len(words.symbol))
    seen = np.maximum.accumulate(np.where((words.symbol > 1) & (words.symbol <= settings.frequent), spot, -1))
    last = np.concatenate([[-1], seen[:-1]])
    inside = last >= np.maximum.accumulate(np.where(words.first, spot, 0))
    topic = (np.where(inside, words.symbol[last], 0) + 1).astype(np.uint64)
    return Decisions(which, place, codes.bits[place], {
        "near": slots((before * _MIXED[1])[which], node, settings.bits), "topic": slots((topic * _MIXED[2])[which], node, settings.topic_bits)})


BYTE_TABLES = ("byte_one", "byte_three", "byte_five")


def byte_decisions(rare: list[bytes], lexicon: Lexicon, settings: ScoreSettings) -> Decisions:
    """Decisions of each escaped word's bytes and its end; ``which`` is the word."""
    length = np.fromiter((len(w) + 1 for w in rare), dtype=np.int64, count=len(rare))
    letters = np.frombuffer(b"\xff".join(rare) + b"\xff", dtype=np.uint8).astype(np.int64)
    spot = np.arange(len(letters)) - np.repeat(np.cumsum(length) - length, length)
    symbols = np.where(spot == np.repeat(length - 1, length), 256, letters)
    codes = lexicon.spelling
    which, place = codes.expand(symbols)
    node, past, found = codes.nodes[place], np.zeros(len(letters), dtype=np.uint64), {}
    for back in range(1, 6):
        letter = np.zeros(len(letters), dtype=np.uint64)
        letter[back:] = letters[:-back] + 1
        letter[spot < back] = 0
        past = (past + letter + np.uint64(back)) * _MIXED[1]
        if back in (1, 3, 5):
            k = back // 2
            found[BYTE_TABLES[k]] = slots(past[which], node, settings.byte_bits[k])
    return Decisions(np.repeat(np.arange(len(rare)), length)[which], place, codes.bits[place], found)


def table_bits(settings: ScoreSettings) -> dict[str, int]:
    return {"near": settings.bits, "topic": settings.topic_bits, **dict(zip(BYTE_TABLES, settings.byte_bits))}


def grouped_texts(batches: Iterator[pa.RecordBatch], columns: list[str], settings: ScoreSettings) -> Iterator[tuple[list[tuple], list[bytes]]]:
    """Blocks of whole texts: the columns of each row, and its bytes (null: empty)."""
    rows, texts, waiting = [], [], 0
    for batch in batches:
        data = batch.column("data")
        for i, values in enumerate(zip(*(batch.column(c).to_pylist() for c in columns)) if columns else ((),) * batch.num_rows):
            texts.append(data[i].as_py() or b"")
            rows.append(values)
            waiting += len(texts[-1]) + 1
            if waiting >= settings.block_bytes:
                yield rows, texts
                rows, texts, waiting = [], [], 0
    if texts:
        yield rows, texts


BLOCK = 1 << 16  # counts that travel in one row
MOST = (1 << 16) - 1


def context_tables(texts: DataFrame, shared, settings: ScoreSettings) -> dict[str, np.ndarray]:
    """Outcome counts of all hashed contexts over all rows of ``texts`` (data), as pairs of 16-bit numbers.

    Each task counts into tables of fixed size and sends them in blocks; a
    block's rows are added up as they stream by.  A pair that passes 16 bits
    is scaled down to them.
    """
    sizes = {name: 2 << bits for name, bits in table_bits(settings).items()}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon.of(shared.value)
        index = lexicon_index(lexicon)
        tables = {name: np.zeros(size, dtype=np.uint32) for name, size in sizes.items()}
        for _rows, texts in grouped_texts(batches, [], settings):
            words = Words.of(texts, index)
            for made in (word_decisions(words, lexicon, settings), *([byte_decisions(words.rare, lexicon, settings)] if words.rare else [])):
                for name, slot in made.slots.items():
                    np.add.at(tables[name], 2 * slot + made.outcome, np.uint32(1))
        yield from _blocks(tables)

    return summed_tables(texts.mapInArrow(count, _TABLE_DDL), sizes, np.dtype(np.uint16))


def summed_tables(sent: DataFrame, sizes: dict[str, int], kind: np.dtype) -> dict[str, np.ndarray]:
    """The sums of the tables that tasks sent in blocks; in 16 bits, pairs are scaled down to them."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, None
        for batch in batches:
            for name, block, data in zip(batch.column("table").to_pylist(), batch.column("block").to_pylist(), batch.column("data")):
                if (name, block) != at:
                    if at:
                        yield _summed(at, total, kind)
                    at, total = (name, block), np.zeros(len(data.as_buffer()) // 4, dtype=np.int64)
                total += np.frombuffer(data.as_buffer(), dtype=np.uint32)
        if at:
            yield _summed(at, total, kind)

    summed = stored(sent.repartition("table", "block").sortWithinPartitions("table", "block").mapInArrow(add, _TABLE_DDL), BATCH_BYTES)
    tables = {name: np.zeros(size, dtype=kind) for name, size in sizes.items()}
    for row in summed.collect():  # fixed size, whatever the corpus
        part = np.frombuffer(row["data"], dtype=kind)
        tables[row["table"]][row["block"] * BLOCK:row["block"] * BLOCK + len(part)] = part
    return tables


_TABLE = pa.schema([("table", pa.string()), ("block", pa.int32()), ("data", pa.binary())])
_TABLE_DDL = "table string, block int, data binary"


def _blocks(tables: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The blocks that hold a count."""
    for name, table in tables.items():
        for b in range(-(-len(table) // BLOCK)):
            part = table[b * BLOCK:(b + 1) * BLOCK]
            if part.any():
                yield pa.RecordBatch.from_pylist([{"table": name, "block": b, "data": part.tobytes()}], schema=_TABLE)


def _summed(at: tuple[str, int], total: np.ndarray, kind: np.dtype) -> pa.RecordBatch:
    if kind == np.uint16:
        pairs = total.reshape(-1, 2)
        most = pairs.max(axis=1, keepdims=True)
        total = np.where(most > MOST, np.maximum(pairs * MOST // np.maximum(most, 1), pairs > 0), pairs)
    return pa.RecordBatch.from_pylist([{"table": at[0], "block": at[1], "data": total.astype(kind).tobytes()}], schema=_TABLE)


PRIORS = {"near": 0.3, "topic": 0.4, "byte_one": 0.4, "byte_three": 0.3, "byte_five": 0.2}


def all_codes(tables: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {name: evidence_codes(table.view(np.uint32), PRIORS[name]) for name, table in tables.items()}


class Model:
    """The lexicon, the corpus's context counts (or their ``codes`` alone) and the mixers; ``bits`` costs words,
    ``tally`` counts what the mixers are fitted to."""

    def __init__(self, lexicon: Lexicon, tables: dict[str, np.ndarray], settings: ScoreSettings, mixers: dict[str, dict] | None = None,
                 codes: dict[str, np.ndarray] | None = None):
        self.lexicon, self.settings = lexicon, settings
        self.pairs = {name: table.view(np.uint32) for name, table in tables.items()}
        self.codes = codes or all_codes(tables)
        self.index = lexicon_index(lexicon)
        self.__dict__.update(new_mixers(settings))
        for name, state in (mixers or {}).items():
            getattr(self, name).__dict__.update(state)

    def decided(self, words: Words, own: np.ndarray) -> Iterator[tuple[Mixer, np.ndarray, np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]]:
        """The decisions of the words, then of the escaped words' bytes: mixer, word, level, logit of the code (bytes:
        none), evidence of the contexts and outcome of each; an ``own`` text's outcome (0 or 1 each) is taken off first."""
        codes, mine = self.lexicon.codes, own.astype(np.uint8)[words.text]
        made = word_decisions(words, self.lexicon, self.settings)
        found = self.evidence(("near", "topic"), made, mine.take(made.which))
        yield self.word_mix, made.which, codes.level.take(made.place), codes.logit.take(made.place), found, made.outcome
        if words.rare:
            escaped = np.flatnonzero(words.symbol == ESCAPE)
            made = byte_decisions(words.rare, self.lexicon, self.settings)
            found = self.evidence(BYTE_TABLES, made, mine[escaped].take(made.which))
            yield self.byte_mix, escaped.take(made.which), np.minimum(self.lexicon.spelling.level, 3).take(made.place), None, found, made.outcome

    def evidence(self, names: tuple[str, ...], made: Decisions, own: np.ndarray) -> list[np.ndarray]:
        state = own * (made.outcome + np.uint8(1))
        return [self.codes[name].take(made.slots[name] * 3 + state) for name in names]

    def bits(self, words: Words, own: np.ndarray, learn: bool = False) -> np.ndarray:
        """Bits per word; ``own`` tells of each text whether it was counted (1) or not (0).  With ``learn`` the mixers
        are fitted afterwards to all that was tallied and these words."""
        bits = self.lexicon.codes.tail[words.symbol].astype(np.float64)
        for mixer, which, *decisions in self.decided(words, own):
            bits += np.bincount(which, weights=mixer.bits(*decisions), minlength=len(bits))
        if learn:
            self.tally(words, own)
            self.fit()
        return bits

    def tally(self, words: Words, own: np.ndarray) -> None:
        for mixer, _, *decisions in self.decided(words, own):
            mixer.count(*decisions)

    def fit(self) -> None:
        for name in MIXERS:
            if len((mixer := getattr(self, name)).seen):
                mixer.fit()


MIXERS = ("word_mix", "byte_mix")


def new_mixers(settings: ScoreSettings) -> dict[str, Mixer]:
    """By level of a decision (of a word's code, at most 16; of a byte's code, at most 4) and what two contexts have seen."""
    return {"word_mix": Mixer(16 * min(max(settings.depth, 1), 16), [0.6, 0.5, 0.3]), "byte_mix": Mixer(64, [0.3, 0.5, 0.3])}


def learned_weights(training: DataFrame, shared, settings: ScoreSettings) -> dict[str, dict]:
    """The mixers fitted to all decisions of all rows of ``training`` (data), which the context tables have counted.

    Tasks count the decisions by gate, rounded inputs and outcome in tables of
    fixed size; their sums are whole numbers, so the fit does not depend on
    the order or the tasks of the rows.
    """

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(Lexicon.of(shared.value["lexicon"]), {}, settings, codes=shared.value["codes"])
        for _rows, texts in grouped_texts(batches, [], settings):
            model.tally(Words.of(texts, model.index), np.ones(len(texts), dtype=np.int64))
        yield from _blocks({name: getattr(model, name).seen for name in MIXERS})

    mixers = new_mixers(settings)
    sizes = {name: 2 * mixer.gates * len(_CORNERS[0]) for name, mixer in mixers.items()}
    for name, seen in summed_tables(training.mapInArrow(tally, _TABLE_DDL), sizes, np.dtype(np.int64)).items():
        mixers[name].seen = seen
        mixers[name].fit()
    return {name: mixer.state() for name, mixer in mixers.items()}


def passages(words: Words, bits: np.ndarray, settings: ScoreSettings) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, hash, times and bits of the different passages of each text.

    A passage begins where the hash of two neighbouring words says so, so the
    same words are cut alike wherever they stand, and after ``longest_passage`` words.
    """
    h = words.hash
    pair = h.copy()
    pair[1:] += h[:-1] * _MIXED[1]
    pair ^= pair >> np.uint64(31)
    pair *= _MIXED[2]
    spot = np.arange(len(h))
    begins = words.first | ((pair >> np.uint64(40)) % np.uint64(settings.passage) == 0)
    since = spot - np.maximum.accumulate(np.where(begins, spot, 0))
    begins |= since % settings.longest_passage == 0
    start = np.flatnonzero(begins)
    inside = spot - np.repeat(start, np.diff(np.append(start, len(h))))
    mixed = (h + inside.astype(np.uint64)) * _MIXED[1]
    mixed ^= mixed >> np.uint64(33)
    total = np.add.reduceat(mixed * _MIXED[2], start)
    total ^= total >> np.uint64(32)
    key, cost, text = total.view(np.int64), np.add.reduceat(bits, start), words.text[start]
    order = np.lexsort((key, text))
    key, cost, text = key[order], cost[order], text[order]
    fresh = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (text[1:] != text[:-1])))
    return text[fresh], key[fresh], np.diff(np.append(fresh, len(key))), np.add.reduceat(cost, fresh)


_SCORED = pa.schema([
    ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("inside", pa.int64()), ("base", pa.float64()), ("bits", pa.float64()),
    ("passage", pa.list_(pa.int64())), ("times", pa.list_(pa.int64())), ("cost", pa.list_(pa.float32())), ("rare", pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())])))])
_SCORED_DDL = ("doc_id long, held_out boolean, n_bytes long, n_tokens long, inside long, base double, bits double, passage array<long>, times array<long>, cost array<float>, "
               "rare array<struct<word: binary, n: long>>")


def _lists(owner: np.ndarray, rows: int, values: pa.Array) -> pa.ListArray:
    """Values, in order of their rows, as one list a row."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=rows))]), pa.int32()), values)


def scored_block(model: Model, rows: list[tuple], texts: list[bytes]) -> pa.RecordBatch:
    """The rows (doc_id, held_out) with counts, base score without rare words, bits, passages, and rare words with counts."""
    lexicon, n = model.lexicon, len(texts)
    words = Words.of(texts, model.index)
    held = np.array([r[1] for r in rows], dtype=bool)
    bits = model.bits(words, (~held).astype(np.int64))
    known = words.symbol != ESCAPE
    base = np.bincount(words.text, weights=np.where(known, lexicon.logs[words.symbol], lexicon.floor), minlength=n) - words.sizes * lexicon.scale
    text, key, times, cost = passages(words, bits, model.settings)
    outside = np.bincount(words.text[~known], minlength=n)
    rare: list[tuple[int, bytes, int]] = []
    at = 0
    for i, many in enumerate(outside.tolist()):
        rare.extend((i, w, c) for w, c in Counter(words.rare[at:at + many]).items())
        at += many
    owner, rare_words, rare_counts = zip(*rare) if rare else ((), (), ())
    spelled = pa.StructArray.from_arrays([pa.array(rare_words, pa.binary()), pa.array(rare_counts, pa.int64())], names=["word", "n"])
    return pa.RecordBatch.from_arrays([
        pa.array([r[0] for r in rows], pa.int64()), pa.array(held), pa.array(words.n_bytes), pa.array(words.sizes), pa.array(np.bincount(words.text[known], minlength=n)),
        pa.array(base), pa.array(np.bincount(words.text, weights=bits, minlength=n)), _lists(text, n, pa.array(key)), _lists(text, n, pa.array(times)),
        _lists(text, n, pa.array(cost.astype(np.float32))), _lists(np.array(owner, dtype=np.int64), n, spelled)], schema=_SCORED)


COUNTED_BYTES = 2 << 20   # of text that is counted at once
HELD_WORDS = 300_000      # different words that a task holds before it sends them on
BATCH_BYTES = 8 << 20     # of texts in one batch of a Python function


def word_counts(docs: DataFrame, training) -> DataFrame:
    """word and n over the training rows, each text with one end mark; summed in the tasks before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        texts, size = [], 0

        def add() -> None:
            data = b"\n".join(texts)
            h, starts, ends = hashed_words(data)
            _, at, times = np.unique(h, return_index=True, return_counts=True)  # each different word becomes an object once
            for j, k, n in zip(starts[at].tolist(), ends[at].tolist(), times.tolist()):
                seen[data[j:k].lower()] += n

        for batch in batches:
            seen[END] += batch.num_rows
            for text in batch.column("data"):
                texts.append(text.as_py() or b"")
                size += len(texts[-1])
                if size >= COUNTED_BYTES:
                    add()
                    texts, size = [], 0
                if len(seen) > HELD_WORDS:
                    yield _counted(seen)
                    seen.clear()
        add()
        if seen:
            yield _counted(seen)

    return docs.where(training).select(F.col("text").cast("binary").alias("data")).mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _counted(seen: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.binary()), pa.array(seen.values(), pa.int64())], names=["word", "n"])


def said_again(scored: DataFrame) -> DataFrame:
    """row, saved and named: the bits that naming passages saves, and how many are named.

    A passage that stands c times in training texts (a training text's own
    ones taken off) among C costs log2(C / c) to name; standing in this text
    alone it is spelled once, and its repeats cost log2 C.  Named is what
    costs less so.
    """
    each = scored.select("row", "held_out", F.inline(F.arrays_zip("passage", "times", "cost")))
    counts = each.where(~F.col("held_out")).groupBy("passage").agg(F.sum("times").alias("c"))
    total = F.lit(float(max(counts.agg(F.sum("c")).first()[0] or 0, 1)))
    again = each.join(counts, "passage").withColumn("others", F.col("c") - F.when(F.col("held_out"), 0).otherwise(F.col("times")))
    price = F.log2(total / F.greatest(F.col("others"), F.lit(1)))
    repeats = F.when(F.col("others") > 0, F.col("times")).otherwise(F.col("times") - 1)
    gain = F.col("cost") / F.col("times") - price
    return again.where((repeats > 0) & (gain > 0)).groupBy("row").agg(F.sum(repeats * gain).alias("saved"), F.sum(repeats).alias("named"))


def score_documents(docs: DataFrame, folds: int = 10, held_out: int = 0, settings: ScoreSettings = ScoreSettings()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte of every row.

    Learned from rows outside the held-out fold.  Null and empty texts are
    scored as an end mark alone (bits_per_byte null).  Without training rows
    the base score is 0 for every token and the model starts untrained.
    Repeated rows are texts of their own, also in training; a null doc_id
    counts as an empty one for its fold.  An empty table gives an empty
    result; other columns are not read.  Which of a text's n passages are
    named costs log2(n + 1) bits and the entropy of their share, n times.
    """
    spark = docs.sparkSession
    out_of_fold = remainder(folds) == held_out
    counts = stored(word_counts(docs, ~out_of_fold), BATCH_BYTES)
    lexicon = build_lexicon(counts, settings)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), out_of_fold.alias("held_out"), F.col("text").cast("binary").alias("data"))
    training = texts.where(~F.col("held_out"))
    state = lexicon.state()
    words = spark.sparkContext.broadcast(state)
    tables = context_tables(training.select("data"), words, settings)
    words.destroy()  # the tables are stored, and the words travel with the codes from here
    shared = spark.sparkContext.broadcast({"lexicon": state, "codes": all_codes(tables)})
    mixers = learned_weights(training.select("data"), shared, settings)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(Lexicon.of(shared.value["lexicon"]), {}, settings, mixers, shared.value["codes"])
        for rows, texts in grouped_texts(batches, ["doc_id", "held_out"], settings):
            yield scored_block(model, rows, texts)

    scored = stored(texts.mapInArrow(score, _SCORED_DDL).withColumn("row", F.monotonically_increasing_id()), BATCH_BYTES)
    rare = scored.select("row", F.inline("rare")).join(counts.withColumnRenamed("n", "c"), "word")
    more = rare.groupBy("row").agg(F.sum("n").alias("more"), F.sum(F.col("n") * (F.log10(F.col("c") + settings.add) - F.lit(lexicon.floor))).alias("gain"))
    known = F.col("inside") + F.coalesce(F.col("more"), F.lit(0)) if lexicon.total else F.lit(0).cast("long")
    n = F.aggregate("times", F.lit(0).cast("long"), lambda a, x: a + x)
    share = F.coalesce(F.col("named"), F.lit(0)) / n
    entropy = F.when((share > 0) & (share < 1), -share * F.log2(share) - (1 - share) * F.log2(1 - share)).otherwise(0.0)
    bits = F.col("bits") - F.coalesce(F.col("saved"), F.lit(0.0)) + F.log2(n + 1) + n * entropy
    return scored.drop("rare").join(more, "row", "left").join(said_again(scored), "row", "left").select(
        "doc_id", "held_out", "n_tokens", known.alias("n_known"), F.lit(lexicon.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce(F.col("gain"), F.lit(0.0))).alias("base_score"), (bits * -math.log10(2)).alias("score"),
        F.when(F.col("n_bytes") > 0, bits / F.col("n_bytes")).alias("bits_per_byte"))
