"""Sum-of-squares packing of token documents into fixed windows.

Every scan task packs its own texts online, without a shuffle.  It counts the
partly filled windows at each fill level; a piece goes to the level (or a new
window) after which the sum of the squared counts is least, so no level piles
up and windows tend to be filled to the last token.  Pieces are cut where that
helps: texts longer than a window give whole windows first, a task holds a
bounded number of open windows, and windows still open at its end fill each
other up.  What is left then is cut into windows of powers of two.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PART = 1 << 19  # characters of text that are tokenized at once


@dataclass(frozen=True)
class PackSettings:
    """Tokens a window, the id that ends a document, partly filled windows of a task."""
    window: int = 1024
    end_id: int = 0
    open_windows: int = 2048


@dataclass
class Piece:
    """Ids ``start`` and following of a document (doc_id, number of its ids)."""
    doc_id: int | None
    doc_tokens: int
    start: int
    ids: np.ndarray

    def cut(self, n: int) -> tuple["Piece", "Piece"]:
        return Piece(self.doc_id, self.doc_tokens, self.start, self.ids[:n]), Piece(self.doc_id, self.doc_tokens, self.start + n, self.ids[n:])


class SumOfSquares:
    """Open windows by fill level; ``put`` and ``finish`` give the windows that are done, as lists of pieces."""

    def __init__(self, settings: PackSettings):
        self.size, self.most = settings.window, settings.open_windows
        self.level = np.zeros(self.size + 1, dtype=np.int64)
        self.windows: list[list[list[Piece]]] = [[] for _ in range(self.size)]

    def choice(self, n: int) -> int:
        """The fill level for a piece of ``n`` ids (0: a new window); of equal ones the fullest."""
        before, after = self.level[:self.size - n + 1], self.level[n:]
        change = 2 * (after - before) + 2
        change[-1] = 1 - 2 * before[-1]  # a full window leaves the count
        change[before == 0] = np.iinfo(np.int64).max
        change[0] = 2 * self.level[n] + 1
        return len(change) - 1 - int(change[::-1].argmin())

    def put(self, piece: Piece) -> Iterator[list[Piece]]:
        while len(piece.ids) >= self.size:
            whole, piece = piece.cut(self.size)
            yield [whole]
        piece.ids = piece.ids.copy()  # an open window keeps its own ids alone
        while len(piece.ids):
            level = self.choice(len(piece.ids))
            if level == 0 and self.level.sum() >= self.most:  # no new window: cut to fill the emptiest
                level = int(np.flatnonzero(self.level)[0])
                part, piece = piece.cut(min(self.size - level, len(piece.ids)))
            else:
                part, piece = piece, piece.cut(len(piece.ids))[1]
            window = []
            if level:
                window = self.windows[level].pop()
                self.level[level] -= 1
            window.append(part)
            level += len(part.ids)
            if level == self.size:
                yield window
            else:
                self.windows[level].append(window)
                self.level[level] += 1

    def finish(self) -> Iterator[list[Piece]]:
        """The open windows: the fullest ones are filled from the emptiest; the rest is cut into powers of two."""
        left = [(level, window) for level in range(self.size) for window in self.windows[level]]
        spare: list[Piece] = []
        low, high = 0, len(left)
        while high > low:
            high -= 1
            level, window = left[high]
            while level < self.size and (spare or low < high):
                if not spare:
                    spare, low = left[low][1], low + 1
                piece = spare.pop()
                part, rest = piece.cut(min(self.size - level, len(piece.ids)))
                window.append(part)
                level += len(part.ids)
                if len(rest.ids):
                    spare.append(rest)
            if level == self.size:
                yield window
            else:
                spare.extend(window)  # the last one
        yield from self._powers(spare)

    def _powers(self, pieces: list[Piece]) -> Iterator[list[Piece]]:
        left = sum(len(p.ids) for p in pieces)
        while left:
            room, window = min(self.size, 1 << (left.bit_length() - 1)), []
            left -= room
            while room:
                piece = pieces.pop()
                part, rest = piece.cut(min(room, len(piece.ids)))
                window.append(part)
                room -= len(part.ids)
                if len(rest.ids):
                    pieces.append(rest)
            yield window


# Characters that the word pattern's engines surely class alike: ASCII, Latin and Cyrillic letters, common punctuation.
_PLAIN = regex.compile(r"[\t\n\r\x20-\x7E¡-¬®-ɏЀ-џ‐-―‘-„…]*")
_SEAM = regex.compile(r"(?<=[A-Za-z0-9.,;]) (?=[A-Za-z])")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones themselves, the rest from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def merge_ranks(spec: dict) -> dict[bytes, int] | None:
    """Byte strings with ids of a plain byte-level BPE whose ids follow the order of its merges; None of any other tokenizer."""
    model, cut = spec["model"], spec.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    if not plain or spec.get("normalizer") or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
        return None
    vocabulary, letters = model["vocab"], byte_letters()
    merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "", 1) for m in model["merges"]]
    if sorted(vocabulary[c] for c in letters) != list(range(256)) or any(vocabulary[w] != 256 + i for i, w in enumerate(merged)):
        return None
    return {bytes(letters[c] for c in word): vocabulary[word] for word in [*letters, *merged]}


class Encoder:
    """Token ids of texts as the tokenizer's file defines them.

    ``pattern`` is the tokenizer's own rule for words.  With it, plain texts of
    a byte-level BPE are merged by ``tiktoken`` from the ranks in the file,
    several times faster with the same ids; texts with characters outside a
    plain set or with a string of an added token, other tokenizers, and all
    texts without a pattern go through ``tokenizers``.
    """

    def __init__(self, tokenizer_json: bytes, pattern: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(tokenizer_json)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        ranks = merge_ranks(json.loads(tokenizer_json)) if pattern else None
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}) if ranks else None

    def part(self, text: str) -> np.ndarray:
        if self.fast and _PLAIN.fullmatch(text) and not any(a in text for a in self.added):
            return np.array(self.fast.encode_ordinary(text), dtype=np.uint32)
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.uint32)

    def ids(self, text: str) -> np.ndarray:
        """Ids of a text; a long one is cut where a word begins after a single blank, which no token spans."""
        if len(text) <= 2 * PART or not self.fast:
            return self.part(text)
        parts, at = [], 0
        while at < len(text):
            seam = _SEAM.search(text, at + PART)
            end = seam.start() if seam else len(text)
            parts.append(self.part(text[at:end]))
            at = end
        return np.concatenate(parts)


_PACKED = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()),
                     ("sequence_id", pa.int64()), ("offset", pa.int64())])


def packed(docs: DataFrame, tokenizer_json: bytes, pattern: str | None = None, settings: PackSettings = PackSettings()) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    A document is its text's ids and ``end_id``; a null or empty text is
    ``end_id`` alone.  Each id lies in exactly one piece, a sequence holds at
    most ``window`` ids without gaps, and every sequence is full or as long as
    a power of two, so nothing is padded.  Rows are packed one by one: rows
    that repeat an id, and rows with a null id, are documents of their own.
    Any length of text is taken; an empty table gives an empty result; other
    columns are not read.  A task that runs again gives the same rows.

    ``tokenizer_json`` is the tokenizer's file (a few MB), sent to each task.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = Encoder(shared.value, pattern), SumOfSquares(settings)
        sequence = TaskContext.get().partitionId() << 36
        rows: list[tuple] = []
        waiting = 0
        ending = np.array([settings.end_id], dtype=np.uint32)

        def windows() -> Iterator[list[Piece]]:
            for batch in batches:
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                    ids = np.append(encoder.ids(text.as_py() or ""), ending)
                    yield from packer.put(Piece(doc_id, len(ids), 0, ids))
            yield from packer.finish()

        def table() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PACKED)], schema=_PACKED)

        for window in windows():
            offset = 0
            for p in window:
                rows.append((p.doc_id, p.start, len(p.ids), p.ids.astype("<u4").tobytes(), p.doc_tokens, sequence, offset))
                offset += len(p.ids)
            sequence += 1
            waiting += offset
            if waiting >= 1 << 19:
                yield table()
                rows, waiting = [], 0
        if rows:
            yield table()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(pack, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def piece_rows(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum (ids_crc32) in place of their ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
