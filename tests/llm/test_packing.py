import random
import struct
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from bidlake.llm import packing
from tests.conftest import SF001
from tests.llm.awkward import LONG, documents, no_documents


@pytest.fixture(scope="module")
def tokenizer_json():
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as file:
        return file.read()


def judge(rows, want):
    """Pieces against the whole documents: every id once, sequences without gaps, full or a power of two."""
    sequences, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r["length"] == len(r["ids"]) // 4 > 0
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[r["doc_id"], r["doc_tokens"]].append((r["start"], r["ids"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024 and at & (at - 1) == 0
    found = {}
    for (doc, n), pieces in by_doc.items():
        at, data = 0, b""
        for start, ids in sorted(pieces):
            assert start == at
            at += len(ids) // 4
            data += ids
        assert at == n
        found[doc] = list(struct.unpack(f"<{at}I", data))
    assert found == want
    return sequences


@pytest.mark.parametrize("pattern", [None, public_tokenizers.PATTERN])
def test_documents_come_back(spark, tokenizer_json, pattern):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {r["doc_id"]: plain.encode(r["text"] or "", add_special_tokens=False).ids + [0] for r in docs.collect()}
    sequences = judge(packing.packed(docs, tokenizer_json, pattern).collect(), want)
    short = sum(sum(n for _, n in s) < 1024 for s in sequences.values())
    assert short <= 10 * docs.rdd.getNumPartitions()  # only the end of a task


def test_awkward_rows(spark, tokenizer_json):
    docs = documents(spark).dropDuplicates(["doc_id"]).where("doc_id is not null")
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {r["doc_id"]: plain.encode(r["text"] or "", add_special_tokens=False).ids + [0] for r in docs.collect()}
    assert want[3] == want[4] == [0]
    judge(packing.packed(docs, tokenizer_json, public_tokenizers.PATTERN).collect(), want)
    everything = packing.packed(documents(spark), tokenizer_json, public_tokenizers.PATTERN)
    assert packing.piece_rows(everything).groupBy().sum("length").first()[0] == sum(len(plain.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in documents(spark).collect())
    assert packing.packed(no_documents(spark), tokenizer_json).count() == 0
    row = everything.where("length > 5").first()
    assert packing.piece_rows(everything.where(everything.sequence_id == row["sequence_id"])).where(f"doc_id = {row['doc_id']} and start = {row['start']}").first()["ids_crc32"] == zlib.crc32(row["ids"])


ODD = ["it's we'll I'd  two  blanks\n\n\nlines \t tabs", "a<|endoftext|>b", "naïve Straße № ½ x²", " nbsp em\u0085nel", "x" * 3000, "'''s '' 's", "日本語 text", " lead", "trail  ", "\x1c\x1d sep",
       "don’t – “quoted” … 12345,678.9", "á combining", "І Ї є ѓ ј"]


def test_merged_ranks_equal_the_tokenizer(tokenizer_json):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encoder = packing.Encoder(tokenizer_json, public_tokenizers.PATTERN)
    pick = random.Random(1)
    texts = ODD + ["".join(pick.choice(ODD + [" ", "\n", "' ", "word", "ß", "7"]) for _ in range(6)) for _ in range(200)]
    for text in texts:
        assert encoder.ids(text).tolist() == plain.encode(text, add_special_tokens=False).ids


def test_other_tokenizers_are_not_merged_by_rank():
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        with open(public_tokenizers.path(name), "rb") as file:
            data = file.read()
        encoder = packing.Encoder(data, public_tokenizers.PATTERN)
        assert (encoder.fast is not None) == name.startswith("byte")
        for text in ODD:
            assert encoder.ids(text).tolist() == Tokenizer.from_buffer(data).encode(text, add_special_tokens=False).ids


def test_long_text_is_cut_at_seams(tokenizer_json, monkeypatch):
    monkeypatch.setattr(packing, "PART", 700)
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encoder = packing.Encoder(tokenizer_json, public_tokenizers.PATTERN)
    for text in (LONG[:60_000], ("It's  a line,\n\n with 's ends.  " * 300), "y" * 5000):
        assert encoder.ids(text).tolist() == plain.encode(text, add_special_tokens=False).ids


def test_choice_is_least_sum_of_squares():
    pick = random.Random(6)
    packer = packing.SumOfSquares(packing.PackSettings(window=40, open_windows=10_000))
    for n in range(1500):
        size = pick.randint(1, 39)
        level = packer.level.copy()

        def after(h):
            new = level.copy()
            if h:
                new[h] -= 1
            if h + size < 40:
                new[h + size] += 1
            return int((new[:40] ** 2).sum())

        allowed = [h for h in range(40 - size + 1) if h == 0 or level[h]]
        assert after(packer.choice(size)) == min(map(after, allowed))
        list(packer.put(packing.Piece(n, size, 0, np.arange(size))))


def test_open_windows_are_bounded():
    packer = packing.SumOfSquares(packing.PackSettings(window=1024, open_windows=16))
    done, total = [], 0
    for n in range(2000):
        size = 600 + n % 50  # no two fit together
        total += size
        done += packer.put(packing.Piece(n, size, 0, np.arange(size)))
        assert packer.level.sum() <= 16
    done += packer.finish()
    sizes = [sum(len(p.ids) for p in w) for w in done]
    assert sum(sizes) == total and sum(s < 1024 for s in sizes) <= 10 and all(s & (s - 1) == 0 for s in sizes)
