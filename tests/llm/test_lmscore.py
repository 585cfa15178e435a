import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from bidlake.llm import lmscore
from tests.conftest import SF01, SF001
from tests.llm import awkward

CASE = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(CASE)) + [""]


def brute(rows):
    """Counts and base scores by definition."""
    held = {i: zlib.crc32(str("" if d is None else d).encode()) % 10 == 0 for i, (d, _) in enumerate(rows)}
    counts = Counter(w for i, (_, t) in enumerate(rows) if not held[i] for w in words(t))
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for i, (d, t) in enumerate(rows):
        found = words(t)
        out.append((d, held[i], len(found), sum(counts[w] > 0 for w in found), total, sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in found)))
    return out


def compare(rows, got):
    want = brute(rows)
    assert len(got) == len(want)
    key = lambda r: (str(r[0]), r[2], round(r[5], 4))
    for g, w in zip(sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got), key=key), sorted(want, key=key)):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], abs=1e-6, rel=1e-9)


def test_base_scores_and_counts(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    compare(rows, lmscore.score_documents(docs).collect())
    small = lmscore.score_documents(docs, settings=lmscore.ScoreSettings(lexicon=50, bits=14, depth=3)).collect()
    compare(rows, small)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in small)


def test_held_out_texts_cost_less_than_in_the_base_model(spark):
    got = [r for r in lmscore.score_documents(spark.read.parquet(f"{SF01}/documents.parquet")).collect() if r["held_out"]]
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)


def test_scores_do_not_depend_on_tasks(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    first, again = (sorted((r["doc_id"], r["score"]) for r in lmscore.score_documents(d).collect()) for d in (docs, docs.repartition(7)))
    assert [d for d, _ in first] == [d for d, _ in again]
    assert [s for _, s in first] == pytest.approx([s for _, s in again], rel=1e-9)


def test_passages_of_other_texts_are_known(spark):
    pick = random.Random(3)
    word = lambda: "".join(pick.choice("aeioulnrst") for _ in range(pick.randrange(3, 9)))
    fresh = lambda n: " ".join(word() for _ in range(n))
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows = {i: fresh(120) for i in range(400)}
    alone, copied, twice = held[0], held[1], [i for i in range(400) if i not in held][:2]
    passage = fresh(120)
    rows[twice[0]] = rows[twice[1]] = fresh(200)
    rows[copied] = fresh(10) + " " + passage + " " + fresh(10)
    rows[next(i for i in range(200, 400) if i not in held)] = fresh(40) + " " + passage
    got = {r["doc_id"]: r for r in lmscore.score_documents(spark.createDataFrame(list(rows.items()), "doc_id long, text string").repartition(8)).collect()}
    usual = [got[i]["bits_per_byte"] for i in range(400) if i not in (copied, *twice)]
    assert got[copied]["bits_per_byte"] < 0.5 * min(usual)
    assert max(got[i]["bits_per_byte"] for i in twice) < 0.4 * min(usual)


def test_codes_are_complete_prefix_codes():
    weights = [5, 1, 1, 9, 2, 30, 1]
    for depth in (16, 2, 1):
        codes = lmscore.Codes(weights, depth)
        odds = [math.prod(1 / (1 + math.exp(-l if b else l)) for l, b in zip(codes.logit[f:f + n], codes.bits[f:f + n])) * 2.0 ** -t
                for f, n, t in zip(codes.first, codes.length, codes.tail)]
        assert odds == pytest.approx([x / 49 for x in weights], rel=1e-5) and max(codes.length) <= depth
    paths = [tuple(codes.bits[f:f + n]) for codes in [lmscore.Codes(weights, 16)] for f, n in zip(codes.first, codes.length)]
    assert not any(a != b and a == b[:len(a)] for a in paths for b in paths)


@pytest.fixture(scope="module")
def model():
    """A small model with random context counts and mixers that have learned from a few texts."""
    pick = np.random.default_rng(1)
    names = [b"w%d" % i for i in range(40)]
    settings = lmscore.ScoreSettings(bits=8, topic_bits=6, byte_bits=(6, 7, 8), frequent=5, depth=4)
    lexicon = lmscore.Lexicon([b"", *names], np.zeros(42), lmscore.Codes([3, 10, *range(1, 41)], settings.depth), lmscore.Codes([1 + i % 7 for i in range(257)], 16), 100, 41, 10, -1.0, 2.0)
    tables = {name: pick.integers(0, 40, 2 << bits).astype(np.uint16) for name, bits in lmscore.table_bits(settings).items()}
    made = lmscore.Model(lexicon, tables, settings)
    texts = [b" ".join(names[int(i)] for i in pick.integers(0, 40, 30)) + b" xyz" for _ in range(60)]
    for _ in range(5):
        made.bits(lmscore.Words.of(texts, made.index), np.ones(len(texts), dtype=np.int64), learn=True)
    return made


def test_chances_of_all_next_words_sum_to_one(model):
    """Every lexicon word and the escape (without its spelling) at one place."""
    chances = []
    for w in model.lexicon.words:
        words = lmscore.Words.of([b"w3 w9 " + w], model.index)
        chances.append(2.0 ** -model.bits(words, np.zeros(1, dtype=np.int64))[2])
    escaped = lmscore.Words.of([b"w3 w9 odd"], model.index)
    whole = model.bits(escaped, np.zeros(1, dtype=np.int64))[2]
    escaped.rare = []
    chances.append(2.0 ** -model.bits(escaped, np.zeros(1, dtype=np.int64))[2])
    assert sum(chances) == pytest.approx(1.0, abs=1e-4) and 2.0 ** -whole < chances[-1]


@pytest.mark.parametrize("own", [0, 1])
def test_bits_by_definition(model, own):
    """The mix of each decision, one after the other in plain numbers."""
    words = lmscore.Words.of([b"w3 W1\tzebra w39 w1"], model.index)
    got = model.bits(words, np.array([own]))

    def decide(mixer, gate, inputs, y):
        dot = max(-11.9, min(11.9, sum(float(mixer.weights[k][gate]) * x for k, x in enumerate(inputs))))
        cell = gate * mixer.CELLS + int((dot + 12) * (mixer.CELLS - 1) / 24)
        adapted = math.log(mixer.refined[2 * cell + 1] / mixer.refined[2 * cell])
        final = (dot + adapted) / 2
        return math.log2(1 + math.exp(-final if y else final))

    def counted(name, slot, y, bits):
        zeros, ones = (int(x) for x in model.pairs[name].view(np.uint16)[2 * slot:2 * slot + 2])
        if own:
            zeros, ones = (max(zeros - 1, 0), ones) if y == 0 else (zeros, max(ones - 1, 0))
        return math.log((ones + lmscore.PRIORS[name]) / (zeros + lmscore.PRIORS[name])), zeros + ones

    step = lambda n: 0 if n == 0 else 1 if n < 3 else 2 if n < 10 else 3
    codes, made = model.lexicon.codes, lmscore.word_decisions(words, model.lexicon, model.settings)
    want = [float(codes.tail[s]) for s in words.symbol]
    for i, (which, place, y) in enumerate(zip(made.which, made.place, made.outcome)):
        (near, n_near), (topic, n_topic) = (counted(t, int(made.slots[t][i]), y, 0) for t in ("near", "topic"))
        gate = int(codes.level[place]) * 16 + step(n_near) * 4 + step(n_topic)
        want[which] += decide(model.word_mix, gate, [float(codes.logit[place]), near, topic], y)
    spelling, made = model.lexicon.spelling, lmscore.byte_decisions(words.rare, model.lexicon, model.settings)
    for i, (place, y) in enumerate(zip(made.place, made.outcome)):
        (one, _), (three, n_three), (five, n_five) = (counted(t, int(made.slots[t][i]), y, 0) for t in lmscore.BYTE_TABLES)
        want[2] += decide(model.byte_mix, min(int(spelling.level[place]), 3) * 16 + step(n_three) * 4 + step(n_five), [one, three, five], y)
    assert got.tolist() == pytest.approx(want, rel=0.01, abs=0.05)


def test_words_of_texts(monkeypatch):
    from bidlake.llm import wordhash

    lexicon = lmscore.Lexicon([b"", b"ab", b"c"], np.zeros(4), None, None, 0, 0, 0, 0.0, 0.0)
    texts = [b"Ab c  xyz", b"", b" \t", b"c\x0bab", "Ü ab".encode()]
    words = lmscore.Words.of(texts, lmscore.lexicon_index(lexicon))
    assert words.sizes.tolist() == [4, 1, 1, 3, 3] and words.symbol.tolist() == [2, 3, 0, 1, 1, 1, 3, 2, 1, 0, 2, 1]
    assert words.rare == [b"xyz", "Ü".encode()] and words.text.tolist() == [0] * 4 + [1, 2] + [3] * 3 + [4] * 3
    assert words.first.tolist() == [True, False, False, False, True, True, True, False, False, True, False, False] and words.n_bytes.tolist() == [9, 0, 0, 5, 6]
    data = b" ".join(b"w%d" % (i % 700) for i in range(5000)) + b" " + b"z" * 9000 + b" end"
    whole = wordhash.hashed_words(data)
    monkeypatch.setattr(wordhash, "PART", 1000)
    assert all((a == b).all() for a, b in zip(whole, wordhash.hashed_words(data)))
    assert (whole[0] == wordhash.word_hashes(data)).all() and [data[i:j] for i, j in zip(*whole[1:])] == data.split()
    known = np.unique(whole[0])
    index = wordhash.HashIndex(known[::2], np.arange(1, len(known[::2]) + 1))
    assert index(known[::2]).tolist() == list(range(1, len(known[::2]) + 1)) and not index(known[1::2]).any()


def test_context_counts_by_definition(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    texts = [r["text"] for r in docs.select("text").collect()]
    settings = lmscore.ScoreSettings(lexicon=60, bits=10, topic_bits=8, byte_bits=(6, 7, 8), block_bytes=3000)
    lexicon = lmscore.build_lexicon(lmscore.word_counts(docs, docs.doc_id.isNotNull()).cache(), settings)
    shared = spark.sparkContext.broadcast(lexicon.state())
    got = lmscore.context_tables(docs.selectExpr("cast(text as binary) as data").repartition(5), shared, settings)
    number, want = lmscore.lexicon_index(lexicon), {n: np.zeros(2 << b, dtype=np.int64) for n, b in lmscore.table_bits(settings).items()}
    for t in texts:
        words = lmscore.Words.of([(t or "").encode()], number)
        for made in (lmscore.word_decisions(words, lexicon, settings), *([lmscore.byte_decisions(words.rare, lexicon, settings)] if words.rare else [])):
            for name, slot in made.slots.items():
                for s, y in zip(slot, made.outcome):
                    want[name][2 * s + y] += 1
    for name, counts in want.items():
        low = counts.reshape(-1, 2).max(axis=1) <= lmscore.MOST
        assert (got[name].reshape(-1, 2)[low] == counts.reshape(-1, 2)[low]).all() and got[name].max() <= lmscore.MOST


def test_contexts_predict_every_decision_of_a_word(spark):
    """A held-out text whose words follow each other as in training costs next to nothing, though each word's code is long."""
    pick = random.Random(11)
    names = [f"w{i}" for i in range(2048)]
    follows = dict(zip(names, pick.sample(names, len(names))))

    def chain(n):
        out = [pick.choice(names)]
        while len(out) < n:
            out.append(follows[out[-1]] if pick.random() < 0.98 else pick.choice(names))
        return " ".join(out)

    docs = spark.createDataFrame([(i, chain(150)) for i in range(1200)], "doc_id long, text string")
    whole, four = (lmscore.score_documents(docs, settings=s).where("held_out").agg({"score": "sum", "n_tokens": "sum"}).first()
                   for s in (lmscore.ScoreSettings(), lmscore.ScoreSettings(depth=4)))
    assert -whole["sum(score)"] / math.log10(2) / whole["sum(n_tokens)"] < 0.6 * -four["sum(score)"] / math.log10(2) / four["sum(n_tokens)"]


def test_no_code_is_cut():
    """Weights of the longest codes there can be (Fibonacci numbers): every decision stands in the paths."""
    weights = [1, 1]
    while len(weights) < 60:
        weights.append(weights[-1] + weights[-2])
    codes = lmscore.Codes(weights, lmscore.ScoreSettings().depth)
    assert codes.length.max() == 59 and not codes.tail.any()


def test_mixers_are_fitted_to_all_training_rows(spark):
    """More rows than any sample of documents: the tables hold every decision, and the fit is that of one pass over all rows."""
    pick = random.Random(5)
    texts = [" ".join(pick.choice("abcdefghij") * pick.randrange(1, 4) for _ in range(pick.randrange(1, 6))) + (f" rare{i}" if i % 7 == 0 else "") for i in range(4000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    settings = lmscore.ScoreSettings(lexicon=20, bits=10, topic_bits=8, byte_bits=(6, 7, 8), block_bytes=3000)
    lexicon = lmscore.build_lexicon(lmscore.word_counts(docs, docs.doc_id.isNotNull()).cache(), settings)
    data = docs.selectExpr("cast(text as binary) as data")
    tables = lmscore.context_tables(data, spark.sparkContext.broadcast(lexicon.state()), settings)
    got = lmscore.learned_weights(data, spark.sparkContext.broadcast({"lexicon": lexicon.state(), "codes": lmscore.all_codes(tables)}), settings)
    model = lmscore.Model(lexicon, tables, settings)
    words = lmscore.Words.of([t.encode() for t in texts], model.index)
    untrained = {name: getattr(model, name).refined.sum() for name in got}
    before = model.bits(words, np.ones(len(texts)), learn=True).sum()
    decisions = {"word_mix": lmscore.word_decisions(words, lexicon, settings), "byte_mix": lmscore.byte_decisions(words.rare, lexicon, settings)}
    for name, made in decisions.items():
        assert got[name]["refined"].sum() - untrained[name] == pytest.approx(len(made.outcome))
        for key, value in getattr(model, name).state().items():
            assert got[name][key] == pytest.approx(value, rel=1e-6)
    assert model.bits(words, np.ones(len(texts))).sum() < before


def test_fit_is_least_loss():
    """Newton's weights against plain descent on the same counted outcomes."""
    pick = np.random.default_rng(3)
    level, y = np.zeros(4000, dtype=np.int8), pick.integers(0, 2, 4000).astype(np.uint8)
    first = np.zeros(4000, dtype=np.float32)
    evidence = [np.round(lmscore.FINE * np.clip(2.0 * y - 1 + pick.normal(0, spread, 4000), -11, 11)).astype(np.int16) * 4 + 3 for spread in (1, 3)]
    mixer = lmscore.Mixer(16, [0.6, 0.5, 0.3])
    mixer.count(level, first, evidence, y)
    mixer.fit()
    rounded = np.stack([first, *(lmscore._LEVELS[np.abs((e >> 2)[:, None] / lmscore.FINE - lmscore._LEVELS).argmin(axis=1)] for e in evidence)])
    weights = np.array([0.6, 0.5, 0.3])
    for _ in range(3000):
        error = y - 1 / (1 + np.exp(-weights @ rounded))
        weights += 0.0001 * (rounded @ error - mixer.HELD * (weights - [0.6, 0.5, 0.3]))
    assert mixer.weights[:, 15].tolist() == pytest.approx(weights.tolist(), abs=0.03)


def test_awkward_rows(spark):
    docs = awkward.documents(spark)
    got = lmscore.score_documents(docs).collect()
    compare([(r[0], r[1]) for r in awkward.ROWS], got)
    assert all(r["bits_per_byte"] is None for r in got if r["doc_id"] in (3, 4, 5))
    assert lmscore.score_documents(awkward.no_documents(spark)).count() == 0
    none = lmscore.score_documents(docs.where("doc_id is null")).collect()  # all held out
    assert {(r["train_tokens"], r["base_score"], r["n_known"]) for r in none} == {(0, 0.0, 0)}
