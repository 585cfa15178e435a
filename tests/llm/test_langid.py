import math
import zlib
from collections import Counter

from bidlake.llm import langid
from bidlake.llm.common import remainder
from tests.conftest import SF001, SF01
from tests.llm import awkward


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    rows = langid.language_ids(docs).collect()
    assert len(rows) == len(truth) and all(0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held) > 0.98
    assert sum(r["rejected"] for r in rows) <= 0.01 * len(rows)


def test_far_texts_are_rejected(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    model = langid.train(docs, remainder(5) != 0)
    far = spark.createDataFrame([(1, "жжфф щщцц ъъыы ээюю яячч"), (2, "zzqx zzqx zqzq xqxq jxjx qqzz"), (3, "12 ... 34")], "doc_id long, text string")
    assert all(r["rejected"] for r in langid.identify(far, model).collect())


def test_unlearned_latin_languages_are_rejected(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    model = langid.train(docs, remainder(5) != 0)
    far = ["Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan, ja heille on annettu järki ja omatunto.",
           "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar, akıl ve vicdana sahiptirler ve birbirlerine karşı kardeşçe davranmalıdırlar.",
           "Minden emberi lény szabadon születik és egyenlő méltósága és joga van, az emberek ésszel és lelkiismerettel bírnak.",
           "Tất cả mọi người sinh ra đều được tự do và bình đẳng về nhân phẩm và quyền lợi, mọi con người đều được tạo hóa ban cho lý trí."]
    rows = langid.identify(spark.createDataFrame(list(enumerate(far)), "doc_id long, text string"), model).collect()
    assert all(r["rejected"] for r in rows), [(r["doc_id"], r["lang_pred"], r["score"]) for r in rows]


def test_awkward_rows(spark):
    docs = awkward.documents(spark)
    rows = langid.language_ids(docs).collect()
    assert len(rows) == len(awkward.ROWS)
    assert all(r["lang_pred"] == "und" and r["rejected"] for r in rows if r["doc_id"] in (3, 4, 5, 8))
    assert {r["lang_pred"] for r in rows} <= {"und", "en", "de", "fr"}
    assert langid.language_ids(awkward.no_documents(spark)).count() == 0
    nothing = langid.train(docs.where("lang is null"), remainder(5) >= 0)
    assert {r["lang_pred"] for r in langid.identify(docs, nothing).collect()} == {"und"}


def test_ngrams_ignore_case_digits_and_signs():
    assert (langid.ngram_counts(b"AbC  12 d!", 8192) == langid.ngram_counts(b"abc d ", 8192)).sum() >= 8190


def grams(data, dims):
    """2- and 3-grams of a text by definition, counted by hashed dimension."""
    x = [b if b >= 128 or 97 <= b < 123 else b + 32 if 65 <= b < 91 else 32 for b in data]
    x = [32, *(c for i, c in enumerate(x) if i == 0 or c != 32 or x[i - 1] != 32), 32]
    shift, counts = 32 - (dims.bit_length() - 1), Counter()
    for i, (a, b) in enumerate(zip(x, x[1:])):
        two = (a * 0x9E3779B1 + b * 0x85EBCA77) % 2 ** 32
        counts[(two * 0x165667B1 % 2 ** 32) >> shift] += 1
        if i + 2 < len(x):
            three = (two * 0xC2B2AE3D + x[i + 2] * 0x27D4EB2F) % 2 ** 32
            counts[(three * 0x165667B1 % 2 ** 32) >> shift] += 1
    return counts


def test_predictions_equal_cosines_by_definition(spark):
    """Frequencies, weights, cosines, nearest centroid and rejection of whole texts, gram by gram."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "lang", "text")
    settings = langid.LanguageSettings(dimensions=512, sample=10, centroids=3)
    model = langid.train(docs, remainder(5) != 0, settings)
    rows = [r for r in docs.collect() if r["text"]]
    learned = [grams(r["text"].encode(), 512) for r in rows if r["lang"] and zlib.crc32(str(r["doc_id"]).encode()) % 5 and langid.HAS_LETTER.search(r["text"])]
    frequency = Counter(d for g in learned for d in g)
    weight = [math.log(1 + (1 + len(learned)) / (1 + frequency[d])) for d in range(512)]
    assert max(abs(a - b) for a, b in zip(weight, model.weight.tolist())) < 1e-5
    assert all(abs(sum(x * x for x in c) - 1) < 1e-4 for c in model.centroids.tolist()) and len(model.languages) > 1
    got = {r["doc_id"]: r for r in langid.identify(docs, model).collect()}
    for r in rows:
        v = {d: math.log(1 + n) * weight[d] for d, n in grams(r["text"].encode(), 512).items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        cosines = [sum(x * float(c[d]) for d, x in v.items()) / norm for c in model.centroids]
        best = max(range(len(cosines)), key=cosines.__getitem__)
        told = got[r["doc_id"]]
        assert abs(told["score"] - min(max(cosines[best], 0), 1)) < 1e-4
        if sorted(cosines)[-1] - sorted(cosines)[-2] > 1e-4:
            size = len(r["text"].encode())
            reached = [k for k, least in enumerate(settings.lengths) if size >= least]
            floor = model.floor[best][reached[-1]] if reached else 0.0
            assert told["lang_pred"] == model.languages[model.owner[best]]
            assert abs(cosines[best] - floor) < 1e-4 or told["rejected"] == (cosines[best] < floor)


def test_sample_vectors_are_held_by_their_non_zero_components():
    import numpy as np

    pick = np.random.default_rng(3)
    dense = np.where(pick.random((300, 512)) < 0.02, pick.random((300, 512)), 0).astype(np.float32)
    vectors = langid.Vectors(iter(dense), 512)
    assert sum(at.nbytes + v.nbytes for at, v in vectors.rows) < dense.nbytes / 10
    centres, members = pick.random((4, 512)).astype(np.float32), pick.random((3, 300)).astype(np.float32)
    assert np.allclose(vectors.cosines(centres), dense @ centres.T, atol=1e-4) and np.allclose(vectors.sums(members), members @ dense, atol=1e-3)
    assert (vectors.whole(299) == dense[299]).all()
    assert langid.cluster(vectors, langid.LanguageSettings()).shape == (4, 512)
