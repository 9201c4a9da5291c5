import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodgeflow.llm import queries, toxicity

SF = "/root/testdata/sf0.1"
BAD = ["idiot", "worthless", "disgusting"]


def made(seed, n, spelled=lambda w: w):
    """Texts of invented words; every third holds one bad word among 30."""
    rng = random.Random(seed)
    parts = "an er the in st ou ed re on at".split()
    out = []
    for k in range(n):
        words = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(30)]
        if toxic := k % 3 == 0:
            words[rng.randrange(30)] = spelled(rng.choice(BAD))
        out.append((k, " ".join(words) + ".", int(toxic)))
    return out


def learnt(spark, rows):
    labelled = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    return toxicity.trained(labelled.select("doc_id", "text"), labelled.select("doc_id", "toxic"))


@pytest.fixture(scope="module")
def model(spark):
    return learnt(spark, made(1, 900))


def scores(spark, model, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = rows.select("doc_id", toxicity.score(model)("text").alias("s")).collect()
    return [s for _, s in sorted(map(tuple, found))]


def accuracy(spark, model, texts):
    found = scores(spark, model, [t for _, t, _ in texts])
    return np.mean([(s >= 0.5) == bool(y) for s, (_, _, y) in zip(found, texts)])


def test_held_out_texts(spark, model):
    assert accuracy(spark, model, made(2, 600)) >= 0.98


def test_unseen_misspellings(spark, model):
    """A letter doubled or changed at the end: the word as such was never seen."""
    assert accuracy(spark, model, made(3, 300, lambda w: w + w[-1] + "z")) >= 0.95
    assert accuracy(spark, model, made(4, 300, lambda w: w[:3] + w[2] + w[3:])) >= 0.9


def test_one_bad_word_in_a_very_long_text(spark, model):
    clean = " ".join(t for _, t, y in made(5, 3000) if not y)
    middle = len(clean) // 2
    bad = clean[:middle] + " worthless idiot " + clean[middle:]
    low, high = scores(spark, model, [clean, bad])
    assert high > 0.5 and high > low


def test_windows_are_scored_alike_in_python_and_by_stretches(model, monkeypatch):
    """The vectorised margins against a plain sum over words, their n-grams and windows."""
    text = "The worthless, the IDIOT stood; and the the again: über ß9 x"
    words = "the worthless the idiot stood and the the again über ß9 x".split()
    cut = [words[:4], words[4:8], words[8:]]

    def hashed(codes):
        value = 0
        for c in codes:
            value = (value * toxicity._MULTIPLIER + c) % 2**64
        return value

    def bucket(value):
        return (value * toxicity._MIX % 2**64) >> (64 - toxicity.BUCKET_BITS)

    def mean(word):
        codes = [0, *map(ord, word), 0]
        grams = [bucket((hashed(codes[k : k + n]) + n) % 2**64) for n in toxicity.SIZES for k in range(len(codes) - n + 1)]
        whole = bucket(sum(c * pow(toxicity._MULTIPLIER, k, 2**64) for k, c in enumerate(codes[:-1])) % 2**64)
        return np.mean([model.weights[b] for b in [whole, *grams]])

    want = [sum(mean(w) for w in set(part)) / max(4, len(part)) + model.bias for part in cut]
    assert np.allclose(toxicity._margins(model, text), want, atol=1e-4)
    monkeypatch.setattr(toxicity, "STRETCH", 20)
    parts = list(toxicity.stretches(text))
    assert "".join(parts) == text and len(parts) > 1
    assert all(not (a[-1].isalnum() and b[0].isalnum()) for a, b in zip(parts, parts[1:]))


def test_edges(spark, model):
    """Null, empty and wordless texts, repeated rows, one endless word."""
    found = scores(spark, model, [None, "", " .,! ", "ok", "ok", "a" * 50_000, "😀".encode("utf-16", "surrogatepass").decode("utf-16")])
    assert found[:3] == [model.share] * 3 and found[3] == found[4] and all(0 <= s <= 1 for s in found)
    assert scores(spark, model, []) == []


@pytest.mark.parametrize("labels, share", [([], 0.0), ([0, 0], 0.0), ([1, 1], 1.0), ([None, 7], 0.0)])
def test_labels_of_one_class_only(spark, labels, share):
    rows = [(k, "some text", y) for k, y in enumerate(labels)]
    model = learnt(spark, rows)
    assert scores(spark, model, ["x", None]) == [share, share]


def test_texts_without_words_teach_nothing(spark):
    rows = [(1, None, 1), (2, "", 1), (3, "plain words", 0)]
    model = learnt(spark, rows)
    assert scores(spark, model, ["x"]) == [pytest.approx(2 / 3)]


def test_labels_without_texts_and_repeated_rows(spark, model):
    """Labels of unknown documents take no place in the sample; repeated rows and labels change nothing."""
    rows = made(1, 900)
    docs = spark.createDataFrame([r[:2] for r in rows] * 2 + [(None, "idiot")], "doc_id bigint, text string")
    marks = [(k, y) for k, _, y in rows] + [(k, 0) for k, _, y in rows] + [(k, 1) for k in range(10_000, 20_000)]
    again = toxicity.trained(docs, spark.createDataFrame(marks, "doc_id bigint, toxic int"))
    assert (again.weights == model.weights).all() and again.bias == model.bias


def test_query_on_held_out_documents(spark):
    got = queries.op11_toxicity(spark, SF)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = got.cache()
    assert got.count() == docs.count() and got.where("score is null or score < 0 or score > 1").count() == 0
    assert got.where((F.col("held_out") != (F.crc32(F.col("doc_id").cast("string")) % 5 == 0))).count() == 0
    judged = got.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out")
    right = dict(judged.groupBy("toxic").agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int"))).collect())
    assert right[0] >= 0.85 and right[1] >= 0.85  # 352 toxic documents of four languages to learn from
