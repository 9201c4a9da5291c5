import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow.parquet as pq
import pytest

from lodgeflow.llm import brown_lm, queries

SF = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs):
    held = lambda i: crc32(("" if i is None else str(i)).encode()) % 7 == 2
    counts = Counter()
    for i, text in docs:
        if not held(i):
            counts.update([*words(text), ("end",)])
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for i, text in docs:
        tokens = [*words(text), ("end",)]
        base = sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in tokens)
        out.append((i, held(i), len(tokens), sum(counts[t] > 0 for t in tokens), total, base))
    return out


def compare(got, docs):
    key = lambda r: repr(r[:4])
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(brute(docs), key=key), strict=True):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], rel=1e-9)


@pytest.mark.parametrize("local", [1 << 16, 1000])
def test_query_equals_brute_force(spark, monkeypatch, local):
    """The base columns; with few words sent along, most counts come through the shuffle."""
    monkeypatch.setattr(brown_lm, "LOCAL", local)
    t = pq.read_table(f"{SF}/documents.parquet").to_pydict()
    got = queries.op3_brown(spark, SF).collect()
    compare(got, list(zip(t["doc_id"], t["text"])))
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_score_is_a_distribution(spark, docs):
    """Transitions sum to one, and so do the emissions of each class with its unknown word."""
    rng = random.Random(4)
    rows = [(k, " ".join(rng.choice(["aa", "bb", "cc", "dd", f"rare{k}"]) for _ in range(30))) for k in range(60)]
    model, counts = brown_lm.trained(brown_lm.split(docs(*rows)))
    assert np.allclose((10**model.transition).sum(1), 1)
    mass = np.zeros(brown_lm.CLASSES + 1)
    for row in counts.collect():
        word = bytes(row.word)
        kind = model.types[model.place[word]]
        mass[model.label[kind]] += row.n + 1
    mass[brown_lm.CLASSES] += model.ends + 1
    assert np.allclose((mass + 1) / 10**model.emission, 1)
    text = rows[0][1]
    n, known, log_counts, classes, rest = model.local(text.encode())
    label = [brown_lm.CLASSES] + [model.label[model.types[model.place[w]]] for w in text.encode().split()] + [brown_lm.CLASSES]
    count = {bytes(r.word): r.n for r in counts.collect()}
    want = sum(model.transition[a, b] for a, b in zip(label, label[1:]))
    want += sum(math.log10(count[w] + 1) - model.emission[c] for w, c in zip(text.encode().split(), label[1:]))
    want += math.log10(model.ends + 1) - model.emission[brown_lm.CLASSES]
    assert log_counts + classes == pytest.approx(want)


def test_exchange_finds_planted_classes():
    rng = np.random.default_rng(1)
    size, classes = 61, 3
    label = np.arange(size - 1) % 3
    bigrams = np.zeros((size, size))
    for _ in range(60_000):
        a = rng.integers(size - 1)
        follow = np.flatnonzero(label == (label[a] + 1) % 3)
        bigrams[a, rng.choice(follow)] += 1
    rng.shuffle(perm := np.arange(size - 1))
    mixed = bigrams.copy()
    mixed[:-1, :-1] = bigrams[np.ix_(perm, perm)]
    got = brown_lm.exchanged(mixed, classes)
    groups = {frozenset(perm[got[:-1] == c]) for c in range(classes)}
    assert groups == {frozenset(np.flatnonzero(label == c)) for c in range(classes)}


def test_edge_rows(docs):
    rows = [(1, None), (2, ""), (3, " \n "), (4, "One one TWO"), (4, "One one TWO"), (None, "ünïcode Ünïcode"), (18, "w " * 200_000)]
    rows += [(k, f"some words {k}") for k in range(100, 130)]
    compare(brown_lm.scores(docs(*rows)).collect(), rows)
    assert brown_lm.scores(docs()).collect() == []
    held = [k for k in range(60) if crc32(str(k).encode()) % 7 == 2]
    only = [(k, "never trained") for k in held]
    compare(brown_lm.scores(docs(*only)).collect(), only)


@pytest.mark.parametrize("local", [1 << 16, 8])
def test_rarer_words_of_one_ending_have_classes_of_their_own(spark, docs, monkeypatch, local):
    """Beyond the most frequent words, nouns and verbs of one ending are told apart by their neighbours."""
    monkeypatch.setattr(brown_lm, "LOCAL", local)
    rng = random.Random(5)
    rows = [(k, " ".join(f"f{j}" for j in range(700))) for k in range(6)]  # frequent words by themselves
    nouns, verbs = ([f"{c}{j}ring" for j in range(20)] for c in "nv")
    assert len({brown_lm.ending(w.encode()) for w in nouns + verbs}) == 1
    for k in range(100, 160):
        rows.append((k, " ".join(f"the a{rng.randrange(9)} will b{rng.randrange(9)} now" for _ in range(40))))
    held = [k for k in range(2000, 3000) if crc32(str(k).encode()) % 7 == 2]
    train = [k for k in range(1000, 2000) if crc32(str(k).encode()) % 7 != 2]
    rows += [(k, f"the {n} will {v} now") for k, n, v in zip(train, nouns * 2, verbs * 2)]
    right, wrong = held[:20], held[20:40]
    rows += [(k, f"the {n} will {v} now") for k, n, v in zip(right, nouns, verbs)]
    rows += [(k, f"the {v} will {n} now") for k, n, v in zip(wrong, nouns, verbs)]
    got = {r.doc_id: r for r in brown_lm.scores(docs(*rows)).collect()}
    for a, b in zip(right, wrong):
        assert got[a].base_score == pytest.approx(got[b].base_score)
        assert got[a].score > got[b].score + 1
