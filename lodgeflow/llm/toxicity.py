"""Toxicity by subword bags: n-gram embeddings averaged into a linear softmax.

A word is the mean of the vectors of itself and of its character n-grams, found by
hash, so a misspelling that was never seen still shares most of its vectors with
the word it comes from. A window of words is the mean of its different words and
goes into a linear softmax; embeddings and softmax are trained jointly, in numpy.
One word in fifty marks a text, so a text is as toxic as its worst window,
whatever its length, and every window of a whole text is scored.

Labels belong to texts, not windows. So training takes turns: first windows drawn
from all over each text stand for it; then a pass over the sample with the model
so far finds each toxic text's worst windows and the clean texts' windows that
look worst, and the model is fitted anew.

Bound: at most SAMPLE_ROWS labelled texts of each class are fitted, those with the
smallest hashes of their ids, of which at most FIRST_WINDOWS windows of each are
taken in the first turn and WINDOWS in later ones. Everything else covers all rows.

Defined cases: null and wordless texts score the share of toxic labels, as does
every text if labels of one class only are given (0.0 without any). Labels other
than 0 and 1, and rows without an id, are not learnt from. Of rows with the same id
the least text is learnt; all are scored. Very long texts are scored a million characters at a time; windows begin
anew there. An empty table gives an empty one. Other columns are never looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeflow.llm.common import landed, map_rows

SAMPLE_ROWS, FIRST_WINDOWS, WINDOWS, TURNS = 1_700, 12, 4, 3
#: Words of a window, n-gram lengths (word boundaries count as a character), hash buckets, dimensions.
WINDOW_WORDS, SIZES, BUCKET_BITS, DIMENSIONS = 4, (3, 4, 5), 17, 8
#: Rounds over the windows, windows of a step, least steps of a round, their size for the softmax, and how much larger
#: steps of all vectors together are.
EPOCHS, BATCH, STEPS, RATE, PACE, SEED = 10, 512, 24, 0.1, 2000, 11
#: Characters that are looked at at once, and the longest wait for a word's end there.
STRETCH, LONGEST_WORD = 1 << 20, 1 << 12
_MULTIPLIER, _MIX = 0x100000001B3, 0x9E3779B97F4A7C15


@dataclass(frozen=True)
class Model:
    """Each bucket's share in the softmax's margin for label 1; ``weights`` is None where nothing could be learnt."""

    weights: np.ndarray | None
    bias: float
    share: float


@cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter or digit."""
    return np.array([chr(c).isalnum() for c in range(0x110000)])


def stretches(text: str) -> Iterator[str]:
    """Pieces of about ``STRETCH`` characters that end between words."""
    start = 0
    while start < len(text):
        end = start + STRETCH
        if end < len(text):
            tail = text[end : end + LONGEST_WORD]
            end += next((k for k, c in enumerate(tail) if not c.isalnum()), len(tail))
        yield text[start:end]
        start = end


def subwords(text: str) -> tuple[np.ndarray, np.ndarray, int, np.ndarray]:
    """Bucket and word number of each subword, the number of words, and a hash of each whole word."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = _letters()[codes]
    kept = inside.copy()
    kept[1:] |= inside[:-1]  # one boundary after each word
    codes = np.concatenate([[0], np.where(inside, codes, 0)[kept], [0]]).astype(np.uint64)
    if len(codes) > 2 and codes[-2] == 0:
        codes = codes[:-1]
    bounds = np.flatnonzero(codes == 0)
    n = len(bounds) - 1
    if len(codes) <= 2 or n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), 0, np.zeros(0, np.uint64)
    lengths = np.diff(bounds)
    word = np.repeat(np.arange(n), lengths)
    ends = np.repeat(bounds[1:], lengths)
    at = np.arange(len(word))
    whole = _whole(codes, bounds)
    hashes, words = [whole], [np.arange(n)]
    rolled = codes
    for size in range(2, SIZES[-1] + 1):
        rolled = rolled[:-1] * np.uint64(_MULTIPLIER) + codes[size - 1 :]
        if size in SIZES and len(rolled):
            fits = (at + size - 1 <= ends)[: len(rolled)]
            hashes.append(rolled[: len(fits)][fits] + np.uint64(size))
            words.append(word[: len(fits)][fits])
    buckets = (np.concatenate(hashes) * np.uint64(_MIX)) >> np.uint64(64 - BUCKET_BITS)
    return buckets.astype(np.int64), np.concatenate(words), n, whole


def _whole(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A hash of each whole word: a difference of prefix sums, moved to a common power."""
    powers, inverse = _powers(1 << max(12, int(len(codes)).bit_length()))
    sums = np.cumsum(codes * powers[: len(codes)])
    return (sums[bounds[1:]] - sums[bounds[:-1]]) * inverse[bounds[:-1]]


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    back = pow(_MULTIPLIER, -1, 2**64)
    return tuple(np.concatenate([[np.uint64(1)], np.cumprod(np.full(n - 1, m, np.uint64))]) for m in (_MULTIPLIER, back))


def _margins(model: Model, text: str) -> np.ndarray:
    """The margin of each window of a stretch."""
    buckets, words, n, whole = subwords(text)
    if not n:
        return np.zeros(0)
    edges = _edges(n)
    means = np.bincount(words, model.weights[buckets], n) / np.bincount(words, minlength=n)
    means[_repeated(whole, edges)] = 0
    return np.add.reduceat(means, edges[:-1]) / np.maximum(np.diff(edges), WINDOW_WORDS) + model.bias


def _repeated(whole: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The words that have occurred before in their window: a bag counts each word once."""
    window = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    order = np.lexsort((whole, window))
    same = (whole[order[1:]] == whole[order[:-1]]) & (window[order[1:]] == window[order[:-1]])
    return order[1:][same]


def _edges(n: int) -> np.ndarray:
    """Where windows begin and end: the last one also takes the words that don't fill another."""
    return np.append(np.arange(0, max(1, n - WINDOW_WORDS + 1), WINDOW_WORDS), n)


def score(model: Model) -> Callable[..., Column]:
    """A column function: the probability that a text is toxic, that of its worst window."""

    def one(text: str | None) -> float:
        best = -np.inf
        if model.weights is not None:
            for part in stretches(text or ""):
                best = max(best, _margins(model, part).max(initial=-np.inf))
        return model.share if best == -np.inf else float(1 / (1 + np.exp(-np.clip(best, -500, 500))))

    def scores(texts: pa.Array) -> pa.Array:
        return pa.array([one(t.as_py()) for t in texts], pa.float64())

    return F.arrow_udf(scores, returnType="double").asNondeterministic()


def trained(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of texts ``doc_id, text`` and labels ``doc_id, toxic``, from a bounded sample of both classes.

    The sample is drawn among the ids, so only its texts are ever joined. A
    document that is labelled more than once is toxic if one label says so.
    """
    known = labels.where(F.col("toxic").isin(0, 1)).join(docs.select("doc_id"), "doc_id", "left_semi")
    known = landed(known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("h", F.xxhash64("doc_id")), "known")
    counts = {int(t): n for t, n in known.groupBy("toxic").count().collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    if len(counts) < 2:
        return Model(None, 0.0, share)
    least = [known.where(F.col("toxic") == t).orderBy("h", "doc_id").limit(SAMPLE_ROWS) for t in (0, 1)]
    chosen = F.broadcast(least[0].unionByName(least[1]).select("doc_id", "h", "toxic"))  # of 2 x SAMPLE_ROWS rows
    texts = docs.join(chosen, "doc_id").groupBy("doc_id", "h", "toxic").agg(F.min("text").alias("text"))
    sample = landed(texts.select("h", "toxic", "text"), "labelled")
    model, clean = None, set()
    for _ in range(TURNS):
        windows = map_rows(sample, _chosen(model), "h bigint, toxic int, window string").collect()
        clean |= {(h, w) for h, t, w in windows if not t}
        texts = sorted({(h, w) for h, t, w in windows if t}), sorted(clean)
        if not all(texts):
            return Model(None, 0.0, share)
        weights, bias = fitted([w for _, w in texts[1]], [w for _, w in texts[0]])
        model = Model(weights, bias, share)
    return model


def _chosen(model: Model | None) -> Callable[..., Iterator[tuple]]:
    """The windows of a text that training takes: without a model from all over, else the worst, of a toxic text just one."""

    def rows(keys: list, labels: list, texts: list) -> Iterator[tuple]:
        for key, label, text in zip(keys, labels, texts):
            found = []  # of (rank, window): those of the lowest ranks
            for part in stretches(text or ""):
                found = sorted(found + list(_ranked(model, part, key)))[: WINDOWS if model else FIRST_WINDOWS]
            for k, (rank, window) in enumerate(found):
                if model is None or not label or k == 0:
                    yield key, label, window

    return rows


def _ranked(model: Model | None, text: str, key: int) -> Iterator[tuple[float, str]]:
    n = subwords(text)[2]
    if not n:
        return
    edges = _edges(n)
    if model is None:
        ranks = np.random.default_rng(key % 2**63).random(len(edges) - 1)
    else:
        ranks = -_margins(model, text)
    spaced = "".join(c if c.isalnum() else " " for c in text.lower()).split()
    for k in np.argsort(ranks)[: WINDOWS if model else FIRST_WINDOWS]:
        yield float(ranks[k]), " ".join(spaced[edges[k] : edges[k + 1]])


def fitted(clean: list[str], toxic: list[str]) -> tuple[np.ndarray, float]:
    """Embeddings and softmax of the two kinds of windows, fitted jointly; both kinds weigh the same.

    Returns each bucket's part in the margin between the two labels, and the bias.
    """
    rng = np.random.default_rng(SEED)
    labels = np.repeat([0, 1], [len(clean), len(toxic)])
    each = np.repeat([len(labels) / 2 / len(clean), len(labels) / 2 / len(toxic)], [len(clean), len(toxic)])
    texts = [*clean, *toxic]
    vectors = rng.uniform(-1, 1, (1 << BUCKET_BITS, DIMENSIONS)) / DIMENSIONS
    softmax, bias = rng.uniform(-1, 1, (DIMENSIONS, 2)), np.zeros(2)
    squares, pace = [np.full(softmax.shape, 1e-6), np.full(2, 1e-6)], 1e-6
    order = rng.permutation(len(texts))
    batches = [_batch([texts[i] for i in part]) + (labels[part], each[part]) for part in np.array_split(order, min(len(order), max(STEPS, len(order) // BATCH)))]
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for used, place, bag, share, n, wanted, weight in batches:
            rows = vectors[used]
            means = np.stack([np.bincount(bag, rows[place, k] * share, n) for k in range(DIMENSIONS)], axis=1)
            margin = means @ softmax + bias
            odds = np.exp(margin - margin.max(axis=1, keepdims=True))
            error = (odds / odds.sum(axis=1, keepdims=True) - np.eye(2)[wanted]) * weight[:, None]
            back = error @ softmax.T
            steps = np.stack([np.bincount(place, back[bag, k] * share, len(used)) for k in range(DIMENSIONS)], axis=1)
            for value, square, step in zip((softmax, bias), squares, (means.T @ error / n, error.sum(axis=0) / n)):
                square += step**2
                value -= rate * step / np.sqrt(square)
            pace += (steps**2).sum()  # one pace for all buckets, so that rare ones are not learnt by heart
            vectors[used] -= PACE * rate * steps / np.sqrt(pace)
    return (vectors @ (softmax[:, 1] - softmax[:, 0])).astype(np.float32), float(bias[1] - bias[0])


def _batch(texts: list[str]) -> tuple:
    """Buckets used, and of each subword its place among them, its bag and its share of the bag's mean."""
    buckets, bags, shares = [], [], []
    for k, text in enumerate(texts):
        found, words, n, whole = subwords(text)
        once = np.ones(n)
        once[_repeated(whole, np.array([0, n]))] = 0
        buckets.append(found)
        bags.append(np.full(len(found), k))
        shares.append((once / np.bincount(words, minlength=n))[words] / max(n, WINDOW_WORDS))
    used, place = np.unique(np.concatenate(buckets), return_inverse=True)
    return used, place, np.concatenate(bags), np.concatenate(shares), len(texts)
