"""A Brown class-based bigram model and its scores.

Every training word has a class of its own choice, however rare it is. The
exchange algorithm, on the ``FREQUENT`` most frequent words and ``ENDINGS`` groups
of all others by a hash of their last bytes, only says where words begin: it moves
one at a time between ``CLASSES`` classes until no move raises the likelihood of
the class bigrams. Then all words leave their groups. In sweeps over the ``LOCAL``
most frequent words each word goes to the class in which the model makes its own
occurrences likeliest, from how often each class comes before and after it, as long
as a sweep raises the likelihood of the training texts by ``GAIN`` of it. Every
other word then goes to its best class in the same way, by all its occurrences,
and the model is counted anew over the classes of all words. A word that training
lacks has the class that most rare words with its ending chose. A text's
probability is the product of P(class | class before) and P(word | class) over
its words and one end token, which is a class of its own and also stands before
the first word. Transitions are smoothed towards the class unigram, emissions by
one count for each known word of the class and one for all unknown ones.

Texts are split into words once and kept as numbers. The numbers of the ``LOCAL``
words are sent along, and their neighbours' classes are added up by word; the other
words of each text are shuffled to their neighbours, counts and classes. The driver
holds the numbers of the first exchange and of the ``LOCAL`` words, whose size has
a fixed bound.

Defined cases: a null or blank text is one end token; a null id is hashed as the
empty text, and so is training; rows repeated in the input count and come back
repeatedly; without training rows every word is unknown; an empty table gives an
empty table. A very long text is one row's words, counted and scored like any
other. Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import islice, repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeflow.llm.common import landed, utf8

FREQUENT = 768
ENDINGS = 256
CLASSES = 32
#: How many words have a number of their own in the texts; with all others' ends, as many as two bytes tell apart.
LOCAL = (1 << 16) - ENDINGS - 1
#: The rise of the training texts' log probability, as a share of it, that another sweep is worth.
GAIN = 1e-3
#: Words whose neighbours are added up in one group.
SLICE = 256
#: Of how many buckets of crc32(doc_id) which one is held out.
FOLDS, HELD_OUT = 7, 2


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()  # on bytes: A-Z, and exactly x20 and x09-x0D


def ending(word: bytes) -> int:
    return FREQUENT + crc32(word[-3:]) % ENDINGS


def split(docs: DataFrame) -> DataFrame:
    """(doc_id, text as bytes, held_out)."""
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS
    return docs.select("doc_id", utf8("text").alias("text"), (fold == HELD_OUT).alias("held_out"))


def word_counts(train: DataFrame) -> DataFrame:
    """(word, n) of all words of all texts; each task adds up before the shuffle."""

    def count(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def out() -> Iterator[pa.RecordBatch]:
            items = iter(held.items())
            while part := list(islice(items, 50_000)):
                words, n = zip(*part)
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(n, pa.int64())], ["word", "n"])
            held.clear()

        for batch in source:
            for text in batch["text"]:
                held.update(words_of(text.as_py()))
                if len(held) > 400_000:
                    yield from out()
        yield from out()

    return train.select("text").mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def encoded(text: bytes, place: dict[bytes, int]) -> tuple[np.ndarray, list[bytes]]:
    """The numbers of a text's words between two ends, and in order the words that have no place.

    These are numbered by their ending, after all places; the end comes last.
    """
    words, size = words_of(text), len(place)
    ids = np.empty(len(words) + 2, np.int64)
    ids[0] = ids[-1] = size + ENDINGS
    inner = ids[1:-1]
    inner[:] = np.fromiter(map(place.get, words, repeat(-1)), np.int64, len(words))
    rare = np.flatnonzero(inner < 0)
    rest = [words[k] for k in rare]
    inner[rare] = [size + ending(w) - FREQUENT for w in rest]
    return ids, rest


def _kind(size: int) -> np.dtype:
    """The kind of numbers that the texts are kept in."""
    return np.min_scalar_type(size + ENDINGS)


def numbered(docs: DataFrame, place: dict[bytes, int]) -> DataFrame:
    """(key, doc_id, held_out, ids, rest): every text as ``encoded``; the key names a row, also where ids repeat."""
    shared = docs.sparkSession.sparkContext.broadcast(place)
    names = ["key", "doc_id", "held_out", "ids", "rest"]
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.list_(pa.binary())]

    def number(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, key, held, size = shared.value, TaskContext.get().partitionId() << 40, [], 0
        kind = _kind(len(place))

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)

        for batch in source:
            for doc, text, held_out in zip(batch["doc_id"], batch["text"], batch["held_out"]):
                ids, rest = encoded(text.as_py(), place)
                held.append((key, doc.as_py(), held_out.as_py(), ids.astype(kind).tobytes(), rest))
                key, size = key + 1, size + len(ids)
                if size > 200_000:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    schema = "key bigint, doc_id bigint, held_out boolean, ids binary, rest array<binary>"
    return landed(docs.mapInArrow(number, schema), "numbered-texts")


def _chained(source: Iterator[pa.RecordBatch], kind: np.dtype) -> Iterator[np.ndarray]:
    """The texts' numbers one after the other, some millions at a time; one end stands between two texts."""
    held: list[np.ndarray] = []
    waiting = 0
    for batch in source:
        for text in batch.column(0):
            ids = np.frombuffer(text.as_buffer(), kind)
            held.append(ids[1:] if held else ids)
            waiting += len(ids)
            if waiting > 1 << 21:
                yield np.concatenate(held).astype(np.int64)
                held, waiting = [], 0
    if held:
        yield np.concatenate(held).astype(np.int64)


def pair_counts(texts: DataFrame, column: str, kind: np.dtype, number: np.ndarray) -> np.ndarray:
    """How often each value of ``number`` follows each, by the numbers of the texts, as a dense matrix."""
    size = int(number.max()) + 1
    shared = texts.sparkSession.sparkContext.broadcast(number)

    def count(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, np.int64)
        for ids in _chained(source, kind):
            path = shared.value[ids]
            np.add(total, np.bincount(path[:-1] * size + path[1:], minlength=size * size), out=total)
        seen = np.flatnonzero(total)
        for k in range(0, len(seen), 100_000):
            part = seen[k : k + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], ["pair", "n"])

    pairs = texts.select(column).mapInArrow(count, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    found = pairs.toArrow()
    matrix = np.zeros(size * size)
    matrix[found["pair"].to_numpy()] = found["n"].to_numpy()
    return matrix.reshape(size, size)


def neighbours(texts: DataFrame, kind: np.dtype, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each number of the texts how often each class comes after it, and how often before it."""
    size, width = len(label), 2 * (CLASSES + 1)
    shared = texts.sparkSession.sparkContext.broadcast(label)

    def count(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * width, np.int64)
        for ids in _chained(source, kind):
            path = shared.value[ids]
            total += np.bincount(ids[:-1] * width + path[1:], minlength=len(total))
            total += np.bincount(ids[1:] * width + path[:-1] + CLASSES + 1, minlength=len(total))
        for k in range(0, size, SLICE):
            part = total[k * width : (k + SLICE) * width]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["at", "n"])

    def add(found: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(n.as_buffer(), np.int64) for n in found["n"])
        return pa.table({"at": found["at"].slice(0, 1), "n": pa.array([total.tobytes()], pa.binary())})

    schema = "at int, n binary"
    found = texts.select("ids").mapInArrow(count, schema).groupBy("at").applyInArrow(add, schema).toArrow()
    counts = np.zeros((size, width))
    for at, n in zip(found["at"].to_pylist(), found["n"]):
        part = np.frombuffer(n.as_buffer(), np.int64).reshape(-1, width)
        counts[at : at + len(part)] = part
    return counts[:, : CLASSES + 1], counts[:, CLASSES + 1 :]


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchanged(bigrams: np.ndarray, classes: int = CLASSES) -> np.ndarray:
    """The class of each type, by the exchange algorithm; the end is class ``classes``.

    Types begin in turn by frequency. Each round visits the types from the most
    frequent on and puts each into the class where the likelihood of the class
    bigrams is largest, until a round moves nothing or raises it no more.
    """
    size = len(bigrams)
    order = np.argsort(-bigrams.sum(1)[:-1], kind="stable")
    label = np.empty(size, np.int64)
    label[order] = np.arange(size - 1) % classes
    label[-1] = classes
    member = np.zeros((size, classes + 1))
    member[np.arange(size), label] = 1
    between = member.T @ bigrams @ member
    right, left = bigrams @ member, bigrams.T @ member  # classes after and before each type
    least = 1e-9 * bigrams.sum()  # well above what rounding can feign
    reached, moved = -math.inf, True
    while moved:
        moved = False
        for w in order:
            old, self_ = label[w], bigrams[w, w]
            after, before = right[w].copy(), left[w].copy()
            if not after.any() and not before.any():
                continue
            after[old] -= self_
            before[old] -= self_
            between[old, :] -= after
            between[:, old] -= before
            between[old, old] -= self_
            rows, columns = between.sum(1), between.sum(0)
            gain = (_xlogx(between + after) - _xlogx(between)).sum(1)
            gain += (_xlogx(between.T + before) - _xlogx(between.T)).sum(1)
            own = np.diag(between)
            gain += _xlogx(own + after + before + self_) - _xlogx(own + after) - _xlogx(own + before) + _xlogx(own)
            out, into = after.sum() + self_, before.sum() + self_
            gain -= _xlogx(rows + out) - _xlogx(rows) + _xlogx(columns + into) - _xlogx(columns)
            new = int(np.argmax(gain[:classes]))
            if gain[new] <= gain[old] + least:
                new = int(old)
            between[new, :] += after
            between[:, new] += before
            between[new, new] += self_
            if new != old:
                moved = True
                label[w] = new
                right[:, old] -= bigrams[:, w]
                right[:, new] += bigrams[:, w]
                left[:, old] -= bigrams[w]
                left[:, new] += bigrams[w]
        likely = _xlogx(between).sum() - _xlogx(between.sum(0)).sum() - _xlogx(between.sum(1)).sum()
        moved, reached = moved and likely > reached + least, likely
    return label


def parameters(between: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logs of the transitions and of the emissions' denominators, by class bigrams and known words of each class."""
    tokens = between.sum(0)  # each token follows one
    unigram = (tokens + 1) / (tokens.sum() + CLASSES + 1)
    transition = np.log10((between + CLASSES * unigram) / (between.sum(1, keepdims=True) + CLASSES))
    return transition, np.log10(tokens + known + 1)


def known_words(label: np.ndarray, words: np.ndarray, ends: float) -> np.ndarray:
    """The different words of each class, by the class and the different words of each number but the end."""
    known = np.bincount(label[:-1], weights=words, minlength=CLASSES + 1)
    known[CLASSES] = ends > 0
    return known


def swept(texts: DataFrame, label: np.ndarray, words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The classes of all numbers after the sweeps over the first ``size``, and the parameters they were last moved by."""
    best, kept = -math.inf, None
    while True:
        after, before = neighbours(texts, _kind(size), label)
        member = np.zeros((len(label), CLASSES + 1))
        member[np.arange(len(label)), label] = 1
        between = member.T @ after
        known = known_words(label, words, between[:, CLASSES].sum())
        transition, emission = parameters(between, known)
        likely = (between * transition).sum() - (between.sum(0) * emission).sum()
        if kept is None or likely > best:
            gained, best, kept = likely - best, likely, (label, transition, emission)
        else:
            break
        if gained <= GAIN * abs(best) or not size:
            break
        worth = after[:size] @ transition.T + before[:size] @ transition - before[:size].sum(1, keepdims=True) * emission
        label = label.copy()
        label[:size] = worth[:, :CLASSES].argmax(1)
    return kept


def rare_classes(texts: DataFrame, label: np.ndarray, transition: np.ndarray, emission: np.ndarray, size: int) -> DataFrame:
    """(word, n, class) of every word of ``texts`` without a place: its count and best class, by all its neighbours."""
    width, kind = CLASSES + 1, _kind(size)
    # The worth of each class between each two classes.
    worth = transition[:, None, :CLASSES] + transition.T[None, :, :CLASSES] - emission[:CLASSES]
    shared = texts.sparkSession.sparkContext.broadcast((label, worth.reshape(width * width, CLASSES)))

    def around(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label = shared.value[0]
        for batch in source:
            pairs = [np.empty(0, np.int64)]
            for text in batch["ids"]:
                ids = np.frombuffer(text.as_buffer(), kind)
                at = np.flatnonzero((ids >= size) & (ids < size + ENDINGS))
                pairs.append(label[ids[at - 1]] * width + label[ids[at + 1]])
            yield pa.RecordBatch.from_arrays(
                [batch["rest"].flatten(), pa.array(np.concatenate(pairs).astype(np.int16))], ["word", "pair"]
            )

    def choose(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worth = shared.value[1]
        for batch in source:
            pairs, n = batch["pairs"].flatten().to_numpy(), batch["pairs"].value_lengths().to_numpy()
            ends, chosen, start = np.cumsum(n), [], 0
            while start < len(n):  # so many words that their occurrences fit
                first = ends[start] - n[start]
                stop = max(start + 1, int(np.searchsorted(ends, first + (1 << 16), "right")))
                sums = np.add.reduceat(worth[pairs[first : ends[stop - 1]]], ends[start:stop] - n[start:stop] - first)
                chosen.append(sums.argmax(1))
                start = stop
            if chosen:
                yield pa.RecordBatch.from_arrays(
                    [batch["word"], pa.array(n.astype(np.int64)), pa.array(np.concatenate(chosen).astype(np.int32))],
                    ["word", "n", "class"],
                )

    pairs = texts.select("ids", "rest").mapInArrow(around, "word binary, pair smallint")
    found = pairs.groupBy("word").agg(F.sort_array(F.collect_list("pair")).alias("pairs"))
    return landed(found.mapInArrow(choose, "word binary, n bigint, class int"), "word-classes")


class Model:
    """Classes, transitions and emissions of a trained model; its size has a fixed bound."""

    def __init__(self, between: np.ndarray, label: np.ndarray, known: np.ndarray, words: list[tuple[bytes, int]]):
        """``label``: the class of each number of the texts; ``words``: the LOCAL most frequent words with counts."""
        self.label = label
        self.transition, self.emission = parameters(between, known)
        self.ends = int(between[:, CLASSES].sum())
        self.tokens, self.known = int(between.sum()), int(known.sum())
        self.place = {w: k for k, (w, _) in enumerate(words)}
        self.types = np.arange(len(words))
        self.counts = np.log10(np.array([n for _, n in words], float) + 1)

    def scored(self, path: np.ndarray) -> float:
        """The log probability of a text's classes, and of its words but for their counts."""
        return float(self.transition[path[:-1], path[1:]].sum() - self.emission[path[1:]].sum())

    def local(self, text: bytes) -> tuple[int, int, float, float, dict[bytes, int]]:
        """Tokens, known local ones, log counts of those, log probability but for counts, and the other words.

        The other words have the class of their ending here.
        """
        ids, rest = encoded(text, self.place)
        found = ids[ids < len(self.place)]
        counts = self.counts[found].sum() + math.log10(self.ends + 1)
        return len(ids) - 1, len(found) + (self.ends > 0), float(counts), self.scored(self.label[ids]), Counter(rest)


def in_classes(texts: DataFrame, label: np.ndarray, rare: DataFrame, counts: np.ndarray) -> DataFrame:
    """(doc_id, held_out, n_known, counts, path): the classes of all words of each text, ends included.

    ``n_known`` and the log counts are those of its words without the end.
    """
    size = len(counts)
    kind, shared = _kind(size), texts.sparkSession.sparkContext.broadcast((label.astype(np.uint8), counts))

    def begin(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label, counts = shared.value
        for batch in source:
            paths, known, logs = [], [], []
            for text in batch["ids"]:
                ids = np.frombuffer(text.as_buffer(), kind)
                found = ids[ids < size]
                path = label[ids]
                path[(ids >= size) & (ids < size + ENDINGS)] += CLASSES + 1  # marks the words whose class comes yet
                paths.append(path.tobytes())
                known.append(len(found))
                logs.append(counts[found].sum())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(known, pa.int64()), pa.array(logs, pa.float64()), pa.array(paths, pa.binary())],
                ["key", "doc_id", "held_out", "n_known", "counts", "path"],
            )

    def end(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            paths = []
            for text, codes in zip(batch["path"], batch["codes"]):
                path = np.frombuffer(text.as_buffer(), np.uint8).copy()
                rare = np.flatnonzero(path > CLASSES)
                path[rare] -= CLASSES + 1
                if codes.is_valid:
                    codes = codes.values.to_numpy()
                    path[rare[codes // CLASSES]] = codes % CLASSES
                paths.append(path.tobytes())
            columns = [batch[c] for c in ("doc_id", "held_out", "n_known", "counts")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(paths, pa.binary())], ["doc_id", "held_out", "n_known", "counts", "path"]
            )

    begun = texts.select("key", "doc_id", "held_out", "ids").mapInArrow(
        begin, "key bigint, doc_id bigint, held_out boolean, n_known bigint, counts double, path binary"
    )
    words = texts.select("key", F.posexplode("rest").alias("k", "word")).join(rare, "word")
    words = words.groupBy("key").agg(
        F.count(F.lit(1)).alias("more_known"),
        F.sum(F.log10(F.col("n") + 1.0)).alias("more_counts"),
        F.collect_list(F.col("k").cast("bigint") * CLASSES + F.col("class")).alias("codes"),
    )
    joined = begun.join(words, "key", "left").select(
        "doc_id",
        "held_out",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        (F.col("counts") + F.coalesce("more_counts", F.lit(0.0))).alias("counts"),
        "path",
        "codes",
    )
    schema = "doc_id bigint, held_out boolean, n_known bigint, counts double, path binary"
    return landed(joined.mapInArrow(end, schema), "class-paths")


def _fitted(docs: DataFrame) -> tuple[Model, DataFrame, DataFrame]:
    """The model of the training rows of ``split(docs)``, all training word counts, and all texts in classes."""
    counts = landed(word_counts(docs.where(~F.col("held_out"))), "word-counts")
    top = counts.orderBy(F.desc("n"), "word").limit(LOCAL).toArrow()
    words = sorted(zip(top["word"].to_pylist(), top["n"].to_pylist()), key=lambda x: (-x[1], x[0]))
    size = len(words)
    texts = numbered(docs, {w: k for k, (w, _) in enumerate(words)})
    train = texts.where(~F.col("held_out"))
    types = np.arange(FREQUENT - size, FREQUENT + ENDINGS + 1)  # of words by ending and of the end
    types[:size] = [k if k < FREQUENT else ending(w) for k, (w, _) in enumerate(words)]
    label = exchanged(pair_counts(train, "ids", _kind(size), types))[types]
    of_ending = (F.crc32(F.substring("word", -3, 3)) % ENDINGS).cast("int").alias("ending")
    different = np.ones(size + ENDINGS)
    different[size:] = -np.bincount([ending(w) - FREQUENT for w, _ in words], minlength=ENDINGS)
    for row in counts.groupBy(of_ending).count().collect():
        different[size + row["ending"]] += row["count"]
    label, transition, emission = swept(train, label, different, size)
    rare = rare_classes(train, label, transition, emission, size)
    chosen = np.zeros((ENDINGS, CLASSES))
    for row in rare.groupBy(of_ending, "class").count().collect():
        chosen[row["ending"], row["class"]] = row["count"]
    label = label.copy()
    label[size:-1] = np.where(chosen.any(1), chosen.argmax(1), label[size:-1])
    logs = np.log10(np.array([n for _, n in words], float) + 1)
    paths = in_classes(texts, label, rare, logs)
    between = pair_counts(paths.where(~F.col("held_out")), "path", np.dtype(np.uint8), np.arange(CLASSES + 1))
    different[size:] = 0
    known = known_words(label, different, between[:, CLASSES].sum())
    known[:CLASSES] += chosen.sum(0)
    return Model(between, label, known, words), counts, paths


def trained(docs: DataFrame) -> tuple[Model, DataFrame]:
    """The model of the training rows of ``split(docs)``, and all training word counts."""
    return _fitted(docs)[:2]


def scores(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of (doc_id, text) rows."""
    model, _, paths = _fitted(split(docs))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scored = shared.value.scored
        for batch in source:
            found = [scored(np.frombuffer(path.as_buffer(), np.uint8)) for path in batch["path"]]
            columns = [batch[c] for c in ("doc_id", "held_out", "n_known", "counts")]
            n = pa.array([len(path.as_buffer()) - 1 for path in batch["path"]], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*columns, n, pa.array(found, pa.float64())],
                ["doc_id", "held_out", "n_known", "counts", "n_tokens", "classes"],
            )

    schema = "doc_id bigint, held_out boolean, n_known bigint, counts double, n_tokens bigint, classes double"
    log_counts = F.col("counts") + math.log10(model.ends + 1)
    base = math.log10(model.tokens + model.known + 1)
    return paths.mapInArrow(score, schema).select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + int(model.ends > 0)).alias("n_known"),
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        (log_counts - F.col("n_tokens") * F.lit(base)).alias("base_score"),
        (log_counts + F.col("classes")).alias("score"),
    )
