"""Benchmark decontamination with a generalised suffix automaton.

The normalised words of all test items are put into one automaton, which accepts
exactly the word strings that occur inside some item. A document's words are fed
to it one by one; the automaton's state and its matching length say at each word
how long the longest item string is that ends there. Where that length reaches
``window`` words, the last ``window`` words are an item's window. An item of
fewer words is one window, found where its own final state lies on the suffix
path of the current state.

Items are taken in blocks of at most ``MAX_BLOCK_WORDS`` words (a longer item is
its own block), so that what is broadcast has a bounded size however large the
benchmark is. A benchmark of several blocks takes a pass over the documents for
each, one after the other, so that no task ever holds two automata; each pass
writes the hits of the documents that have some, and these are united by document.

Defined cases: a null or wordless text has no words and is clean; a null or
wordless item matches nothing; items that repeat a text all count; rows repeated
in the documents come back repeated; empty tables give no rows or no hits. A very
long text is streamed word by word, with its words and spans in memory. Other
columns of both inputs are not read, and those of the documents are kept; the new
one's name must be free.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from itertools import chain

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeflow.llm.common import fresh, landed, per_row, utf8

WINDOW = 13
#: Words of the items that one automaton may hold.
MAX_BLOCK_WORDS = 200_000

# A-Z become a-z; every other ASCII character that is no digit or letter splits words.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def normalised(text: bytes) -> list[bytes]:
    """The lower-case words of a UTF-8 text."""
    return text.translate(_FOLD).split()


class Automaton:
    """Suffix automaton of several word strings."""

    def __init__(self, items: Iterable[tuple[int, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.ends: dict[int, list[tuple[int, list[int]]]] = {}  # state -> (words, ids) of short items
        self.windows: dict[tuple[int, ...], list[int]] = {}
        self.shortest = window
        for item, words in items:
            if not words:
                continue
            path = [self.ids.setdefault(w, len(self.ids) + 1) for w in words]
            state = 0
            for word in path:
                state = self._extend(state, word)
            if len(path) < window:
                self.shortest = min(self.shortest, len(path))
            for k in range(max(1, len(path) - window + 1)):
                found = self.windows.setdefault(tuple(path[k : k + window]), [])
                if item not in found:
                    found.append(item)
        for key in self.windows:
            if len(key) < window:
                state = 0
                for word in key:
                    state = self.next[state][word]
                self.ends.setdefault(state, []).append((len(key), self.windows[key]))

    def _state(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, parent: int, child: int, word: int) -> int:
        """A copy of ``child`` that holds only its strings of up to the parent's length plus one."""
        copy = self._state(self.length[parent] + 1, self.link[child], dict(self.next[child]))
        self.link[child] = copy
        while parent >= 0 and self.next[parent].get(word) == child:
            self.next[parent][word] = copy
            parent = self.link[parent]
        return copy

    def _extend(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:  # another item went this way
            if self.length[known] == self.length[last] + 1:
                return known
            return self._split(last, known, word)
        new = self._state(self.length[last] + 1, 0, {})
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at >= 0:
            child = self.next[at][word]
            whole = self.length[child] == self.length[at] + 1
            self.link[new] = child if whole else self._split(at, child, word)
        return new

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Maximal hit spans (start, end) and the items whose windows occur in ``words``."""
        get = self.ids.get
        path = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
        # Only a run of known words can hold a match.
        edge = np.flatnonzero(np.diff(np.concatenate(([0], path != 0, [0])).astype(np.int8)))
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        for start, end in edge.reshape(-1, 2):
            if end - start >= self.shortest:
                self._stream(path[start:end].tolist(), int(start), spans, items)
        return spans, items

    def _stream(self, path: list[int], offset: int, spans: list, items: set) -> None:
        following, link, length, window = self.next, self.link, self.length, self.window
        state = matched = 0
        for k, word in enumerate(path):
            while state and word not in following[state]:
                state = link[state]
                matched = length[state]
            if word in following[state]:
                state = following[state][word]
                matched += 1
            reach = 0
            if matched >= window:
                reach = window
                items.update(self.windows[tuple(path[k + 1 - window : k + 1])])
            if self.ends:
                at = state
                while at > 0:
                    for size, found in self.ends.get(at, ()):
                        if size <= matched:
                            items.update(found)
                            reach = max(reach, size)
                    at = link[at]
            if reach:
                start, end = offset + k + 1 - reach, offset + k + 1
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, end))


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, bytes]]]:
    """Items in blocks of at most MAX_BLOCK_WORDS words; the driver holds one block at a time."""
    block, size = [], 0
    for item, text in benchmark.select("item_id", utf8("text")).toLocalIterator():
        words = len(normalised(bytes(text)))
        if block and size + words > MAX_BLOCK_WORDS:
            yield block
            block, size = [], 0
        if words:
            block.append((item, bytes(text)))
            size += words
    if block:
        yield block


_HITS = "struct<n_words:bigint, spans:array<struct<start:bigint, end:bigint>>, items:array<bigint>>"


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def with_hits(documents: DataFrame, benchmark: DataFrame, column: str, window: int = WINDOW) -> DataFrame:
    """``documents`` (with a ``text``) plus ``column``, a struct of n_words, spans and items.

    Spans are maximal runs of hit words, as word positions with an exclusive end;
    items are the ids of the items with an occurring window, each once, sorted.
    """
    blocks = _blocks(benchmark)
    first, second = next(blocks, []), next(blocks, None)
    if second is None:
        return documents.withColumn(column, _found(documents, first, window)(utf8("text")))
    # Rows are told apart by a number that is written down, as ids may repeat or be null.
    key = fresh(documents, "_row")
    documents = landed(documents.withColumn(key, F.monotonically_increasing_id()), "numbered")
    found = []
    for block in chain((first, second), blocks):
        hits = documents.select(key, _found(documents, block, window)(utf8("text")).alias("hits"))
        # The first block's rows bring the number of words of every document.
        found.append(landed(hits if not found else hits.where(F.size("hits.spans") > 0), "hits"))
    merged = reduce(DataFrame.unionByName, found).groupBy(key).agg(F.collect_list("hits").alias("hits"))
    united = merged.select(key, per_row(_united, _HITS)("hits").alias(column))
    return documents.join(united, key).drop(key)


def _found(documents: DataFrame, block: list[tuple[int, bytes]], window: int) -> Callable[[Column], Column]:
    """A column function: the hits of one block's automaton, which each task builds once."""
    shared, built = documents.sparkSession.sparkContext.broadcast(block), []

    def find(text: bytes) -> dict:
        if not built:
            built.append(Automaton(((i, normalised(t)) for i, t in shared.value), window))
        words = normalised(text)
        spans, items = built[0].hits(words)
        return _hits(len(words), spans, items)

    return per_row(find, _HITS)


def _hits(n_words: int, spans: list[tuple[int, int]], items: set) -> dict:
    return {
        "n_words": n_words,
        "spans": [{"start": a, "end": b} for a, b in spans],
        "items": sorted(items, key=lambda i: (i is not None, i)),
    }


def _united(hits: list[dict]) -> dict:
    """The hits of several blocks in one document."""
    spans = _merged([(x["start"], x["end"]) for h in hits for x in h["spans"]])
    return _hits(hits[0]["n_words"], spans, {i for h in hits for i in h["items"]})


def n_hit(hits: str) -> Column:
    """Hit words of a document."""
    length = lambda total, span: total + span["end"] - span["start"]
    return F.aggregate(F.col(hits)["spans"], F.lit(0).cast("bigint"), length)


def contaminated(hits: str, coverage: int = 20) -> Column:
    """True where at least one word in ``coverage`` is hit."""
    return (n_hit(hits) > 0) & (coverage * n_hit(hits) >= F.col(hits)["n_words"])


def without_spans(documents: DataFrame, hits: str, min_span: int, coverage: int) -> DataFrame:
    """Texts without their spans of ``min_span`` or more words, where coverage exceeds its limit.

    A removed span takes the characters from its first word up to the next word
    that stays. Other texts are unchanged.
    """

    def cut(text, found):
        doomed = [(x["start"], x["end"]) for x in found["spans"] if x["end"] - x["start"] >= min_span]
        bounds = [m.span() for m in re.finditer(rb"[^ ]+", text.translate(_FOLD))]
        out, at = [], 0
        for start, end in doomed:
            out.append(text[at : bounds[start][0]])
            at = bounds[end][0] if end < len(bounds) else len(text)
        return b"".join(out) + text[at:]

    rest = per_row(cut, "binary")(utf8("text"), F.col(hits)).cast("string")
    return documents.withColumn("text", F.when(contaminated(hits, coverage), rest).otherwise(F.col("text")))
