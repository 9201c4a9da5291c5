"""Quality rules as a short-circuit cascade.

Two base rules (too few words, too much repetition) are part of every result.
The further rules of ``RULES`` each read a text's counts or pass over its words.
On a bounded sample each rule's cost (seconds a text) and selectivity (share it
rejects) are estimated; the rules then run in falling order of rejection per
cost, and a text that one rejects is spared the rest. The order changes what a
verdict costs, never the verdict.

The query returns all base counts of every text, so there the cascade spares only
the rules' own passes. :func:`kept` gives the verdict alone: repetition is then
one more rule of the cascade, and what a text's rules don't ask for is not counted.

Defined cases: a null, empty or blank text has no words and fails the base rule;
text without a repeated window has no repeated words; rows repeated in the input
come back repeated; an empty table gives an empty table and the listed order of
rules. A very long text is held whole, one at a time, with its words. Other columns
are kept as they are; the new one's name must be free.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import cached_property, partial
from time import perf_counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeflow.llm.common import map_rows, per_row, utf8

#: Texts of the sample on which cost and selectivity are estimated.
SAMPLE = 2000

# Fixed values.
SYMBOLS = b"#*$%&|<>"
WINDOW = 3
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


class Counts:
    """The base counts of one UTF-8 text, each worked out when first asked for."""

    def __init__(self, text: bytes):
        self.text, self.words = text, text.split()  # on bytes: exactly x20 and x09-x0D
        self.n_words = len(self.words)

    @cached_property
    def joined(self) -> bytes:
        return b"".join(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.joined.decode("utf-8", "replace"))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.joined) - len(self.joined.translate(None, SYMBOLS))  # none of them is a space

    @cached_property
    def lines(self) -> list[bytes]:
        return [line for line in self.text.split(b"\n") if line.strip()]

    @property
    def n_lines(self) -> int:
        return len(self.lines)

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        return _repeated(self.words)

    @property
    def repetitive(self) -> bool:
        return 100 * self.n_repeat_words > MAX_REPEAT_PERCENT * self.n_words

    @property
    def base_failed(self) -> bool:
        return self.n_words < MIN_WORDS or self.repetitive


def _repeated(words: list[bytes]) -> int:
    """Words inside windows that occur twice or more."""
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    if len(words) <= WINDOW:
        return 0
    key = ids[: len(ids) - WINDOW + 1]
    for k in range(1, WINDOW):  # numbered anew at each word, so that keys stay small
        key = key * len(known) + ids[k : len(ids) - WINDOW + 1 + k]
        if k + 1 < WINDOW:
            key = np.unique(key, return_inverse=True)[1]
    _, at, times = np.unique(key, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(times[at] > 1)
    covered = np.zeros(len(words), bool)
    for k in range(WINDOW):
        covered[starts + k] = True
    return int(covered.sum())


def _share(words: list[bytes], test: Callable[[str], bool]) -> float:
    return sum(test(w.decode("utf-8", "replace")) for w in words) / max(len(words), 1)


#: Words of a stretch, within which different words are counted: a share that doesn't fall with a text's length.
BLOCK = 1000


def _few_distinct(c: Counts) -> bool:
    """Whether the words are few in each stretch of the text."""
    distinct = sum(len(set(c.words[k : k + BLOCK])) for k in range(0, c.n_words, BLOCK))
    return 10 * distinct < c.n_words


#: Name and rejecting test of each further rule. A test is true for a text to reject.
RULES: dict[str, Callable[[Counts], bool]] = {
    "symbols": lambda c: c.n_symbols > 0.2 * c.n_words,
    "word_length": lambda c: not 2 * c.n_words <= c.word_chars <= 20 * c.n_words,
    "dup_lines": lambda c: 2 * c.n_dup_lines > c.n_lines,
    "few_distinct": _few_distinct,
    "no_letters": lambda c: _share(c.words, lambda w: any(map(str.isalpha, w))) < 0.7,
    "shouting": lambda c: _share(c.words, str.isupper) > 0.5,
}
#: The same rules under the name they had when the query spared long texts from one of them.
ALL_LENGTHS = RULES
#: With the costly base rule as one of the cascade.
CASCADE = RULES | {"repetitive": lambda c: c.repetitive}


def _trial(names: list[str], texts: list[bytes]):
    """(rule, seconds, rejected) of every rule on every text, each with what it needs counted."""
    for text in texts:
        for name in names:
            counts = Counts(text)
            start = perf_counter()
            rejected = CASCADE[name](counts)
            yield name, perf_counter() - start, int(rejected)


def planned(docs: DataFrame, sample: int = SAMPLE, rules: Iterable[str] = RULES) -> list[str]:
    """Rules by falling rejection per cost, estimated on at most ``sample`` texts of all files."""
    share = min(1.0, 1.5 * sample / max(docs.count(), 1))
    texts = docs.sample(share, seed=7).limit(sample).select(utf8("text"))
    tried = map_rows(texts, partial(_trial, list(rules)), "rule string, seconds double, rejected int")
    worth = {
        r.rule: (r.rejected + 0.5) / (r.seconds + 1e-9)
        for r in tried.groupBy("rule").agg(F.sum("seconds").alias("seconds"), F.sum("rejected").alias("rejected")).collect()
    }
    return sorted(rules, key=lambda name: -worth.get(name, 0.0))


def judged(
    docs: DataFrame, column: str = "quality", order: list[str] | None = None, rules: Iterable[str] = RULES
) -> DataFrame:
    """``docs`` plus a struct of the base counts, ``base_failed`` and ``kept``; ``order`` stands for ``rules``."""
    order = planned(docs, rules=rules) if order is None else order

    def judge(text: bytes) -> dict:
        c = Counts(text)
        return {
            "n_words": c.n_words, "word_chars": c.word_chars, "n_symbols": c.n_symbols,
            "n_dup_lines": c.n_dup_lines, "n_repeat_words": c.n_repeat_words,
            "base_failed": c.base_failed,
            "kept": not c.base_failed and not any(CASCADE[name](c) for name in order),
        }

    kind = (
        "struct<n_words:bigint, word_chars:bigint, n_symbols:bigint, n_dup_lines:bigint, "
        "n_repeat_words:bigint, base_failed:boolean, kept:boolean>"
    )
    return docs.withColumn(column, per_row(judge, kind)(utf8("text")))


def kept(docs: DataFrame, column: str, order: list[str] | None = None) -> DataFrame:
    """``docs`` plus the verdict alone: too few words, then the rules in order until one rejects."""
    order = planned(docs, rules=CASCADE) if order is None else order

    def judge(text: bytes) -> bool:
        c = Counts(text)
        return c.n_words >= MIN_WORDS and not any(CASCADE[name](c) for name in order)

    return docs.withColumn(column, per_row(judge, "boolean")(utf8("text")))
