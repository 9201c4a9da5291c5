"""Fill-in-the-middle: texts cut at lines and put together anew, behind sentinels.

Each text is chunked where a rolling hash of the last 16 bytes says so, so equal
passages of different texts become equal chunks wherever they start. What a cut
needs to know of a chunk (its line ends and code points) is looked up in a memo
by the chunk's hash, and used only after the contents have proved equal; the
chunks' counts, added up, tell the chunk that holds a cut, and its boundary
summary the place within. The memo is bounded and a task's own: it saves work and
changes no result.

Defined cases: a null text counts as empty, an empty text stays plain, as does
one that contains a sentinel. A null id draws its numbers as the text ``7:`` does.
Rows with the same id get the same draw and are all kept. A text of one line has
one unit. Very long texts are chunked like others, at a few times their own size in
memory. An empty table gives an empty one. All columns stay; the new one's name
must be free (:func:`lodgeflow.llm.common.fresh`).
"""

from __future__ import annotations

from bisect import bisect_left
from collections import OrderedDict
from hashlib import sha256
from itertools import accumulate
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeflow.llm.common import per_row

# The sentinels of prefix, suffix and middle, and the text before the id in its digest.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SALT = "7:"
#: Percentages of texts that are cut at all, and of those that begin with the suffix.
CUT_PERCENT, SUFFIX_FIRST_PERCENT = 100, 50
#: A chunk ends where the low bits of the rolling hash are all set: 512 bytes on average.
CHUNK_BITS = 9
#: Bytes of chunk contents that one task remembers.
MEMO_BYTES = 32 << 20
#: Bytes under the rolling hash, a power of two, and bytes that are hashed at once.
WINDOW, _STRETCH = 16, 4 << 20
_MULTIPLIER = 0x9E3779B1

FORM = "struct<n:bigint, form:string, prefix_chars:bigint, middle_chars:bigint, output:string>"


class Chunk(NamedTuple):
    """A chunk's boundary summary: code points, and where its line ends are, in code points and after them."""

    chars: int
    ends: tuple[int, ...]


class Memo:
    """Summaries of chunks by content hash; a summary is used only if the contents are equal."""

    def __init__(self, limit: int = MEMO_BYTES):
        self.limit, self.size = limit, 0
        self.known: OrderedDict[int, tuple[bytes, Chunk]] = OrderedDict()

    def summary(self, key: int, content: bytes) -> Chunk:
        found = self.known.get(key)
        if found and found[0] == content:
            self.known.move_to_end(key)
            return found[1]
        fresh = summarised(content)
        self.size += _weight(content, fresh) - (_weight(*found) if found else 0)
        self.known[key] = (content, fresh)
        self.known.move_to_end(key)
        while self.size > self.limit:
            self.size -= _weight(*self.known.popitem(last=False)[1])
        return fresh


def _weight(content: bytes, chunk: Chunk) -> int:
    """About the bytes that a remembered chunk takes."""
    return len(content) + 40 * len(chunk.ends) + 300


def summarised(content: bytes) -> Chunk:
    """Continuation bytes at a chunk's start belong to a code point that an earlier chunk has counted."""
    data = np.frombuffer(content, np.uint8)
    starts = np.cumsum((data & 0xC0) != 0x80)
    return Chunk(int(starts[-1]), tuple(starts[data == 10].tolist()))


def chunk_bounds(data: np.ndarray) -> list[int]:
    """Where chunks end: where the hash of the last 16 bytes begins to have its upper bits set."""
    found = [_boundaries(data, start) for start in range(0, len(data), _STRETCH)]
    ends = np.concatenate(found).tolist() if found else []
    return [e for e in ends if e < len(data)] + [len(data)] if len(data) else []


def _boundaries(data: np.ndarray, start: int) -> np.ndarray:
    """The chunk ends among the ``_STRETCH`` bytes from ``start``, judged with the bytes before them."""
    first = max(0, start - WINDOW)
    part = data[first : start + _STRETCH]
    if len(part) < WINDOW:
        return np.zeros(0, np.int64)
    rolled, width, power = part.astype(np.uint32) + np.uint32(1), 1, _MULTIPLIER
    while width < WINDOW:  # hash of 2w bytes = hash of w bytes * m^w + hash of the next w bytes
        rolled = rolled[:-width] * np.uint32(power) + rolled[width:]
        width, power = 2 * width, power * power % 2**32
    due = (rolled >> np.uint32(32 - CHUNK_BITS)) == (1 << CHUNK_BITS) - 1
    ends = np.flatnonzero(due[1:] & ~due[:-1]) + first + WINDOW + 1  # the first of a run, so that runs of one byte don't crumble
    return ends[ends > start]


class Lines:
    """The line ends of a text, found through the summaries of its chunks."""

    def __init__(self, text: str, memo: Memo):
        data = text.encode("utf-8", "surrogatepass")
        ends = chunk_bounds(np.frombuffer(data, np.uint8))
        pieces = [data[a:b] for a, b in zip([0, *ends], ends)]
        self.chunks = [memo.summary(hash(piece), piece) for piece in pieces]
        self.lines = list(accumulate(len(c.ends) for c in self.chunks))
        self.chars = list(accumulate((c.chars for c in self.chunks), initial=0))
        closed = self.lines[-1] if self.lines else 0
        self.n = closed + bool(text and not text.endswith("\n"))
        self.length = len(text)

    def place(self, units: int) -> int:
        """Code points in the first ``units`` lines."""
        if units <= 0:
            return 0
        if units >= self.n:
            return self.length
        k = bisect_left(self.lines, units)
        before = self.lines[k - 1] if k else 0
        return self.chars[k] + self.chunks[k].ends[units - before - 1]


def drawn(key: str) -> tuple[int, int, int, int]:
    """Four 32-bit numbers that depend on nothing but ``key``."""
    digest = sha256(f"{SALT}{key}".encode()).hexdigest()
    return tuple(int(digest[8 * k : 8 * k + 8], 16) for k in range(4))


def infilled(key: int | None, text: str | None, memo: Memo) -> dict:
    """The form, the output and its counts for one text."""
    text = text or ""
    lines = Lines(text, memo)
    h1, h2, h3, h4 = drawn("" if key is None else str(key))
    plain = not text or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= CUT_PERCENT
    if plain:
        return {"n": lines.n, "form": "plain", "prefix_chars": None, "middle_chars": None, "output": text}
    first, second = sorted((h1 % (lines.n + 1), h2 % (lines.n + 1)))
    a, b = lines.place(first), lines.place(second)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < SUFFIX_FIRST_PERCENT:
        form, output = "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    else:
        form, output = "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return {"n": lines.n, "form": form, "prefix_chars": a, "middle_chars": b - a, "output": output}


def with_infill(docs: DataFrame, name: str = "infill", key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with struct ``name``: units ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``."""
    memo = None

    def one(doc: int | None, body: str | None) -> dict:
        nonlocal memo
        memo = memo or Memo()
        return infilled(doc, body, memo)

    return docs.withColumn(name, per_row(one, FORM)(F.col(key), F.col(text)))


def text_of(infill: str) -> Column:
    """The text, rebuilt from the output and form in a struct of :func:`with_infill`.

    A text that is cut holds no sentinel, so each occurs once in its output.
    """
    form, output = F.col(infill)["form"], F.col(infill)["output"]

    def parts(second: str) -> tuple[Column, Column, Column]:
        rest = F.substr(output, F.lit(4))
        one = F.substring_index(rest, second, 1)
        rest = F.substr(rest, F.length(one) + 4)
        return one, F.substring_index(rest, MIDDLE, 1), F.substring_index(rest, MIDDLE, -1)

    prefix, suffix, middle = parts(SUFFIX)
    suffix_first, prefix_second, middle_last = parts(PREFIX)
    return (
        F.when(form == "psm", F.concat(prefix, middle, suffix))
        .when(form == "spm", F.concat(prefix_second, middle_last, suffix_first))
        .otherwise(output)
    )
