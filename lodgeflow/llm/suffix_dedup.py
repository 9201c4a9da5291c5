"""Removal of repeated strings of ``length`` bytes, over suffixes of all documents.

The suffixes of a collection are sorted column by column: each round puts the
next symbol (from the right) of every string into the collection's
Burrows-Wheeler transform, and updates the common prefixes of neighbours. Where
neighbours share ``length`` symbols, all but the earliest are repeats.

Rounds go on for as long as the longest string has symbols, so whole documents
are not inserted. They are cut into short segments first. A window of ``length``
bytes is led by its minimizer, the k-mer in it with the smallest hash; a segment
is a run of windows with the same k-mer. Equal windows have equal minimizers, so
only segments of the same minimizer can share one:

1. Each task hashes its segments, marks those that repeat an earlier one of the
   same batch whole, and sends on one row for each different segment.
2. Rows meet by minimizer, in order. Equal segments are marked but for the first;
   a segment that is alone with its minimizer is done, unless it has it twice.
3. What is left, different segments with a common minimizer, gets its bytes
   and is sorted as above, many minimizers in one collection.
   A minimizer with more than ``DIRECT`` different segments is taken window by
   window instead: windows meet by their hash as segments do in step 2.

The files of the column-wise method are sequential arrays here: collections hold
a few thousand segments of fewer than 200 bytes, each in the memory of one task,
and the shuffles between the steps are Spark's.

Defined cases: a null text is empty; a text of fewer than ``length`` bytes keeps
all; rows of one id are ordered by a hash of their text, and rows that are equal
in both count as one document and get the same result; a null id comes first; an
empty table gives an empty table. Very long texts are hashed in pieces of 1 MB and
cut into segments like others. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeflow.llm.common import landed, per_row, utf8

LENGTH = 100
KMER = 32
#: Bytes hashed at a time; longer texts are taken in pieces.
CHUNK = 1 << 20
#: Different segments of one minimizer that are sorted together.
DIRECT = 4096
#: Segments of one collection, but for a larger single minimizer.
COLLECTION = 1024
#: Rows of one minimizer that a task holds; beyond them all its segments go window by window.
CROWD = 200_000

# Fixed values of the hashes: an odd base, its inverse modulo 2**64, and odd multipliers.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 to base**(n-1) modulo 2**64."""
    out = np.ones(n, np.uint64)
    done = 1
    while done < n:
        step = np.uint64(pow(base, done, 1 << 64))
        out[done : 2 * done] = out[: min(done, n - done)] * step
        done *= 2
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(_MIX[0])
    x = (x ^ (x >> np.uint64(29))) * np.uint64(_MIX[1])
    return x ^ (x >> np.uint64(32))


class Hashes:
    """Hashes of all substrings of a byte array, from sums of weighted bytes."""

    _up = _down = np.empty(0, np.uint64)
    _values = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))

    def __init__(self, data: np.ndarray):
        if len(Hashes._up) < len(data) + 1:
            Hashes._up, Hashes._down = (_powers(b, len(data) + 1) for b in (_BASE, _INVERSE))
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self._values[data] * self._up[: len(data)], out=self._sums[1:])

    def of(self, start: np.ndarray | slice, end: np.ndarray | slice) -> np.ndarray:
        return _mixed((self._sums[end] - self._sums[start]) * self._down[: len(self._sums)][start])


def segments(data: np.ndarray, valid: np.ndarray, length: int = LENGTH, kmer: int = KMER):
    """(minimizer, hash, first window, last window, whether it may repeat itself) of the segments of ``data``.

    ``valid`` says for each window start whether its window lies in one document.
    Two equal windows of one segment have the minimizer at two places.
    """
    hashes, n = Hashes(data), len(data)
    width = length - kmer + 1  # k-mers of a window, at most 128
    at = np.arange(n - kmer + 1, dtype=np.uint64)
    low = np.uint64(127)
    plain = hashes.of(slice(0, n - kmer + 1), slice(kmer, n + 1)) & ~low
    key = plain | (at & low)
    done = 1
    while 2 * done <= width:
        key = np.minimum(key[:-done], key[done:])
        done *= 2
    if done < width:
        key = np.minimum(key[: len(key) - (width - done)], key[width - done :])
    at = at[: len(key)]
    place = at + ((key - at) & low)
    new = np.concatenate(([True], (place[1:] != place[:-1]) | ~valid[:-1])) & valid
    stop = np.concatenate((place[1:] != place[:-1], [True])) | ~np.concatenate((valid[1:], [False]))
    first, last = np.flatnonzero(new), np.flatnonzero(stop & valid)
    whole = hashes.of(first, last + length) ^ ((last - first).astype(np.uint64) * np.uint64(_MIX[0]))
    lead, here = key[first] & ~low, place[first].astype(np.int64)
    loop = np.zeros(len(first), bool)
    for shift in range(1, int((last - first).max(initial=0)) + 1):
        loop |= (plain[np.minimum(here + shift, len(plain) - 1)] == lead) & (here + shift < len(plain)) & (last - first >= shift)
    return (lead >> np.uint64(7)).view(np.int64), whole.view(np.int64), first, last, loop


_ROW = "p bigint, seg bigint, doc bigint, th int, a int, b int, kind byte"
_NAMES = ["p", "seg", "doc", "th", "a", "b", "kind"]
#: Kinds of rows: a segment to compare; marked windows; a segment to sort; one to take window by window;
#: one to compare that may repeat itself.
SEGMENT, MARKED, SORT, WINDOWS, LOOP = range(5)


def _batch(p, seg, doc, th, a, b, kind) -> pa.RecordBatch:
    doc = doc if isinstance(doc, pa.Array) else pa.array(doc, pa.int64())
    arrays = [pa.array(p, pa.int64()), pa.array(seg, pa.int64()), doc]
    arrays += [pa.array(th, pa.int32()), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(kind, pa.int8())]
    return pa.RecordBatch.from_arrays(arrays, _NAMES)


def _ranges(doc: np.ndarray, start: np.ndarray, stop: np.ndarray):
    """Sorted (document, first, last) ranges with those that touch joined, and the first row of each."""
    if not len(doc):
        return doc, start, stop, np.empty(0, np.int64)
    top = np.maximum.accumulate(stop + doc * (1 << 40)) - doc * (1 << 40)
    new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (start[1:] > top[:-1] + 1)))
    heads = np.flatnonzero(new)
    return doc[heads], start[heads], np.maximum.reduceat(stop, heads), heads


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Chunks of a batch of texts: bytes, valid window starts, and by document its row, place and offset in the text."""
    held, size = [], 0

    def out():
        data = np.concatenate([np.frombuffer(t, np.uint8) for _, t, _ in held])
        rows, offsets = np.array([r for r, _, _ in held]), np.array([o for _, _, o in held])
        sizes = np.array([len(t) for _, t, _ in held])
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        valid = np.ones(len(data), bool)
        for s, e in zip(starts, starts + sizes):
            valid[max(s, e - LENGTH + 1) : e] = False
        return data, valid[: len(data) - LENGTH + 1], rows, starts, offsets

    for row, text in enumerate(batch["text"]):
        text = memoryview(text.as_buffer())
        for offset in range(0, max(1, len(text) - LENGTH + 1), CHUNK):
            part = text[offset : offset + CHUNK + LENGTH - 1]
            if len(part) >= LENGTH:
                held.append((row, part, offset))
                size += len(part)
            if size >= CHUNK:
                yield out()
                held, size = [], 0
    if held:
        yield out()


def _cut(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 1: segments of (doc, th, text) rows."""
    for batch in source:
        found = []
        for data, valid, rows, starts, offsets in _pieces(batch):
            p, seg, first, last, loop = segments(data, valid)
            k = np.searchsorted(starts, first, side="right") - 1
            shift = offsets[k] - starts[k]
            found.append((p, seg, rows[k], first + shift, last + shift, np.where(loop, LOOP, SEGMENT).astype(np.int8)))
        if not found:
            continue
        p, seg, row, a, b, kind = (np.concatenate(x) for x in zip(*found))
        doc = batch["doc"].to_numpy(zero_copy_only=False) if not batch["doc"].null_count else np.array(
            [-(1 << 63) if d is None else d for d in batch["doc"].to_pylist()], np.int64
        )
        th = batch["th"].to_numpy(zero_copy_only=False)
        order = np.lexsort((a, th[row], doc[row], seg))
        p, seg, row, a, b, kind = (x[order] for x in (p, seg, row, a, b, kind))
        same = np.concatenate(([False], seg[1:] == seg[:-1]))
        head = np.maximum.accumulate(np.where(~same, np.arange(len(seg)), 0))
        later = same & ((doc[row] != doc[row[head]]) | (th[row] != th[row[head]]) | (a != a[head]))
        once = ~same
        r = row[once]
        docs = batch["doc"].take(pa.array(r))
        yield _batch(p[once], seg[once], docs, th[r], a[once], b[once], kind[once])
        r, s, e = row[later], a[later], b[later]
        order = np.lexsort((s, r))
        r, s, e, _ = _ranges(r[order], s[order], e[order])
        if len(r):
            spread = _mixed(r.astype(np.uint64) * np.uint64(_BASE) ^ s.astype(np.uint64)).view(np.int64) | (-1 << 63)
            none = np.zeros(len(r), np.int64)
            yield _batch(spread, none, batch["doc"].take(pa.array(r)), th[r], s, e, np.full(len(r), MARKED, np.int8))


def _met(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 2: rows sorted by minimizer, segment hash, document and place; a minimizer may cross batches."""
    held: pa.Table | None = None
    crowded = None  # a minimizer whose rows go window by window as they come

    def settled(table: pa.Table) -> Iterator[pa.RecordBatch]:
        p, seg, kind = (table[c].to_numpy() for c in ("p", "seg", "kind"))
        marked, n = kind == MARKED, len(p)
        new_p = np.concatenate(([True], p[1:] != p[:-1]))
        new_s = new_p | np.concatenate(([True], seg[1:] != seg[:-1]))
        head = np.maximum.accumulate(np.where(new_s, np.arange(n), 0))
        doc = table["doc"].fill_null(-(1 << 63)).to_numpy()
        th, a = table["th"].to_numpy(), table["a"].to_numpy()
        later = marked | ~new_s & ((doc != doc[head]) | (th != th[head]) | (a != a[head]))
        first = np.flatnonzero(new_p)
        different = np.repeat(np.add.reduceat(new_s.astype(np.int64), first), np.diff(np.append(first, n)))
        keep = later | new_s & ((different > 1) | (kind == LOOP))
        if keep.any():
            kinds = np.where(later, MARKED, np.where(different > DIRECT, WINDOWS, SORT)).astype(np.int8)
            yield from _of_kind(table.filter(pa.array(keep)), kinds[keep])

    for batch in source:
        table = pa.Table.from_batches([batch]).select(_NAMES)
        if crowded is not None:
            same = int(np.searchsorted(table["p"].to_numpy(), crowded, side="right"))
            yield from _of_kind(table.slice(0, same), np.full(same, WINDOWS, np.int8))
            table = table.slice(same)
            if not table.num_rows:
                continue
            crowded = None
        table = pa.concat_tables([held, table]) if held is not None else table
        if not table.num_rows:
            continue
        p = table["p"].to_numpy()
        cut = int(np.searchsorted(p, p[-1]))
        if cut:
            yield from settled(table.slice(0, cut))
        held = table.slice(cut)
        if held.num_rows > CROWD:
            crowded = int(p[-1])
            yield from _of_kind(held, np.full(held.num_rows, WINDOWS, np.int8))
            held = None
    if held is not None and held.num_rows:
        yield from settled(held)


def _of_kind(table: pa.Table, kinds: np.ndarray) -> Iterator[pa.RecordBatch]:
    if table.num_rows:
        yield from table.set_column(6, "kind", pa.array(kinds)).combine_chunks().to_batches()


_TEXTS = "kind byte, p bigint, seg bigint, doc bigint, th int, a int, body binary"


def _fetched(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 3: the bytes of wanted segments, or the hashes of their windows."""
    names = ["kind", "p", "seg", "doc", "th", "a", "body"]
    kinds = [pa.int8(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    held = []
    for batch in source:
        for text, doc, th, wanted in zip(*(batch[c] for c in ("text", "doc", "th", "wanted"))):
            text, doc, th = text.as_py(), doc.as_py(), th.as_py()
            for w in wanted.as_py():
                a, b = w["a"], w["b"]
                body = text[a : b + LENGTH]
                if w["kind"] == SORT:
                    held.append((SORT, w["p"], 0, doc, th, a, body))
                    continue
                for k in range(b - a + 1):
                    digest = hashlib.blake2b(body[k : k + LENGTH], digest_size=16).digest()
                    one, two = (int.from_bytes(x, "little", signed=True) for x in (digest[:8], digest[8:]))
                    held.append((WINDOWS, one, two, doc, th, a + k, None))
                if len(held) > 20_000:
                    yield out(held)
                    held = []
            if len(held) > 20_000:
                yield out(held)
                held = []
    if held:
        yield out(held)


def sorted_suffixes(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, length, common prefix with the one before) of all suffixes, sorted.

    Column by column: the transform holds for each suffix so far the symbol
    before it. Sorting the transform stably tells where each suffix with one more
    symbol belongs; its common prefix with a neighbour is one more than that of
    the shorter suffixes, the least of all common prefixes between the two.
    """
    m = len(strings)
    sizes = np.array([len(s) for s in strings], np.int64)
    begins = np.concatenate(([0], np.cumsum(sizes)))
    data = np.frombuffer(b"".join(strings), np.uint8)
    wide = np.uint8 if not len(data) or data.max() < 255 else np.uint16
    symbols = np.concatenate((data.astype(wide) + wide(1), [wide(0)]))

    def before(string: np.ndarray, length: int) -> np.ndarray:
        """The symbol before the suffix of a length, 0 where the suffix is the whole string."""
        at = begins[string + 1] - length - 1
        return np.where(length < sizes[string], symbols[at], 0).astype(wide)

    small = np.uint8 if sizes.max(initial=0) < 256 else np.int32
    who = np.arange(m, dtype=np.int32)
    bwt = before(who, 0)
    prefix, longs = np.zeros(m, small), np.zeros(m, small)
    place = np.arange(m)  # of each string's longest suffix so far
    for length in range(1, int(sizes.max(initial=0)) + 1):
        active = np.flatnonzero(sizes >= length)
        n = len(bwt)
        order = np.argsort(bwt, kind="stable")
        ended = m - len(active)
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n)
        mine = rank[place[active]]
        # Common prefixes anew for the added suffixes and the ones right after them.
        added = np.zeros(n + 1, bool)
        added[mine] = True
        redo = np.flatnonzero(added[:-1] | np.concatenate(([False], added[:-2])))
        redo = redo[redo >= ended]
        left, right = order[np.maximum(redo, 1) - 1], order[redo]
        joint = (bwt[left] == bwt[right]) & (redo > ended)
        fresh = np.zeros(len(redo), small)
        if joint.any():
            lo, hi = left[joint] + 1, right[joint] + 1
            by = np.argsort(lo, kind="stable")
            bounds = np.stack((lo[by], hi[by]), 1).ravel()
            least = np.minimum.reduceat(np.append(prefix, small(0)), bounds)[::2]
            value = np.empty(len(by), small)
            value[by] = least
            fresh[joint] = value + small(1)
        new = mine - ended + m
        size = n + len(active)
        kept = np.ones(size, bool)
        kept[new] = False
        spread = lambda old, kind: np.zeros(size, kind)
        bwt_, prefix_, who_, longs_ = (spread(x, x.dtype) for x in (bwt, prefix, who, longs))
        bwt_[kept], prefix_[kept], who_[kept], longs_[kept] = bwt, prefix, who, longs
        bwt_[new], who_[new], longs_[new] = before(active, length), active, length
        prefix_[redo - ended + m] = fresh
        bwt, prefix, who, longs = bwt_, prefix_, who_, longs_
        place[active] = new
    return who, longs.astype(np.int64), prefix.astype(np.int64)


def _repeats(strings: list[bytes], document: np.ndarray, start: np.ndarray, length: int):
    """(document, window start) of all windows that equal an earlier one; documents are numbered in their order."""
    who, size, prefix = sorted_suffixes(strings)
    same = np.concatenate(([False], (prefix[1:] >= length) & (size[1:] >= length) & (size[:-1] >= length)))
    head = np.flatnonzero(~same)
    ends = start + np.array([len(s) for s in strings])
    key = document[who] * (1 << 40) + (ends[who] - size)
    key[size < length] = np.iinfo(np.int64).max
    least = np.repeat(np.minimum.reduceat(key, head), np.diff(np.append(head, len(key))))
    later = np.unique(key[(key > least) & (size >= length)])
    return later >> 40, later & ((1 << 40) - 1)


def _compared(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 3: segments sorted by minimizer, in collections of whole minimizers."""
    held: list[tuple] = []

    def marked() -> Iterator[pa.RecordBatch]:
        docs = sorted({(d is not None, d or 0, th) for _, d, th, _, _ in held})
        number = {d: k for k, d in enumerate(docs)}
        document = np.array([number[d is not None, d or 0, th] for _, d, th, _, _ in held], np.int64)
        start = np.array([a for *_, a, _ in held], np.int64)
        d, s = _repeats([body for *_, body in held], document, start, LENGTH)
        d, s, e, _ = _ranges(d, s, s)
        if len(d):
            ids = [docs[k][1] if docs[k][0] else None for k in d]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([docs[k][2] for k in d], pa.int32()),
                 pa.array(s, pa.int32()), pa.array(e, pa.int32())], ["doc", "th", "a", "b"],
            )

    for batch in source:
        for row in zip(*(batch[c].to_pylist() for c in ("p", "doc", "th", "a", "body"))):
            if len(held) >= COLLECTION and row[0] != held[-1][0]:
                yield from marked()
                held.clear()
            held.append(row)
    if held:
        yield from marked()


def marked_windows(docs: DataFrame) -> DataFrame:
    """(doc, th, a, b): windows a to b of a document start a string that also starts earlier.

    ``docs`` has (doc, th, text as bytes), where th tells rows of one id apart.
    """
    rows = (
        docs.mapInArrow(_cut, _ROW)
        .repartition("p")
        .sortWithinPartitions("p", "seg", "doc", "th", "a")
        .mapInArrow(_met, _ROW)
    )
    met = landed(rows, "segments")
    wanted = (
        met.where(F.col("kind").isin(SORT, WINDOWS))
        .groupBy("doc", "th")
        .agg(F.collect_list(F.struct("p", "a", "b", "kind")).alias("wanted"))
        .select(F.col("doc").alias("doc_"), F.col("th").alias("th_"), "wanted")
    )
    match = docs.doc.eqNullSafe(F.col("doc_")) & (docs.th == F.col("th_"))
    fetched = landed(docs.join(wanted, match).select("doc", "th", "text", "wanted").mapInArrow(_fetched, _TEXTS), "fetched")
    compared = (
        fetched.where(F.col("kind") == SORT)
        .select("p", "doc", "th", "a", "body")
        .repartition("p")
        .sortWithinPartitions("p")
        .mapInArrow(_compared, "doc bigint, th int, a int, b int")
    )
    windows = fetched.where(F.col("kind") == WINDOWS).select("p", "seg", F.struct("doc", "th", "a").alias("at"))
    first = windows.groupBy("p", "seg").agg(F.min("at").alias("first"))
    single = windows.join(first, ["p", "seg"]).where("at > first").select("at.doc", "at.th", "at.a", F.col("at.a").alias("b"))
    return met.where(F.col("kind") == MARKED).select("doc", "th", "a", "b").unionByName(compared).unionByName(single)


def removed(text: bytes, marks: list[dict] | None, length: int = LENGTH) -> tuple[bytes, list[tuple[int, int]]]:
    """What stays of a text, and the maximal removed runs."""
    runs: list[tuple[int, int]] = []
    for a, b in sorted((m["a"], m["b"]) for m in marks or ()):
        if runs and a <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(runs[-1][1], b + length))
        else:
            runs.append((a, b + length))
    parts, at = [], 0
    for start, end in runs:
        parts.append(text[at:start])
        at = end
    return b"".join(parts) + text[at:], runs


def deduplicated(documents: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, rest, runs) of every row of (doc_id, text).

    ``rest`` is the text as bytes without its repeats, ``runs`` the maximal
    removed runs in bytes.
    """
    docs = documents.select(F.col("doc_id").alias("doc"), F.hash("text").alias("th"), utf8("text").alias("text"))
    marks = (
        marked_windows(docs)
        .groupBy("doc", "th")
        .agg(F.collect_list(F.struct("a", "b")).alias("marks"))
        .select(F.col("doc").alias("doc_"), F.col("th").alias("th_"), "marks")
    )
    found = docs.join(marks, docs.doc.eqNullSafe(F.col("doc_")) & (docs.th == F.col("th_")), "left")

    def rest(text: bytes, marks: list[dict] | None) -> dict:
        kept, runs = removed(text, marks)
        return {"rest": kept, "runs": [{"start": a, "end": b} for a, b in runs]}

    kind = "struct<rest:binary, runs:array<struct<start:bigint, end:bigint>>>"
    return found.select(
        F.col("doc").alias("doc_id"), F.length("text").cast("bigint").alias("n_bytes"), per_row(rest, kind)("text", "marks").alias("r")
    ).select("doc_id", "n_bytes", "r.*")
