"""SimHash near-duplicates by pigeonhole blocks.

A text's fingerprint has bit b set when more than half of its shingle hashes
have it. Two fingerprints that differ in at most ``distance`` bits agree in
``BLOCKS - distance`` of ``BLOCKS`` blocks; every fingerprint is dealt to each
choice of that many blocks, and those that meet there are compared bit by bit.

Equal fingerprints are one node from the start, so a group of exact copies costs
one row. Within a block group only the edges of a spanning forest are returned,
never all pairs: a forest has the same components.

Defined cases: a null text, like a text of spaces, has no words and the
fingerprint zero, which links like any other; a text of one or two words has one
shingle; a null id counts in no component's smallest id; repeated rows come back
repeated; an empty table gives an empty table. A very long text is one row's
shingles, whose hashes are counted in pieces. Other columns of the input are not
read, and stay with the representatives.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeflow.llm.common import fresh, landed, map_rows, per_row, utf8

SEED = 42
BLOCKS = 6
#: Block groups above this size are split by their other bits before comparison.
DIRECT = 1024


def fingerprint(text: bytes, words_per_shingle: int = 3) -> int:
    """The 64-bit fingerprint of a UTF-8 text, as an unsigned number."""
    words = text.lower().split()  # on bytes: A-Z, and exactly x20 and x09-x0D
    if not words:
        return 0
    if len(words) < words_per_shingle:
        words, words_per_shingle = [b" ".join(words)], 1
    shingles = map(b" ".join, zip(*(words[i:] for i in range(words_per_shingle))))
    n = len(words) - words_per_shingle + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for start in range(0, n, 1 << 15):
        part = hashes[start : start + (1 << 15)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return sum(1 << b for b in range(64) if 2 * counts[b] > n)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, words_per_shingle: int = 3) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed long."""

    def rows(ids, texts):
        return ((i, _signed(fingerprint(t, words_per_shingle))) for i, t in zip(ids, texts))

    return map_rows(docs.select("doc_id", utf8("text")), rows, "doc_id bigint, fp bigint")


def _masks(distance: int) -> list[int]:
    """One mask for each choice of blocks that two linked fingerprints may share."""
    edges = [round(64 * i / BLOCKS) for i in range(BLOCKS + 1)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [_signed(sum(c)) for c in combinations(blocks, BLOCKS - distance)]


def _forest(values: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links among distinct uint64 values."""
    edges, rest = [], values
    while len(rest):
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            at = frontier.pop()
            near = np.bitwise_count(rest ^ at) <= distance
            if near.any():
                found = rest[near]
                edges += [(at, x) for x in found]
                frontier += list(found)
                rest = rest[~near]
    return edges


def _group_edges(values: np.ndarray, distance: int, bits: Sequence[int] = range(64)) -> list[tuple[int, int]]:
    """Edges that link what is within ``distance`` among values that agree in all bits but ``bits``.

    Large groups are split by pigeonhole again: of ``distance + 1`` parts of the
    bits, one is equal. A part that a quarter of the values or more agree in holds
    near copies, which a split would only repeat and a forest takes away at once.
    """
    if len(values) <= DIRECT or len(bits) <= distance:
        return _forest(values, distance)
    edges = []
    for k in range(distance + 1):
        part = bits[k :: distance + 1]
        mask = np.uint64(sum(1 << b for b in part))
        rest = [b for b in bits if b not in part]
        key = values & mask
        order = np.argsort(key, kind="stable")
        for group in np.split(values[order], np.flatnonzero(np.diff(key[order])) + 1):
            if 4 * len(group) > len(values):
                edges += _forest(group, distance)
            elif len(group) > 1:
                edges += _group_edges(group, distance, rest)
    return edges


def links(distinct: DataFrame, distance: int = 3) -> DataFrame:
    """(a, b) over distinct fingerprints: edges whose components are those of all links."""
    if not 0 <= distance < BLOCKS:
        raise ValueError(f"distance must be between 0 and {BLOCKS - 1}")
    shared = [F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(m)).alias("block")) for i, m in enumerate(_masks(distance))]
    dealt = (
        distinct.select("fp", F.explode(F.array(*shared)).alias("key"))
        .select(F.col("key.i").alias("i"), F.col("key.block").alias("block"), "fp")
        .repartition("i", "block")
        .sortWithinPartitions("i", "block")
    )

    free = [[b for b in range(64) if not (mask >> b) & 1] for mask in _masks(distance)]

    def met(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs of equal keys, gathered over batches until the next key begins."""
        key, held = None, []

        def edges(groups: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
            found = [e for i, values in groups if len(values) > 1 for e in _group_edges(values, distance, free[i])]
            array = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(array[:, 0]), pa.array(array[:, 1])], ["a", "b"])

        for batch in source:
            if not batch.num_rows:
                continue
            i, block, fp = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            fp = fp.view(np.uint64)
            cuts = np.flatnonzero((np.diff(i) != 0) | (np.diff(block) != 0)) + 1
            bounds = np.concatenate(([0], cuts, [len(fp)]))
            first, last = (int(i[0]), int(block[0])), (int(i[-1]), int(block[-1]))
            groups, start = [], 0
            if key == first:
                held.append(fp[: bounds[1]])
                start = 1
            if key is not None and (key != first or len(bounds) > 2):
                groups.append((key[0], np.concatenate(held)))
                key = None
            if start < len(bounds) - 1:  # the batch's last run waits for the next batch
                whole = np.flatnonzero(np.diff(bounds)[start:-1] > 1) + start
                groups += [(int(i[bounds[k]]), fp[bounds[k] : bounds[k + 1]]) for k in whole]
                key, held = last, [fp[bounds[-2] :].copy()]
            if groups:
                yield edges(groups)
        if key is not None:
            yield edges([(key[0], np.concatenate(held))])

    return dealt.mapInArrow(met, "a bigint, b bigint").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge, by alternating star contraction.

    Each round hangs every node's neighbours on the smallest of them, first the
    larger ones, then the smaller ones; the number of rounds grows with the
    logarithm of the longest path. Each round is written before the next.
    """
    edges = landed(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = landed(small.unionByName(least.withColumnRenamed("m", "b")).where("a <> b").distinct(), "edges")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def near_duplicates(docs: DataFrame, distance: int = 3, words_per_shingle: int = 3) -> DataFrame:
    """(doc_id, fp, component_id, root) for every row of ``docs`` (doc_id, text).

    ``root`` names the component by its smallest fingerprint, ``component_id`` by
    its smallest id.
    """
    prints = landed(fingerprints(docs, words_per_shingle), "fingerprints")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    joined = components(links(nodes.select("fp"), distance))
    named = nodes.join(joined, nodes.fp == joined.node, "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root")
    )
    # Grouped by a key of its own, so that the join on a large component's root can be split.
    least = named.groupBy(F.struct("root").alias("of")).agg(F.min("least_id").alias("component_id")).select(
        "of.root", "component_id"
    )
    return prints.join(named.join(least, "root").select("fp", "component_id", "root"), "fp").select(
        "doc_id", "fp", "component_id", "root"
    )


def representatives(docs: DataFrame, distance: int = 3, words_per_shingle: int = 3) -> DataFrame:
    """One row of ``docs`` for each component: the smallest id, any of equal rows.

    An id counts as larger where it is null.
    """
    found = near_duplicates(docs, distance, words_per_shingle)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "fp")).alias("first")
    key = [fresh(docs, name) for name in ("_id", "_no_id", "_fp")]

    def keyed(doc_id: Column, fp: Column) -> list[Column]:
        return [c.alias(k) for c, k in zip((F.coalesce(doc_id, F.lit(0)), doc_id.isNull(), fp), key)]

    kept = found.groupBy("root").agg(first).select(*keyed(F.col("first.doc_id"), F.col("first.fp")))
    fp = per_row(lambda t: _signed(fingerprint(t, words_per_shingle)), "bigint")(utf8("text"))
    printed = docs.select("*", *keyed(F.col("doc_id"), fp))
    # Repeated rows meet in the partitions of the join; the texts are shuffled once.
    return printed.join(kept, key, "left_semi").dropDuplicates(key).select(*docs.columns)
