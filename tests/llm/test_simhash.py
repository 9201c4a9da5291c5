import random
import re

import numpy as np
import pyarrow.parquet as pq
import xxhash

from lodgeflow.llm import queries, simhash

SF = "/root/testdata/sf0.001"


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute(pairs):
    prints = [brute_print(t) for _, t in pairs]
    root = list(range(len(pairs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(pairs)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(pairs):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(
        ((i, f"{prints[k]:016x}", least.get(find(k))) for k, (i, _) in enumerate(pairs)), key=repr
    )


def test_query_equals_brute_force(spark, rows):
    table = pq.read_table(f"{SF}/documents.parquet").to_pydict()
    assert rows(queries.op8_simhash(spark, SF)) == brute(list(zip(table["doc_id"], table["text"])))


def test_edge_rows(docs, rows):
    pairs = [
        (5, None), (6, ""), (7, " \n\t"), (8, "One"), (9, "one"), (10, "a b"), (11, "A  B"),
        (12, " x y z"), (12, " x y z"), (None, "lone words here"), (13, "a b c " * 30000),
    ]
    got = simhash.near_duplicates(docs(*pairs)).drop("root")
    want = brute(pairs)
    assert sorted(((i, f"{f & (1 << 64) - 1:016x}", c) for i, f, c in got.collect()), key=repr) == want
    assert simhash.near_duplicates(docs()).collect() == []


def test_links_of_a_dense_cluster_keep_its_components(spark):
    random.seed(1)
    values = set()
    for _ in range(40):
        base = random.getrandbits(64)
        values |= {base ^ sum(1 << random.randrange(64) for _ in range(3)) for _ in range(30)}
    values = sorted(values)
    signed = [(simhash._signed(v & (1 << 64) - 1),) for v in values]
    nodes = spark.createDataFrame(signed, "fp bigint").distinct()
    got = {}
    for node, root in simhash.components(simhash.links(nodes)).collect():
        got.setdefault(root, set()).add(node)
    flat = [v for (v,) in set(signed)]
    group = {v: {v} for v in flat}
    for a in flat:
        for b in flat:
            if a != b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 3 and group[a] is not group[b]:
                group[a] |= group[b]
                for x in group[b]:
                    group[x] = group[a]
    want = {frozenset(g) for g in group.values() if len(g) > 1}
    assert {frozenset(g) for g in got.values()} == want


def test_large_block_groups_are_split(monkeypatch):
    values = np.unique(np.array([random.getrandbits(12) for _ in range(600)], np.uint64))
    whole = simhash._forest(values, 3)
    monkeypatch.setattr(simhash, "DIRECT", 10)
    parts = simhash._group_edges(values, 3)
    assert len({x for e in parts for x in e}) == len({x for e in whole for x in e})


def test_a_hot_block_is_split_by_its_other_bits(spark):
    """20,000 different fingerprints with equal lower halves, in chains of two bits' distance and alone."""
    rng = np.random.default_rng(4)
    upper = np.unique(rng.integers(0, 2**32, 10_000, dtype=np.uint64))
    near = upper ^ np.uint64(0b11 << 7)
    values = np.unique(np.concatenate([upper, near])) << np.uint64(32) | np.uint64(77)

    def parts(edges):
        root = {int(v): int(v) for v in values}

        def find(v):
            while root[v] != v:
                root[v] = v = root[root[v]]
            return v

        for a, b in edges:
            root[max(find(int(a)), find(int(b)))] = min(find(int(a)), find(int(b)))
        return {v: find(v) for v in root}

    want = parts(simhash._forest(values, 3))
    assert parts(simhash._group_edges(values, 3, range(32, 64))) == want
    table = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp bigint")
    found = simhash.links(table).collect()
    assert parts([(a % 2**64, b % 2**64) for a, b in found]) == want
    assert len(set(want.values())) < len(values) * 0.6
