import re
import struct
from collections import defaultdict

import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F

from lodgeflow.llm import mixing, queries

SF = "/root/testdata/sf0.001"


def brute_draw(doc):
    seed = 42
    if doc is not None:
        seed = xxhash.xxh64_intdigest(struct.pack("<q", doc), seed)
    return (xxhash.xxh64_intdigest(struct.pack("<i", mixing.SEED), seed) >> 11) / (1 << 53)


def brute(docs):
    """(doc_id, cell, tokens, probability, sampled) of (doc_id, source, lang, text) rows."""
    rows = []
    for doc, source, lang, text in docs:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        bars = (text or "").count("|")
        form = "blank" if not n else "table" if bars * 10 > n else "note" if n < 150 else "article" if n < 600 else "report"
        rows.append((doc, (source or "", lang or "", form), n))
    tokens = defaultdict(int)
    for _, cell, n in rows:
        tokens[cell] += n
    targets = []
    for d in range(3):
        sums = defaultdict(int)
        for cell, n in tokens.items():
            sums[cell[d]] += n
        powers = {v: n**mixing.TEMPER for v, n in sums.items() if n}
        targets.append({v: p / sum(powers.values()) for v, p in powers.items()})
    weight = {c: float(n) for c, n in tokens.items()}
    for _ in range(300):
        for d in range(3):
            sums = defaultdict(float)
            for cell, w in weight.items():
                sums[cell[d]] += w
            weight = {c: w * targets[d].get(c[d], 0) / sums[c[d]] if sums[c[d]] else 0.0 for c, w in weight.items()}
    rate = {c: weight[c] / n if n else 0.0 for c, n in tokens.items()}
    top = max(rate.values(), default=0)
    return [(doc, cell, n, rate[cell] / top if top else 0.0) for doc, cell, n in rows]


def agree(got, want):
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    got = sorted(((r.doc_id, (r.source, r.lang, r.topic), r.n_tokens, r.probability, r.sampled) for r in got), key=key)
    want = sorted(want, key=key)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    for g, w in zip(got, want):
        assert g[3] == pytest.approx(w[3], abs=1e-3)
        assert abs(brute_draw(g[0]) - g[3]) < 1e-9 or g[4] == (brute_draw(g[0]) < g[3])


def test_query_equals_brute_force(spark):
    t = pq.read_table(f"{SF}/documents.parquet").to_pydict()
    agree(queries.op6_mixing(spark, SF).collect(), brute(list(zip(t["doc_id"], t["source"], t["lang"], t["text"]))))


def test_marginals_meet_their_targets(spark):
    cells = spark.createDataFrame(
        [(f"s{s}", l, t, 1 + (s * 7 + k * 3) % 11) for s in range(4) for k, (l, t) in enumerate([("a", "x"), ("a", "y"), ("b", "x"), ("b", "y")])],
        "source string, lang string, topic string, tokens bigint",
    )
    table = lambda shares: spark.createDataFrame(list(shares.items()), "value string, share double")
    want = {"source": {"s0": 4.0, "s1": 3.0, "s2": 2.0, "s3": 1.0, "none": 5.0}, "lang": {"a": 0.3, "b": 0.7}, "topic": {"x": 0.5, "y": 0.5}}
    out = mixing.raked(cells, {d: table(s) for d, s in want.items()})
    del want["source"]["none"]
    for dimension, shares in want.items():
        got = {r[0]: r[1] for r in out.groupBy(dimension).agg(F.sum("weight")).collect()}
        total = sum(shares.values())
        assert got == pytest.approx({v: s / total for v, s in shares.items()}, abs=1e-5)
    top = mixing.probabilities(out).agg(F.max("probability")).first()[0]
    assert top == pytest.approx(1)


def test_edge_rows(spark):
    rows = [(1, None, None, None), (2, "", "", ""), (3, "a", "en", " \n"), (4, "a", "en", "one two"), (4, "a", "en", "one two"), (None, "b", "de", "x | y | z"), (6, "b", "de", "w " * 50_000)]
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id bigint, source string, lang string, text string, topic string, weight string")
    measured = mixing.measured(table)
    agree(mixing.mixed(measured, mixing.planned(measured)).collect(), brute(rows))
    empty = mixing.measured(table.limit(0))
    assert mixing.mixed(empty, mixing.planned(empty)).collect() == []
