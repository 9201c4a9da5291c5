import random
import re
from collections import Counter

import corpus_pipeline
import pyarrow.parquet as pq

from lodgeflow.llm import quality_cascade, queries

SF = "/root/testdata/sf0.001"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    n = len(words)
    windows = Counter(tuple(words[k : k + 3]) for k in range(n - 2))
    repeated = {k + d for k in range(n - 2) if windows[tuple(words[k : k + 3])] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(x in lines[:k] for k, x in enumerate(lines))
    failed = n < 50 or 100 * len(repeated) > 50 * n
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return n, sum(map(len, words)), symbols, dup, len(repeated), failed


def test_query_equals_brute_force(spark):
    t = pq.read_table(f"{SF}/documents.parquet").to_pydict()
    got = {r[0]: r for r in queries.op4_quality(spark, SF).collect()}
    assert len(got) == len(t["doc_id"])
    for doc, text in zip(t["doc_id"], t["text"]):
        row = got[doc]
        assert tuple(row)[1:7] == brute(text)
        assert not (row.base_failed and row.kept)


def test_verdicts_agree_with_the_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = pq.read_table(f"{sf}/labels.parquet").to_pydict()
    quality = dict(zip(labels["doc_id"], labels["quality"]))
    judged = [(quality[r.doc_id], r) for r in queries.op4_quality(spark, sf).collect() if r.doc_id in quality]
    assert all(r.kept for q, r in judged if q == 1 and not r.base_failed)
    assert not any(r.kept for q, r in judged if q == 0)


def test_edge_rows(docs, rows):
    prose = " ".join(f"plain{k} words" for k in range(60))
    texts = [
        None, "", " \n\t\n", "a", "a b c", "a b c a b c", "x\n\nx\n x\nx", "  é ü #|", prose,
        prose.upper(), "## " + prose.replace(" ", " # "), "same line here\n" * 40, "a " * 200_000,
        " ".join(f"{k:06d}" for k in range(100)), " ".join(f"w{k}q" for k in range(120_000)),
    ]
    table = docs(*enumerate(texts), (0, None))
    got = quality_cascade.judged(table).select("doc_id", "quality.*", "word").collect()
    assert len(got) == len(texts) + 1
    for row in got:
        assert tuple(row)[1:7] == brute(texts[row.doc_id])
        assert row.kept == (row.doc_id in (8, 14))
    assert quality_cascade.judged(docs()).collect() == []


def test_order_changes_no_verdict(docs):
    table = docs((1, "plain words " * 30), (2, " ".join(f"w{k} #" for k in range(60))))
    names = list(quality_cascade.RULES)
    verdicts = [
        [r.quality.kept for r in quality_cascade.judged(table, order=o).collect()]
        for o in (names, names[::-1])
    ]
    assert verdicts[0] == verdicts[1]
    assert sorted(quality_cascade.planned(table)) == sorted(names)


def test_junk_of_few_words_at_both_sides_of_5000(docs):
    rng = random.Random(3)
    junk = lambda n: " ".join(f"junk{rng.randrange(50)}" for _ in range(n))
    prose = lambda n: " ".join(f"plain{rng.randrange(3000)}" for _ in range(n))
    table = docs(*enumerate([junk(4999), junk(5000), junk(20_000), prose(4999), prose(5000), prose(60_000)]))
    every = quality_cascade.judged(table, rules=quality_cascade.ALL_LENGTHS)
    assert {r.doc_id for r in every.collect() if r.quality.kept} == {3, 4, 5}
    kept = corpus_pipeline.quality_rules(table.sparkSession, table, "")
    assert {r.doc_id for r in kept.collect()} == {3, 4, 5}
    sql = quality_cascade.judged(table).collect()  # as the SQL counterpart has it
    assert {r.doc_id: r.quality.kept for r in sql}[0] is False


def test_the_verdict_alone_is_the_same(docs, monkeypatch):
    """In any order, and without counting what no rule has asked for."""
    rng = random.Random(8)
    texts = [None, "", "a b", "a " * 200_000]
    for _ in range(60):
        pool = ["plain", "words", "HERE", "12345", "#", "*|*", "x"] + [f"w{k}" for k in range(rng.choice([3, 40, 400]))]
        texts.append(rng.choice([" ", "\n"]).join(rng.choice(pool) for _ in range(rng.randrange(30, 400))))
    table = docs(*enumerate(texts))
    want = {r.doc_id: r.quality.kept for r in quality_cascade.judged(table).collect()}
    assert 0 < sum(want.values()) < len(want)
    names = list(quality_cascade.CASCADE)
    for order in (None, names, names[::-1]):
        assert {r.doc_id: r.ok for r in quality_cascade.kept(table, "ok", order).collect()} == want
    counted = []
    monkeypatch.setattr(quality_cascade, "_repeated", lambda words: counted.append(1) or 0)
    c = quality_cascade.Counts(b"# " * 99)
    assert any(quality_cascade.CASCADE[name](c) for name in ("symbols", "repetitive")) and not counted
