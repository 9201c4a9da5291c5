import hashlib
import random
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lodgeflow.llm import decontam, queries

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=13):
    windows = {}
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - window + 1)) if w else ():
            windows.setdefault(tuple(w[k : k + window]), set()).add(item)
    sizes = {len(x) for x in windows}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                if (x := tuple(w[k : k + size])) in windows:
                    hit |= set(range(k, k + size))
                    found |= windows[x]
        joined = ",".join(sorted(map(str, found)))
        digest = hashlib.sha256(joined.encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def pairs(name, key):
    t = pq.read_table(f"{SF}/{name}.parquet").to_pydict()
    return list(zip(t[key], t["text"]))


def test_query_equals_brute_force(spark, rows):
    want = brute(pairs("documents", "doc_id"), pairs("benchmark", "item_id"))
    assert rows(queries.op7_decontam(spark, SF)) == want
    assert any(r[5] for r in want) and not all(r[5] for r in want)


@pytest.mark.parametrize("limit", [200_000, 40])
def test_random_words_and_edges(spark, docs, rows, monkeypatch, limit):
    """Small alphabets, short and repeated items, one block of items and many."""
    monkeypatch.setattr(decontam, "MAX_BLOCK_WORDS", limit)
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice("ab") for _ in range(n))
    items = [(k, text(rng.choice([3, 5, 8, 13, 20, 30]))) for k in range(25)]
    items += [(90, None), (91, ""), (92, items[0][1]), (93, "Ünï-cöde Ünï")]
    texts = [text(rng.randrange(60)) for _ in range(60)] + [items[5][1] + " zz " + items[6][1]]
    pairs_ = list(enumerate(texts)) + [
        (200, None), (201, ""), (202, "..."), (203, "ünï! cöde, ünï"), (0, texts[0]), (None, texts[1]),
    ]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, doc_id string")
    found = decontam.with_hits(docs(*pairs_), bench, "hits")
    items_ = F.array_sort(F.transform("hits.items", lambda i: i.cast("string")))
    got = found.select(
        "doc_id", "hits.n_words", decontam.n_hit("hits"), F.size("hits.items"),
        F.sha2(F.concat_ws(",", items_), 256), decontam.contaminated("hits"),
    )
    assert rows(got) == brute(pairs_, items)


def test_spans_are_cut(spark, docs):
    item = " ".join(f"w{k}" for k in range(15))
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    table = docs((1, f"Keep this. {item.upper()}, and that."), (2, "only this"))
    found = decontam.with_hits(table, bench, "hits")
    cut = decontam.without_spans(found, "hits", 13, 20).select("doc_id", "text").collect()
    assert {tuple(r) for r in cut} == {(1, "Keep this. and that."), (2, "only this")}


def test_empty_tables(spark, docs):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert decontam.with_hits(docs(), bench, "hits").collect() == []
    (row,) = decontam.with_hits(docs((1, "a b")), bench, "hits").collect()
    assert (row.hits.n_words, row.hits.spans, row.hits["items"]) == (2, [], [])


def test_no_plan_holds_more_than_one_block(spark, docs, rows, plan, monkeypatch):
    """Many blocks: each has a pass of its own, and only documents with hits are written for it."""
    items = [(k, f"alpha{k} beta{k} gamma{k}") for k in range(6)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    table = docs(*[(k, f"x alpha{k} beta{k} gamma{k} alpha0 beta0 gamma0") for k in range(6)], (6, "clean"), (6, "clean"), (None, None))
    want = rows(decontam.with_hits(table, bench, "hits").select("doc_id", "hits"))
    landed, seen = decontam.landed, []
    monkeypatch.setattr(decontam, "landed", lambda df, label: seen.append((label, plan(df), landed(df, label))) or seen[-1][2])
    monkeypatch.setattr(decontam, "MAX_BLOCK_WORDS", 3)
    found = decontam.with_hits(table, bench, "hits")
    assert [label for label, _, _ in seen] == ["numbered"] + ["hits"] * 6
    assert all(text.count("ArrowEvalPython") <= 1 for _, text, _ in seen) and plan(found).count("ArrowEvalPython") <= 1
    assert [out.count() for _, _, out in seen[1:]] == [9, 1, 1, 1, 1, 1]
    assert rows(found.select("doc_id", "hits")) == want and found.columns == [*table.columns, "hits"]
