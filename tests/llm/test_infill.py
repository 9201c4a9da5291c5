import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodgeflow.llm import infill


def brute(doc, text):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    digest = hashlib.sha256(f"7:{doc}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 50:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def texts():
    rng = random.Random(9)
    out = [None, "", "\n", "\n\n\n", "one", "one\n", "a<P>b\nc", "x<S>", "<M>", "<\n<P", "P>\n<S", "ü\n€\n😀 tail", "\r\n x\x00\n"]
    shared = "".join(rng.choice("abcdefgh \n") for _ in range(5000))
    for k in range(40):
        own = "".join(rng.choice("äöü€😀ab \n") for _ in range(rng.randrange(3000)))
        out.append(own + shared + own[:k])
    return out + ["\n" * 5000, "a" * 20_000, "ab\n" * 4000, shared, shared]


@pytest.mark.parametrize("stretch, memo", [(4 << 20, 32 << 20), (100, 2000)])
def test_outputs_and_round_trip(spark, docs, monkeypatch, stretch, memo):
    """Against plain splitting; hashing in stretches and a memo that forgets change nothing."""
    monkeypatch.setattr(infill, "_STRETCH", stretch)
    known = infill.Memo(memo)
    rows = list(enumerate(texts()))
    for doc, text in rows:
        found = infill.infilled(doc, text, known)
        assert tuple(found.values()) == brute(doc, text)
    assert known.size <= memo and known.size == sum(infill._weight(*x) for x in known.known.values())


def test_columns(spark, docs):
    rows = list(enumerate(texts())) + [(3, "again\nand again\n"), (None, "no id\nat all\n")]
    out = infill.with_infill(docs(*rows)).withColumn("back", infill.text_of("infill"))
    assert set(docs(*rows).columns) < set(out.columns) and out.count() == len(rows)
    for r in out.collect():
        want = brute("" if r.doc_id is None else r.doc_id, r.text)
        assert tuple(r.infill) == want and r.back == (r.text or "")


def test_empty_table(spark, docs):
    assert infill.with_infill(docs((1, "x")).where("doc_id > 1")).count() == 0


def test_chunks_follow_the_content():
    """Passages that two texts share are cut alike, but for their edges, wherever they start."""
    rng = np.random.default_rng(2)
    shared, own = (rng.integers(32, 127, n, np.uint8).tobytes() for n in (20_000, 777))
    pieces = []
    for data in (shared, own + shared):
        ends = infill.chunk_bounds(np.frombuffer(data, np.uint8))
        pieces.append({data[a:b] for a, b in zip([0, *ends], ends)})
        assert ends[-1] == len(data) and ends == sorted(set(ends))
    assert len(pieces[0] & pieces[1]) >= len(pieces[0]) - 2 > 10
    assert infill.chunk_bounds(np.zeros(0, np.uint8)) == [] and infill.chunk_bounds(np.zeros(5, np.uint8)) == [5]


def test_equal_hashes_of_different_chunks_are_told_apart():
    memo = infill.Memo()
    assert memo.summary(1, b"a\nb") == infill.Chunk(3, (2,))
    assert memo.summary(1, b"abc") == infill.Chunk(3, ())
    assert memo.summary(1, "é\n".encode()) == infill.Chunk(2, (2,))
