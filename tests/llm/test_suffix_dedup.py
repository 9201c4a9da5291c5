import hashlib
import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from lodgeflow.llm import queries, suffix_dedup

SF = "/root/testdata/sf0.001"


def brute(docs, length=100):
    """docs: (doc_id, text); ids are different."""
    first, out = {}, []
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0))
    for doc, text in order:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for k in range(len(data) - length + 1):
            w = data[k : k + length]
            if w in first:
                gone[k : k + length] = True
            else:
                first[w] = (doc, k)
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((doc, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_query_equals_brute_force(spark, rows):
    t = pq.read_table(f"{SF}/documents.parquet").to_pydict()
    want = brute(list(zip(t["doc_id"], t["text"])))
    assert rows(queries.op1_suffix(spark, SF)) == want
    assert any(r[2] for r in want)


def in_process(docs):
    """The steps of the operator with lists and sorts in the place of Spark's tables and shuffles."""
    table = pa.RecordBatch.from_arrays(
        [pa.array([d for d, _ in docs], pa.int64()), pa.array([0] * len(docs), pa.int32()),
         pa.array([t.encode() for _, t in docs], pa.binary())], ["doc", "th", "text"],
    )
    parts = [table.slice(k, 7) for k in range(0, len(docs), 7)]
    cut = pa.Table.from_batches(suffix_dedup._cut(iter(parts)))
    cut = cut.sort_by([(c, "ascending") for c in ("p", "seg", "doc", "th", "a")])
    met = [r for b in suffix_dedup._met(iter(cut.to_batches(max_chunksize=9))) for r in b.to_pylist()]
    marks = [(r["doc"], r["a"], r["b"]) for r in met if r["kind"] == suffix_dedup.MARKED]
    wanted = {}
    for r in met:
        if r["kind"] != suffix_dedup.MARKED:
            wanted.setdefault(r["doc"], []).append({k: r[k] for k in ("p", "a", "b", "kind")})
    asked = pa.RecordBatch.from_pylist(
        [{"doc": d, "th": 0, "text": t.encode(), "wanted": wanted[d]} for d, t in docs if d in wanted]
    )
    fetched = [r for b in suffix_dedup._fetched(iter([asked])) for r in b.to_pylist()]
    segments = sorted((r for r in fetched if r["kind"] == suffix_dedup.SORT), key=lambda r: r["p"])
    if segments:
        for b in suffix_dedup._compared(iter([pa.RecordBatch.from_pylist(segments)])):
            marks += [(r["doc"], r["a"], r["b"]) for r in b.to_pylist()]
    windows = [r for r in fetched if r["kind"] == suffix_dedup.WINDOWS]
    first = {}
    for r in windows:
        key = r["p"], r["seg"]
        first[key] = min(first.get(key, (r["doc"], r["a"])), (r["doc"], r["a"]))
    marks += [(r["doc"], r["a"], r["a"]) for r in windows if (r["doc"], r["a"]) > first[r["p"], r["seg"]]]
    out = []
    for doc, text in docs:
        rest, runs = suffix_dedup.removed(text.encode(), [{"a": a, "b": b} for d, a, b in marks if d == doc])
        n = len(text.encode())
        out.append((doc, n, n - len(rest), len(runs), hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=repr), len(segments), len(windows)


@pytest.mark.parametrize(
    "direct, crowd, chunk, collection",
    [(4096, 200_000, 1 << 20, 1024), (4096, 200_000, 997, 3), (2, 200_000, 1 << 20, 5), (3, 4, 1000, 1)],
)
def test_crowded_minimizers_and_pieces(monkeypatch, direct, crowd, chunk, collection):
    """Minimizers that go window by window, texts in small pieces, collections of few segments."""
    for name, value in {"DIRECT": direct, "CROWD": crowd, "CHUNK": chunk, "COLLECTION": collection}.items():
        monkeypatch.setattr(suffix_dedup, name, value)
    rng = random.Random(8)
    noise = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    block = [noise(rng.randrange(90, 400)) for _ in range(4)]
    texts = [noise(rng.randrange(50)) + rng.choice(block) + noise(rng.randrange(200)) + rng.choice(block) for _ in range(60)]
    docs = list(enumerate(texts + texts[:5] + ["", "x" * 3000, noise(5000)]))
    found, n_segments, n_windows = in_process(docs)
    assert found == brute(docs)
    assert n_windows if direct < 10 else n_segments


def got(df):
    return sorted(
        ((r.doc_id, r.n_bytes, r.n_bytes - len(r.rest), len(r.runs), hashlib.sha256(bytes(r.rest)).hexdigest()) for r in df.collect()),
        key=repr,
    )


def test_edge_rows(docs):
    rng = random.Random(9)
    noise = lambda n, a="abé ": "".join(rng.choice(a) for _ in range(n))
    block, common = noise(300), noise(130)
    texts = [None, "", "a" * 99, "a" * 100, "a" * 101, "a" * 5000, block, f"x{block}y", block[:150] + block, common, "q" + common[:99], "r" + common[:100], common[1:], "ab" * 2000]
    texts += [noise(rng.randrange(40)) + common + noise(rng.randrange(300)) for _ in range(60)]
    texts += [noise(40_000, "ab"), noise(120, "a" * 60 + "b")]
    pairs = list(enumerate(texts)) + [(None, block)]
    assert got(suffix_dedup.deduplicated(docs(*pairs))) == brute(pairs)
    assert suffix_dedup.deduplicated(docs()).collect() == []


def test_repeated_rows_are_one_document(docs):
    text = " ".join(f"w{k}" for k in range(100))
    rows = got(suffix_dedup.deduplicated(docs((1, text), (1, text), (2, text))))
    assert [r[2] for r in rows] == [0, 0, len(text)]


def test_sorted_suffixes():
    rng = random.Random(6)
    for trial in range(200):
        strings = [bytes(rng.choice([0, 97, 98, 255] if trial % 2 else [97, 98]) for _ in range(rng.randrange(12))) for _ in range(rng.randrange(1, 8))]
        who, size, prefix = suffix_dedup.sorted_suffixes(strings)
        want = sorted((strings[w][len(strings[w]) - n :], w, n) for w, s in enumerate(strings) for n in range(len(s) + 1))
        suffix = [strings[w][len(strings[w]) - n :] for w, n in zip(who, size)]
        assert suffix == [s for s, *_ in want] and len(set(zip(who, size))) == len(want)
        for k in range(1, len(suffix)):
            a, b = suffix[k - 1], suffix[k]
            same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert prefix[k] == same


def test_equal_windows_share_a_minimizer():
    rng = np.random.default_rng(2)
    core = rng.integers(97, 101, 400, np.uint8)
    seen = []
    for pad in (0, 1, 57, 200):
        data = np.concatenate((rng.integers(97, 101, pad, np.uint8), core))
        p, _, first, last, _ = suffix_dedup.segments(data, np.ones(len(data) - 99, bool))
        lead = np.repeat(p, last - first + 1)
        assert len(lead) == len(data) - 99
        seen.append(lead[pad:])
    assert all((s == seen[0]).all() for s in seen)
