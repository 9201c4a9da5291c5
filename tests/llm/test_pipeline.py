import pyarrow.parquet as pq
import test_decontam
import test_mixing
import test_pii_votes
import test_quality_cascade
import test_simhash

import corpus_pipeline
from lodgeflow.llm import quality_cascade

SF = "/root/testdata/sf0.001"
SECRET = r'token = "([0-9a-f]{40})"'


def brute_masked(text):
    import re

    spans = test_pii_votes.brute(text) + [("secret", *m.span(1)) for m in re.finditer(SECRET, text)]
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def brute(docs, bench):
    rules = list(quality_cascade.RULES.values())
    counts = {d["doc_id"]: quality_cascade.Counts((d["text"] or "").encode()) for d in docs}
    docs = [
        d for d in docs
        if not test_quality_cascade.brute(d["text"])[5] and not any(r(counts[d["doc_id"]]) for r in rules)
    ]
    first = test_simhash.brute([(d["doc_id"], d["text"]) for d in docs])
    kept = {doc for doc, _, component in first if doc == component}
    docs = [d for d in docs if d["doc_id"] in kept]
    bad = {r[0] for r in test_decontam.brute([(d["doc_id"], d["text"]) for d in docs], bench) if r[5]}
    docs = [d | {"text": brute_masked(d["text"])} for d in docs if d["doc_id"] not in bad]
    mixed = test_mixing.brute([(d["doc_id"], d["source"], d["lang"], d["text"]) for d in docs])
    return {
        d["doc_id"]: (d["text"], len(d["text"]), p)
        for d, (_, _, _, p) in zip(docs, mixed) if test_mixing.brute_draw(d["doc_id"]) < p
    }


def test_run_equals_brute_force(spark):
    docs = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    bench = pq.read_table(f"{SF}/benchmark.parquet").to_pydict()
    want = brute(docs, list(zip(bench["item_id"], bench["text"])))
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "topic", "n_tokens", "probability"]
    got = {r.doc_id: r for r in out.collect()}
    assert got.keys() == want.keys()
    for doc, (text, n_chars, p) in want.items():
        assert (got[doc].text, got[doc].n_chars) == (text, n_chars)
        assert abs(got[doc].probability - p) < 1e-3


def test_stages_on_edge_rows(spark, docs):
    prose = " ".join(f"plain{k} words" for k in range(60))
    table = docs((1, None), (2, ""), (3, prose), (3, prose), (None, prose), (4, f"{prose} a@b.cd"), (5, prose[::-1]))
    table = table.withColumnRenamed("word", "_hits").withColumnRenamed("key", "_quality").withColumnRenamed("i", "topic")
    for name, stage in corpus_pipeline.STAGES:
        for rows in (table, table.limit(0)):
            out = stage(spark, rows, SF)
            found = out.collect()
            assert out.columns[: len(table.columns)] == table.columns
            assert out.columns[len(table.columns) :] == (["n_tokens", "probability"] if name == "mixing" else [])
            if rows is not table:
                assert found == []
    once = corpus_pipeline.near_duplicates(spark, table, SF).collect()
    assert sorted((r.doc_id for r in once if r.text == prose), key=repr) == [3]


def test_a_given_topic_is_raked(spark, docs):
    """Cells are those of the given topics, and columns of the same names as the new ones stay."""
    prose = [(k, " ".join(f"w{k}x{j}" for j in range(60))) for k in range(40)]
    table = docs(*prose).withColumnRenamed("fp", "n_tokens").selectExpr("*", "if(doc_id < 30, 'often', 'rare') AS topic")
    out = corpus_pipeline.mixing_to_targets(spark, table, SF)
    assert out.columns == [*table.columns, "n_tokens_", "probability"]
    found = {r.topic: r.probability for r in out.collect()}
    assert found["rare"] == 1.0 and abs(found.get("often", 1) - (30 / 10) ** (0.7 - 1)) < 1e-6
