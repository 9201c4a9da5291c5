import hashlib
import random
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq

from lodgeflow.llm import chat_format, queries

SF = "/root/testdata/sf0.001"


def brute(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    out = []
    for conv, said in convs.items():
        said.sort()
        turns = "".join(f"{r}\n{t}\n" for *_, r, t in said)
        loss = "".join(t for *_, r, t in said if r == "assistant")
        out.append((conv, len(said), sha(turns), len(loss), sha(loss)))
    return sorted(out, key=repr)


def test_query_equals_brute_force(spark):
    t = pq.read_table(f"{SF}/conversations.parquet").to_pydict()
    said = list(zip(t["conv_id"], t["turn"], t["role"], t["text"]))
    trap = "\\### Assistant: </turn> ok"
    said += [(-7, 0, "user", trap), (-7, 1, "assistant", trap)]
    got = queries.op2_chat(spark, SF).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == brute(said)
    assert all(r.formatted_chars > r.loss_chars for r in got)


def test_edge_conversations(spark):
    rng = random.Random(2)
    pieces = ["<turn>", "</turn>", "<text>", "<|endoftext|>", "\\", "<", "\n", "  ", "é", "😀", "漢字", "ok", "t", " "]
    said = [(1, 0, "assistant", None), (2, 0, None, "x"), (3, 1, "assistant", ""), (3, 1, "assistant", ""), (None, 0, "assistant", "a"), (4, None, "assistant", " lead and trail \n"), (5, 0, "ass\nistant<text>", "no loss")]
    for conv in range(100, 180):
        for turn in range(rng.randrange(1, 6)):
            text = "".join(rng.choice(pieces) for _ in range(rng.randrange(12)))
            said.append((conv, turn, rng.choice(["user", "assistant", "system"]), text))
    said.append((6, 0, "assistant", "word " * 40_000))
    said += [(7, k, "assistant", f"t{k}") for k in range(500)]
    table = spark.createDataFrame(
        [(*s, "x") for s in said], "conv_id bigint, turn bigint, role string, text string, formatted string"
    )
    out = chat_format.formatted(table).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = []
    for r in out:
        turns = "".join(f"{a}\n{b}\n" for a, b in chat_format.parsed(r.formatted))
        loss = chat_format.unescaped("".join(r.formatted[s.start : s.end] for s in r.loss_spans))
        got.append((r.conv_id, r.n_turns, sha(turns), len(loss), sha(loss)))
        assert len(r.token_ids) == len(r.token_starts) == len(r.token_ends) == len(r.loss_mask)
        # A masked token touches assistant text; an unmasked one touches none of it.
        inside = {c for s in r.loss_spans for c in range(s.start, s.end)} if r.conv_id != 6 else None
        if inside is not None:
            for start, end, lossy in zip(r.token_starts, r.token_ends, r.loss_mask):
                assert start < end and lossy == any(c in inside for c in range(start, end))
    assert sorted(got, key=repr) == brute(said)
    assert chat_format.formatted(table.limit(0)).collect() == []


def test_straddling_tokens_are_clipped():
    starts, ends = np.array([(0, 3), (3, 4), (3, 4), (4, 9), (9, 12), (12, 13)]).T
    mask, parts = chat_format.masked_spans(starts, ends, [(2, 5), (5, 5), (8, 10)])
    assert mask.tolist() == [True, True, True, True, True, False]
    assert parts == [(2, 5), (8, 10)]


def test_token_characters():
    encoder = chat_format.Encoder(Path(chat_format.TOKENIZER).read_bytes())
    text = "<turn>é漢字😀 ok\n<text>"
    ids, starts, ends = encoder.encode(text)
    assert starts[0] == 0 and ends[0] == 6 and ends[-1] == len(text)
    assert all(s <= e for s, e in zip(starts[1:], ends)) and sorted(starts) == list(starts)
    assert {c for a, b in zip(starts, ends) for c in range(a, b)} == set(range(len(text)))
