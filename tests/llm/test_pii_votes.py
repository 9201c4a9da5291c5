import hashlib
import random
import re

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from lodgeflow.llm import pii_votes, queries

SF = "/root/testdata/sf0.01"


def luhn(d):
    d = [int(c) for c in d][::-1]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def brute(text):
    text = text or ""
    digits = lambda s: re.sub("[^0-9]", "", s)
    tests = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    }
    return [(k, *m.span()) for k, (p, ok) in tests.items() for m in re.finditer(p, text) if ok(m[0])]


def test_query_equals_brute_force(spark):
    t = pq.read_table(f"{SF}/documents.parquet").to_pydict()
    texts = dict(zip(t["doc_id"], t["text"]))
    secrets = 0
    for row in queries.op5_pii(spark, SF).collect():
        base = brute(texts[row.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [
            sum(k == x for k, _, _ in base) for x in pii_votes.KINDS
        ]
        assert row.spans.startswith(joined)
        extra = row.spans[len(joined) :].strip(",").split(",")
        # The secrets of the given texts stand in quotes after "token = ".
        want = [m.span(1) for m in re.finditer(r'token = "([0-9a-f]{40})"', texts[row.doc_id])]
        assert [tuple(map(int, x.split(":")[1:])) for x in extra if x.startswith("secret")] == want
        assert not any(x.startswith("number") for x in extra)
        secrets += len(want)
    assert secrets


def test_base_spans_on_random_text():
    rng = random.Random(3)
    for _ in range(4000):
        text = "".join(rng.choice("ab1290.@@+- ()é") for _ in range(rng.randrange(60)))
        assert pii_votes.base_spans(text) == brute(text), text


def test_long_runs_end_in_time():
    for text in ("1" * 300_000, "a@" * 100_000, "x" * 300_000 + "@", "1." * 100_000, "+1" * 100_000, "1a" * 100_000):
        base = pii_votes.base_spans(text)
        list(pii_votes.candidates(text, base))


def test_edge_rows(docs):
    table = docs((1, None), (2, ""), (3, "a@b.cd"), (3, "a@b.cd"), (None, "é 10.0.0.1"))
    found = table.withColumn("found", pii_votes.scanned(table.text))
    model = pii_votes.trained(found, "found")
    spans = pii_votes.all_spans(model, "found")
    got = found.select("doc_id", pii_votes.masked(F.col("text"), spans).alias("t"), "key").collect()
    assert sorted(((r.doc_id, r.t) for r in got), key=repr) == sorted(
        [(1, None), (2, ""), (3, "<EMAIL>"), (3, "<EMAIL>"), (None, "é <IP>")], key=repr
    )
    empty = docs().withColumn("found", pii_votes.scanned(F.col("text")))
    assert pii_votes.trained(empty, "found").weight == {}


def test_em_recovers_reliabilities():
    rng = random.Random(11)
    true, patterns = [0.9, 0.7, 0.8], {}
    for _ in range(20_000):
        label = rng.random() < 0.4
        votes = "".join("0" if rng.random() < 0.2 else "+" if (rng.random() < r) == label else "-" for r in true)
        patterns[votes] = patterns.get(votes, 0) + 1
    belief, right = pii_votes.reliabilities(patterns)
    assert all(abs(a - b) < 0.05 for a, b in zip(true, right))
    assert belief["+++"] > 0.9 > 0.1 > belief["---"]


def added(text):
    return [(k, text[a:b]) for k, a, b in pii_votes.candidates(text, pii_votes.base_spans(text))]


def test_whatever_is_announced_or_assigned_is_a_candidate():
    """Short and long, of digits, letters or both, in four languages; what nothing points at stays out while short."""
    assert added("password = hunter22") == [("secret", "hunter22")]
    assert added("password = correcthorse, ok") == [("secret", "correcthorse")]
    assert added('"kennwort": "geheimnis"') == [("secret", "geheimnis")]
    assert added("my pin: 4821.") == [("number", "4821")]
    assert added("Mot de passe : soleil!") == [("secret", "soleil")]
    assert added("contraseña=abc1") == [("secret", "abc1")]
    assert added("token=" + "a1" * 20) == [("secret", "a1" * 20)] and added("k=ab12ab12ab12ab==") == [("secret", "ab12ab12ab12ab==")]
    assert added("token " + "a1" * 6) == added("about " + "a1" * 6) == [("secret", "a1" * 6)]
    assert added("it was 1984 and 12 of b52") == [] == added("at 9:30 she said: hello")
    assert added("key: a@b.cd") == []  # a base span
    assert added("12345678 and 1234567") == [("number", "12345678"), ("number", "1234567")]


def test_the_whole_line_announces():
    line = "account number, as was said before at some length, is 12345678"
    text = f"12345678\n{line} 87654321\n12345678"
    lines = pii_votes._Lines(text)
    found = [(text[a:b], lines.announced(a)) for _, a, b in pii_votes.candidates(text, [])]
    assert [x for _, x in found] == [False, True, False] or [x for _, x in found] == [False, True, True, False]
    votes = [v["votes"] for v in _votes(text)]
    assert votes[0][2] == "0" and votes[1][2] == "+" and votes[-1][2] == "0"


def _votes(text):
    lines = pii_votes._Lines(text)
    for k, a, b in pii_votes.candidates(text, pii_votes.base_spans(text)):
        votes, features = pii_votes.described(text, k, a, b, lines.announced(a))
        yield {"votes": votes, "features": features}


def test_numbers_and_short_secrets_are_added(docs):
    """Announced and assigned data among plain numbers and words; the classifier tells them apart."""
    rng = random.Random(2)
    rows, want = [], {}
    for k in range(300):
        number, word = rng.randrange(10**7, 10**8), "".join(rng.choice("abcdefgh") for _ in range(8))
        text, private = rng.choice([
            (f"the sum of {number} things, then", ""), (f"in {rng.randrange(1000, 2100)} it was so", ""),
            (f"my account number is: {number}", f"number {number}"), (f"password = {word}", f"secret {word}"),
            (f'pin: "{number % 10000:04d}"', f"number {number % 10000:04d}"), (f"telefon: 030 {number}", f"number 030 {number}"),
        ])
        rows.append((k, text))
        want[k] = private
    found = docs(*rows).withColumn("found", pii_votes.scanned(F.col("text")))
    spans = pii_votes.all_spans(pii_votes.trained(found, "found"), "found")
    got = {r.doc_id: " ".join(f"{s.kind} {r.text[s.start:s.end]}" for s in r.spans) for r in found.select("doc_id", "text", spans.alias("spans")).collect()}
    assert got == want


def test_one_long_line_is_read_once():
    text = "key " + "12345678 word " * 40_000
    assert len(list(_votes(text))) == 40_000
