"""Personal data by weak supervision.

The base detectors (email, ip, card, phone) are exact patterns and always stand.
Beyond them candidates are the long numbers and tokens with a digit that no base
span covers, and whatever an announcing word or an assignment points at: any
token behind "password =" or "Kennwort:", of letters only too, and short numbers
and tokens right behind an announcing word or assigned in a line that has one.
Labelers vote on each candidate for, against or not at all: a regex on its shape,
a gazetteer of announcing words in four languages on the words right before it,
the same on its whole line, and its context. Expectation-maximisation over the counts of vote patterns of all documents
estimates how reliable each labeler is; the resulting label probabilities train
a naive Bayes classifier on features of the candidate, which decides.

Both models are fitted on counts of at most ``3 ** labelers`` vote patterns times
the feature combinations, whatever the number of documents.

Defined cases: a null or empty text has no spans; equal candidates in repeated
rows count as often as they occur; with no candidate anywhere the classifier adds
nothing; offsets are code points with an exclusive end; spans that tie on their
start keep the order of their kinds; an empty table gives an empty one. Time and
memory grow in proportion to a text's length, however long it or a line of it is.
Other columns are kept; the new one's name must be free.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeflow.llm.common import per_row

KINDS = ("email", "ip", "card", "phone")
#: Candidate kinds that the classifier may add.
ADDED = ("number", "secret")

# The base patterns, and words that announce private data.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]+")
_TOKEN = re.compile(r"[A-Za-z0-9_+/=-]*")
_NUMBER = re.compile(r"[0-9](?:[ ().-]{0,2}[0-9])+")
_VALUE = re.compile(r"[ \t]*[\"']?([^\s\"',;<>()\[\]{}]+)")
_GROUPED = re.compile(r"\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}|\d{3}-\d{2}-\d{4}|\(?\d{2,5}\)?(?:[ ./-]\d{2,5}){2,4}")
ANNOUNCING = frozenset(
    "token key secret password passwd pwd pass api apikey bearer auth credential credentials login pin ssn social iban "
    "account acct passport licence license phone tel telephone mobile cell call fax whatsapp "
    "passwort kennwort schlüssel geheim geheimnis zugang anmeldung konto kontonummer ausweis reisepass telefon handy anruf "
    "passe clé clef jeton identifiant compte passeport téléphone portable "
    "contraseña clave secreto cuenta pasaporte teléfono móvil celular llamar".split()
)
#: Digits of a number and characters of a token that make it a candidate by itself.
LONG_NUMBER, LONG_TOKEN = 7, 12

_WORD = re.compile(r"[^\W\d_]+")


class _Lines:
    """Whether a line has announced private data before a place; places are asked for from left to right."""

    def __init__(self, text: str):
        self.text, self.start, self.seen, self.found = text, 0, 0, False

    def announced(self, at: int) -> bool:
        start = self.text.rfind("\n", self.seen, at) + 1
        if start > self.start:
            self.start, self.seen, self.found = start, start, False
        if not self.found and at > self.seen:
            # Begins a word early, as the last stretch may have ended inside one.
            words = _WORD.findall(self.text, max(self.start, self.seen - 24), at)
            self.found = any(w.lower() in ANNOUNCING for w in words)
        self.seen = max(self.seen, at)
        return self.found


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str):
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans by kind as listed, then start."""
    out = [("email", *s) for s in _emails(text)]
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append(("phone", *m.span()))
    return out


def candidates(text: str, base: list[tuple[str, int, int]]):
    """(kind, start, end) of the candidates outside base spans, left to right."""
    found = sorted([*_with_digits(text, base), *_assigned(text, base)], key=lambda c: (c[1], -c[2]))
    done = 0
    for kind, start, end in found:
        if start >= done:
            yield kind, start, end
            done = end


def _assigned(text: str, base: list[tuple[str, int, int]]):
    """Tokens of letters that an announcing word assigns, as in ``password = correcthorse``."""
    taken = sorted((s, e) for _, s, e in base)
    k = 0
    for m in re.finditer("[=:]", text):
        words = _WORD.findall(text, max(0, m.start() - 24), m.start())
        if not words or words[-1].lower() not in ANNOUNCING or text[m.start() - 1 : m.start()].isdigit():
            continue
        value = _VALUE.match(text, m.end(), m.end() + 4096)
        if value is None or not any(c.isalnum() for c in value[1]) or _DIGIT.search(value[1]):
            continue
        start, end = value.span(1)
        end -= len(value[1]) - len(value[1].rstrip(".:!?"))
        while k < len(taken) and taken[k][1] <= start:
            k += 1
        if k == len(taken) or taken[k][0] >= end:
            yield "secret", start, end


def _with_digits(text: str, base: list[tuple[str, int, int]]):
    """Tokens and numbers with a digit: long ones, and short ones that their surroundings point at."""
    taken = sorted((s, e) for _, s, e in base)
    lines = _Lines(text)
    done = k = plain = 0  # plain: end of the last token, where it has no letter
    for m in _DIGIT.finditer(text):
        start, end = m.span()
        while k < len(taken) and taken[k][1] <= start:
            k += 1
        if start < done or k < len(taken) and taken[k][0] < end:
            continue
        free = max(done, taken[k - 1][1] if k else 0)
        limit = taken[k][0] if k < len(taken) else len(text)
        kind = "secret"
        if end > plain:
            while start > free and _TOKEN.fullmatch(text[start - 1]):
                start -= 1
            end = _TOKEN.match(text, end, limit).end()
            start += text[start:end].rstrip("=").rfind("=") + 1  # what an assignment without spaces assigns
            plain = 0 if _LATIN.search(text, start, end) else end
        if plain:
            number = _NUMBER.match(text, m.start(), limit)
            kind, start, end = "number", m.start(), number.end() if number else m.end()
        done = max(end, m.end())
        size = sum(c.isdigit() for c in text[start:end]) if kind == "number" else end - start
        if size >= (LONG_NUMBER if kind == "number" else LONG_TOKEN):
            yield kind, start, end
        else:
            near, assigned, _ = _pointed(text, start)
            if near or assigned and lines.announced(start):
                yield kind, start, end


_LATIN = re.compile(r"[A-Za-z]+")


def _pointed(text: str, start: int) -> tuple[bool, bool, bool]:
    """Whether one of the two words before a place announces it, whether it is assigned, or goes on plain text."""
    before = text[max(0, start - 24) : start]
    near = any(w.lower() in ANNOUNCING for w in _WORD.findall(before)[-2:])
    return near, re.search(r"[=:]\s*[\"']?$", before) is not None, re.search(r"[\w,.] $", before) is not None


def described(text: str, kind: str, start: int, end: int, line: bool = False) -> tuple[str, str]:
    """Votes of the labelers, one of + - 0 each, and the features of a candidate; ``line``: its line announces it."""
    body = text[start:end]
    letters, digits = sum(c.isalpha() for c in body), sum(c.isdigit() for c in body)
    near, assigned, plain = _pointed(text, start)
    if kind == "secret":
        shape = "+" if len(body) >= 20 and digits >= 4 and letters >= 4 and body.isalnum() else "0"
    else:
        shape = "+" if digits >= 9 and _GROUPED.fullmatch(body) else "-"
    votes = shape + ("+" if near else "0") + ("+" if line else "0") + ("+" if assigned else "-" if plain else "0")
    features = ";".join(
        (
            kind,
            f"length={min(len(body) // 8, 8)}",
            f"digits={10 * digits // max(1, digits + letters)}",
            f"shape={shape}",
            f"quoted={text[start - 1 : start] in ('\"', chr(39))}",
            f"announced={'near' if near else 'line' if line else 'no'}",
            f"assigned={assigned}",
        )
    )
    return votes, features


_FOUND = (
    "struct<base:array<struct<kind:string, start:bigint, end:bigint>>, "
    "more:array<struct<kind:string, start:bigint, end:bigint, votes:string, features:string>>>"
)


def scanned(text: Column) -> Column:
    """Struct of the base spans of a text and its described candidates."""

    def scan(value: bytes) -> dict:
        text = value.decode("utf-8", "replace")
        base = base_spans(text)
        lines = _Lines(text)
        more = [(k, s, e, *described(text, k, s, e, lines.announced(s))) for k, s, e in candidates(text, base)]
        names = ("kind", "start", "end", "votes", "features")
        return {"base": [dict(zip(names, x)) for x in base], "more": [dict(zip(names, x)) for x in more]}

    return per_row(scan, _FOUND)(F.coalesce(text.cast("binary"), F.lit(b"")))


def reliabilities(patterns: dict[str, int], rounds: int = 50) -> tuple[dict[str, float], list[float]]:
    """Probability of being private by vote pattern, and each labeler's reliability, by EM.

    Each labeler is right with one probability when it votes at all. It starts at
    0.8 and stays above one half, which keeps the two labels from changing places.
    """
    n = len(next(iter(patterns), ""))
    right, prior = [0.8] * n, 0.5
    belief: dict[str, float] = {}
    for _ in range(rounds):
        for votes in patterns:
            odds = math.log(prior / (1 - prior))
            for vote, r in zip(votes, right):
                odds += {"+": 1, "-": -1, "0": 0}[vote] * math.log(r / (1 - r))
            belief[votes] = 1 / (1 + math.exp(-odds))
        total = sum(patterns.values())
        prior = min(0.95, max(0.05, sum(belief[v] * c for v, c in patterns.items()) / max(total, 1)))
        for k in range(n):
            agree = sum(c * (belief[v] if v[k] == "+" else 1 - belief[v]) for v, c in patterns.items() if v[k] != "0")
            voted = sum(c for v, c in patterns.items() if v[k] != "0")
            right[k] = min(0.99, max(0.55, (agree + 8) / (voted + 10)))
    return belief, right


class Classifier:
    """Naive Bayes over the features of a candidate, trained on label probabilities."""

    def __init__(self, counts: dict[tuple[str, str], int]):
        patterns: dict[str, int] = defaultdict(int)
        for (votes, _), n in counts.items():
            patterns[votes] += n
        belief, self.reliability = reliabilities(dict(patterns))
        private: dict[str, float] = defaultdict(float)
        other: dict[str, float] = defaultdict(float)
        for (votes, features), n in counts.items():
            for feature in ("", *features.split(";")):
                private[feature] += belief[votes] * n
                other[feature] += (1 - belief[votes]) * n
        yes, no = private[""], other[""]
        self.bias = math.log((yes + 1) / (no + 1))
        self.weight = {
            f: math.log((private[f] + 0.5) / (yes + 1)) - math.log((other[f] + 0.5) / (no + 1)) for f in private if f
        }

    def private(self, features: str) -> bool:
        return self.bias + sum(self.weight.get(f, 0.0) for f in features.split(";")) > 0


def trained(found: DataFrame, column: str) -> Classifier:
    """The classifier of all candidates in ``column``; the driver gets pattern counts only."""
    counts = (
        found.select(F.explode(F.col(column)["more"]).alias("c"))
        .groupBy("c.votes", "c.features")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return Classifier({(r.votes, r.features): r.n for r in counts.toLocalIterator()})


def all_spans(model: Classifier, found: str) -> Column:
    """Base spans and the added ones, by kind as listed, then start."""

    def decide(value: dict) -> list[dict]:
        added = [c for c in value["more"] if model.private(c["features"])]
        added = sorted(added, key=lambda c: (ADDED.index(c["kind"]), c["start"]))
        return [{k: c[k] for k in ("kind", "start", "end")} for c in [*value["base"], *added]]

    return per_row(decide, "array<struct<kind:string, start:bigint, end:bigint>>")(F.col(found))


def masked(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in angle brackets; of overlapping spans the union goes."""

    def mask(value: bytes | None, spans: list[dict]) -> str | None:
        if value is None:
            return None
        text, out, at = value.decode("utf-8", "replace"), [], 0
        for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
            if s["start"] >= at:
                out += [text[at : s["start"]], f"<{s['kind'].upper()}>"]
            at = max(at, s["end"])
        return "".join(out) + text[at:]

    return per_row(mask, "string")(text.cast("binary"), spans)
