"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole from a template of control strings, encoded
once with offsets, and each token's span is intersected with the spans of the
turns that carry loss; both lists are sorted, so binary search finds the turn.

Control strings inside roles and texts are escaped: every backslash is doubled,
and a backslash follows the first character of every control string. No control
string is left in an escaped text, and ``unescaped`` gives the text back.

The rows of a conversation are brought together by a shuffle on its id and read
in order from a sorted partition; one conversation is held at a time.

Defined cases: a null text or role is empty; rows of one turn number follow by
role, then text, and all stay; a null conversation id is a conversation of its
own; an empty table gives an empty table. A conversation, however long its texts,
is held whole by one task, as it is rendered and encoded once. Other columns are
not read.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator
from itertools import groupby
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
TURN, TEXT, END = "<turn>", "<text>", "</turn>"

# Fixed value: how byte-level BPE vocabularies cut text into words before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""

_ESCAPED = re.compile(r"\\(.)", re.S)


def escaped(text: str) -> str:
    text = text.replace("\\", "\\\\")
    for control in (TURN, TEXT, END):
        text = text.replace(control, f"{control[0]}\\{control[1:]}")
    return text


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def rendered(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the span of each turn's escaped text."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{TURN}{escaped(role)}{TEXT}", escaped(text)
        parts += [head, body, END]
        spans.append((at + len(head), at + len(head) + len(body)))
        at = spans[-1][1] + len(END)
    return "".join(parts), spans


def parsed(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    turns = []
    for part in formatted.split(TURN)[1:]:
        role, _, body = part.removesuffix(END).partition(TEXT)
        turns.append((unescaped(role), unescaped(body)))
    return turns


def masked_spans(
    starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]
) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Which tokens touch ``spans`` (sorted, disjoint), and the parts of ``spans`` they cover.

    Tokens are sorted and may share characters, as pieces of one character do;
    the parts are disjoint.
    """
    mask = np.zeros(len(starts), bool)
    spans = [s for s in spans if s[0] < s[1]]
    if not spans or not len(starts):
        return mask, []
    begin, finish = np.array(spans, np.int64).T
    first = np.searchsorted(finish, starts, side="right")  # the first span that ends after the token's start
    last = np.searchsorted(begin, ends, side="left")  # one past the last span that starts before its end
    mask = (first < last) & (starts < ends)
    hit = np.flatnonzero(mask)
    token = np.repeat(hit, last[hit] - first[hit])
    place = np.concatenate([np.arange(a, b) for a, b in zip(first[hit], last[hit])] or [np.empty(0, np.int64)])
    a, b = np.maximum(starts[token], begin[place]), np.minimum(ends[token], finish[place])
    if not len(a):
        return mask, []
    reach = np.maximum.accumulate(b)
    new = np.concatenate(([True], a[1:] > reach[:-1]))
    return mask, list(zip(a[new].tolist(), np.maximum.reduceat(b, np.flatnonzero(new)).tolist()))


class Encoder:
    """A byte-level BPE that gives each token's characters."""

    def __init__(self, ranks: bytes):
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        top = max(table.values()) + 1
        self.special = {name: top + k for k, name in enumerate((TURN, TEXT, END))}
        self._engine = tiktoken.Encoding("chat", pat_str=PATTERN, mergeable_ranks=table, special_tokens=self.special)
        self._sizes = np.zeros(top + 3, np.int64)
        for piece, rank in table.items():
            self._sizes[rank] = len(piece)
        for name, rank in self.special.items():
            self._sizes[rank] = len(name)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Token ids, and the first and past-the-last character that each token has a byte of."""
        ids = np.array(self._engine.encode(text, allowed_special=set(self.special), disallowed_special=()), np.int64)
        stops = np.cumsum(self._sizes[ids])
        lead = (np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80
        before = np.concatenate(([0], np.cumsum(lead)))  # characters that begin before a byte
        at = stops - self._sizes[ids]
        return ids, before[at] - ~np.concatenate((lead, [True]))[at], before[stops]


@functools.lru_cache(maxsize=1)
def _encoder(ranks: bytes) -> Encoder:
    return Encoder(ranks)


_SCHEMA = (
    "conv_id bigint, n_turns bigint, formatted string, token_ids array<int>, token_starts array<int>, "
    "token_ends array<int>, loss_mask array<boolean>, loss_spans array<struct<start:int, end:int>>"
)


def formatted(
    conversations: DataFrame, tokenizer: str = TOKENIZER, loss_roles: tuple[str, ...] = ("assistant",)
) -> DataFrame:
    """A row for each conversation of (conv_id, turn, role, text) rows.

    ``loss_spans`` are the characters of ``formatted`` that the masked tokens
    cover inside the turns of ``loss_roles``. The driver reads the tokenizer's
    file and sends it along; executors need no copy.
    """
    shared = conversations.sparkSession.sparkContext.broadcast(Path(tokenizer).read_bytes())
    schema = to_arrow_schema(StructType.fromDDL(_SCHEMA))

    def turns(source: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in source:
            for start in range(0, batch.num_rows, 256):
                yield from zip(*(c.to_pylist() for c in batch.slice(start, 256).columns))

    def conversations_of(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        held, size = [], 0
        for conv, rows in groupby(turns(source), key=lambda r: r[0]):
            said = [(role, text) for _, role, text in rows]
            text, spans = rendered(said)
            lossy = [s for s, (role, _) in zip(spans, said) if role in loss_roles]
            ids, starts, ends = encoder.encode(text)
            mask, parts = masked_spans(starts, ends, lossy)
            loss = [{"start": a, "end": b} for a, b in parts]
            held.append((conv, len(said), text, ids, starts, ends, mask, loss))
            size += len(text)
            if size > 1 << 18:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    blank = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    ordered = (
        conversations.select("conv_id", "turn", blank("role"), blank("text"))
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
    )
    return ordered.select("conv_id", "role", "text").mapInArrow(conversations_of, _SCHEMA)
