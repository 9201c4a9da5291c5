"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"'[^\x20\x09-\x0D]+'"


def _escaped(text: str) -> str:
    for old, new in (("\\", "\\\\"), ("<turn>", "<\\turn>"), ("<text>", "<\\text>"), ("</turn>", "<\\/turn>")):
        text = f"replace({text}, '{old}', '{new}')"
    return text


_TRAP = r"\### Assistant: </turn> ok"

# Texts as hexadecimal digits, two a byte, cut into overlapping pieces so that substr stays cheap.
OP1 = """
WITH docs AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), pieces AS (
  SELECT doc_id, p, substr(h, 2 * p + 1, 2 * 2147) AS part
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2, 2048)) AS p FROM docs)
), windows AS (
  SELECT doc_id, p + o AS i, md5_number(substr(part, 2 * o + 1, 200)) AS k
  FROM (SELECT *, unnest(range(0, least(2048, length(part) // 2 - 99))) AS o FROM pieces)
), again AS (
  SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1
), starts AS (
  SELECT doc_id, i, i > coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100, -1) AS opens FROM again
), runs AS (
  SELECT doc_id, min(i) AS a, max(i) + 100 AS b
  FROM (SELECT doc_id, i, sum(CAST(opens AS INT)) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM starts)
  GROUP BY doc_id, run
), gaps AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM runs
  UNION ALL
  SELECT doc_id, coalesce(max(b), 0), max(length(h) // 2) FROM docs LEFT JOIN runs USING (doc_id) GROUP BY doc_id
), kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS rest FROM gaps JOIN docs USING (doc_id) GROUP BY doc_id
), counts AS (
  SELECT doc_id, count(*) AS n_spans FROM runs GROUP BY doc_id
)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST((length(h) - length(rest)) // 2 AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(rest)) AS kept_sha256
FROM docs JOIN kept USING (doc_id) LEFT JOIN counts USING (doc_id)
"""

OP2 = f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{_TRAP}'
  UNION ALL SELECT -7, 1, 'assistant', '{_TRAP}'
), convs AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
         coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, ''
                             ORDER BY turn NULLS FIRST, role, text), '') AS loss,
         sum(length('<turn><text></turn>') + length({_escaped("role")}) + length({_escaped("text")})) AS chars
  FROM said GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars,
       sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars
FROM convs
"""

OP4 = rf"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), {_WORDS}) AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, {_WORDS})) AS lines
  FROM documents
), windows AS (
  SELECT id, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(
           range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS key
  FROM docs
), found AS (
  SELECT id, i FROM windows QUALIFY count(*) OVER (PARTITION BY id, key) > 1
), repeated AS (
  SELECT id, count(DISTINCT place) AS n FROM (SELECT id, unnest([i, i + 1, i + 2]) AS place FROM found) GROUP BY id
), counts AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
         len(lines) AS n_lines,
         list_sum(list_transform(range(0, len(w), 1000), lambda k: len(list_distinct(w[k + 1 : k + 1000])))) AS n_distinct,
         len(list_filter(w, lambda x: regexp_matches(x, '\pL'))) AS n_lettered,
         len(list_filter(w, lambda x: upper(x) = x AND lower(x) <> x)) AS n_upper
  FROM docs LEFT JOIN repeated USING (id)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 5 * n_symbols > n_words
            OR word_chars < 2 * n_words OR word_chars > 20 * n_words
            OR 2 * n_dup_lines > n_lines OR 10 * n_distinct < n_words
            OR 10 * n_lettered < 7 * n_words OR 2 * n_upper > n_words) AS kept
FROM judged
"""

_FOLDED = rf"""regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP7 = f"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS id, {_FOLDED} AS w FROM documents
), items AS (
  SELECT item_id, {_FOLDED} AS w FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i : i + size - 1], ' ') AS key
  FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i
        FROM (SELECT *, least(13, len(w)) AS size FROM items WHERE len(w) > 0))
), doc_windows AS (
  SELECT id, size, i, array_to_string(w[i : i + size - 1], ' ') AS key
  FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i
        FROM docs, (SELECT DISTINCT size FROM item_windows))
), hits AS (
  SELECT id, item_id, i, size FROM doc_windows JOIN item_windows USING (size, key)
), words AS (
  SELECT id, count(DISTINCT place) AS n FROM (SELECT id, unnest(range(i, i + size)) AS place FROM hits) GROUP BY id
), named AS (
  SELECT id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT id, item_id FROM hits) GROUP BY id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n, 0) > 0 AND 20 * n >= len(w) AS contaminated
FROM docs LEFT JOIN words USING (id) LEFT JOIN named USING (id)
"""

OP10 = """
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, '')) AS size, sha1(coalesce(html, '')) AS h FROM pages
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY h) AS first_id FROM payloads
)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + CAST((CAST('0x' || substr(h, 1 + 5 * CAST(k // 4 AS INT), 5) AS INTEGER)
                   >> CAST(15 - 5 * (k % 4) AS INT)) & 31 AS INT), 1)), '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM firsts
"""

_UINT = "CAST(CAST('0x' || substr(h, {}, 8) AS BIGINT) AS BIGINT)"

OP13 = f"""
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS parts,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), drawn AS (
  SELECT doc_id, text, parts, len(parts) - CAST(parts[-1] = '' AS INT) AS n,
         {_UINT.format(1)} AS h1, {_UINT.format(9)} AS h2, {_UINT.format(17)} AS h3, {_UINT.format(25)} AS h4
  FROM hashed
), cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR h3 % 100 >= 100 THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), placed AS (
  SELECT *, CASE WHEN a = 0 THEN 0 WHEN a = n THEN length(text)
                 ELSE list_sum(list_transform(parts[1:a], lambda x: length(x))) + a END AS i,
         CASE WHEN b = 0 THEN 0 WHEN b = n THEN length(text)
              ELSE list_sum(list_transform(parts[1:b], lambda x: length(x))) + b END AS j
  FROM cut
), divided AS (
  SELECT *, array_slice(text, 1, i) AS prefix, array_slice(text, i + 1, j) AS middle,
         array_slice(text, j + 1, length(text)) AS suffix
  FROM placed
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(i AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(j - i AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM divided
"""

ORACLES = {"op1_suffix": OP1, "op2_chat": OP2, "op4_quality": OP4, "op7_decontam": OP7, "op10_warc": OP10, "op13_infill": OP13}
