"""DuckDB SQL for the training-data queries that SQL can express."""

from __future__ import annotations

from marketlake.llm.conversation_oracles import OP12, OP13

# Fixed value: the white space of the contracts, as a regular expression.
_WS = r"[\x20\x09-\x0D]"

# Every window that occurred before is deleted: three non-blank lines, fewer that hold
# 50 words, or all lines of a document that has less than three.
_OP1 = rf"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS p
  FROM documents
), f AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY p) AS i, count(*) OVER (PARTITION BY doc_id) AS n,
         len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM l
  WHERE regexp_replace(line, '{_WS}', '', 'g') <> ''
), v AS (
  SELECT *, 1 AS size, [line] AS lines, words AS held FROM f
  UNION ALL
  SELECT a.*, 2, [a.line, b.line], a.words + b.words FROM f a JOIN f b ON b.doc_id = a.doc_id AND b.i = a.i + 1
  UNION ALL
  SELECT a.*, 3, [a.line, b.line, c.line], 50
  FROM f a JOIN f b ON b.doc_id = a.doc_id AND b.i = a.i + 1 JOIN f c ON c.doc_id = a.doc_id AND c.i = a.i + 2
), w AS (
  SELECT doc_id, i, size, row_number() OVER (PARTITION BY lines, held < 50 ORDER BY doc_id, i) AS seen
  FROM v WHERE held >= 50 OR n = size
), gone AS (
  SELECT DISTINCT f.doc_id, f.p FROM w JOIN f ON f.doc_id = w.doc_id AND f.i BETWEEN w.i AND w.i + size - 1 WHERE seen > 1
), t AS (
  SELECT l.doc_id, count(*) AS n_lines, count(g.p) AS n_removed,
         coalesce(string_agg(l.line, chr(10) ORDER BY l.p) FILTER (WHERE g.p IS NULL), '') AS text
  FROM l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.p = l.p GROUP BY l.doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       CASE WHEN d.text IS NOT NULL THEN t.text END AS text
FROM documents d LEFT JOIN t USING (doc_id)
"""

_OP3 = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents
), k AS (
  SELECT doc_id, length(t) AS chars, sha256(regexp_replace(t, '{_WS}', '', 'g')) AS h FROM d
), r AS (
  SELECT *, count(*) OVER (PARTITION BY h) AS group_size,
         row_number() OVER (PARTITION BY h ORDER BY chars DESC, doc_id) AS rn,
         first_value(doc_id) OVER (PARTITION BY h ORDER BY chars DESC, doc_id) AS keep_id
  FROM k
)
SELECT doc_id, keep_id, group_size, rn = 1 AS kept, h AS text_sha256 FROM r
"""

# Jump consistent hashing as a recursion over the jumps, in 128-bit arithmetic
# reduced to 64 bits, for 16 and 17 shards; CRC-32 as a fold over the bytes.
_OP2 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, encode(coalesce(text, '')) AS bytes FROM documents
), key AS (
  SELECT doc_id, ('0x' || md5(CAST(doc_id AS VARCHAR))[1:15])::BIGINT AS k FROM d
), steps AS (
  SELECT doc_id, n, k::UHUGEINT AS state, 0::BIGINT AS b, 0::BIGINT AS j FROM key, (VALUES (16), (17)) s(n)
  UNION ALL
  SELECT doc_id, n, next, j, floor((j + 1) * (2147483648.0::DOUBLE / ((next // 8589934592::UHUGEINT) + 1)::DOUBLE))::BIGINT
  FROM (SELECT *, (state * 2862933555777941757::UHUGEINT + 1) % 18446744073709551616::UHUGEINT AS next
        FROM steps WHERE j < n)
), placed AS (
  SELECT doc_id, n, max(b) AS shard FROM steps GROUP BY doc_id, n
), crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
      lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM (SELECT unnest(range(256)) AS i))
), crc AS (
  SELECT doc_id, octet_length(bytes) + 1 AS size,
    xor(list_reduce([4294967295]::BIGINT[] || list_transform(range(octet_length(bytes)),
        lambda i: ('0x' || hex(bytes)[2 * i + 1:2 * i + 2])::BIGINT),
      lambda c, x: xor(c >> 8, t[xor(c, x) % 256 + 1])), 4294967295) AS text_crc32
  FROM d, crc_table
)
SELECT c.doc_id, size::BIGINT AS size, text_crc32, 'key' AS law, p.shard::INTEGER AS shard,
  row_number() OVER (PARTITION BY p.shard ORDER BY
    (k + text_crc32) % ceil((SELECT count(*) FROM documents) / 100000)::BIGINT, c.doc_id, text_crc32, size) - 1 AS slot,
  g.shard::INTEGER AS grown_shard
FROM crc c JOIN key USING (doc_id) JOIN placed p ON p.doc_id = c.doc_id AND p.n = 16
JOIN placed g ON g.doc_id = c.doc_id AND g.n = 17
"""

_OP5 = r"""
WITH p AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), u AS (
  SELECT page_id, coalesce(regexp_extract(rest, '^([^/?#]*)', 1), '') AS raw_host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM p
), h AS (
  SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM u
), rules(rhost, rpath, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), m AS (
  SELECT h.*, r.rhost || r.rpath AS rule, r.verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(r.rhost || r.rpath) DESC, r.verdict DESC) AS rn
  FROM h LEFT JOIN rules r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE rn = 1
"""

_OP6 = r"""
WITH t AS (
  SELECT DISTINCT conv_id, coalesce(turn, 9223372036854775807) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), s AS (
  SELECT *, row_number() OVER o AS i, count(*) OVER (PARTITION BY conv_id) AS n,
         string_agg(turn || chr(1) || role || chr(1) || text, chr(2)) OVER (o ROWS UNBOUNDED PRECEDING) AS prefix
  FROM t WINDOW o AS (PARTITION BY conv_id ORDER BY turn, role, text)
), kept AS (
  SELECT min(conv_id) AS conv_id, n FROM s WHERE i = n AND prefix NOT IN (SELECT prefix FROM s WHERE i < n)
  GROUP BY n, prefix
)
SELECT conv_id, n AS n_turns, (i - 1) // 256 AS part,
       string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY i) AS text
FROM (SELECT * EXCLUDE (n) FROM s) JOIN kept USING (conv_id) GROUP BY ALL
"""

def _op11(limits: dict[int, int], line_limit: int) -> str:
    """``limits``: length of windows -> percent of the characters they may cover."""
    windows = ",\n".join(
        f"      CASE WHEN i + {n - 1} <= n THEN string_agg(w, ' ') OVER "
        f"(PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING) END AS g{n}" for n in limits)
    twice = ", ".join(f"g{n} IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, g{n}) > 1 AS t{n}" for n in limits)
    covered = ", ".join(
        f"bool_or(t{n}) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS c{n}"
        for n in limits)
    sums = ", ".join(f"sum(length(w)) FILTER (c{n}) AS dup_chars_{n}" for n in limits)
    longs = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
             *[f"dup_chars_{n}" for n in limits], "dup_line_chars"]
    kept = " AND ".join(f"100 * dup_chars_{n} <= {limit} * word_chars" for n, limit in limits.items())
    return rf"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS w,
         generate_subscripts(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), 1) AS i,
         len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS n FROM t
), g AS (
  SELECT *,
{windows} FROM w
), c AS (
  SELECT *, {twice} FROM g
), m AS (
  SELECT *, {covered} FROM c
), s AS (
  SELECT doc_id, count(*) AS n_words, sum(length(w)) AS word_chars, count(*) FILTER (c5) AS n_repeat_words, {sums}
  FROM m GROUP BY doc_id
), l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS p FROM t
), r AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, line ORDER BY p) AS seen,
         length(regexp_replace(line, '{_WS}', '', 'g')) AS chars FROM l
), d AS (
  SELECT doc_id, count(*) AS n_dup_lines, sum(chars) AS dup_line_chars FROM r WHERE seen > 1 AND chars > 0 GROUP BY doc_id
), o AS (
  SELECT t.doc_id, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, s.* EXCLUDE (doc_id), d.* EXCLUDE (doc_id)
  FROM t LEFT JOIN s USING (doc_id) LEFT JOIN d USING (doc_id)
), z AS (
  SELECT doc_id, {", ".join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in longs)} FROM o
), b AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM z
)
SELECT *, NOT base_failed AND 100 * dup_line_chars <= {line_limit} * word_chars AND {kept} AS kept FROM b
"""


ORACLES: dict[str, str] = {
    "op12_structure_repair": OP12,
    "op13_prefix_trie": OP13,
    "op11_quality_rules": _op11({5: 25, 6: 24, 7: 23, 8: 22, 9: 21, 10: 20}, 30),
    "op1_line_dedup": _OP1,
    "op6_chat_formatting": _OP6,
    "op2_sharding": _OP2,
    "op3_exact_dedup": _OP3,
    "op5_url_filters": _OP5,
}
