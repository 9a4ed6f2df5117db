"""DuckDB SQL for the queries on damaged and rebuilt conversations."""

from __future__ import annotations

# CRC-32 as a fold over the bytes of a text.
_CRC_TABLE = r"""crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
      lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM (SELECT unnest(range(256)) AS i))
)"""


def _crc32(text: str) -> str:
    b = f"encode({text})"
    return f"""xor(list_reduce([4294967295]::BIGINT[] || list_transform(range(octet_length({b})),
        lambda i: ('0x' || hex({b})[2 * i + 1:2 * i + 2])::BIGINT),
      lambda c, x: xor(c >> 8, t[xor(c, x) % 256 + 1])), 4294967295)"""


# The cheapest edits by recursion over the rows, one step for all conversations; the
# least string of a state is kept as no string of one row number is another's prefix.
OP12 = rf"""
WITH RECURSIVE {_CRC_TABLE}, g AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS code
  FROM conversations, crc_table
), d AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
         CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN code = 3 THEN 2 ELSE 1 END)) AS copy
  FROM g WHERE code <> 0
), o AS (
  SELECT conv_id, turn, role, text, role[1] AS initial, row_number() OVER w AS i, lag(role[1]) OVER w AS prior,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text))
), y AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS seen FROM o
), r AS (
  SELECT *, CASE WHEN bare = '' THEN 'b' WHEN seen > 1 THEN 'd' WHEN NOT regexp_matches(bare, '[.!?]$') THEN 't' ELSE '.' END AS fault
  FROM y
), inserts(p, m, paid, made) AS (
  VALUES (0, 0, 0, ''), (0, 2, 3, 'I'), (0, 3, 6, 'II'), (1, 1, 0, ''), (1, 2, 3, 'I'), (1, 3, 6, 'II'), (2, 2, 0, ''), (2, 3, 3, 'I'),
         (3, 3, 0, ''), (3, 2, 3, 'I')
), edits(of, m, q, price, letter) AS (
  VALUES ('s', 0, 1, 0, 'K'), ('u', 0, 2, 0, 'K'), ('u', 1, 2, 0, 'K'), ('u', 3, 2, 0, 'K'), ('a', 2, 3, 0, 'K'),
         ('', 0, 2, 3, 'R'), ('', 1, 2, 3, 'R'), ('', 3, 2, 3, 'R'), ('', 2, 3, 3, 'R'),
         ('', 0, 0, 4, 'D'), ('', 1, 1, 4, 'D'), ('', 2, 2, 4, 'D'), ('', 3, 3, 4, 'D')
), moves AS (
  SELECT p, q, of, letter, paid + price AS price, made || letter AS made FROM inserts JOIN edits USING (m)
), kinds AS (  -- every row's moves, by its initial and fault
  SELECT initial, fault, p, q, min({{'price': price + CASE WHEN fault = 't' AND letter <> 'D' THEN 3 ELSE 0 END, 'made': made}}) AS best
  FROM (SELECT DISTINCT initial, fault FROM r) JOIN moves ON (of = '' OR of = initial) AND (letter = 'D' OR fault NOT IN ('b', 'd'))
  GROUP BY initial, fault, p, q
), dp AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS state, {{'cost': 0, 'audit': ''}} AS best FROM conversations
  UNION ALL
  SELECT dp.conv_id, r.i, q, min({{'cost': dp.best.cost + kinds.best.price, 'audit': dp.best.audit || kinds.best.made}})
  FROM dp JOIN r ON r.conv_id IS NOT DISTINCT FROM dp.conv_id AND r.i = dp.i + 1
  JOIN kinds ON kinds.initial = r.initial AND kinds.fault = r.fault AND kinds.p = dp.state
  GROUP BY dp.conv_id, r.i, q
), closing(state, price, made) AS (
  VALUES (0, 0, ''), (1, 6, 'II'), (2, 3, 'I'), (3, 0, '')
), done AS (
  SELECT conv_id, min({{'cost': best.cost + price, 'audit': best.audit || made}}) AS best
  FROM (SELECT *, i = max(i) OVER (PARTITION BY conv_id) AS last FROM dp) JOIN closing USING (state) WHERE last GROUP BY conv_id
), e AS (
  SELECT conv_id, unnest(regexp_extract_all(best.audit, '.')) AS e, generate_subscripts(regexp_extract_all(best.audit, '.'), 1) AS place FROM done
), f AS (
  SELECT *, count(*) FILTER (e <> 'I') OVER (PARTITION BY conv_id ORDER BY place) AS i FROM e
), h AS (  -- lines that are left, with their number
  SELECT f.conv_id, place, e, role, text, initial, row_number() OVER (PARTITION BY f.conv_id ORDER BY place) AS line
  FROM f LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM f.conv_id AND r.i = f.i AND e <> 'I' WHERE e <> 'D'
), j AS (
  SELECT *, bool_or(line = 1 AND e = 'K' AND initial = 's') OVER (PARTITION BY conv_id) AS system FROM h
), t AS (
  SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (line - CASE WHEN system THEN 1 ELSE 0 END) % 2 = 1 THEN 'user' ELSE 'assistant' END
                             || ':' || coalesce(text, ''), chr(10) ORDER BY place) AS text FROM j GROUP BY conv_id
), n AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
         count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (i > 1 AND prior || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id
)
SELECT done.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.cost::BIGINT AS cost, best.audit AS audit,
       sha256(coalesce(t.text, '')) AS repaired_sha256
FROM done LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM done.conv_id LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM done.conv_id
"""

# Nodes are whole paths of SHA-256 marks; every node is joined to the nodes above it.
OP13 = rf"""
WITH {_CRC_TABLE}, o AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text)) - 1 AS i,
         sha256(length(role) || ':' || role || text) AS mark, length(text) AS chars
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
), c AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, {_crc32('CAST(conv_id AS VARCHAR)')} % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM o), crc_table
), b AS (
  SELECT conv_id AS base, count(*) AS held FROM o GROUP BY conv_id
), r AS (
  SELECT c.conv_id, i + 1 AS depth, mark, chars FROM c JOIN o ON o.conv_id = base AND i < h
  UNION ALL
  SELECT c.conv_id, i + 1 - h + least(h, coalesce(held, 0)), mark, chars FROM c JOIN o USING (conv_id) LEFT JOIN b USING (base) WHERE i >= h
), p AS (
  SELECT conv_id, depth, chars, string_agg(mark, ',') OVER (PARTITION BY conv_id ORDER BY depth ROWS UNBOUNDED PRECEDING) AS path FROM r
  UNION ALL
  SELECT conv_id, 0, 0, '' FROM c
), l AS (
  SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM p
), n AS (
  SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars,
         coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (ends), '') AS enders,
         CASE WHEN depth > 1 THEN path[:-66] ELSE '' END AS up
  FROM l GROUP BY depth, path
), k AS (
  SELECT depth - 1 AS depth, up AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL
), m AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (depth, path)
), s AS (
  SELECT a.depth, a.path, sum(CASE WHEN m.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((m.n_convs - 1) * m.chars) AS saved_tokens
  FROM m JOIN l a ON a.conv_id = m.conv_id AND a.depth <= m.depth GROUP BY ALL
)
SELECT m.conv_id, m.depth, u.conv_id AS parent_conv_id, m.n_convs, m.n_children, n_leaves, saved_tokens, sha256(m.enders) AS ends_sha256
FROM m JOIN s USING (depth, path) LEFT JOIN m u ON u.depth = m.depth - 1 AND u.path = m.up
"""
