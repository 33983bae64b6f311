"""The same answers as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

_URL = r"""
WITH rules(host, path, verdict) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
parts AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM cut),
fits AS (
  SELECT p.page_id, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host || r.path) DESC) AS place
  FROM parts p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f ON f.page_id = p.page_id AND f.place = 1
"""

# DuckDB has no SHA-1 in base 32 at hand: five bytes of the hex digest make eight characters.
_B32 = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(hex, {a}, 10))::BIGINT >> {s}) & 31)::INT, 1)"
_DIGEST = " || ".join(_B32.format(a=a, s=s) for a in (1, 11, 21, 31) for s in range(35, -1, -5))
_WARC = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages),
g AS (SELECT hex, max(page_id) AS first FROM p GROUP BY hex)
SELECT page_id, octet_length(encode(body))::BIGINT AS payload_bytes, {_DIGEST} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM p JOIN g USING (hex)
"""


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
#: With a relation of documents in place of {{docs}}: per document n_words, n_hit, the items and contaminated.
DECONTAMINATE = f"""
items AS (SELECT item_id::VARCHAR AS item, {_ITEM_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(w), 13) AS n,
         array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS gram
  FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM items WHERE len(w) > 0)),
doc_words AS (SELECT doc_id, {_ITEM_WORDS} AS w FROM {{docs}}),
lengths AS (SELECT DISTINCT n FROM windows),
probes AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words, lengths WHERE len(w) >= n)),
found AS (SELECT doc_id, n, i, item FROM probes JOIN windows USING (n, gram)),
covered AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS word FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item) AS n_items, array_to_string(list_sort(list(DISTINCT item)), ',') AS items FROM found GROUP BY doc_id),
judged AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
         sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
  FROM doc_words LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id))
"""

_SPACED = f"regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+')"
#: With a relation of documents in place of {{docs}}: doc_id, n_shingles, component_id.
SIMILAR = f"""
shingled AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM (SELECT doc_id, {_SPACED} AS w FROM {{docs}}) WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingled GROUP BY doc_id),
shared AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS i FROM shingled a JOIN shingled b USING (shingle) WHERE a.doc_id != b.doc_id GROUP BY ALL),
links AS (SELECT u, v FROM shared JOIN sizes a ON a.doc_id = u JOIN sizes b ON b.doc_id = v WHERE 100 * i >= 90 * (a.n + b.n - i)),
reach AS (
  SELECT doc_id AS node, doc_id AS other FROM {{docs}}
  UNION
  SELECT reach.node, links.v FROM reach JOIN links ON links.u = reach.other),
linked AS (
  SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
  FROM (SELECT node AS doc_id, min(other) AS component_id FROM reach GROUP BY node) LEFT JOIN sizes USING (doc_id))
"""

_SIMILAR = f"WITH RECURSIVE {SIMILAR.format(docs='documents')} SELECT * FROM linked"

_DECONTAMINATE = f"WITH {DECONTAMINATE.format(docs='documents')} SELECT * FROM judged"


_HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS same, list_inner_product(a.e, c.e)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.other_id AS positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY n.score DESC, n.other_id)::INT AS rank,
       n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same AND 100 * n.score BETWEEN 30 * p.score AND 90 * p.score
QUALIFY rank <= 10
"""

# DuckDB has no CRC-32: a byte at a time, eight shifts each (reversed polynomial 0xEDB88320).
_BYTE = (
    "list_reduce([xor(r, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)"
)
_BYTES = "list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT))"
CRC = f"xor(list_reduce({_BYTES}, lambda r, b: {_BYTE}), 4294967295::BIGINT)"

_TRIE = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT conv_id, conv_id - conv_id % 20 AS other_id, {CRC} % 4 AS taken FROM (SELECT DISTINCT conv_id FROM t)),
rebuilt AS (
  SELECT i.conv_id, 0 AS own, t.place, t.role, t.text FROM ids i JOIN t ON t.conv_id = i.other_id AND t.place <= i.taken
  UNION ALL
  SELECT i.conv_id, 1, t.place, t.role, t.text FROM ids i JOIN t ON t.conv_id = i.conv_id AND t.place > i.taken),
turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, place) AS depth,
         len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS n_words, sha256(len(role) || ':' || role || ':' || text) AS turn
  FROM rebuilt),
paths AS (
  SELECT conv_id, depth, n_words, string_agg(turn, '') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM turns
  UNION ALL SELECT conv_id, 0, 0, '' FROM ids),
sizes AS (SELECT conv_id, max(depth) AS size FROM paths GROUP BY conv_id),
nodes AS (
  SELECT path, min(conv_id) AS conv_id, min(depth) AS depth, count(*) AS n_convs, min(n_words) AS n_words,
         sha256(coalesce(string_agg(CASE WHEN depth = size THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM paths JOIN sizes USING (conv_id) GROUP BY path),
children AS (SELECT left(path, length(path) - 64) AS path, count(*) AS n FROM nodes WHERE path <> '' GROUP BY 1),
each AS (SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c USING (path))
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children,
       count(*) FILTER (b.n_children = 0) AS n_leaves, sum((b.n_convs - 1) * b.n_words)::BIGINT AS saved_tokens, n.ends_sha256
FROM each n JOIN each b ON starts_with(b.path, n.path) LEFT JOIN nodes p ON n.path <> '' AND p.path = left(n.path, length(n.path) - 64)
GROUP BY n.path, n.conv_id, n.depth, p.conv_id, n.n_convs, n.n_children, n.ends_sha256
"""


def oracles() -> dict[str, str]:
    return {
        "op2_url_rules": _URL, "op4_decontaminate": _DECONTAMINATE, "op6_similar": _SIMILAR, "op9_archives": _WARC,
        "op11_hard_negatives": _HARD_NEGATIVES, "op13_prefix_trie": _TRIE,
    }
