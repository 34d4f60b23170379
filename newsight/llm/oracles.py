"""SQL of corpus queries, for DuckDB over the same tables."""

from __future__ import annotations

# remainders of crc32 by byte: eight steps of the reversed polynomial 0xEDB88320
_CRC = """
crc_steps(i, x, k) AS (
  SELECT range, range::UBIGINT, 0 FROM range(256)
  UNION ALL
  SELECT i, xor(x >> 1, 3988292384::UBIGINT * (x & 1)), k + 1 FROM crc_steps WHERE k < 8
), crc_table AS (SELECT list(x ORDER BY i) AS tab FROM crc_steps WHERE k = 8)
"""


def _crc32(list_of_bytes: str) -> str:
    return f"""xor(4294967295::UBIGINT, list_reduce(
      list_prepend(4294967295::UBIGINT, {list_of_bytes}),
      lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255)::BIGINT + 1])))"""


_DECIMAL = "list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ord(s)::UBIGINT)"

PREFIX_TRIE = f"""
WITH RECURSIVE {_CRC},
turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, substr(sha256(
      length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32)) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, n, {_crc32(_DECIMAL)} % 4 AS h
  FROM (SELECT conv_id, count(*) AS n FROM turns GROUP BY conv_id), crc_table
), rebuilt AS (
  SELECT c.conv_id, t.pos AS depth, t.role, t.text
  FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 20 AND t.pos <= c.h
  UNION ALL
  SELECT c.conv_id, least(c.h, coalesce(b.n, 0)) + t.pos - c.h, t.role, t.text
  FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h
  LEFT JOIN convs b ON b.conv_id = c.conv_id - c.conv_id % 20
), keyed AS (
  SELECT conv_id, depth, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
    sha256(length(role)::VARCHAR || ':' || role || text) AS k
  FROM rebuilt
), paths AS (
  SELECT conv_id, depth, words,
    string_agg(k, '') OVER (PARTITION BY conv_id ORDER BY depth) AS path
  FROM keyed
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs
), ended AS (
  SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS ends,
    min(conv_id) OVER (PARTITION BY depth, path) AS node
  FROM paths
), nodes AS (
  SELECT node, depth, count(*) AS n_convs, any_value(words) AS words,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM ended GROUP BY node, depth
), linked AS (
  SELECT n.*, p.node AS parent
  FROM nodes n LEFT JOIN ended p ON p.conv_id = n.node AND p.depth = n.depth - 1
), children AS (
  SELECT parent, depth - 1 AS depth, count(*) AS n_children FROM linked WHERE depth > 0 GROUP BY ALL
), counted AS (
  SELECT l.*, coalesce(c.n_children, 0) AS n_children
  FROM linked l LEFT JOIN children c ON c.parent = l.node AND c.depth = l.depth
), under AS (
  SELECT a.node, a.depth, sum((d.n_children = 0)::BIGINT) AS n_leaves,
    sum((d.n_convs - 1) * d.words) AS saved_tokens
  FROM counted d JOIN ended a ON a.conv_id = d.node AND a.depth <= d.depth
  GROUP BY a.node, a.depth
)
SELECT c.node AS conv_id, c.depth::BIGINT AS depth, c.parent AS parent_conv_id, c.n_convs::BIGINT AS n_convs,
  c.n_children::BIGINT AS n_children, u.n_leaves::BIGINT AS n_leaves,
  u.saved_tokens::BIGINT AS saved_tokens, c.ends_sha256
FROM counted c JOIN under u USING (node, depth)
"""

# bytes of a text from the hex form of its blob
_BYTES = """list_transform(range(1, len(hexed), 2),
      lambda i: ((instr('0123456789ABCDEF', hexed[i]) - 1) * 16
        + instr('0123456789ABCDEF', hexed[i + 1]) - 1)::UBIGINT)"""

IMPORTANCE = f"""
WITH RECURSIVE {_CRC},
texts AS (
  SELECT 0 AS kind, row_number() OVER () AS row, doc_id, text FROM documents
  UNION ALL SELECT 1, row_number() OVER (), NULL, text FROM benchmark
), split AS (
  SELECT kind, row, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM texts
), features AS (
  SELECT kind, row, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS feature
  FROM split
), hashed AS (
  SELECT feature, hex(encode(feature)) AS hexed FROM (SELECT DISTINCT feature FROM features)
), places AS (
  SELECT feature, {_crc32(_BYTES)} % 10000 AS bucket FROM hashed, crc_table
), placed AS (SELECT f.kind, f.row, p.bucket FROM features f JOIN places p USING (feature)
), counts AS (
  SELECT bucket, count(*) FILTER (kind = 0) AS s, count(*) FILTER (kind = 1) AS t FROM placed GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1) * ((SELECT sum(s) FROM counts) + 10000))::DOUBLE
    / ((s + 1) * ((SELECT sum(t) FROM counts) + 10000))::DOUBLE))::BIGINT AS gain
  FROM counts
), weights AS (
  SELECT p.row, count(*) AS n_features, floor(sum(g.gain)::DOUBLE / count(*))::BIGINT AS weight
  FROM placed p JOIN gains g USING (bucket) WHERE p.kind = 0 GROUP BY p.row
), scored AS (
  SELECT s.doc_id, coalesce(w.n_features, 0) AS n_features, coalesce(w.weight, 0) AS weight,
    len(s.w) >= 20 AS can, coalesce(w.weight, 0) + floor(-1000 * ln(-ln(
      (('0x' || substr(sha256('7:' || coalesce(s.doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
      / 4294967296::DOUBLE)))::BIGINT AS score
  FROM split s LEFT JOIN weights w USING (row) WHERE s.kind = 0
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY can DESC, score DESC, doc_id NULLS FIRST, n_features) AS place,
    count(*) FILTER (can) OVER () AS n
  FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN can AND place <= 25 * n // 100 THEN place END AS rank
FROM ranked
"""

_WORDS = "regexp_extract_all(coalesce({}, ''), '[^\\x20\\x09-\\x0D]+')"

SUBSTRING = f"""
WITH split AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS gram
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM split)
), seen AS (SELECT gram, min(doc_id) AS first FROM windows GROUP BY gram),
covered AS (
  SELECT DISTINCT doc_id, i + j AS pos
  FROM windows JOIN seen USING (gram), range(13) AS r(j) WHERE first < doc_id
), words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM split),
kept AS (
  SELECT doc_id, count(c.pos) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (c.pos IS NULL) AS kept
  FROM words LEFT JOIN covered c USING (doc_id, pos) GROUP BY doc_id
)
SELECT s.doc_id, len(s.w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM split s LEFT JOIN kept USING (doc_id)
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

MINHASH = f"""
WITH RECURSIVE split AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, least(len(w), 1) + 1))) AS i FROM split)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT p.a, p.b
  FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
        FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL) p
    JOIN sizes s ON s.doc_id = p.a JOIN sizes t ON t.doc_id = p.b
  WHERE 100 * common >= 80 * (s.n + t.n - common)
), reach AS (
  SELECT doc_id AS node, doc_id AS low FROM documents
  UNION SELECT l.b, r.low FROM reach r JOIN links l ON l.a = r.node
)
SELECT d.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(r.low) AS component_id,
  min(r.low) = d.doc_id AS kept
FROM documents d JOIN reach r ON r.node = d.doc_id LEFT JOIN sizes s USING (doc_id) GROUP BY d.doc_id
"""

SUFFIX = """
WITH hexed AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
parts AS (  -- 256 windows each, as cutting from a long string is slow
  SELECT doc_id, base, substr(h, 2 * base + 1, 2 * 655) AS part
  FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 399, 256)) AS base FROM hexed)
), windows AS (
  SELECT doc_id, base + j AS i, md5(substr(part, 2 * j + 1, 800)) AS k
  FROM (SELECT doc_id, base, part, unnest(range(0, len(part) // 2 - 399)) AS j FROM parts)
), repeated AS (
  SELECT doc_id, i FROM windows WHERE k IN (SELECT k FROM windows GROUP BY k HAVING count(*) > 1)
), steps AS (
  SELECT *, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 400, TRUE) AS new FROM repeated
), runs AS (
  SELECT doc_id, min(i) AS first, max(i) + 400 AS last
  FROM (SELECT *, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM steps) GROUP BY doc_id, run
), gaps AS (
  SELECT doc_id, coalesce(lag(last) OVER (PARTITION BY doc_id ORDER BY first), 0) AS a, first AS b FROM runs
  UNION ALL SELECT h.doc_id, coalesce(max(r.last), 0), any_value(len(h.h)) // 2
  FROM hexed h LEFT JOIN runs r USING (doc_id) GROUP BY h.doc_id
), kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS kept
  FROM gaps JOIN hexed USING (doc_id) GROUP BY doc_id
), removed AS (SELECT doc_id, sum(last - first) AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id)
SELECT h.doc_id, (len(h.h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
  coalesce(n_spans, 0) AS n_spans, sha256(unhex(k.kept)) AS kept_sha256
FROM hexed h JOIN kept k USING (doc_id) LEFT JOIN removed USING (doc_id)
"""

ORACLES: dict[str, str] = {
    "op2_substring": SUBSTRING,
    "op6_minhash": MINHASH,
    "op10_suffix": SUFFIX,
    "op12_prefix_trie": PREFIX_TRIE,
    "op13_importance": IMPORTANCE,
}
