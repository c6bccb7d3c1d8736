"""Operators whose whole result SQL can state, as DuckDB statements over the given tables."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Distinct sets are nodes; every two of them that share a shingle are compared in full.
MINHASH = rf"""
WITH RECURSIVE read AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_sort(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3
    THEN [array_to_string(w, ' ')]
    ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]
                        FOR i IN range(1, len(w) - 1)]) END) AS s
  FROM read),
nodes AS (SELECT s, min(doc_id) AS node, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
members AS (SELECT node, n, unnest(s) AS shingle FROM nodes),
links AS (
  SELECT a.node AS u, b.node AS v
  FROM members a JOIN members b ON a.shingle = b.shingle AND a.node <> b.node
  WHERE 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reached AS (
  SELECT node, node AS other FROM nodes
  UNION SELECT r.node, l.v FROM reached r JOIN links l ON r.other = l.u),
named AS (SELECT node, min(other) AS component_id FROM reached GROUP BY node)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles,
  coalesce(c.component_id, s.doc_id) AS component_id,
  s.doc_id = coalesce(c.component_id, s.doc_id) AS kept
FROM sets s LEFT JOIN nodes n ON s.s = n.s LEFT JOIN named c ON n.node = c.node
"""

# CRC-32 by its table, a byte at a time; near words by the places at which they lose a letter.
SPELLING = rf"""
WITH RECURSIVE steps AS (
  SELECT i, i AS c, 0 AS k FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1
  FROM steps WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run
  FROM documents),
counted AS (
  SELECT doc_id, run, count(*) AS n, hex(encode(concat(doc_id, ':', run))) AS b
  FROM runs WHERE length(run) >= 7 GROUP BY doc_id, run),
marked AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_prepend(4294967295, [CAST('0x' || substr(b, i, 2) AS BIGINT)
                              FOR i IN range(1, length(b), 2)]),
    lambda c, x: xor(c >> 8, t[CAST(xor(c, x) & 255 AS INTEGER) + 1]))) AS h
  FROM counted, crc),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT n, CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run))
          || substr(run, h % length(run) + 2) ELSE run END AS word FROM marked)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
shorter AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM words, range(1, 100000) t(i) WHERE i <= length(word)),
near AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM shorter a JOIN shorter b
    ON a.rest = b.rest AND a.i = b.i WHERE a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM words a JOIN shorter b ON a.word = b.rest
  UNION SELECT b.word, b.n, a.word, a.n FROM words a JOIN shorter b ON a.word = b.rest),
judged AS (
  SELECT word, n, count(*) AS n_near, max(near_n) AS top,
    min(near) FILTER (WHERE near_n = best) AS form
  FROM (SELECT *, max(near_n) OVER (PARTITION BY word) AS best FROM near) GROUP BY word, n),
forms AS (SELECT word, form, top FROM judged WHERE top >= 10 * n),
paths AS (
  SELECT word, form AS root, 1 AS steps FROM forms
  UNION ALL SELECT p.word, f.form, p.steps + 1 FROM paths p JOIN forms f ON p.root = f.word),
roots AS (SELECT word, arg_max(root, steps) AS root FROM paths GROUP BY word)
SELECT w.word, f.form, coalesce(r.root, w.word) AS root, w.n,
  coalesce(j.n_near, 0) AS n_near, f.top AS form_n
FROM words w LEFT JOIN judged j ON w.word = j.word LEFT JOIN forms f ON w.word = f.word
  LEFT JOIN roots r ON w.word = r.word
"""

# Bytes as pairs of hexadecimal digits; windows that start later than an equal one go.
SUFFIXES = """
WITH docs AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h,
    CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n FROM documents),
chunks AS (
  SELECT doc_id, n, base, substr(h, 2 * base + 1, 2198) AS c
  FROM (SELECT doc_id, n, h, unnest(range(0, greatest(n - 99, 0), 1000)) AS base FROM docs)),
windows AS (
  SELECT doc_id, base + j AS i, substr(c, 2 * j + 1, 200) AS w
  FROM (SELECT doc_id, base, c, unnest(range(0, least(1000, n - 99 - base))) AS j FROM chunks)),
repeated AS (
  SELECT w, min((doc_id, i)) AS earliest FROM windows GROUP BY w HAVING count(*) > 1),
again AS (
  SELECT s.doc_id, s.i FROM windows s JOIN repeated r ON s.w = r.w
  WHERE (s.doc_id, s.i) > r.earliest),
cut AS (
  SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100, true) AS new
  FROM again),
numbered AS (
  SELECT doc_id, i, count(*) FILTER (WHERE new) OVER (PARTITION BY doc_id ORDER BY i) AS span
  FROM cut),
spans AS (
  SELECT doc_id, min(i) AS b, max(i) + 100 AS e FROM numbered GROUP BY doc_id, span),
pieces AS (
  SELECT doc_id, b, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY b), 0) AS before
  FROM spans),
kept AS (
  SELECT p.doc_id, count(*) AS n_spans, sum(e - b) AS n_removed,
    string_agg(substr(h, 2 * before + 1, 2 * (b - before)), '' ORDER BY b)
      || substr(any_value(h), 2 * max(e) + 1) AS rest
  FROM pieces p JOIN docs d ON p.doc_id = d.doc_id GROUP BY p.doc_id)
SELECT d.doc_id, d.n AS n_bytes, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed,
  coalesce(k.n_spans, 0) AS n_spans, sha256(unhex(coalesce(k.rest, d.h))) AS kept_sha256
FROM docs d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

ORACLES = {"op4_suffix_dedup": SUFFIXES, "op10_minhash": MINHASH, "op11_spelling": SPELLING}
