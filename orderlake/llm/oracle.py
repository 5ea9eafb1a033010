"""DuckDB SQL for the queries that SQL can express, over the same tables."""

from __future__ import annotations

from orderlake.llm.queries import PROBE

_WORD = r"[^\x20\x09-\x0D]+"

_OP1 = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
h AS (SELECT doc_id, hex(b) AS h, octet_length(b) AS n FROM d),
w AS (SELECT doc_id, s, md5(substr(h, 2 * s + 1, 200)) AS k FROM (SELECT *, unnest(range(0, n - 99)) AS s FROM h WHERE n >= 100)),
f AS (SELECT doc_id, s FROM w QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, s) > 1),
m AS (SELECT doc_id, s, lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS p FROM f),
g AS (SELECT doc_id, s, sum(CASE WHEN p IS NULL OR s > p + 100 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY s) AS r FROM m),
spans AS (SELECT doc_id, r, min(s) AS a, max(s) + 100 AS b FROM g GROUP BY doc_id, r),
pieces AS (
  SELECT doc_id, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS x, a AS y FROM spans
  UNION ALL
  SELECT h.doc_id, coalesce(max(b), 0), any_value(n) FROM h LEFT JOIN spans ON spans.doc_id = h.doc_id GROUP BY h.doc_id),
kept AS (
  SELECT p.doc_id, string_agg(substr(h.h, 2 * x + 1, 2 * (y - x)), '' ORDER BY x) AS k
  FROM pieces p JOIN h ON h.doc_id = p.doc_id GROUP BY p.doc_id),
counts AS (SELECT doc_id, sum(b - a) AS removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT h.doc_id, n::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(k)) AS kept_sha256
FROM h JOIN kept ON kept.doc_id = h.doc_id LEFT JOIN counts ON counts.doc_id = h.doc_id
"""

_OP2 = f"""
WITH s AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR,
      'null' || md5(coalesce(text, '')) || ':' || row_number() OVER (PARTITION BY doc_id, md5(coalesce(text, ''))))), 1, 15))::BIGINT AS h
  FROM documents),
t AS (SELECT source, sum(size)::BIGINT AS ss FROM s GROUP BY source),
w AS (SELECT source, ss, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1)::BIGINT % 3 + 1]::DOUBLE AS w FROM t),
o AS (
  SELECT *, 2.0 * ss / w AS ratio,
    coalesce(sum(ss) OVER (ORDER BY 2.0 * ss / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS cut,
    sum(w) OVER (ORDER BY 2.0 * ss / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest_w,
    (sum(ss) OVER ())::DOUBLE AS total
  FROM w),
r AS (SELECT (1.5 * total - 2.0 * cut) / rest_w AS rate FROM o WHERE ratio >= (1.5 * total - 2.0 * cut) / rest_w ORDER BY ratio LIMIT 1),
g AS (SELECT source, ss, least(2.0 * ss, w * rate)::DOUBLE AS target FROM w, r),
b AS (SELECT *, CASE WHEN ss > 0 THEN floor(target / ss) ELSE 0 END AS whole FROM g),
c AS (
  SELECT s.*, ss, target, whole, target - whole * ss AS rest,
    sum(size) OVER (PARTITION BY s.source ORDER BY h) AS upto,
    sum(size) OVER (PARTITION BY s.source, h) AS here
  FROM s JOIN b ON s.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, ss AS source_size, target,
  (size * (whole + CASE WHEN rest > 0 AND (upto <= rest OR (upto - here < rest AND upto - rest < rest - (upto - here))) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c
"""

_OP3 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)
  UNION ALL
  SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) IN (1, 2)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM c JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * common >= 90 * (a.n + b.n - common)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(doc_id, x) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.x)
SELECT r.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.x) AS component_id
FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""


def _escaped(x: str) -> str:
    return f"replace(replace(replace({x}, '\\', '\\\\'), '### ', '\\### '), '</turn>', '\\</turn>')"


_OP4 = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{PROBE}' UNION ALL SELECT -7, 1, 'assistant', '{PROBE}'),
f AS (
  SELECT *, '### ' || CASE role WHEN 'system' THEN 'System' WHEN 'user' THEN 'User' WHEN 'assistant' THEN 'Assistant'
    ELSE '=' || replace({_escaped('role')}, ':', '\\:') END || ': ' || {_escaped('text')} || '</turn>' || chr(10) AS formatted
  FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(formatted))::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
"""

_OP6 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{_WORD}') AS w FROM d),
x AS (SELECT r, i, array_to_string(w[i : i + 7], ' ') AS k FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM w WHERE len(w) >= 8)),
y AS (SELECT r, i FROM x QUALIFY count(*) OVER (PARTITION BY r, k) > 1),
z AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM y) GROUP BY r),
l AS (SELECT r, doc_id, source, unnest(string_split(t, chr(10))) AS line FROM d),
k AS (
  SELECT r, doc_id, source, line, len(regexp_extract_all(line, '{_WORD}')) AS n,
    regexp_replace(trim(regexp_replace(lower(line), '[\\x20\\x09-\\x0D]+', ' ', 'g')), '[0-9]', '0', 'g') AS norm
  FROM l WHERE regexp_matches(line, '{_WORD}')),
q AS (SELECT source, norm FROM k GROUP BY source, norm HAVING count(DISTINCT doc_id) > 50),
gone AS (SELECT r, sum(n) AS n FROM k JOIN q ON k.norm = q.norm AND k.source IS NOT DISTINCT FROM q.source GROUP BY r),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM k GROUP BY r),
m AS (
  SELECT w.r, w.doc_id, len(w.w)::BIGINT AS n_words, length(array_to_string(w.w, ''))::BIGINT AS word_chars,
    length(regexp_replace(w.t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(dup.n, 0)::BIGINT AS n_dup_lines,
    coalesce(z.n, 0)::BIGINT AS n_repeat_words, (len(w.w) - coalesce(gone.n, 0))::BIGINT AS n_left_words
  FROM w LEFT JOIN z ON z.r = w.r LEFT JOIN dup ON dup.r = w.r LEFT JOIN gone ON gone.r = w.r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND n_left_words >= 20 AND 100 * n_left_words >= 50 * n_words AS kept, n_left_words
FROM m
"""

_OP8 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, (row_number() OVER o)::INTEGER AS rank, vec_id, score FROM s
WINDOW o AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER o <= 10
"""

_OP9 = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS n, sha1(encode(coalesce(html, ''))) AS digest FROM pages),
f AS (SELECT digest, n, max(page_id) AS first FROM p WHERE n >= 1000 GROUP BY digest, n)
SELECT page_id, p.n AS payload_bytes, p.digest AS payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON p.digest = f.digest AND p.n = f.n
"""

_OP11 = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
t AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
g AS (
  SELECT lang, size, array_to_string(w[i : i + size - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM (SELECT *, unnest([1, 2, 3, 4, 5]) AS size FROM w) WHERE len(w) >= size)),
f AS (SELECT lang, size, phrase, count(*)::BIGINT AS f FROM g GROUP BY lang, size, phrase HAVING count(*) >= 100),
c AS (SELECT * FROM f WHERE size > 1),
kept AS (
  SELECT c.* FROM c WHERE NOT EXISTS (
    SELECT 1 FROM c x WHERE x.lang = c.lang AND x.size > c.size AND 100 * x.f >= 100 * c.f AND contains(' ' || x.phrase || ' ', ' ' || c.phrase || ' '))),
cuts AS (
  SELECT lang, phrase, f AS a, k, array_to_string(ws[:k], ' ') AS head, array_to_string(ws[k + 1:], ' ') AS tail
  FROM (SELECT *, string_split(phrase, ' ') AS ws, unnest(range(1, size)) AS k FROM kept)),
s AS (
  SELECT cuts.lang, cuts.phrase, a, k, x.f AS l, y.f AS r, n, ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = head JOIN f y ON y.lang = cuts.lang AND y.phrase = tail JOIN t ON t.lang = cuts.lang
  QUALIFY row_number() OVER (PARTITION BY cuts.lang, cuts.phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER o AS rank, phrase, a, l, r, n, score FROM s
WINDOW o AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) QUALIFY row_number() OVER o <= 2000
"""

_OP13 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.v, c.v)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, (row_number() OVER o)::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW o AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER o <= 10
"""

#: Networks, tokenizers, alignments and random fields (5, 7, 10, 12) have no SQL form; tests hold them against brute force.
ORACLE: dict[str, str] = {
    "op1_suffix_dedup": _OP1, "op2_source_mixing": _OP2, "op3_ngram_join": _OP3, "op4_chat_format": _OP4,
    "op6_line_quality": _OP6, "op8_exact_topk": _OP8, "op9_warc": _OP9,
    "op11_collocations": _OP11, "op13_hard_negatives": _OP13,
}
