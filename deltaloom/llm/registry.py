"""The queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from deltaloom.llm import chat, hard_negatives, language, mixing, ngrams, packing, resampling, secret_scan, simhash, suffixes, toxicity, vectors

OP3_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
  CAST(sum(length('<turn><says></turn>') + length(replace(replace(role, '\', '\\'), '<', '\l')) + length(replace(replace(text, '\', '\\'), '<', '\l'))) AS BIGINT) AS formatted_chars,
  CAST(0 AS BIGINT) AS attachment_tokens
FROM turns GROUP BY conv_id
"""

#: Each window of 100 bytes as 200 hexadecimal digits; rows of one doc_id would need the operator's digests, and stand by text here.
OP7_SQL = """
WITH d AS (
  SELECT row_number() OVER (ORDER BY doc_id NULLS LAST, text) AS n, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
parts AS (
  SELECT n, start_, substr(h, 2 * start_ + 1, 2 * (400 + 99)) AS part FROM (SELECT n, h, unnest(range(0, greatest(0, len(h) // 2 - 99), 400)) AS start_ FROM d)),
windows AS (
  SELECT n, start_ + i AS p, substr(part, 2 * i + 1, 200) AS w FROM (SELECT n, start_, part, unnest(range(0, least(400, len(part) // 2 - 99))) AS i FROM parts)),
repeats AS (SELECT n, p FROM (SELECT n, p, row_number() OVER (PARTITION BY w ORDER BY n, p) AS k FROM windows) WHERE k > 1),
marked AS (SELECT n, p, coalesce(p > lag(p) OVER o + 100, true) AS fresh FROM repeats WINDOW o AS (PARTITION BY n ORDER BY p)),
numbered AS (SELECT n, p, count(*) FILTER (fresh) OVER (PARTITION BY n ORDER BY p) AS g FROM marked),
spans AS (SELECT n, min(p) AS a, max(p) + 100 AS b FROM numbered GROUP BY n, g),
pieces AS (SELECT n, a, b, coalesce(lag(b) OVER (PARTITION BY n ORDER BY a), 0) AS since FROM spans),
cut AS (
  SELECT n, sum(b - a) AS removed, count(*) AS many, max(b) AS last, string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) AS kept
  FROM pieces JOIN d USING (n) GROUP BY n)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(many, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN cut USING (n)
"""

OP9_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM scored)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM ranked WHERE n <= 20
"""

#: CRC-32 by the 256-entry table of its rule, byte by byte of each distinct feature.
OP11_SQL = r"""
WITH rule AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) r(i))),
texts AS (SELECT row_number() OVER () AS n, doc_id, text FROM documents UNION ALL SELECT -row_number() OVER (), NULL, text FROM benchmark),
words AS (
  SELECT n, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM texts),
runs AS (
  SELECT n, unnest(w) AS f FROM words
  UNION ALL SELECT n, unnest(list_transform(range(1, greatest(1, len(w))), lambda i: w[i] || ' ' || w[i + 1])) FROM words),
counted AS (SELECT n, f, count(*) AS c FROM runs GROUP BY ALL),
bytes AS (
  SELECT f, list_transform(range(strlen(f)), lambda i: CAST('0x' || substr(hex(encode(f)), 2 * i + 1, 2) AS BIGINT)) AS b FROM (SELECT DISTINCT f FROM counted)),
bucketed AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, t[1 + (xor(c, x) & 255)])), 4294967295) % 10000 AS k FROM bytes, rule),
totals AS (SELECT k, sum(c) FILTER (n > 0) AS s, sum(c) FILTER (n < 0) AS t FROM counted JOIN bucketed USING (f) GROUP BY k),
sums AS (SELECT coalesce(sum(s), 0) AS ss, coalesce(sum(t), 0) AS tt FROM totals),
gains AS (
  SELECT k, CAST(floor(1000 * ln((CAST(coalesce(t, 0) AS DOUBLE) + 1) * CAST(ss + 10000 AS DOUBLE) / ((CAST(coalesce(s, 0) AS DOUBLE) + 1) * CAST(tt + 10000 AS DOUBLE)))) AS BIGINT) AS g
  FROM totals, sums),
weights AS (
  SELECT n, CAST(sum(c) AS BIGINT) AS n_features, CAST(floor(sum(c * g) / sum(c)) AS BIGINT) AS weight
  FROM counted JOIN bucketed USING (f) JOIN gains USING (k) WHERE n > 0 GROUP BY n),
noise AS (SELECT n, doc_id, len(w) AS n_words, CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h FROM words WHERE n > 0),
scored AS (
  SELECT n, doc_id, n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) AS BIGINT) AS score
  FROM noise LEFT JOIN weights USING (n)),
placed AS (
  SELECT n, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS r, count(*) OVER () AS many FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 25 * many // 100 THEN r END AS rank FROM scored LEFT JOIN placed USING (n)
"""

OP12_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.x, c.x) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND (a.label <> c.label OR c.vec_id <> a.vec_id)),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
windows AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS n
  FROM positives JOIN scored USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(n AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM windows WHERE n <= 10
"""

#: Matches are put between two marks, at which texts are cut; the lengths of the pieces tell where matches begin. Of tokens with a checksum, CRC-32 bit by bit.
OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS text FROM documents),
kinds AS (SELECT * FROM (VALUES
  (1, 'assign', '((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+)'),
  (2, 'access', '(AKIA[A-Z0-9]+)'), (3, 'hex', '([0-9a-f]+)'), (4, 'github', '(gh[pousr]_[0-9A-Za-z]+)'), (5, 'npm', '(npm_[0-9A-Za-z]+)')) k(o, kind, pattern)),
cut AS (SELECT n, o, kind, string_split(regexp_replace(text, pattern, chr(1114108) || '\1' || chr(1114109), 'g'), chr(1114108)) AS parts FROM d, kinds),
pieces AS (SELECT n, o, kind, unnest(parts) AS piece, unnest(range(len(parts))) AS i FROM cut WHERE len(parts) > 1),
placed AS (
  SELECT n, o, kind, i, split_part(piece, chr(1114109), 1) AS m,
    coalesce(sum(length(piece) - (i > 0)::INT) OVER (PARTITION BY n, o ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a
  FROM pieces),
known AS (
  SELECT n, o, kind, a, a + length(m) AS b, CASE WHEN o > 3 THEN substr(m, strpos(m, '_') + 1) END AS body, m FROM placed WHERE i > 0
    AND CASE o WHEN 1 THEN length(regexp_extract(m, '[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)$', 1)) >= 8 WHEN 2 THEN length(m) >= 16 WHEN 3 THEN length(m) >= 32 ELSE length(m) = 36 + strpos(m, '_') END),
summed AS (
  SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(substr(body, 1, 30), ''), lambda c: [CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
    lambda c, x: CASE WHEN xor(c, x) & 1 = 1 THEN xor(xor(c, x) >> 1, 3988292384) ELSE xor(c, x) >> 1 END)) AS crc
  FROM known),
good AS (
  SELECT n, o, kind, a, b FROM summed
  WHERE o <= 3 OR substr(body, 31) = array_to_string(list_transform([5, 4, 3, 2, 1, 0],
    lambda p: substr('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz', CAST(crc // CAST(62 ** p AS BIGINT) % 62 AS INT) + 1, 1)), '')),
told AS (
  SELECT n, count(*) FILTER (o = 1) AS n1, count(*) FILTER (o = 2) AS n2, count(*) FILTER (o = 3) AS n3,
    string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, o) FILTER (o <= 3) AS base, string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, o) AS spans
  FROM good GROUP BY n)
SELECT doc_id, coalesce(n1, 0) AS n_assign, coalesce(n2, 0) AS n_access, coalesce(n3, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN told USING (n)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": toxicity.op1_toxicity,
        "op2_language_id": language.op2_language_id,
        "op3_chat_formatting": chat.op3_chat_formatting,
        "op4_simhash": simhash.op4_simhash,
        "op5_ann": vectors.op5_ann,
        "op6_packing": packing.op6_packing,
        "op7_suffix_dedup": suffixes.op7_suffix_dedup,
        "op8_mixing": mixing.op8_mixing,
        "op9_ball_tree": vectors.op9_ball_tree,
        "op10_lm_scoring": ngrams.op10_lm_scoring,
        "op11_importance": resampling.op11_importance,
        "op12_hard_negatives": hard_negatives.op12_hard_negatives,
        "op13_secrets": secret_scan.op13_secrets,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_chat_formatting": OP3_SQL, "op7_suffix_dedup": OP7_SQL, "op9_ball_tree": OP9_SQL, "op11_importance": OP11_SQL, "op12_hard_negatives": OP12_SQL, "op13_secrets": OP13_SQL}
