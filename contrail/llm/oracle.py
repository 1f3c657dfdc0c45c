"""The same results as SQL, where SQL can express them.

No SQL form: op1 (search over a lattice), op2 and op3 (normalisation and CRC-32
have none in the checking engine), op6 (hashes of the draws), op7 and op9
(trained models), op12 (eigenvectors) and op13 (patterns with checks, iterated
scores); their tests compare with brute force or held-out labels.
"""

from contrail.llm.quality_rules import STOP_WORDS

_STOP = ", ".join(f"'{w}'" for w in sorted({w for words in STOP_WORDS.values() for w in words.split()}))

# Shared text forms: words, and lines that hold a word.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLE_SQL: dict[str, str] = {
    "op4_ngram_jaccard_join": rf"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
g AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE []::VARCHAR[] END) AS gram
  FROM d),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY 1, 2),
edge AS (SELECT x, y FROM common JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 5 * k >= 4 * (nx.n + ny.n - k)),
reach(doc_id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT edge.y, reach.root FROM reach JOIN edge ON edge.x = reach.doc_id),
class AS (SELECT doc_id, min(root) AS class_id FROM reach GROUP BY doc_id),
links AS (SELECT x, count(*) AS links FROM edge GROUP BY x)
SELECT class.doc_id, class_id, coalesce(links, 0)::BIGINT AS links FROM class LEFT JOIN links ON x = class.doc_id
""",
    "op5_warc_bundles": """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
h AS (SELECT page_id, strlen(body)::BIGINT AS payload_bytes, sha1(body) AS sha, min(page_id) OVER (PARTITION BY sha1(body)) AS least FROM p)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(sha, (k // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (k % 4))) & 31) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = least THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> least THEN least END AS refers_to
FROM h
""",
    "op8_quality_rules": rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
w AS (SELECT doc_id, unnest(range(1, len(ws) - 3)) AS i, ws FROM d WHERE len(ws) >= 5),
v AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(ws[i:i + 4], ' ')) AS c FROM w),
r AS (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS j FROM v WHERE c > 1),
s AS (SELECT doc_id, sum(least(5, coalesce(j - i, 5)))::BIGINT AS n FROM r GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(ws)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(s.n, 0)::BIGINT AS n_repeat_words,
    len(ls)::BIGINT AS n_lines,
    (length(t) - length(replace(t, '!', '')))::BIGINT AS n_marks,
    len(list_filter(ws, lambda x: lower(x) IN ({_STOP})))::BIGINT AS n_stop_words
  FROM d LEFT JOIN s ON s.doc_id = d.doc_id),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND word_chars / n_words BETWEEN 1.5 AND 15.0 AND n_symbols / n_words <= 0.1 AND n_marks / n_words <= 0.3
  AND (n_words < 20 OR n_stop_words >= 1) AND (n_stop_words + 1) / n_words >= 0.02 AND (n_dup_lines - 1) / n_lines <= 0.3 AS kept
FROM b
""",
    "op10_hamming_topk": """
WITH pair AS (
  SELECT q.vec_id AS query_id, c.vec_id AS neighbor_id,
    len(list_filter(range(1, 65), lambda i: coalesce(q.embedding[i] > 0, false) <> coalesce(c.embedding[i] > 0, false)))::INTEGER AS distance
  FROM embeddings q, embeddings c WHERE q.vec_id % 100 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id)::INTEGER AS rank FROM pair)
SELECT query_id, rank, neighbor_id, distance FROM ranked WHERE rank <= 10
""",
    "op11_hard_negatives": """
WITH r AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_dot_product(a.x, r.x)::BIGINT AS score
  FROM r AS a JOIN r ON a.vec_id <> r.vec_id AND len(a.x) = len(r.x) WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id,
  row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
WHERE 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
""",
}
