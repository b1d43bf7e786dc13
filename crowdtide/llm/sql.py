"""The queries that SQL can express, as DuckDB SQL over the same tables."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP2 = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
  FROM documents
), k AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY body ORDER BY points DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM k
"""

_CONTROLS = ("<|", "|>", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
# Two more characters for each control string, one for each backslash.
_ESCAPED = "length({0}) + length({0}) - length(replace({0}, '\\', ''))" + "".join(
    f" + 2 * ((length({{0}}) - length(replace({{0}}, '{c}', ''))) // {len(c)})" for c in _CONTROLS
)

OP3 = f"""
WITH m AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(10 + {_ESCAPED.format("role")} + {_ESCAPED.format("text")})::BIGINT AS formatted_chars
FROM m GROUP BY conv_id
"""

OP4 = r"""
WITH r(rhost, rpath, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), p AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), hit AS (
  SELECT page_id, rhost || rpath AS rule, verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(rhost) + length(rpath) DESC, length(rhost) DESC) AS n
  FROM p JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN (SELECT * FROM hit WHERE n = 1) USING (page_id)
"""

OP7 = rf"""
WITH d AS (
  SELECT doc_id, source, len({WORDS})::BIGINT AS size, md5('17:' || doc_id::VARCHAR) AS shuffled FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM d GROUP BY source
), w AS (
  SELECT *, ([5.0, 2.0, 1.0]::DOUBLE[])[(place % 3 + 1)::INT] AS weight, source_size * 2.0::DOUBLE AS whole FROM s
), l AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(whole) OVER o, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0)) AS reached
  FROM w WINDOW o AS (ORDER BY whole / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT *, max(CASE WHEN reached <= whole / weight THEN reached END) OVER () AS level FROM l
), c AS (
  SELECT doc_id, shuffled, epoch, d.size, source_size, least(whole, level * weight) AS target, place, weight, level,
    sum(d.size) OVER (PARTITION BY place, epoch ORDER BY shuffled, doc_id ROWS UNBOUNDED PRECEDING) + epoch * source_size AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source, (VALUES (0), (1)) AS e(epoch)
), v AS (
  SELECT *, greatest(0, least(size, floor(level * weight + 1e-6)::BIGINT - (upto - size))) AS served, upto / weight AS finish FROM c
), g AS (
  SELECT *, sum(served) OVER (ORDER BY finish, place, epoch, shuffled, doc_id ROWS UNBOUNDED PRECEDING) - served AS ahead,
    floor((SELECT sum(size) FROM d) * 1.5::DOUBLE)::BIGINT AS budget
  FROM v WHERE served > 0 OR true
)
SELECT doc_id, any_value(size) AS size, any_value(source_size) AS source_size, any_value(target) AS target,
  sum(greatest(0, least(served, budget - ahead)))::BIGINT AS taken
FROM g GROUP BY doc_id
"""

OP9 = rf"""
WITH d AS (
  SELECT doc_id, {WORDS} AS w FROM documents
), win AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)
), early AS (
  SELECT h, min(doc_id) AS m FROM win GROUP BY h
), gone AS (
  SELECT DISTINCT doc_id, i + k AS j FROM (SELECT win.doc_id, i, unnest(range(50)) AS k FROM win JOIN early USING (h) WHERE m < win.doc_id)
), per AS (
  SELECT doc_id, list(j) AS js FROM gone GROUP BY doc_id
), kept AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(js), 0)::BIGINT AS n_removed,
    CASE WHEN js IS NULL THEN w ELSE [w[i] FOR i IN range(1, len(w) + 1) IF NOT list_contains(js, i)] END AS k
  FROM d LEFT JOIN per USING (doc_id)
)
SELECT doc_id, n_words, n_removed, sha256(coalesce(array_to_string(k, ' '), '')) AS kept_sha256 FROM kept
"""

OP10 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, [translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FOR x IN {WORDS}] AS w FROM documents
), sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 1], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM d WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
), links AS (
  SELECT a, b
  FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id)
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * c >= 80 * (na.n + nb.n - c)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(b) AS component_id, d.doc_id = min(b) AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN reach ON d.doc_id = reach.a GROUP BY d.doc_id
"""

_VECTORS = """
WITH v AS (
  SELECT vec_id, {label} AS label, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS parts FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, a.label = b.label AS same,
    coalesce(list_sum([a.parts[i] * b.parts[i] FOR i IN range(1, least(len(a.parts), len(b.parts)) + 1)]), 0)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0 AND a.label IS NOT NULL AND b.label IS NOT NULL
)"""

OP12 = f"""{_VECTORS.format(label="CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")}, p AS (
  SELECT query_id, vec_id, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.query_id AS anchor_id, p.vec_id AS positive_id, row_number() OVER w AS rank, s.vec_id AS negative_id,
  p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON p.query_id = s.query_id AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
WINDOW w AS (PARTITION BY p.query_id, p.vec_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 3
"""

OP13 = f"""{_VECTORS.format(label="0")}
SELECT query_id, row_number() OVER w AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5
"""

SQL = {
    "op2_streaming_dedup": OP2,
    "op3_chat_format": OP3,
    "op4_url_rules": OP4,
    "op7_fair_queueing": OP7,
    "op9_debruijn_spans": OP9,
    "op10_bbit_minhash": OP10,
    "op12_slot_negatives": OP12,
    "op13_bit_sliced_topk": OP13,
}
