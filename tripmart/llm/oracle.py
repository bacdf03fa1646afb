"""The operators that SQL can express, in DuckDB's dialect."""

from __future__ import annotations

import string

LOWER = f"translate({{}}, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

URLS = f"""
WITH urls AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
    SELECT page_id, coalesce({LOWER.format("regexp_extract(rest, '^[^/?#]*')")}, '') AS host,
           coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
    FROM urls
), rules(rule, verdict, host_part, path_part) AS (
    VALUES ('com/', 'allow', 'com', '/'), ('example.com/en/', 'block', 'example.com', '/en/'),
           ('www.example.com/en/', 'allow', 'www.example.com', '/en/'), ('net/es/', 'block', 'net', '/es/'),
           ('net/fr/', 'block', 'net', '/fr/')
), best AS (
    SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
    FROM (SELECT DISTINCT host, path FROM parts)
    JOIN rules ON (host = host_part OR ends_with(host, '.' || host_part)) AND starts_with(path, path_part)
    GROUP BY host, path
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN best USING (host, path)
"""

LINES = """
WITH docs AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
places AS (SELECT doc_id, unnest(range(1, len(lines) - 1)) AS i, lines FROM docs WHERE len(lines) >= 3),
windows AS (SELECT doc_id, i, lines[i:i + 2] AS w FROM places),
repeats AS (
    SELECT doc_id, i FROM (
        SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS nth FROM windows
    ) WHERE nth > 1
),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 3)) AS line FROM repeats),
lists AS (SELECT doc_id, list(line) AS gone FROM gone GROUP BY doc_id)
SELECT doc_id, coalesce(len(lines), 0)::INT AS n_lines, coalesce(len(gone), 0)::INT AS n_removed,
       md5(CASE WHEN gone IS NULL THEN text ELSE array_to_string(
           list_transform(list_filter(range(1, len(lines) + 1), lambda i: NOT list_contains(gone, i)),
                          lambda i: lines[i]), chr(10)) END) AS text_md5
FROM docs LEFT JOIN lists USING (doc_id)
"""

CONTAMINATION = f"""
WITH item_words AS (
    SELECT item_id, regexp_extract_all({LOWER.format("text")}, {WORDS}) AS ws FROM benchmark
), item_windows AS (
    SELECT DISTINCT item_id::VARCHAR AS item, ws[i:i + 9] AS w
    FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM item_words WHERE len(ws) > 0)
), doc_words AS (
    SELECT doc_id, coalesce(regexp_extract_all({LOWER.format("text")}, {WORDS}), []) AS ws FROM documents
), widths AS (SELECT DISTINCT len(w) AS n FROM item_windows
), doc_windows AS (
    SELECT doc_id, i, ws[i:i + n - 1] AS w
    FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM doc_words, widths WHERE len(ws) >= n)
), matches AS (SELECT doc_id, i, w, item FROM doc_windows JOIN item_windows USING (w)
), hits AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + len(w))) AS place FROM (SELECT DISTINCT doc_id, i, w FROM matches))
    GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item FROM matches) GROUP BY doc_id
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

FIXITY = """
WITH replica AS (
    SELECT page_id, url, CASE WHEN page_id % 97 = 13 THEN substr(html, 1, 10) || '?' ELSE html END AS html
    FROM pages WHERE page_id % 101 <> 7
    UNION ALL SELECT page_id + 1000000000, url, html FROM pages WHERE page_id % 103 = 5
), sides AS (
    SELECT 'p' AS side, page_id, url, html FROM pages UNION ALL SELECT 'r', page_id, url, html FROM replica
), leaves AS (
    SELECT side, page_id, count(*) AS n, sum(strlen(url) + strlen(html))::BIGINT AS bytes,
           list_sort(list(md5(url) || md5(html))) AS content
    FROM sides GROUP BY side, page_id
), placed AS (
    SELECT *, coalesce(sum(bytes) OVER (PARTITION BY side ORDER BY page_id
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS at FROM leaves
)
SELECT coalesce(p.page_id, r.page_id) AS page_id,
       CASE WHEN r.page_id IS NULL THEN 'missing' WHEN p.page_id IS NULL THEN 'extra' ELSE 'changed' END AS status,
       p.n AS primary_records, p.bytes AS primary_bytes, p.at AS primary_offset,
       r.n AS replica_records, r.bytes AS replica_bytes, r.at AS replica_offset
FROM (SELECT * FROM placed WHERE side = 'p') p FULL JOIN (SELECT * FROM placed WHERE side = 'r') r USING (page_id)
WHERE p.content IS DISTINCT FROM r.content
"""

TOP_K = """
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS q FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
    SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
    FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores
) WHERE rank <= 10
"""

LANGUAGE_MODEL = f"""
WITH docs AS MATERIALIZED (
    SELECT row_number() OVER () AS doc, doc_id, coalesce(regexp_extract_all({LOWER.format("text")}, {WORDS}), []) AS ws
    FROM documents
), words AS MATERIALIZED (
    SELECT doc, ws[i] AS w, CASE WHEN i > 1 THEN ws[i - 1] END AS v
    FROM (SELECT doc, ws, unnest(range(1, len(ws) + 1)) AS i FROM docs)
), own_ones AS (SELECT doc, w, count(*) AS n FROM words GROUP BY ALL
), own_twos AS (SELECT doc, v, w, count(*) AS n FROM words WHERE v IS NOT NULL GROUP BY ALL
), ones AS (SELECT doc, w, sum(n) OVER (PARTITION BY w) - n AS n FROM own_ones
), twos AS (SELECT doc, v, w, sum(n) OVER (PARTITION BY v, w) - n AS n FROM own_twos
), others AS (SELECT doc, greatest(sum(len(ws)) OVER () - len(ws), 1) AS n FROM docs
), scored AS (
    SELECT doc, CASE WHEN two.n >= 1 THEN ln(two.n / before.n)
                     ELSE CASE WHEN words.v IS NULL THEN 0 ELSE ln(0.4) END
                          + CASE WHEN one.n >= 1 THEN ln(one.n / others.n) ELSE ln(0.4) - ln(others.n) END END AS s
    FROM words JOIN ones one USING (doc, w) JOIN others USING (doc)
    LEFT JOIN ones before ON before.doc = words.doc AND before.w = words.v
    LEFT JOIN twos two ON two.doc = words.doc AND two.v = words.v AND two.w = words.w
), sums AS (SELECT doc, avg(s) AS s FROM scored GROUP BY doc)
SELECT doc_id, len(ws)::BIGINT AS n_words, round(s, 6) AS mean_log_score FROM docs LEFT JOIN sums USING (doc)
"""


COLLOCATIONS = rf"""
WITH pieces AS (
    SELECT row_number() OVER () AS piece, * FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({LOWER.format("text")}, '[.,;:!?\x0A-\x0D]')) AS line
        FROM documents)
), words AS (
    SELECT piece, lang, unnest(ws) AS w, unnest(range(len(ws))) AS i
    FROM (SELECT piece, lang, regexp_extract_all(line, '[^\x20\x09]+') AS ws FROM pieces)
), runs AS (
    SELECT lang, w AS a, lead(w) OVER following AS b, lead(w, 2) OVER following AS c FROM words
    WINDOW following AS (PARTITION BY piece ORDER BY i)
), ones AS (SELECT lang, a AS p, count(*) AS n FROM runs GROUP BY ALL
), twos AS (SELECT lang, a, b, a || ' ' || b AS p, count(*) AS n FROM runs WHERE b IS NOT NULL GROUP BY ALL
), threes AS (
    SELECT lang, a, b, c, a || ' ' || b AS ab, b || ' ' || c AS bc, ab || ' ' || c AS p, count(*) AS n
    FROM runs WHERE c IS NOT NULL GROUP BY ALL HAVING n >= 10
), sizes AS (SELECT lang, sum(n)::BIGINT AS n FROM ones GROUP BY lang
), longer AS (
    SELECT lang, p, max(n) AS n FROM (SELECT lang, ab AS p, n FROM threes UNION ALL SELECT lang, bc, n FROM threes) GROUP BY ALL
), cuts AS (
    SELECT twos.lang, twos.p, twos.n AS a, 1 AS k, x.n AS l, y.n AS r FROM twos
    JOIN ones x ON x.lang = twos.lang AND x.p = a JOIN ones y ON y.lang = twos.lang AND y.p = b
    LEFT JOIN longer ON longer.lang = twos.lang AND longer.p = twos.p
    WHERE twos.n >= 10 AND 100 * coalesce(longer.n, 0) < 50 * twos.n
    UNION ALL SELECT t.lang, t.p, t.n, 1, x.n, y.n FROM threes t
    JOIN ones x ON x.lang = t.lang AND x.p = t.a JOIN twos y ON y.lang = t.lang AND y.p = t.bc
    UNION ALL SELECT t.lang, t.p, t.n, 2, x.n, y.n FROM threes t
    JOIN twos x ON x.lang = t.lang AND x.p = t.ab JOIN ones y ON y.lang = t.lang AND y.p = t.c
), scored AS (SELECT *, (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM cuts
), lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank, p AS phrase, a, l, r, sizes.n, score
FROM lowest JOIN sizes USING (lang) QUALIFY rank <= 2000
"""

HARD_NEGATIVES = """
WITH vectors AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score
    FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


def llm_oracles() -> dict[str, str]:
    return {
        "op1_url_filter": URLS, "op2_line_dedup": LINES, "op4_decontaminate": CONTAMINATION, "op5_warc_fixity": FIXITY,
        "op9_topk": TOP_K, "op10_lm_score": LANGUAGE_MODEL, "op11_collocations": COLLOCATIONS,
        "op13_hard_negatives": HARD_NEGATIVES,
    }
