"""The operators' results in DuckDB SQL, stated anew where SQL can express them."""

WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _lower(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


OP1 = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '{WORD}') AS w,
    string_split(coalesce(text, ''), chr(10)) AS l
  FROM documents
), win AS (
  SELECT doc_id, unnest(range(1, len(w) - 3)) AS p, w FROM d WHERE len(w) >= 5
), grams AS (
  SELECT doc_id, p, array_to_string(w[p:p + 4], ' ') AS g FROM win
), twice AS (
  SELECT doc_id, p FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT p + k) AS n
  FROM twice, (SELECT unnest(range(0, 5)) AS k) GROUP BY doc_id
), ls AS (
  SELECT doc_id, source, unnest(l) AS raw FROM d
), lk AS (
  SELECT doc_id, source, raw, len(regexp_extract_all(raw, '{WORD}')) AS nw,
    {_lower(f"trim(raw, {BLANK})")} AS k FROM ls
), dup AS (
  SELECT doc_id, sum(c - 1) AS n
  FROM (SELECT doc_id, raw, count(*) AS c FROM lk WHERE nw > 0 GROUP BY doc_id, raw) GROUP BY doc_id
), hosts AS (
  SELECT source, count(DISTINCT doc_id) AS hd FROM documents GROUP BY source
), freq AS (
  SELECT source, k, count(DISTINCT doc_id) AS n, min(doc_id) AS first FROM lk WHERE k <> '' GROUP BY source, k
), above AS (
  SELECT f.source, f.k, f.first FROM freq f JOIN hosts h ON f.source IS NOT DISTINCT FROM h.source
  WHERE n > 10 OR (n > 5 AND n > hd * 0.5::DOUBLE)
), lost AS (
  SELECT doc_id, sum(nw) AS n FROM lk JOIN above a
  ON lk.source IS NOT DISTINCT FROM a.source AND lk.k = a.k AND lk.doc_id IS DISTINCT FROM a.first GROUP BY doc_id
), s AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(dup.n, 0)::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
    lost.n AS lost
  FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN lost USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  coalesce(lost, 0)::BIGINT AS n_boiler_words,
  (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND (lost IS NULL
    OR (n_words - lost >= 10 AND n_words - lost >= n_words * 0.3::DOUBLE)) AS kept
FROM s
"""

OP2 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, '{WORD}') AS w FROM documents
), e AS (
  SELECT doc_id, unnest(range(1, CASE WHEN len(w) = 0 THEN 1 ELSE greatest(len(w) - 4, 1) + 1 END)) AS p, w
  FROM d
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + 4], ' ') AS g FROM e
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), i AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), l AS (
  SELECT a, b FROM i JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id
  WHERE 100 * i >= 75 * (x.n + y.n - i)
), reach(a, b) AS (
  SELECT a, b FROM l UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a
), c AS (
  SELECT a, min(b) AS b FROM reach GROUP BY a
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles,
  least(d.doc_id, coalesce(c.b, d.doc_id)) AS component_id
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN c ON d.doc_id = c.a
"""

OP3 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
    md5('7:' || coalesce(doc_id::VARCHAR, 'null ' || md5(coalesce(md5(text), '')))) AS k
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5, 2, 1][((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::INT] AS weight
  FROM d GROUP BY source
), fill(step, level) AS (
  SELECT 0, (SELECT 1.5::DOUBLE * sum(source_size) / sum(weight) FROM s)
  UNION ALL
  SELECT step + 1, (
    SELECT (1.5::DOUBLE * sum(source_size)
        - sum(CASE WHEN weight * level > 2 * source_size THEN 2.0::DOUBLE * source_size ELSE 0 END))
      / sum(CASE WHEN weight * level > 2 * source_size THEN 0 ELSE weight END) FROM s)
  FROM fill WHERE step < 60
), t AS (
  SELECT s.*, least(weight * level, 2.0::DOUBLE * source_size) AS target
  FROM s, fill WHERE step = 60
), r AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole
  FROM t
), o AS (
  SELECT d.doc_id, d.size, r.source_size, r.target, r.whole,
    target - whole * source_size AS rest,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.size ROWS UNBOUNDED PRECEDING) - d.size AS prior
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
), c AS (
  SELECT *, (whole + CASE WHEN size > 0 AND whole < 2 AND 2 * prior + size <= 2 * rest
    THEN 1 ELSE 0 END)::BIGINT AS copies FROM o
)
SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken, copies FROM c
"""

OP5 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
), u AS (
  SELECT vec_id, label, e, sqrt(list_inner_product(e, e)) AS n FROM v
  WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_inner_product(a.e, b.e) / (a.n * b.n) >= 0.98
), reach(a, b) AS (
  SELECT a, b FROM l UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a
), c AS (
  SELECT a, min(b) AS b FROM reach GROUP BY a
), n AS (
  SELECT a, count(*) AS n FROM l GROUP BY a
)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least(vec_id, coalesce(c.b, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(c.b, vec_id)) AS kept
FROM embeddings e LEFT JOIN n ON e.vec_id = n.a LEFT JOIN c ON e.vec_id = c.a
"""

OP7 = f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS raw,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS p
  FROM documents
), k AS (
  SELECT doc_id, p, raw, {_lower(f"trim(raw, {BLANK})")} AS k FROM l
), f AS (
  SELECT k FROM k WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*)::BIGINT AS n_lines,
  count(*) FILTER (f.k IS NOT NULL)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(raw, chr(10) ORDER BY p) FILTER (f.k IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f ON k.k = f.k GROUP BY doc_id
"""

OP8 = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS b, sha1(coalesce(html, '')) AS g FROM pages
), m AS (
  SELECT *, CASE WHEN b >= 1000 THEN max(page_id) OVER (PARTITION BY g, b) END AS last FROM p
)
SELECT page_id, b AS payload_bytes, g AS payload_digest,
  CASE WHEN page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < last THEN last END AS refers_to
FROM m
"""

OP12 = rf"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents
), l AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), fails AS (
  SELECT d.doc_id, part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CASE WHEN len(w) < 100 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask
  FROM d LEFT JOIN l ON d.doc_id = l.doc_id
), cells AS (
  SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM fails GROUP BY part, mask
), f(name, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)
), orders AS (
  SELECT a.name || b.name || c.name || d.name || e.name AS o, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a, f b, f c, f d, f e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5
), steps AS (
  SELECT o, s, bits[s] AS bit, list_sum(bits[1:s - 1]) AS before FROM orders, range(1, 6) r(s)
), counted AS (
  SELECT part, o, s, bit,
    sum(CASE WHEN mask & (coalesce(before, 0) + bit)::BIGINT = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & coalesce(before, 0)::BIGINT = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & coalesce(before, 0)::BIGINT <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & coalesce(before, 0)::BIGINT = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & coalesce(before, 0)::BIGINT = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells, steps GROUP BY part, o, s, bit
)
SELECT part, o AS filter_order, s::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
  redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
  toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM counted
"""

SQL = {
    "op1_quality_rules": OP1,
    "op2_ngram_jaccard_join": OP2,
    "op3_source_mixing": OP3,
    "op5_embedding_dedup": OP5,
    "op7_line_dedup": OP7,
    "op8_warc": OP8,
    "op12_filter_audit": OP12,
}
