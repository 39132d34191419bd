"""DuckDB SQL of the corpus queries that SQL can express."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

OP1 = f"""
WITH RECURSIVE w AS (
    SELECT doc_id, {WORDS.format(f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')")} AS ws FROM documents
), s AS (
    SELECT DISTINCT doc_id, md5(array_to_string(ws[i:i + 4], ' ')) AS s FROM w, unnest(range(1, greatest(len(ws) - 3, 2))) AS t(i) WHERE len(ws) > 0
), n AS (
    SELECT doc_id, count(*) AS n FROM s GROUP BY 1
), pair AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), link AS (
    SELECT a, b FROM pair JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 75 * (x.n + y.n - common)
), edge AS (
    SELECT a, b FROM link UNION SELECT b, a FROM link
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, edge.b FROM reach JOIN edge ON edge.a = reach.b
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1) r USING (doc_id)
"""

OP2 = rf"""
WITH w AS (
    SELECT doc_id, coalesce(text, '') AS text, {WORDS.format("coalesce(text, '')")} AS ws FROM documents
), sized AS (
    SELECT *, len(ws) AS n FROM w
), k AS (
    SELECT doc_id, unnest([5, 8, greatest(26, n * 5 // 100 + 1)]) AS k, unnest(['window', 'cover', 'longest']) AS kind, ws, n FROM sized
), win AS (
    SELECT doc_id, kind, k, i, md5(array_to_string(ws[i:i + k - 1], ' ')) AS h FROM k, unnest(range(1, n - k + 2)) AS t(i) WHERE n >= k
), twice AS (
    SELECT * FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, kind, h) > 1
), cover AS (
    SELECT doc_id, kind, count(DISTINCT p) AS n FROM (SELECT doc_id, kind, unnest(range(i, i + k)) AS p FROM twice) GROUP BY 1, 2
), base AS (
    SELECT s.doc_id, s.n AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
            - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS n_dup_lines,
        coalesce(a.n, 0) AS n_repeat_words, coalesce(b.n, 0) AS covered_words, c.n IS NOT NULL AS long_repeat
    FROM sized s LEFT JOIN cover a ON a.doc_id = s.doc_id AND a.kind = 'window'
    LEFT JOIN cover b ON b.doc_id = s.doc_id AND b.kind = 'cover' LEFT JOIN cover c ON c.doc_id = s.doc_id AND c.kind = 'longest'
), failed AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
    n_repeat_words::BIGINT AS n_repeat_words, base_failed,
    NOT base_failed AND NOT (100 * covered_words > 15 * n_words OR long_repeat) AS kept, covered_words::BIGINT AS covered_words
FROM failed
"""

OP7 = """
WITH b AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), win AS (
    SELECT doc_id, i, hash(substring(h, 2 * i - 1, 100)) AS w FROM b, unnest(range(1, n - 48)) AS t(i) WHERE n >= 50
), least AS (
    SELECT w, min(doc_id) AS m FROM win GROUP BY 1 HAVING min(doc_id) < max(doc_id)
), bad AS (
    SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > 50 AS apart FROM win JOIN least USING (w) WHERE m < doc_id
), part AS (
    SELECT doc_id, i, sum(coalesce(apart, true)::INT) OVER (PARTITION BY doc_id ORDER BY i) AS part FROM bad
), span AS (
    SELECT doc_id, part, min(i) AS first, max(i) + 49 AS last FROM part GROUP BY 1, 2
), gap AS (
    SELECT doc_id, last + 1 AS first, lead(first) OVER (PARTITION BY doc_id ORDER BY first) - 1 AS last FROM span
    UNION ALL SELECT doc_id, 1, min(first) - 1 FROM span GROUP BY 1
), kept AS (
    SELECT doc_id, string_agg(substring(h, 2 * first - 1, 2 * (coalesce(last, n) - first + 1)), '' ORDER BY first) AS t
    FROM gap JOIN b USING (doc_id) GROUP BY 1
), lost AS (
    SELECT doc_id, sum(last - first + 1) AS n_removed, count(*) AS n_spans FROM span GROUP BY 1
)
SELECT b.doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
    sha256(unhex(CASE WHEN n_spans IS NULL THEN h ELSE t END)) AS kept_sha256
FROM b LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

OP10 = f"""
WITH w AS (
    SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS ws FROM documents
), win AS (
    SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS h FROM w, unnest(range(1, len(ws) - 48)) AS t(i) WHERE len(ws) >= 50
), bad AS (
    SELECT doc_id, i FROM win QUALIFY min(doc_id) OVER (PARTITION BY h) < doc_id
), cov AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS k FROM bad
), kept AS (
    SELECT e.doc_id, string_agg(e.x, ' ' ORDER BY e.k) AS t, count(*) AS n
    FROM (SELECT doc_id, unnest(ws) AS x, generate_subscripts(ws, 1) AS k FROM w) e ANTI JOIN cov ON cov.doc_id = e.doc_id AND cov.k = e.k GROUP BY 1
)
SELECT w.doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

OP12 = rf"""
WITH d AS (
    SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents
), w AS (
    SELECT lang, source, r, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), c AS (
    SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs FROM w GROUP BY ALL
), l AS (
    SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL HAVING sum(docs) >= 30
), total AS (
    SELECT lang, count(*)::HUGEINT AS v, sum(n) AS n FROM l GROUP BY 1
), g AS (
    SELECT d.lang, d.source, coalesce(any_value(t.v), 0) AS v, coalesce(any_value(own.n), 0) AS n
    FROM (SELECT DISTINCT lang, source FROM d) d LEFT JOIN total t USING (lang)
    LEFT JOIN (SELECT c.lang, c.source, sum(c.n) AS n FROM c JOIN l USING (lang, term) GROUP BY ALL) own ON own.lang = d.lang AND own.source = d.source GROUP BY ALL
), share AS (
    SELECT g.lang, g.source, l.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (g.n + 5 * g.v) AS p,
        1 + (1000000000::HUGEINT * (l.n + 5)) // (t.n + 5 * t.v) AS q
    FROM g JOIN l USING (lang) JOIN total t USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = l.term
), far AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM share a JOIN share b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pair AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(far.value, 0) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source
), found AS (
    SELECT lang, source, 'pair' AS part, item, value FROM pair
    UNION ALL SELECT lang, source, 'term', term, p - q FROM share WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM found QUALIFY part = 'pair' OR rank <= 50
"""

OP11 = """
WITH RECURSIVE v AS (
    SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
), u AS (
    SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), link AS (
    SELECT a.r AS a, b.r AS b FROM u a JOIN u b ON a.label = b.label AND a.r <> b.r AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach AS (
    SELECT r AS a, r AS b FROM v UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b
), c AS (
    SELECT a AS r, min(vec_id) AS component_id FROM reach JOIN v ON v.r = reach.b GROUP BY 1
), n AS (
    SELECT a AS r, count(*) AS n FROM link GROUP BY 1
)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, coalesce(vec_id = component_id, component_id IS NULL) AS kept FROM v JOIN c USING (r) LEFT JOIN n USING (r)
"""

#: crc32 of the decimal doc_id, bit by bit.
_CRC = "x"
for _ in range(8):
    _CRC = f"list_transform([{_CRC}], lambda b: xor(b >> 1, (b & 1) * 3988292384))[1]"
CRC32 = f"""xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda a, c: list_transform([xor(a, c)], lambda x: {_CRC})[1]), 4294967295::BIGINT)"""

# Places where words q apart are equal, in unbroken stretches of the same q: a stretch of m is a run of m + q words.
OP13 = f"""
WITH o AS (
    SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS ws, {CRC32} AS h FROM documents
), z AS (
    SELECT *, len(ws) AS n, CASE WHEN h % 10 = 0 AND len(ws) > 0 THEN (h // 10) % len(ws) END AS a, 3 + (h // 10) % 8 AS part FROM o
), t AS (
    SELECT doc_id, n, i, ws[1 + CASE WHEN i >= a THEN a + (i - a) % (1 + (n - a) // part) ELSE i END] AS w FROM z, unnest(range(n)) AS u(i)
), e AS (
    SELECT x.doc_id, y.i - x.i AS q, x.i AS i, x.i - row_number() OVER (PARTITION BY x.doc_id, y.i - x.i ORDER BY x.i) AS stretch
    FROM t x JOIN t y ON x.doc_id = y.doc_id AND x.w = y.w AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
), r AS (
    SELECT doc_id, min(i) AS start, count(*) + q AS length, q AS period FROM e GROUP BY doc_id, q, stretch HAVING count(*) + q >= greatest(6, 4 * q)
), run AS (
    SELECT doc_id, start, length, min(period) AS period FROM r GROUP BY 1, 2, 3
), best AS (
    SELECT doc_id, count(*) AS n_runs, min({{'l': -length, 's': start, 'q': period}}) AS b,
        string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed FROM run GROUP BY 1
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM run
), kept AS (
    SELECT t.doc_id, string_agg(t.w, ' ' ORDER BY t.i) AS text FROM t ANTI JOIN gone ON gone.doc_id = t.doc_id AND gone.i = t.i GROUP BY 1
)
SELECT z.doc_id, coalesce(n_runs, 0) AS n_runs, b.s AS start, -b.l AS length, b.q AS period, (-b.l * 1000) // b.q AS exponent_milli,
    sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM z LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

ORACLE = {
    "op1_ngram_jaccard": OP1,
    "op2_repetition_rules": OP2,
    "op7_suffix_dedup": OP7,
    "op10_substring_dedup": OP10,
    "op11_pstable_embedding_dedup": OP11,
    "op12_source_divergence": OP12,
    "op13_periodic_runs": OP13,
}
