"""SQL statements, for DuckDB, of the results of operators that SQL can express."""

from herdcast.llm.quality_rules import STOP_WORDS, SYMBOLS

_WORDS = r"list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_SOLID = r"length(regexp_replace({}, '[\x20\x09-\x0D]', '', 'g'))"

QUALITY_RULES = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
s AS (SELECT doc_id, t, {_WORDS} AS ws, list_filter(string_split(t, chr(10)), lambda x: {_SOLID.format('x')} > 0) AS ls FROM d),
x AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS p, unnest(ws) AS a FROM s),
y AS (SELECT doc_id, p, a, lead(a, 1) OVER o AS b, lead(a, 2) OVER o AS c FROM x WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
g AS (SELECT doc_id, p, concat_ws(' ', a, b, c) AS g FROM y WHERE c IS NOT NULL),
twice AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS c
          FROM g) WHERE c > 1),
covered AS (SELECT doc_id, count(DISTINCT p + k) AS n FROM twice, (VALUES (0), (1), (2)) AS v(k) GROUP BY doc_id),
b AS (SELECT s.doc_id, t, ws, len(ws) AS n_words, {_SOLID.format('t')} AS word_chars,
             length(t) - length(translate(t, '{SYMBOLS}', '')) AS n_symbols, len(ls) AS n_lines,
             len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
      FROM s LEFT JOIN covered ON covered.doc_id = s.doc_id),
j AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 3 * n_words OR word_chars > 10 * n_words
            OR 2 * n_dup_lines > n_lines
            OR 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 30 * word_chars
            OR len(list_intersect(ws, [{', '.join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))}])) < 2) AS kept
FROM j
"""

MIXING = """
WITH s AS (SELECT source, CAST(coalesce(sum(length(text)), 0) AS BIGINT) AS n_chars FROM documents GROUP BY source),
w AS (SELECT source, n_chars, CASE WHEN n_chars > 0 THEN pow(CAST(n_chars AS DOUBLE), 0.5) ELSE 0 END AS share FROM s),
r AS (SELECT source, CASE WHEN n_chars > 0 THEN (SELECT CAST(sum(n_chars) AS DOUBLE) FROM w)
             * (share / (SELECT sum(share) FROM w)) / n_chars ELSE 0 END AS rate FROM w),
p AS (SELECT source, greatest(1, CAST(ceil(rate / 16) AS INT)) AS parts, rate / greatest(1, CAST(ceil(rate / 16) AS INT)) AS mean
      FROM r WHERE rate > 0),
k AS (SELECT source, parts, mean, unnest(range(0, CAST(ceil(mean + 12 * sqrt(mean) + 20) AS INT) + 1)) AS k FROM p),
cdf AS (SELECT source, sum(exp(-mean + k * ln(mean) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS c FROM k),
u AS (SELECT d.doc_id, d.source, d.text, unnest(range(1, parts + 1)) AS j
      FROM documents d JOIN p ON d.source IS NOT DISTINCT FROM p.source),
h AS (SELECT doc_id, source, text, j, (CAST('0x' || substr(md5('20:' || j || ':' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13)
             AS BIGINT) + 0.5) / 4503599627370496.0 AS u FROM u),
n AS (SELECT h.doc_id, h.source, h.text, count(c) AS n FROM h LEFT JOIN cdf
      ON h.source IS NOT DISTINCT FROM cdf.source AND c < h.u GROUP BY h.doc_id, h.source, h.text),
e AS (SELECT doc_id, source, text, unnest(range(1, n + 1)) AS copy FROM n)
SELECT doc_id, source, text, copy, md5('20:order:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || copy) AS order_key FROM e
"""

# crc32 of the decimal digits: a list of steps, a byte or -1 for the shift by one bit
_CRC = ("xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), "
        "lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]))), lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) "
        "ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295)")

PREFIX_TRIE = rf"""
WITH d AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL),
s AS (SELECT conv_id, turn, sha256(length(role) || ':' || role || ':' || t) AS g, len({_WORDS}) AS words FROM d),
p AS (SELECT conv_id, g, words, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, g) AS place FROM s),
ids AS (SELECT conv_id, {_CRC} % 4 AS h FROM (SELECT DISTINCT conv_id FROM p)),
r AS (SELECT ids.conv_id, 0 AS part, place, g, words FROM ids JOIN p ON p.conv_id = ids.conv_id - ids.conv_id % 20 AND place <= h
      UNION ALL SELECT p.conv_id, 1, place, g, words FROM p JOIN ids ON p.conv_id = ids.conv_id WHERE place > h),
q AS (SELECT conv_id, 0 AS depth, '' AS key, 0 AS words FROM ids
      UNION ALL SELECT conv_id, row_number() OVER o, string_agg(g, '') OVER o, words FROM r WINDOW o AS (PARTITION BY conv_id ORDER BY part, place)),
n AS (SELECT key, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words FROM q GROUP BY key),
e AS (SELECT key, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ends
      FROM (SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS last FROM q) WHERE last GROUP BY key),
c AS (SELECT left(key, length(key) - 64) AS key, count(*) AS n FROM n WHERE depth > 0 GROUP BY 1),
b AS (SELECT a.key, sum((x.n_convs - 1) * x.words) AS saved, count(*) FILTER (c.n IS NULL) AS leaves
      FROM n a JOIN n x ON starts_with(x.key, a.key) LEFT JOIN c ON c.key = x.key GROUP BY a.key)
SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, CAST(coalesce(c.n, 0) AS BIGINT) AS n_children,
       b.leaves AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e.ends, '')) AS ends_sha256
FROM n JOIN b ON b.key = n.key LEFT JOIN c ON c.key = n.key LEFT JOIN e ON e.key = n.key
LEFT JOIN n up ON n.depth > 0 AND up.key = left(n.key, length(n.key) - 64)
"""
