"""DuckDB texts for the queries that SQL can express; each is written from the contract."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

MIX = rf"""
WITH sized AS (
  SELECT doc_id, source, coalesce(text, '') AS body, len({_WORDS})::BIGINT AS size FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE
           AS weight
  FROM sized GROUP BY source),
filled AS (
  SELECT *, 2.0 * source_size AS cap, sum(source_size) OVER () * 1.5::DOUBLE AS budget,
         row_number() OVER (ORDER BY 2.0 * source_size / weight, source) AS place FROM sources),
levels AS (
  SELECT place,
         (budget - coalesce(sum(cap) OVER earlier, 0))
           / (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0)) AS level, cap / weight AS edge
  FROM filled
  WINDOW earlier AS (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
chosen AS (SELECT min_by(level, place) AS level FROM levels WHERE level <= edge),
planned AS (
  SELECT source, source_size, least(cap, level * weight)::DOUBLE AS target FROM filled, chosen),
rated AS (
  SELECT s.doc_id, s.size, p.source_size, p.target,
         CASE WHEN p.source_size > 0 THEN p.target / p.source_size ELSE 0.0 END AS rate,
         ('0x' || substr(md5('20:' || coalesce(s.doc_id::VARCHAR, '') || ':' || s.body), 1, 13))::BIGINT
           / 4503599627370496.0::DOUBLE AS drawn
  FROM sized s JOIN planned p ON s.source IS NOT DISTINCT FROM p.source),
copied AS (
  SELECT *, (floor(rate) + CASE WHEN drawn < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS copies
  FROM rated)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies FROM copied
"""

# All pairs of a label; components by walking the links.
VECTORS = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v,
         sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) AS norm
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM usable a JOIN usable b
    ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.98),
reach(x, y) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
degree AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT e.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, l.component_id,
       e.vec_id = l.component_id AS kept
FROM embeddings e JOIN least l ON e.vec_id = l.x LEFT JOIN degree d ON e.vec_id = d.x
"""

WARC = """
WITH sized AS (
  SELECT page_id, coalesce(html, '') AS body, octet_length(encode(coalesce(html, ''))) AS n
  FROM pages),
first AS (SELECT body, max(page_id) AS page_id FROM sized WHERE n >= 1000 GROUP BY body)
SELECT s.page_id, s.n::BIGINT AS payload_bytes, sha1(s.body) AS payload_digest,
       CASE WHEN f.page_id <> s.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.page_id <> s.page_id THEN f.page_id END AS refers_to, true AS intact
FROM sized s LEFT JOIN first f ON s.body = f.body AND s.n >= 1000
"""

# Quartiles are exact here; the sketches are as long as they hold no more values than their size,
# which is so for groups of up to 1,024 rows.
RULES = rf"""
WITH texts AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS body, {_WORDS} AS words FROM documents),
lines AS (
  SELECT doc_id, list_filter(string_split(body, chr(10)),
                             lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM texts),
windows AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM texts)),
again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows)
  WHERE n > 1),
repeated AS (
  SELECT doc_id, count(DISTINCT i + k)::BIGINT AS n FROM again, (SELECT unnest([0, 1, 2]) AS k)
  GROUP BY doc_id),
counted AS (
  SELECT t.doc_id, t.lang, t.source, len(t.words)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(t.words, lambda w: length(w))), 0)::BIGINT AS word_chars,
         (length(t.body) - length(regexp_replace(t.body, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         len(l.lines)::BIGINT AS n_lines,
         (len(l.lines) - len(list_distinct(l.lines)))::BIGINT AS n_dup_lines,
         coalesce(r.n, 0)::BIGINT AS n_repeat_words,
         (length(t.body) - length(regexp_replace(t.body, '[A-Z]', '', 'g')))::BIGINT AS n_capitals
  FROM texts t JOIN lines l USING (doc_id) LEFT JOIN repeated r USING (doc_id)),
rated AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0.0 END::DOUBLE AS symbol_ratio,
         CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0.0 END::DOUBLE AS word_length,
         CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0.0 END::DOUBLE AS repeat_ratio,
         CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0.0 END::DOUBLE AS dup_line_ratio,
         CASE WHEN word_chars > 0 THEN n_capitals / word_chars ELSE 0.0 END::DOUBLE AS capital_ratio
  FROM counted),
measures AS (
  UNPIVOT rated ON symbol_ratio, word_length, repeat_ratio, dup_line_ratio, capital_ratio
  INTO NAME rule VALUE x),
spread AS (
  SELECT lang, source, rule, count(*) AS n, grouping(lang) + grouping(source) AS width,
         quantile_disc(x, 0.25) AS low, quantile_disc(x, 0.75) AS high
  FROM measures WHERE NOT base_failed GROUP BY GROUPING SETS (
    (lang, source, rule), (lang, rule), (rule))),
slack AS (
  SELECT * FROM (VALUES ('symbol_ratio', 0.05), ('word_length', 0.5), ('repeat_ratio', 0.15),
                        ('dup_line_ratio', 0.2), ('capital_ratio', 0.03)) AS s(rule, least)),
chosen AS (
  SELECT m.doc_id, m.rule, m.x, k.least,
         CASE WHEN o.n >= 100 THEN o.low WHEN l.n >= 100 THEN l.low ELSE t.low END AS low,
         CASE WHEN o.n >= 100 THEN o.high WHEN l.n >= 100 THEN l.high ELSE t.high END AS high
  FROM measures m JOIN slack k ON m.rule = k.rule
  LEFT JOIN spread o ON o.width = 0 AND o.rule = m.rule AND o.lang IS NOT DISTINCT FROM m.lang
    AND o.source IS NOT DISTINCT FROM m.source
  LEFT JOIN spread l ON l.width = 1 AND l.rule = m.rule AND l.lang IS NOT DISTINCT FROM m.lang
  LEFT JOIN spread t ON t.width = 2 AND t.rule = m.rule),
judged AS (
  SELECT doc_id, rule,
         x > ceil((high + 3.0::DOUBLE * greatest(high - low, least::DOUBLE)) * 64) / 64
         OR (rule = 'word_length'
             AND x < floor((low - 3.0::DOUBLE * greatest(high - low, least::DOUBLE)) * 64) / 64)
           AS broken
  FROM chosen),
verdicts AS (
  SELECT doc_id, coalesce(string_agg(rule, ',' ORDER BY list_position(
           ['symbol_ratio', 'word_length', 'repeat_ratio', 'dup_line_ratio', 'capital_ratio'], rule))
           FILTER (broken), '') AS broken FROM judged GROUP BY doc_id)
SELECT r.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND v.broken = '' AS kept, v.broken
FROM rated r JOIN verdicts v USING (doc_id)
"""

# Exact weighted similarity of all pairs that share a shingle; classes by walking the links.
NEAR = rf"""
WITH RECURSIVE texts AS (SELECT doc_id, {_WORDS} AS words FROM documents),
shingles AS (
  SELECT doc_id, list_aggregate(words[i:i + 4], 'string_agg', ' ') AS s
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM texts
        WHERE len(words) > 0)),
counted AS (SELECT doc_id, s, count(*) AS n FROM shingles GROUP BY ALL),
total AS (SELECT doc_id, sum(n) AS n FROM counted GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, sum(least(a.n, b.n)) AS n
  FROM counted a JOIN counted b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
one_way AS (
  SELECT x, y FROM common c JOIN total a ON a.doc_id = c.x JOIN total b ON b.doc_id = c.y
  WHERE c.n >= 0.8 * (a.n + b.n - c.n)
  UNION ALL
  SELECT a.doc_id, b.doc_id FROM texts a JOIN texts b ON a.doc_id < b.doc_id
  WHERE len(a.words) = 0 AND len(b.words) = 0),
links AS (SELECT x, y FROM one_way UNION ALL SELECT y, x FROM one_way),
reach(x, y) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
classes AS (SELECT x AS doc_id, min(y) AS class_id FROM reach GROUP BY x)
SELECT doc_id, class_id, count(*) OVER (PARTITION BY class_id)::BIGINT AS class_size,
       doc_id = class_id AS kept
FROM classes
"""

# Every prefix of every rebuilt conversation, then every node under each of its prefixes. The checksum
# is the polynomial division of CRC-32, byte by byte and bit by bit.
TRIE = """
WITH said AS (
  SELECT conv_id, turn, coalesce(text, '') AS body,
         strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '') AS key
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list({'k': key, 'n': length(body)} ORDER BY turn NULLS FIRST, md5(key)) AS t
  FROM said GROUP BY conv_id),
summed AS (
  SELECT conv_id, t, xor(list_reduce(list_concat([4294967295::BIGINT],
      list_transform(range(1, length(conv_id::VARCHAR) + 1),
                     lambda i: ord(substr(conv_id::VARCHAR, i, 1))::BIGINT)),
      lambda a, b: list_reduce(list_concat([xor(a, b)], range(0, 8)),
                               lambda r, i: xor(r >> 1, 3988292384::BIGINT * (r & 1)))),
    4294967295::BIGINT) % 6 AS h
  FROM own),
whole AS (
  SELECT s.conv_id, list_concat(CASE WHEN s.h > 0 THEN coalesce(b.t[1:s.h], []) ELSE [] END,
                                s.t[s.h + 1:]) AS t
  FROM summed s LEFT JOIN own b ON b.conv_id = s.conv_id - s.conv_id % 100),
listed AS (
  SELECT conv_id, list_transform(t, lambda x: x.k) AS ks, list_transform(t, lambda x: x.n) AS ns
  FROM whole),
prefixes AS (
  SELECT conv_id, ks[1:d] AS p, d, d = len(ks) AS ends,
         CASE WHEN d > 0 THEN ns[d] ELSE 0 END AS own_tokens
  FROM (SELECT *, unnest(range(0, len(ks) + 1)) AS d FROM listed)),
nodes AS (
  SELECT p, d, min(conv_id) AS conv_id, count(*) AS n, max(own_tokens) AS own_tokens,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS ends
  FROM prefixes GROUP BY p, d),
kids AS (SELECT p[1:d - 1] AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
above AS (
  SELECT v.p[1:j] AS p, sum((v.n - 1) * v.own_tokens) AS saved,
         count(*) FILTER (WHERE k.n IS NULL) AS leaves
  FROM (SELECT *, unnest(range(0, d + 1)) AS j FROM nodes) v LEFT JOIN kids k ON k.p = v.p
  GROUP BY 1)
SELECT v.conv_id, v.d::BIGINT AS depth, u.conv_id AS parent_conv_id, v.n::BIGINT AS n_convs,
       coalesce(k.n, 0)::BIGINT AS n_children, a.leaves::BIGINT AS n_leaves,
       a.saved::BIGINT AS saved_tokens, sha256(v.ends) AS ends_sha256
FROM nodes v LEFT JOIN nodes u ON v.d > 0 AND u.p = v.p[1:v.d - 1]
  LEFT JOIN kids k ON k.p = v.p JOIN above a ON a.p = v.p
"""

SQL: dict[str, str] = {
    "op13_prefix_trie": TRIE,
    "op2_mix_sources": MIX,
    "op6_sign_hash_vectors": VECTORS,
    "op8_warc_segments": WARC,
    "op9_adaptive_rules": RULES,
    "op10_dart_near_duplicates": NEAR,
}
