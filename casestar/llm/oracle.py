"""DuckDB SQL for the queries that SQL can express.

The others are tested against brute force: fingerprints and edit distances (op7, op10, pipeline),
trained scores (op2), differencing (op8), page blocks (op4), strings of bytes, of which the
tables have too many for SQL (op3), and a vocabulary's merges (op11).
"""

from __future__ import annotations

# The white space that separates words.
_WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"

_QUALITY = rf"""
WITH base AS (
 SELECT row_number() OVER () AS row_no, doc_id, lang, source, coalesce(text, '') AS text
 FROM documents),
split AS (SELECT *, {_WORDS} AS words, string_split(text, chr(10)) AS lines FROM base),
windows AS (
 SELECT row_no, i, list_slice(words, i, i + 4) AS five
 FROM (SELECT row_no, words, unnest(range(1, len(words) - 3)) AS i FROM split)),
again AS (
 SELECT row_no, i FROM windows
 QUALIFY count(*) OVER (PARTITION BY row_no, five) > 1),
repeats AS (
 SELECT row_no, count(DISTINCT i + k) AS n
 FROM again, (SELECT unnest(range(5)) AS k) GROUP BY row_no),
filled AS (
 SELECT row_no, unnest(list_filter(lines, lambda x: len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) > 0))
  AS line FROM split),
line_counts AS (
 SELECT row_no, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
 FROM filled GROUP BY row_no),
counts AS (
 SELECT split.row_no, doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
  CAST(coalesce(length(array_to_string(words, '')), 0) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
  coalesce(n_lines, 0) AS n_lines
 FROM split LEFT JOIN repeats USING (row_no) LEFT JOIN line_counts USING (row_no)),
failed AS (
 SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  1000 * word_chars // greatest(n_words, 1) AS word_length,
  1000 * n_symbols // greatest(n_words, 1) AS symbols,
  1000 * n_dup_lines // greatest(n_lines, 1) AS dup_lines,
  1000 * n_repeat_words // greatest(n_words, 1) AS repeats
 FROM counts),
long AS (
 SELECT lang, source, 'word_length' AS metric, word_length AS v, 800 AS spread FROM failed WHERE NOT base_failed
 UNION ALL SELECT lang, source, 'symbols', symbols, 60 FROM failed WHERE NOT base_failed
 UNION ALL SELECT lang, source, 'dup_lines', dup_lines, 160 FROM failed WHERE NOT base_failed
 UNION ALL SELECT lang, source, 'repeats', repeats, 100 FROM failed WHERE NOT base_failed),
bucketed AS (
 SELECT *, CASE WHEN v < 32 THEN v ELSE v // CAST(power(2, length(bin(v)) - 5) AS BIGINT)
  * CAST(power(2, length(bin(v)) - 5) AS BIGINT) END AS floor_v FROM long),
levels AS (
 SELECT 0 AS level, lang, source, metric, floor_v, spread FROM bucketed
 UNION ALL SELECT 1, lang, NULL, metric, floor_v, spread FROM bucketed
 UNION ALL SELECT 2, NULL, NULL, metric, floor_v, spread FROM bucketed),
placed AS (
 SELECT *, row_number() OVER (PARTITION BY level, lang, source, metric ORDER BY floor_v) AS r,
  count(*) OVER (PARTITION BY level, lang, source, metric) AS n FROM levels),
quartiles AS (
 SELECT level, lang, source, metric, n, spread,
  min(floor_v) FILTER (WHERE r * 4 >= n) AS q1, min(floor_v) FILTER (WHERE r * 4 >= n * 3) AS q3
 FROM placed GROUP BY ALL),
fences AS (
 SELECT level, lang, source, metric, n, q3 + 3 * greatest(q3 - q1, spread) AS high,
  CASE WHEN metric = 'word_length' THEN q1 - 3 * greatest(q3 - q1, spread) ELSE -1 END AS low
 FROM quartiles),
limits AS (
 SELECT g.lang, g.source, g.metric,
  CASE WHEN g.n >= 100 THEN g.low WHEN l.n >= 100 THEN l.low ELSE a.low END AS low,
  CASE WHEN g.n >= 100 THEN g.high WHEN l.n >= 100 THEN l.high ELSE a.high END AS high
 FROM (SELECT * FROM fences WHERE level = 0) g
 JOIN (SELECT * FROM fences WHERE level = 1) l
  ON g.metric = l.metric AND g.lang IS NOT DISTINCT FROM l.lang
 JOIN (SELECT * FROM fences WHERE level = 2) a ON g.metric = a.metric),
verdicts AS (
 SELECT f.row_no, bool_and(CASE m.metric WHEN 'word_length' THEN f.word_length
   WHEN 'symbols' THEN f.symbols WHEN 'dup_lines' THEN f.dup_lines ELSE f.repeats END
  BETWEEN m.low AND m.high) AS inside
 FROM failed f JOIN limits m
  ON f.lang IS NOT DISTINCT FROM m.lang AND f.source IS NOT DISTINCT FROM m.source
 GROUP BY f.row_no)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
 NOT base_failed AND coalesce(inside, false) AS kept
FROM failed LEFT JOIN verdicts USING (row_no)
"""

_ARCHIVES = """
WITH payloads AS (
 SELECT page_id, coalesce(html, '') AS html FROM pages),
digests AS (
 SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest
 FROM payloads),
firsts AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM digests)
SELECT page_id, payload_bytes, payload_digest,
 CASE WHEN payload_bytes >= 1000 AND first_id <> page_id THEN 'revisit' ELSE 'response' END
  AS record_type,
 CASE WHEN payload_bytes >= 1000 AND first_id <> page_id THEN first_id END AS refers_to
FROM firsts
"""

_COPIED = rf"""
WITH words AS (
 SELECT row_number() OVER () AS row_no, doc_id, {_WORDS} AS words
 FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)),
windows AS (
 SELECT row_no, doc_id, i, array_to_string(list_slice(words, i, i + 12), ' ') AS words
 FROM (SELECT *, unnest(range(1, len(words) - 11)) AS i FROM words)),
copied AS (
 SELECT row_no, i FROM windows
 QUALIFY doc_id > min(doc_id) OVER (PARTITION BY words)),
removed AS (
 SELECT row_no, list(DISTINCT i + k) AS places
 FROM copied, (SELECT unnest(range(13)) AS k) GROUP BY row_no),
kept AS (
 SELECT doc_id, len(words) AS n_words, coalesce(len(places), 0) AS n_removed,
  CASE WHEN places IS NULL THEN words
   ELSE list_filter(words, lambda w, i: NOT list_contains(places, i)) END AS words
 FROM words LEFT JOIN removed USING (row_no))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed,
 sha256(coalesce(array_to_string(words, ' '), '')) AS kept_sha256
FROM kept
"""

# The polynomial and the mask of CRC-32.
_TRIE = """
WITH ids AS (
 SELECT DISTINCT conv_id,
  xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(
    string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
   lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda x, i: xor(x >> 1, 3988292384::BIGINT * (x & 1)))), 4294967295::BIGINT) % 9 AS h
 FROM conversations WHERE conv_id IS NOT NULL),
named AS (
 SELECT conv_id, turn, strlen(coalesce(text, '')) AS size,
  sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS name
 FROM conversations),
own AS (
 SELECT conv_id, name, size,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, name) AS p FROM named),
taken AS (
 SELECT ids.conv_id, 0 AS part, p, name, size
 FROM ids JOIN own ON own.conv_id = ids.conv_id - ids.conv_id % 5 AND p <= h
 UNION ALL
 SELECT conv_id, 1, p, name, size FROM ids JOIN own USING (conv_id) WHERE p > h),
members AS (
 SELECT conv_id, size, row_number() OVER w AS depth, string_agg(name, '') OVER w AS path
 FROM taken WINDOW w AS (PARTITION BY conv_id ORDER BY part, p)
 UNION ALL SELECT conv_id, 0, 0, '' FROM ids),
nodes AS (
 SELECT path, min(conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs,
  any_value(size) AS size FROM members GROUP BY path),
parents AS (
 SELECT node.path, parent.path AS parent_path, parent.conv_id AS parent_conv_id
 FROM nodes AS node JOIN members ON members.conv_id = node.conv_id
  AND members.depth = node.depth - 1
 JOIN nodes AS parent ON parent.path = members.path),
children AS (SELECT parent_path AS path, count(*) AS n_children FROM parents GROUP BY parent_path),
sums AS (
 SELECT members.path, sum(CASE WHEN children.path IS NULL THEN 1 ELSE 0 END) AS n_leaves,
  sum((node.n_convs - 1) * node.size) AS saved_tokens
 FROM nodes AS node LEFT JOIN children USING (path)
 JOIN members ON members.conv_id = node.conv_id AND members.depth <= node.depth
 GROUP BY members.path),
last AS (
 SELECT arg_max(path, depth) AS path, conv_id FROM members GROUP BY conv_id),
ends AS (
 SELECT path, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS listed
 FROM last GROUP BY path)
SELECT node.conv_id, CAST(node.depth AS BIGINT) AS depth, parent_conv_id, n_convs,
 coalesce(n_children, 0) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
 CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(listed, '')) AS ends_sha256
FROM nodes AS node LEFT JOIN parents USING (path) LEFT JOIN children USING (path)
LEFT JOIN sums USING (path) LEFT JOIN ends USING (path)
"""

# The characters that end a piece and those that separate words.
_PHRASES = r"""
WITH pieces AS (
 SELECT row_number() OVER () AS piece, lang, piece AS text FROM (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
   '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
cut AS (SELECT lang, regexp_extract_all(text, '[^\x20\x09]+') AS w FROM pieces),
placed AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM cut),
counts AS (
 SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase, count(*) AS f
 FROM placed, (SELECT unnest([1, 2, 3]) AS k) WHERE i + k - 1 <= len(w) GROUP BY ALL),
totals AS (SELECT lang, sum(f) AS n FROM counts WHERE k = 1 GROUP BY lang),
frequent AS (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE f >= 10),
triples AS (SELECT lang, w, f FROM frequent WHERE k = 3),
inside AS (
 SELECT lang, phrase, max(f) AS most FROM (
  SELECT lang, f, w[1] || ' ' || w[2] AS phrase FROM triples
  UNION ALL SELECT lang, f, w[2] || ' ' || w[3] FROM triples) GROUP BY ALL),
candidates AS (
 SELECT frequent.* FROM frequent LEFT JOIN inside USING (lang, phrase)
 WHERE k = 3 OR (k = 2 AND NOT coalesce(100 * most >= 50 * f, false))),
cuts AS (
 SELECT lang, k, phrase, f AS a, c, array_to_string(w[1:c], ' ') AS head,
  array_to_string(w[c + 1:], ' ') AS tail
 FROM candidates, (SELECT unnest([1, 2]) AS c) WHERE c < k),
scored AS (
 SELECT cuts.*, x.f AS l, y.f AS r,
  1000000::HUGEINT * a::HUGEINT * a::HUGEINT // (x.f::HUGEINT * y.f::HUGEINT) AS score
 FROM cuts JOIN frequent AS x ON x.lang = cuts.lang AND x.phrase = head
 JOIN frequent AS y ON y.lang = cuts.lang AND y.phrase = tail),
lowest AS (
 SELECT * FROM scored
 QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
ranked AS (
 SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
 FROM lowest)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_quality_rules": _QUALITY, "op5_arc_to_warc": _ARCHIVES,
            "op9_rlz_dedup": _COPIED, "op12_conversation_trie": _TRIE,
            "op13_collocations": _PHRASES}
