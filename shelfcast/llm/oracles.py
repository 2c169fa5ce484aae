"""SQL that gives the same rows as a query, where SQL can express its operator; for small tables."""

from __future__ import annotations

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Components of ``links(a, b)`` over ``nodes(node)``, as (node, component).
COMPONENTS = """
reached(node, place) AS (SELECT node, node FROM nodes UNION SELECT r.node, l.b FROM reached r JOIN links l ON l.a = r.place),
components AS (SELECT node, min(place) AS component FROM reached GROUP BY node)"""

QUALITY = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, {WORDS.format('text')} AS w, string_split(text, chr(10)) AS lines FROM t),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n
  FROM (SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM w, unnest(range(1, len(w) - 1)) AS r(i))),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM windows, unnest([0, 1, 2]) AS o(k) WHERE n > 1 GROUP BY doc_id),
counts AS (
  SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS worded, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
    len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) AS lettered,
    length(regexp_replace(text, '[^A-Z]', '', 'g')) AS upper, strlen(regexp_replace(text, '[\x00-@\[-`{{-\x7F]', '', 'g')) AS letters,
    len(list_filter(lines, lambda x: ends_with(x, '...') OR ends_with(x, '…'))) AS cut, len(list_filter(lines, lambda x: x <> '')) AS filled
  FROM w LEFT JOIN covered c ON c.doc_id = w.doc_id),
judged AS (
  SELECT *, CAST(len(worded) - len(list_distinct(worded)) AS BIGINT) AS n_dup_lines,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR 2 * word_chars < 5 * n_words OR word_chars > 12 * n_words
    OR 10 * n_dup_lines > 3 * len(worded) OR 10 * lettered < 6 * n_words OR 2 * upper > letters OR 2 * cut > filled) AS kept
FROM judged"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS.format(LOWERED)} AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s FROM w, unnest(range(1, greatest(len(w) - 3, least(len(w), 1)) + 1)) AS r(i)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM shingles x JOIN shingles y ON y.s = x.s AND y.doc_id <> x.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared.n >= 80 * (x.n + y.n - shared.n)),
nodes AS (SELECT doc_id AS node FROM documents),{COMPONENTS}
SELECT node AS doc_id, coalesce(n, 0) AS n_shingles, component AS component_id, node = component AS kept
FROM components LEFT JOIN sizes ON sizes.doc_id = node"""

NEAR_VECTORS = f"""
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
known AS (
  SELECT *, sqrt(list_dot_product(e, e)) AS norm FROM v
  WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(e, e) > 0),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM known x JOIN known y ON y.label = x.label AND len(y.e) = len(x.e) AND y.vec_id <> x.vec_id
  WHERE list_dot_product(x.e, y.e) / (x.norm * y.norm) >= 0.98),
nodes AS (SELECT vec_id AS node FROM embeddings),{COMPONENTS}
SELECT node AS vec_id, count(l.a) AS n_links, component AS component_id, node = component AS kept
FROM components LEFT JOIN links l ON l.a = node GROUP BY node, component"""

PHRASES = rf"""
WITH texts AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({LOWERED}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM texts),
f AS MATERIALIZED (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, count(*) AS n
  FROM w, unnest(range(1, len(w) + 1)) AS r(i), unnest([1, 2, 3]) AS s(size) WHERE i + size - 1 <= len(w) GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
candidates AS (SELECT lang, size, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND n >= 10),
parts AS (
  SELECT lang, phrase, a, k, lang || ' ' || array_to_string(w[1:k], ' ') AS head, lang || ' ' || array_to_string(w[k + 1:size], ' ') AS tail
  FROM candidates, unnest([1, 2]) AS t(k) WHERE k < size),
known AS MATERIALIZED (SELECT lang || ' ' || phrase AS part, n FROM f WHERE n >= 10),
heads AS MATERIALIZED (SELECT parts.*, n AS l FROM parts JOIN known ON part = head),
cuts AS (SELECT heads.*, n AS r, CAST((1000000::HUGEINT * a * a) // (l::HUGEINT * n) AS BIGINT) AS score FROM heads JOIN known ON part = tail),
weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_parts AS (SELECT lang, array_to_string(w[i:i + 1], ' ') AS phrase, max(a) AS most FROM candidates, unnest([1, 2]) AS r(i) WHERE size = 3 GROUP BY ALL),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score
  FROM weakest LEFT JOIN inner_parts USING (lang, phrase) WHERE coalesce(100 * most < 50 * a, true))
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""

#: crc32 by its table: 256 entries, and the bytes of a word by their hexadecimal digits.
RESAMPLING = rf"""
WITH crc_table AS (
  SELECT list(v ORDER BY i) AS t
  FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS v FROM range(256) AS r(i))),
words AS (
  SELECT 's' AS side, doc_id, unnest(regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM documents
  UNION ALL SELECT 't', NULL, unnest(regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark),
bytes AS (
  SELECT word, list_transform(range(strlen(word)), lambda i: 16 * (instr('0123456789ABCDEF', substr(h, 2 * i + 1, 1)) - 1) + instr('0123456789ABCDEF', substr(h, 2 * i + 2, 1)) - 1) AS b
  FROM (SELECT DISTINCT word, hex(encode(word)) AS h FROM words)),
hashed AS (
  SELECT word, xor(4294967295, list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]))) % 10000 AS bucket FROM bytes, crc_table),
features AS (SELECT side, doc_id, bucket FROM words JOIN hashed USING (word)),
totals AS (SELECT count(*) FILTER (side = 's') AS s_all, count(*) FILTER (side = 't') AS t_all FROM features),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST((count(*) FILTER (side = 't') + 1) * (s_all + 10000) AS DOUBLE) / CAST((count(*) FILTER (side = 's') + 1) * (t_all + 10000) AS DOUBLE))) AS BIGINT) AS gain
  FROM features, totals GROUP BY bucket, s_all, t_all),
weights AS (SELECT doc_id, count(*) AS n, sum(gain) AS total FROM features JOIN gains USING (bucket) WHERE side = 's' GROUP BY doc_id),
noise AS (
  SELECT doc_id, list_reduce(list_transform(range(8), lambda i: instr('0123456789abcdef', substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), i + 1, 1)) - 1), lambda x, y: 16 * x + y) AS h
  FROM documents),
scored AS (
  SELECT noise.doc_id, coalesce(n, 0) AS n_features, coalesce(CAST(floor(total / n) AS BIGINT), 0) AS weight,
    coalesce(CAST(floor(total / n) AS BIGINT), 0) + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM noise LEFT JOIN weights USING (doc_id)),
placed AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY n_features >= 20) AS fit FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * fit // 100 THEN place END AS rank FROM placed"""

REVISITS = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p),
firsts AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS original FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> original THEN original END AS refers_to
FROM firsts"""

ORACLES = {
    "op5_quality_cascade": QUALITY,
    "op8_circulant_minhash": NEAR_DUPLICATES,
    "op10_projection_passes": NEAR_VECTORS,
    "op11_phrase_trees": PHRASES,
    "op12_importance_resampling": RESAMPLING,
    "op13_warc_revisits": REVISITS,
}
