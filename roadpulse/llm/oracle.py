"""DuckDB SQL for the text queries that SQL can express."""

from __future__ import annotations

_SPACE = r"[\x20\x09-\x0D]+"

_WORD = r"[^\x20\x09-\x0D]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4 = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, hash(list_slice(w, i, i + 3)) AS h
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles a JOIN shingles b ON a.h = b.h AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
reach AS (
  SELECT doc_id AS v, doc_id AS u FROM documents
  UNION SELECT r.v, l.b FROM reach r JOIN links l ON r.u = l.a)
SELECT r.v AS doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(r.u) AS component_id
FROM reach r LEFT JOIN sizes s ON s.doc_id = r.v GROUP BY r.v
"""

# The stock phrases of the quality rules.
_PHRASES = (
    "all rights reserved|cookie policy|cookie settings|accept cookies|privacy policy|terms of use|terms of service"
    "|enable javascript|lorem ipsum|click here|subscribe to our newsletter|skip to content|powered by"
)

OP6 = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
windows AS (
  SELECT doc_id, i, list_slice(w, i, i + 7) AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) > 7)),
twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, x) > 1),
covered AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS j FROM twice) GROUP BY doc_id),
split AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS pos FROM d),
lines AS (
  SELECT *, regexp_extract_all(line, '{_WORD}') AS lw,
         row_number() OVER (PARTITION BY doc_id, line ORDER BY pos) > 1 AS again,
         len(regexp_extract_all(line, '[|»›·•→]')) AS seps
  FROM split WHERE regexp_matches(line, '{_WORD}')),
windows_of_lines AS (
  SELECT doc_id, pos, i, list_slice(lw, i, i + 7) AS x
  FROM (SELECT doc_id, pos, lw, unnest(range(1, len(lw) - 6)) AS i FROM lines WHERE len(lw) > 1000 AND 5 * len(list_distinct(lw)) < len(lw))),
twice_in_line AS (SELECT doc_id, pos, i FROM windows_of_lines QUALIFY count(*) OVER (PARTITION BY doc_id, pos, x) > 1),
repeats AS (
  SELECT doc_id, pos, count(DISTINCT j) AS n FROM (SELECT doc_id, pos, unnest(range(i, i + 8)) AS j FROM twice_in_line) GROUP BY doc_id, pos),
measured AS (
  SELECT l.*, coalesce(r.n, 0) AS n_again,
         list_sum([len(string_split(p, ' ')) for p in regexp_extract_all(lower(line), '{_PHRASES}')]) AS n_stock,
         list_sum([len(list_distinct(list_slice(lw, k, k + 999))) for k in range(1, len(lw) + 1, 1000)]) AS n_per_block
  FROM lines l LEFT JOIN repeats r ON r.doc_id IS NOT DISTINCT FROM l.doc_id AND r.pos = l.pos),
failed AS (
  SELECT *, seps >= 3 AND len(lw) <= 3 * (seps + 1)
      OR 10 * length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) > length(regexp_replace(line, '{_SPACE}', '', 'g'))
      OR 4 * coalesce(n_stock, 0) >= len(lw)
      OR again
      OR len(lw) >= 8 AND 5 * len(list_distinct(lw)) < len(lw) AND (5 * n_per_block < len(lw) OR 2 * n_again > len(lw)) AS fails
  FROM measured),
per_doc AS (
  SELECT doc_id, sum(CASE WHEN again THEN 1 ELSE 0 END) AS dup, sum(CASE WHEN fails THEN len(lw) ELSE 0 END) AS lost
  FROM failed GROUP BY doc_id),
judged AS (
  SELECT d.doc_id, len(w) AS n_words, length(regexp_replace(text, '{_SPACE}', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dup, 0) AS n_dup_lines,
         coalesce(c.n, 0) AS n_repeat_words, coalesce(lost, 0) AS n_lost_words
  FROM d LEFT JOIN covered c USING (doc_id) LEFT JOIN per_doc USING (doc_id))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       CAST(n_lost_words AS BIGINT) AS n_lost_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 100 * n_lost_words <= 50 * n_words AS kept
FROM judged
"""

OP7 = rf"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), 'text:' || coalesce(text, ''))) AS hash,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3]::DOUBLE AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT *, 2.0 * source_size / weight AS ratio,
         (1.5::DOUBLE * sum(source_size) OVER () - (sum(2.0::DOUBLE * source_size) OVER o - 2.0::DOUBLE * source_size))
           / sum(weight) OVER (ORDER BY 2.0 * source_size / weight, source IS NULL, source
                               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources WINDOW o AS (ORDER BY 2.0 * source_size / weight, source IS NULL, source)),
targets AS (
  SELECT source, source_size,
         CASE WHEN ratio <= level THEN 2.0::DOUBLE * source_size
              ELSE least(weight * first_value(CASE WHEN ratio > level THEN level END IGNORE NULLS) OVER (
                ORDER BY ratio, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING),
                2.0::DOUBLE * source_size) END AS target
  FROM levels),
ordered AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 1 END AS copies,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.hash RANGE UNBOUNDED PRECEDING) AS upto,
         sum(s.size) OVER (PARTITION BY s.source, s.hash) AS own
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       CAST(size * (copies + CASE WHEN size > 0 AND 2 * (target - copies * source_size - (upto - own)) >= own THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM ordered
"""

OP10 = rf"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '{_SPACE}', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
FROM n WINDOW g AS (PARTITION BY norm)
"""

# CRC-32 of each feature byte by byte, all features at once; 3988292384 is its polynomial.
OP11 = rf"""
WITH RECURSIVE
steps AS (SELECT i, i AS c, 0 AS k FROM range(256) r(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8),
texts AS (SELECT 'd' AS part, doc_id AS id, coalesce(text, '') AS text FROM documents
  UNION ALL SELECT 'b', item_id, coalesce(text, '') FROM benchmark),
words AS (SELECT part, id, regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
features AS (
  SELECT part, id, unnest(w) AS f FROM words
  UNION ALL SELECT part, id, w[i] || ' ' || w[i + 1] FROM (SELECT part, id, w, unnest(range(1, len(w))) AS i FROM words)),
counted AS (SELECT part, id, f, count(*) AS n FROM features GROUP BY ALL),
named AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM counted)),
crc AS (SELECT f, h, 4294967295 AS c, 1 AS pos FROM named
  UNION ALL SELECT f, h, xor(c >> 8, t[1 + (xor(c, CAST('0x' || substr(h, pos, 2) AS BIGINT)) & 255)]), pos + 2 FROM crc, crc_table WHERE pos < length(h)),
buckets AS (SELECT f, xor(c, 4294967295) % 10000 AS b FROM crc WHERE pos > length(h)),
placed AS (SELECT part, id, b, n FROM counted JOIN buckets USING (f)),
sums AS (SELECT part, b, sum(n) AS n FROM placed GROUP BY ALL),
totals AS (SELECT CAST(coalesce(sum(n) FILTER (part = 'd'), 0) AS DOUBLE) AS s_all, CAST(coalesce(sum(n) FILTER (part = 'b'), 0) AS DOUBLE) AS t_all FROM sums),
gains AS (
  SELECT b, CAST(floor(1000 * ln((t + 1) * (t_s + 10000) / ((s + 1) * (t_t + 10000)))) AS BIGINT) AS gain
  FROM (SELECT b, CAST(coalesce(sum(n) FILTER (part = 'd'), 0) AS DOUBLE) AS s, CAST(coalesce(sum(n) FILTER (part = 'b'), 0) AS DOUBLE) AS t FROM sums GROUP BY b),
       (SELECT s_all AS t_s, t_all AS t_t FROM totals)),
weights AS (
  SELECT id, CAST(sum(n) AS BIGINT) AS n_features, CAST(floor(CAST(sum(n * gain) AS DOUBLE) / CAST(sum(n) AS DOUBLE)) AS BIGINT) AS weight
  FROM placed JOIN gains USING (b) WHERE part = 'd' GROUP BY id),
scored AS (
  SELECT id AS doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || id), 1, 8) AS BIGINT) + 0.5) / 4294967296.0))) AS BIGINT) AS score
  FROM words LEFT JOIN weights USING (id) WHERE part = 'd'),
placed_docs AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, 25 * count(*) OVER () // 100 AS most FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= most THEN r END AS rank
FROM scored LEFT JOIN placed_docs USING (doc_id)
"""

OP12 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
found AS (SELECT row, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM found GROUP BY lang, term HAVING count(DISTINCT row) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
cells AS (
  SELECT g.lang, g.source, k.term, k.total, count(f.row) AS c
  FROM groups g JOIN kept k ON g.lang = k.lang LEFT JOIN found f ON f.lang = g.lang AND f.source = g.source AND f.term = k.term
  GROUP BY ALL),
sums AS (SELECT lang, source, sum(c) AS n FROM cells GROUP BY lang, source),
shares AS (
  SELECT c.lang, c.source, c.term, c.c, CAST(1 + 1000000000 * (c.c + 2) // (s.n + 2 * l.v) AS BIGINT) AS p,
         CAST(1 + 1000000000 * (c.total + 2) // (l.n + 2 * l.v) AS BIGINT) AS q
  FROM cells c JOIN sums s ON c.lang = s.lang AND c.source = s.source JOIN langs l ON c.lang = l.lang),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
all_pairs AS (
  SELECT a.lang, a.source, b.source AS item, CAST(coalesce(p.value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source),
terms AS (SELECT lang, source, term AS item, CAST((p - q) * (p - q) // (p + q) AS BIGINT) AS value FROM shares WHERE c > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value,
       CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM all_pairs
UNION ALL
SELECT * FROM (
  SELECT lang, source, 'term', item, value,
         CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM terms)
WHERE rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_jaccard_join": OP4,
        "op6_quality_rules": OP6,
        "op7_source_mix": OP7,
        "op10_exact_dedup": OP10,
        "op11_target_resampling": OP11,
        "op12_source_divergence": OP12,
    }
