"""DuckDB SQL for the queries that SQL can express, written apart from the operators."""

from __future__ import annotations

from ledgerflow.llm.license_rules import RULES, WINDOW

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOW = f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')"
_WORD = r"'[^\x20\x09-\x0D]+'"

# The checksum byte by byte: eight shifts make the table of 256, one step per byte of the text.
SHARDS = f"""
WITH steps AS (
  SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
  FROM (SELECT unnest(range(256)) AS i)),
tab AS (SELECT list(v ORDER BY i) AS t FROM steps),
rows AS (
  SELECT doc_id, source, coalesce(octet_length(encode(text)), 0) + 16 AS size,
    CASE WHEN text IS NOT NULL THEN xor(4294967295, list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: ('0x' || x)::BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) END AS text_crc32
  FROM documents, tab),
keyed AS (
  SELECT *, ('0x' || substr(md5(concat_ws(':', 0, coalesce(doc_id::VARCHAR, '-'), size, coalesce(text_crc32::VARCHAR, '-'))), 1, 15))::BIGINT AS key
  FROM rows),
ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY source ORDER BY key, doc_id, size, text_crc32) - 1 + 0.5::DOUBLE)
    / count(*) OVER (PARTITION BY source) AS fraction
  FROM keyed),
placed AS (
  SELECT *, row_number() OVER (ORDER BY fraction, source IS NULL, coalesce(source, '')) - 1 AS place, count(*) OVER () AS n FROM ranked),
dealt AS (SELECT *, (place * 40) // n AS shard FROM placed)
SELECT doc_id, size, text_crc32, 'rows' AS law, shard, place - (shard * n + 39) // 40 AS slot, NULL::INTEGER AS grown_shard, source, fraction
FROM dealt
"""

_ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
)
_ALLOWED = (
    "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    "^[+/_=-]*([A-Za-z]?[a-z]+|[A-Z]+|[0-9]{1,4})([+/_=-]+([A-Za-z]?[a-z]+|[A-Z]+|[0-9]{1,4}))*[+/_=-]*$",
)
_PLACEHOLDER = "[Ee][Xx][Aa][Mm][Pp][Ll][Ee]|[Pp][Ll][Aa][Cc][Ee][Hh][Oo][Ll][Dd][Ee][Rr]|[Dd][Uu][Mm][Mm][Yy]|[Xx]{8}|0{8}|123456789|abcdefgh|ABCDEFGH"


def _spans(kind: int, pattern: str) -> str:
    return f"""
  SELECT row, {kind} AS kind, hit, before + hits_before AS start, before + hits_before + length(hit) AS stop FROM (
    SELECT row, hit, sum(length(gap)) OVER w AS before, coalesce(sum(length(hit)) OVER (PARTITION BY row ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS hits_before
    FROM (
      SELECT row, unnest(regexp_extract_all(text, '{pattern}')) AS hit, unnest(string_split_regex(text, '{pattern}')[:len(regexp_extract_all(text, '{pattern}'))]) AS gap,
        generate_subscripts(regexp_extract_all(text, '{pattern}'), 1) AS k
      FROM docs)
    WINDOW w AS (PARTITION BY row ORDER BY k))"""


SECRETS = f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
found AS ({" UNION ALL ".join(_spans(k, p) for k, p in enumerate((_ASSIGN, "AKIA[A-Z0-9]{12,}", "[0-9a-f]{32,}", "[A-Za-z0-9+/_=-]{20,}")))}),
base AS (SELECT * FROM found WHERE kind IN (1, 2) OR kind = 0 AND length(regexp_extract(hit, '{_ASSIGN}', 2)) >= 8),
runs AS (
  SELECT * REPLACE (CASE
    WHEN regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[A-Za-z]') THEN CASE WHEN regexp_matches(hit, '^[0-9a-f]+$|^[0-9A-F]+$') THEN 3 ELSE 4 END
    WHEN regexp_matches(hit, '[A-Za-z]') THEN 5 ELSE 6 END AS kind) FROM found
  WHERE kind = 3 AND regexp_matches(hit, '[0-9A-Za-z]') AND NOT ({" OR ".join(f"regexp_matches(hit, '{p}')" for p in _ALLOWED)})),
parts AS (
  SELECT row, kind, start, stop, unnest(p) AS part, unnest(range(len(p))) AS n
  FROM (SELECT *, string_split_regex(hit, '{_PLACEHOLDER}') AS p FROM runs)),
signs AS (SELECT row, kind, start, stop, n * 1000000000 + i AS i, unnest(string_split(substr(part, i, 20), '')) AS sign
  FROM (SELECT *, unnest(range(1, length(part) - 18)) AS i FROM parts)),
counted AS (SELECT row, kind, start, stop, i, sign, count(*) AS c FROM signs GROUP BY ALL),
windows AS (SELECT row, kind, start, stop, i, -sum(c / 20.0::DOUBLE * log2(c / 20.0::DOUBLE)) AS h FROM counted GROUP BY ALL),
high AS (SELECT DISTINCT row, kind, start, stop FROM windows WHERE h >= [3.0, 3.7, 4.0, 3.1][kind - 2] - 1e-9),
spans AS (
  SELECT row, kind, start, stop FROM base
  UNION ALL SELECT * FROM high WHERE NOT EXISTS (SELECT 1 FROM base WHERE base.row = high.row AND base.start <= high.start AND high.stop <= base.stop)),
named AS (SELECT *, ['assign', 'access', 'hex', 'entropy_hex', 'entropy_mixed', 'entropy_letters', 'entropy_digits'][kind + 1] || ':' || start::BIGINT || ':' || stop::BIGINT AS label FROM spans),
listed AS (
  SELECT row, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
    string_agg(label, ',' ORDER BY start, kind) FILTER (kind < 3) AS base, string_agg(label, ',' ORDER BY start, kind) AS spans
  FROM named GROUP BY row)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN listed USING (row)
"""

JACCARD = f"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all({_LOW}, {_WORD}) AS w FROM documents),
sets AS (
  SELECT doc_id, CASE
    WHEN len(w) >= 4 THEN list_distinct(list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3]))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
  FROM words),
grams AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS overlap
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS MATERIALIZED (
  SELECT a, b FROM shared WHERE 100 * overlap >= 85 * (na + nb - overlap)
  UNION ALL SELECT b, a FROM shared WHERE 100 * overlap >= 85 * (na + nb - overlap)),
reach AS (SELECT doc_id, doc_id AS root FROM documents UNION SELECT links.b, reach.root FROM reach JOIN links ON links.a = reach.doc_id)
SELECT doc_id, len(s) AS n_shingles, component_id
FROM sets JOIN (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)
"""

PHRASES = f"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOW}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
split AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
numbered AS (SELECT row_number() OVER () AS piece, lang, w FROM split WHERE len(w) > 0),
words4 AS (
  SELECT lang, word, lead(word, 1) OVER p AS w2, lead(word, 2) OVER p AS w3, lead(word, 3) OVER p AS w4
  FROM (SELECT piece, lang, unnest(w) AS word, unnest(range(len(w))) AS place FROM numbered) WINDOW p AS (PARTITION BY piece ORDER BY place)),
grams AS (
  SELECT lang, 1 AS size, word AS phrase FROM words4
  UNION ALL SELECT lang, 2, word || ' ' || w2 FROM words4 WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, 3, word || ' ' || w2 || ' ' || w3 FROM words4 WHERE w3 IS NOT NULL
  UNION ALL SELECT lang, 4, word || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM words4 WHERE w4 IS NOT NULL),
counts AS MATERIALIZED (SELECT lang, size, phrase, count(*) AS f, string_split(phrase, ' ') AS w FROM grams GROUP BY ALL HAVING count(*) >= 30),
cuts AS (
  SELECT c.lang, c.size, c.phrase, c.f AS a, k, l.f AS l, r.f AS r, (2000000::HUGEINT * c.f // (l.f + r.f)) AS score
  FROM counts c JOIN range(1, 4) AS ks(k) ON k < c.size
  JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[:k], ' ')
  JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:], ' ')),
worst AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_parts AS (
  SELECT lang, f, m, w, unnest(range(1, size - m + 2)) AS i FROM counts, range(2, 4) AS ms(m) WHERE m < size),
around AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(f) AS most FROM inner_parts GROUP BY ALL),
alone AS (SELECT c.* FROM worst c LEFT JOIN around x ON x.lang = c.lang AND x.phrase = c.phrase WHERE x.most IS NULL OR 100::HUGEINT * x.most < 80 * c.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM alone),
words AS (SELECT lang, sum(len(w)) AS n FROM split GROUP BY lang)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked JOIN words USING (lang) WHERE rank <= 2000
"""

DIVERGENCE = f"""
WITH docs AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all({_LOW}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
places AS (SELECT row, lang, source, unnest(w) AS term FROM docs),
kept AS MATERIALIZED (SELECT lang, term FROM places GROUP BY ALL HAVING count(DISTINCT row) >= 10),
sources AS (SELECT DISTINCT lang, source FROM docs),
units AS (SELECT lang, source, false AS whole FROM sources UNION ALL SELECT DISTINCT lang, '', true FROM sources),
counted AS (
  SELECT lang, source, false AS whole, term, count(*) AS c FROM places GROUP BY ALL
  UNION ALL SELECT lang, '', true, term, count(*) FROM places GROUP BY ALL),
entries AS (
  SELECT lang, source, whole, term, coalesce(c, 0) AS c, sum(coalesce(c, 0)) OVER w AS n, count(*) OVER w AS v
  FROM units JOIN kept USING (lang) LEFT JOIN counted USING (lang, source, whole, term)
  WINDOW w AS (PARTITION BY lang, source, whole)),
shares AS MATERIALIZED (SELECT lang, source, whole, term, c, 1 + (1000000000::HUGEINT * (c + 2)) // (n + 2 * v) AS p FROM entries),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(d.value, 0) AS value FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source AS a, y.source AS b, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS value
    FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND NOT x.whole AND NOT y.whole AND x.source <> y.source GROUP BY ALL) d
  ON d.lang = a.lang AND d.a = a.source AND d.b = b.source),
terms AS (
  SELECT x.lang, x.source, x.term AS item, ((x.p - y.p) * (x.p - y.p)) // (x.p + y.p) AS value
  FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND NOT x.whole AND y.whole WHERE x.c > 0 AND x.p > y.p),
parts AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', item, value FROM terms)
SELECT lang, source, part, item, value::BIGINT AS value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM parts QUALIFY part = 'pair' OR rank <= 10
"""

_RULES = ", ".join(f"({k}, '{r.first}', ' {r.need} ', '^{r.pattern}', '{r.label}', {r.priority}, {r.weight}::DOUBLE, {r.base})" for k, r in enumerate(RULES))
_FIRST = ", ".join(sorted({f"'{r.first}'" for r in RULES}))

LICENSES = f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all({_LOW}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
rules(rule, first, need, pattern, label, priority, weight, base) AS (VALUES {_RULES}),
words AS (SELECT row, w, unnest(w) AS word, unnest(range(len(w))) AS start FROM docs),
anchors AS (SELECT row, word, start, ' ' || array_to_string(w[start + 1:start + {WINDOW}], '  ') || ' ' AS ahead FROM words WHERE word IN ({_FIRST})),
hits AS (
  SELECT row, rule, label, priority, weight, base, start, regexp_extract(ahead, pattern) AS hit
  FROM anchors JOIN rules ON word = first AND contains(ahead, need)),
found AS (SELECT *, start + (length(hit) - length(replace(hit, ' ', ''))) // 2 AS stop FROM hits WHERE hit <> ''),
walked AS (
  SELECT *, coalesce(max(stop) OVER (PARTITION BY row ORDER BY start, stop DESC, priority DESC, rule ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS reach FROM found),
beside AS (
  SELECT *, lag(stop) OVER w AS stop_before, lag(priority) OVER w AS priority_before, lead(start) OVER w AS start_after, lead(priority) OVER w AS priority_after
  FROM walked WHERE stop > reach WINDOW w AS (PARTITION BY row ORDER BY start)),
kept AS (
  SELECT row, label, weight, false AS base, start FROM beside
  WHERE NOT coalesce(start < stop_before AND priority_before > priority, false) AND NOT coalesce(start_after < stop AND priority_after > priority, false)),
told AS (SELECT * FROM kept UNION ALL SELECT row, label, weight, true, start FROM found WHERE base),
summed AS (
  SELECT row, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(weight) AS score
  FROM told GROUP BY row)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, coalesce(score, 0) AS score
FROM docs LEFT JOIN summed USING (row)
"""
