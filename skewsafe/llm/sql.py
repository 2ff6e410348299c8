"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from skewsafe.llm.url_filter import ALIKE, ALIKE_MEMBERS, BOUND, MAX_BAD_RATE, MULTI_LABEL_SUFFIXES, PRIOR_OUTCOMES, PRIOR_RATE

_MULTI = ", ".join(f"'{s}'" for s in MULTI_LABEL_SUFFIXES)


_SUMS = f"sum(n / (1 + (n - 1) * {ALIKE})) AS n, sum(k / (1 + (n - 1) * {ALIKE})) AS k"


def _shrunk(table: str) -> str:
    """SQL of ``table`` (n, k, m, u) with its strength s, posterior mean p and variance v."""
    strength = f"""SELECT 1 / greatest(0.0001, least(0.5,
      (coalesce(sum(((k - n * m) * (k - n * m) - n * m * (1 - m)) / (n * n * m * (1 - m))), 0) + {ALIKE * ALIKE_MEMBERS})
      / (coalesce(sum((n - 1) / n), 0) + {ALIKE_MEMBERS}))) - 1 AS s FROM {table} WHERE n > 1"""
    return f"""(SELECT *, p * (1 - p) / (n + s + 1) + (s / (n + s)) * (s / (n + s)) * u AS v
    FROM (SELECT *, (k + s * m) / (n + s) AS p FROM {table}, ({strength})))"""


OP8 = f"""
WITH split AS (
  SELECT page_id, regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1) AS raw,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
parsed AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM split),
known AS (
  SELECT doc_id AS page_id, max(greatest(1 - quality, toxic)) AS bad FROM labels
  WHERE doc_id IS NOT NULL AND greatest(1 - quality, toxic) IN (0, 1) GROUP BY 1),
hosts AS (
  SELECT host, CAST(count(bad) AS DOUBLE) AS n, CAST(coalesce(sum(bad), 0) AS DOUBLE) AS k
  FROM parsed LEFT JOIN known USING (page_id) GROUP BY 1),
named AS (SELECT *, regexp_replace(host, '(^.*@)|(:[0-9]*$)', '', 'g') AS name FROM hosts),
labelled AS (SELECT *, string_split(name, '.') AS part FROM named),
placed AS (
  SELECT host, n, k,
    CASE WHEN regexp_matches(name, '^[0-9.]+$') THEN name
         WHEN array_to_string(part[-2:], '.') IN ({_MULTI}) THEN array_to_string(part[-3:], '.')
         ELSE array_to_string(part[-2:], '.') END AS domain,
    CASE WHEN regexp_matches(name, '^[0-9.]+$') THEN name
         WHEN array_to_string(part[-2:], '.') IN ({_MULTI}) THEN array_to_string(part[-2:], '.')
         ELSE part[-1] END AS suffix
  FROM labelled),
domains AS (SELECT domain, suffix, {_SUMS} FROM placed GROUP BY 1, 2),
suffix_sums AS (SELECT suffix, {_SUMS} FROM domains GROUP BY 1),
overall AS (
  SELECT rate AS m, rate * (1 - rate) / (size + 1) AS u
  FROM (SELECT (k + {PRIOR_RATE * PRIOR_OUTCOMES}) / (n + {PRIOR_OUTCOMES}) AS rate, n + {PRIOR_OUTCOMES} AS size
        FROM (SELECT {_SUMS} FROM suffix_sums))),
suffixes AS (SELECT * FROM suffix_sums, overall),
by_suffix AS (SELECT suffix, p AS m, v AS u FROM {_shrunk('suffixes')}),
domain_m AS (SELECT domain, n, k, m, u FROM domains JOIN by_suffix USING (suffix)),
by_domain AS (SELECT domain, p AS m, v AS u FROM {_shrunk('domain_m')}),
host_m AS (SELECT host, n, k, m, u FROM placed JOIN by_domain USING (domain)),
reputation AS (SELECT host, p - {BOUND} * sqrt(v) AS bound FROM {_shrunk('host_m')}),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM parsed)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
  WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
  WHEN bound > {MAX_BAD_RATE} THEN 'block' ELSE 'allow' END AS verdict
FROM ruled JOIN reputation USING (host)
"""

# The checksum's 256 table entries come from its polynomial, eight steps each.
OP2 = """
WITH RECURSIVE crc(n, k, c) AS (
  SELECT n, 0, n FROM (SELECT unnest(range(256)) AS n)
  UNION ALL
  SELECT n, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc WHERE k < 8),
steps AS (SELECT list(c ORDER BY n) AS step FROM crc WHERE k = 8),
sized AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size, hex(encode(coalesce(text, ''))) AS h
  FROM documents),
summed AS (
  SELECT doc_id, size, xor(4294967295, list_reduce(
      list_prepend(CAST(4294967295 AS BIGINT), list_transform(regexp_extract_all(h, '..'), lambda p: CAST('0x' || p AS BIGINT))),
      lambda c, b: xor(c >> 8, step[CAST(xor(c & 255, b) AS BIGINT) + 1]))) AS text_crc32
  FROM sized, steps),
placed AS (
  SELECT *, coalesce(sum(size) OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos,
         sum(size) OVER () AS total
  FROM summed),
sharded AS (SELECT *, CAST((2 * pos + size) * 16 // (2 * total) AS INTEGER) AS shard FROM placed)
SELECT doc_id, size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM sharded
"""

OP11 = """
WITH known AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY 1),
docs AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words
  FROM documents),
firsts AS (SELECT text, min(doc_id) AS first FROM docs GROUP BY 1),
fails AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, count(*) AS n,
         len(words) < 50 AS a, 100 * len(list_distinct(words)) < 65 * len(words) AS b,
         100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) AS c,
         regexp_matches(text, '[#$%&*|]') AS d, coalesce(first < doc_id, false) AS e
  FROM docs JOIN firsts USING (text) LEFT JOIN known USING (doc_id) GROUP BY ALL),
cells AS (
  SELECT part, good, toxic, n, (CASE WHEN a THEN 1 ELSE 0 END) + (CASE WHEN b THEN 2 ELSE 0 END) + (CASE WHEN c THEN 4 ELSE 0 END)
         + (CASE WHEN d THEN 8 ELSE 0 END) + (CASE WHEN e THEN 16 ELSE 0 END) AS mask
  FROM fails),
letters AS (SELECT chr(65 + CAST(i AS INTEGER)) AS f, CAST(pow(2, i) AS BIGINT) AS bit FROM range(5) r(i)),
orders_ AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (
  SELECT filter_order, CAST(i AS INTEGER) AS step, bit,
         (SELECT coalesce(sum(l.bit), 0) FROM letters l WHERE position(l.f IN filter_order) < i)::BIGINT AS before
  FROM orders_, range(1, 6) r(i), letters WHERE f = substr(filter_order, i, 1)),
counted AS (
  SELECT part, filter_order, step, bit,
    sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & before <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 AND good = 1 THEN n ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 AND toxic = 1 THEN n ELSE 0 END) AS toxic_lost
  FROM cells, steps GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM counted
"""

OP13 = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, row_number() OVER () AS p, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS w FROM pieces),
words AS (SELECT lang, p, unnest(w) AS w1, unnest(range(1, len(w) + 1)) AS i FROM worded),
near AS (SELECT lang, w1, lead(w1, 1) OVER (PARTITION BY p ORDER BY i) AS w2, lead(w1, 2) OVER (PARTITION BY p ORDER BY i) AS w3 FROM words),
grams AS (
  SELECT lang, 1 AS k, w1 AS g FROM near
  UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM near WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM near WHERE w3 IS NOT NULL),
counts AS (SELECT lang, k, g, CAST(count(*) AS HUGEINT) AS f FROM grams GROUP BY ALL),
cand AS (SELECT lang, k, g, f AS a FROM counts WHERE k > 1 AND f >= 10),
cuts AS (
  SELECT c.lang, c.k, c.g, c.a, j AS cut, l.f AS l, r.f AS r, 1000000 * c.a * c.a // (l.f * r.f) AS score
  FROM cand c JOIN (SELECT unnest([1, 2]) AS j) ON j < c.k
  JOIN counts l ON l.lang = c.lang AND l.g = array_to_string(string_split(c.g, ' ')[1:j], ' ')
  JOIN counts r ON r.lang = c.lang AND r.g = array_to_string(string_split(c.g, ' ')[j + 1:c.k], ' ')),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
longer AS (
  SELECT lang, part AS g, max(a) AS longer FROM (
    SELECT lang, a, unnest([array_to_string(string_split(g, ' ')[1:2], ' '), array_to_string(string_split(g, ' ')[2:3], ' ')]) AS part
    FROM cand WHERE k = 3) GROUP BY ALL),
kept AS (SELECT s.* FROM scored s LEFT JOIN longer USING (lang, g) WHERE longer IS NULL OR 100 * longer < 50 * a),
totals AS (SELECT lang, sum(f) AS n FROM counts WHERE k = 1 GROUP BY 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(g)) AS rank, g AS phrase,
       CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
"""

ORACLE_SQL = {"op2_sharding": OP2, "op8_url_filter": OP8, "op11_filter_audit": OP11, "op13_phrases": OP13}
