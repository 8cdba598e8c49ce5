"""DuckDB statements of the queries of this folder that SQL can state."""

from __future__ import annotations

from .host_reputation import BOUND, LEAST, TWO_LABEL_SUFFIXES

_ASSIGNED = """
d{t} AS MATERIALIZED (
  SELECT r, c, CAST(list_sum(list_transform(range(1, 65), lambda i: (k.v[i] - m.v[i]) * (k.v[i] - m.v[i]))) AS BIGINT) AS d
  FROM kept AS k CROSS JOIN m{t} AS m),
a{t} AS MATERIALIZED (SELECT r, c, d FROM d{t} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)"""

_MEANS = """
s{t} AS MATERIALIZED (
  SELECT c, i, sum(x) AS s, count(*) AS n
  FROM (SELECT c, unnest(v) AS x, unnest(range(1, 65)) AS i FROM a{p} JOIN kept USING (r)) GROUP BY c, i),
m{t} AS MATERIALIZED (
  SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM s{t} GROUP BY c
  UNION ALL SELECT c, v FROM m{p} WHERE c NOT IN (SELECT c FROM a{p}))"""


def _clusters(rounds: int) -> str:
    steps = [_ASSIGNED.format(t=0)]
    for t in range(1, rounds + 1):
        steps += [_MEANS.format(t=t, p=t - 1), _ASSIGNED.format(t=t)]
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
m0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, vec_id, v) - 1 AS c, v
  FROM (SELECT sha256('3:' || vec_id) AS h, vec_id, v FROM kept WHERE vec_id IS NOT NULL ORDER BY h, vec_id, v LIMIT 8)),
{",".join(steps)}
SELECT vec_id, CAST(c AS INTEGER) AS cluster, d AS distance,
  CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(v, ',')) AS centroid_sha256
FROM a{rounds} JOIN kept AS k USING (r) JOIN (SELECT c, v AS v FROM m{rounds}) AS m USING (c)
""".replace("array_to_string(v, ',')", "array_to_string(m.v, ',')")


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _linked(size: int, percent: int) -> str:
    """Columns r, doc_id, n, component of documents linked by shingles of ``size`` words."""
    shingle = " || ' ' || ".join(f"w[i + {k}]" for k in range(size))
    return f"""
WITH RECURSIVE split AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS MATERIALIZED (
  SELECT r, unnest(list_distinct(CASE
    WHEN len(w) >= {size} THEN list_transform(range(1, len(w) - {size - 2}), lambda i: {shingle})
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s FROM split),
sizes AS MATERIALIZED (SELECT r, count(*) AS n FROM sets GROUP BY r),
pairs AS MATERIALIZED (
  SELECT x.r AS a, y.r AS b, count(*) AS common FROM sets AS x JOIN sets AS y ON x.s = y.s AND x.r < y.r GROUP BY 1, 2),
links AS MATERIALIZED (
  SELECT a, b FROM pairs JOIN sizes AS x ON x.r = a JOIN sizes AS y ON y.r = b WHERE 100 * common >= {percent} * (x.n + y.n - common)),
reached(r, t) AS (
  SELECT r, r FROM split
  UNION SELECT reached.r, l.b FROM reached JOIN (SELECT a, b FROM links UNION ALL SELECT b, a FROM links) AS l ON l.a = reached.t),
found AS (
  SELECT reached.r, min(x.doc_id) AS component FROM reached JOIN split AS x ON x.r = reached.t GROUP BY reached.r)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component AS component_id
FROM split JOIN found USING (r) LEFT JOIN sizes USING (r)"""


_COLLOCATIONS = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(string_split_regex({_LOWER}, '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS w
  FROM documents),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i, len(w) AS many FROM pieces),
f AS MATERIALIZED (
  SELECT lang, k AS words, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM places CROSS JOIN (VALUES (1), (2), (3)) AS lengths(k) WHERE i + k - 1 <= many GROUP BY ALL),
sizes AS (SELECT lang, sum(f) AS n FROM f WHERE words = 1 GROUP BY lang),
candidates AS (SELECT lang, phrase, words, f AS a, string_split(phrase, ' ') AS w FROM f WHERE words > 1 AND f >= 10),
cuts AS (SELECT *, unnest(range(1, words)) AS k FROM candidates),
scored AS (
  SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r, CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts AS c JOIN f AS x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k], ' ')
  JOIN f AS y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:], ' ')
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, array_to_string(w[i:i + 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT lang, w, a, unnest([1, 2]) AS i FROM candidates WHERE words = 3) GROUP BY 1, 2)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score
FROM scored LEFT JOIN inside USING (lang, phrase) JOIN sizes USING (lang)
WHERE longer IS NULL OR 100 * longer < 50 * a
QUALIFY rank <= 2000"""


_REPEATS = """
WITH split AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
windows AS (
  SELECT r, i, sha256(array_to_string(w[i:i + 34], ' ')) AS h
  FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM split WHERE len(w) >= 35)),
repeated AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY h) > 1),
covered AS MATERIALIZED (SELECT DISTINCT r, i + k AS i FROM repeated, range(0, 35) AS g(k)),
words AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM split),
kept AS (
  SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text
  FROM words ANTI JOIN covered USING (r, i) GROUP BY r)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (r)"""


def _strength(groups: str, name: str) -> str:
    """How many pages a prior counts for, from groups with ``n`` labelled and ``s`` good pages: moments of the shares."""
    return f"""
{name}_sums AS (
  SELECT CAST(count(*) AS DOUBLE) AS g, CAST(sum(n) AS DOUBLE) AS t, CAST(sum(n * n) AS DOUBLE) AS t2,
         CAST(sum(s) AS DOUBLE) AS good, sum(CAST(s * s AS DOUBLE) / n) AS q FROM {groups} WHERE n > 0),
{name}_spread AS (
  SELECT g, t, greatest((q - good * good / t) / (g - 1), 0) AS between_, greatest((good - q) / (t - g), 1e-9) AS within_,
         (t - t2 / t) / (g - 1) AS size FROM {name}_sums WHERE g > 1 AND t > g),
{name} AS (
  SELECT coalesce((
    SELECT least(greatest(1 / greatest((between_ - within_) / (between_ + (size - 1) * within_), 1e-6) - 1, 1.0), 1000.0)
    FROM {name}_spread), 1000.0) AS strength)"""


def _reputation(rules: list[tuple[str, str, str]], suffixes: tuple[str, ...], bound: float, least: float) -> str:
    listed = ", ".join(f"({i}, '{verdict}', '{host}', '{path}')" for i, (verdict, host, path) in enumerate(rules))
    pairs = ", ".join(f"'{x}'" for x in suffixes)
    address = "regexp_matches(name, '^\\d+(\\.\\d+){3}$|^\\[')"
    return f"""
WITH rules(place, verdict, rule_host, rule_path) AS (VALUES {listed}),
good AS (
  SELECT doc_id AS page_id, min(CAST(quality = 1 AND toxic = 0 AS INT)) AS good FROM labels
  WHERE doc_id IS NOT NULL AND (quality = 1 AND toxic = 0) IS NOT NULL GROUP BY doc_id),
parts AS MATERIALIZED (
  SELECT row_number() OVER () AS r, page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
named AS (
  SELECT host, n, s, CASE WHEN {address} THEN name
      WHEN array_to_string(labels[-2:], '.') IN ({pairs}) THEN array_to_string(labels[-3:], '.')
      ELSE array_to_string(labels[-2:], '.') END AS domain
  FROM (SELECT *, string_split(name, '.') AS labels FROM (
    SELECT host, regexp_replace(regexp_replace(host, '^.*@', ''), ':\\d*$', '') AS name,
           count(good) AS n, coalesce(sum(good), 0) AS s
    FROM parts LEFT JOIN good USING (page_id) GROUP BY host))),
hosts AS MATERIALIZED (
  SELECT *, CASE WHEN contains(domain, '.') AND NOT {address.replace("name", "domain")}
    THEN regexp_replace(domain, '^[^.]*\\.', '') ELSE '' END AS suffix FROM named),
domains AS MATERIALIZED (SELECT domain, suffix, sum(n) AS n, sum(s) AS s FROM hosts GROUP BY ALL),
suffixes AS MATERIALIZED (SELECT suffix, sum(n) AS n, sum(s) AS s FROM domains GROUP BY ALL),
{_strength("suffixes", "a")}, {_strength("domains", "b")}, {_strength("hosts", "c")},
by_suffix AS (
  SELECT suffix, (s + strength * (SELECT (sum(s) + 1.0) / (sum(n) + 2) FROM suffixes)) / (n + strength) AS prior FROM suffixes, a),
by_domain AS (SELECT domain, (s + strength * prior) / (n + strength) AS prior FROM domains JOIN by_suffix USING (suffix), b),
by_host AS (
  SELECT host, mean - {bound} * sqrt(mean * (1 - mean) / (n + strength + 1)) AS lower_bound
  FROM (SELECT host, n, strength, (s + strength * prior) / (n + strength) AS mean
        FROM hosts JOIN by_domain USING (domain), c)),
fits AS (
  SELECT r, rule_host || rule_path AS rule, verdict FROM parts JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY len(rule_host || rule_path) DESC, place) = 1)
SELECT page_id, host, path, rule, coalesce(verdict, if(lower_bound >= {least}, 'allow', 'block')) AS verdict
FROM parts JOIN by_host USING (host) LEFT JOIN fits USING (r)"""


STATEMENTS = {
    "op7_host_reputation": _reputation(
        [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")],
        TWO_LABEL_SUFFIXES, BOUND, LEAST),
    "op9_substring_dedup": _REPEATS,
    "op8_jaccard_join": _linked(5, 80),
    "op11_centroid_clusters": _clusters(10),
    "op12_collocations": _COLLOCATIONS,
    "op13_circulant_minhash": f"SELECT *, doc_id IS NOT DISTINCT FROM component_id AS kept FROM ({_linked(2, 80)})",
}
