"""DuckDB SQL for corpus queries that SQL expresses; the others are tested against plain versions."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP1 = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS ws FROM documents),
starts AS (SELECT r, ws, unnest(range(1, len(ws) - 33)) AS i FROM d),
win AS (SELECT r, i, sha256(array_to_string(list_slice(ws, i, i + 34), ' ')) AS h FROM starts),
twice AS (SELECT h FROM win GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS j FROM win JOIN twice USING (h)),
words AS (SELECT r, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS j FROM d),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY j) AS k, count(*) AS n FROM words ANTI JOIN gone USING (r, j) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

OP4 = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS j FROM d),
k AS (SELECT *, translate(trim(line, {_SPACE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
held AS (SELECT key, min(doc_id) AS owner FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
kept AS (SELECT r, string_agg(line, chr(10) ORDER BY j) AS t, count(*) AS n FROM k LEFT JOIN held USING (key)
         WHERE owner IS NULL OR owner = doc_id GROUP BY r)
SELECT doc_id, len(ls)::BIGINT AS n_lines, (len(ls) - coalesce(n, 0))::BIGINT AS n_dropped, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

OP9 = rf"""
WITH d AS (SELECT doc_id, source, row_number() OVER () AS r, coalesce(text, '') AS t, {_WORDS} AS ws FROM documents),
words AS (SELECT r, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS j FROM d),
tri AS (SELECT r, j, w || ' ' || lead(w) OVER (PARTITION BY r ORDER BY j) || ' ' || lead(w, 2) OVER (PARTITION BY r ORDER BY j) AS x FROM words),
twice AS (SELECT r, j FROM (SELECT r, j, count(*) OVER (PARTITION BY r, x) AS n FROM tri WHERE x IS NOT NULL) WHERE n > 1),
rep AS (SELECT r, count(*) AS n_repeat_words FROM (SELECT DISTINCT r, unnest([j, j + 1, j + 2]) AS j FROM twice) GROUP BY r),
l AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
f AS (
  SELECT doc_id, source, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN rep USING (r) LEFT JOIN dup USING (r)),
g AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f),
h AS (SELECT *, base_failed OR 2 * n_symbols > n_words OR 2 * n_dup_lines > n_words AS rule_failed FROM g),
hosts AS (SELECT source, count(*) AS n, count(*) FILTER (rule_failed) AS bad FROM h GROUP BY source),
prior AS (SELECT avg(bad / n) AS m, var_samp(bad / n) - avg(bad / n) * (1 - avg(bad / n)) * avg(1 / n) AS v FROM hosts),
strength AS (SELECT m, CASE WHEN v IS NULL OR (v >= m * (1 - m) AND m * (1 - m) > 0) THEN 10 WHEN v > 0 THEN m * (1 - m) / v - 1 ELSE 1e9 END AS s FROM prior),
shrunk AS (SELECT source, n + s AS weight, (bad + m * s) / (n + s) AS p, least(1.5 * m, 0.5) AS bar FROM hosts, strength),
verdict AS (SELECT source, p - 2 * sqrt(p * (1 - p) / (weight + 1)) > bar AS rejected FROM shrunk)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (rejected AND rule_failed) AS kept
FROM h JOIN verdict ON h.source IS NOT DISTINCT FROM verdict.source
"""

OP11 = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.r AS ar, a.vec_id AS anchor_id, b.r AS br, b.vec_id, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 50 = 0),
p AS (
  SELECT ar, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id) AS slot
  FROM s WHERE same QUALIFY slot <= 5)
SELECT p.anchor_id, positive_id, (row_number() OVER (PARTITION BY p.ar, slot ORDER BY score DESC, vec_id))::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.ar = s.ar AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

OP12 = rf"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, {_WORDS} AS ws FROM documents),
firsts AS (SELECT t, min(doc_id) AS first FROM d GROUP BY t),
good AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         (len(ws) < 100)::INT + 2 * (100 * len(list_distinct(ws)) < 80 * len(ws))::INT
         + 4 * (100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT
         + 16 * coalesce(first < d.doc_id, false)::INT AS bits
  FROM d JOIN firsts USING (t) LEFT JOIN good ON d.doc_id = good.doc_id),
c AS (SELECT part, bits, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, bits),
one AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS b),
perm AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bs
  FROM one a, one b, one c, one d, one e WHERE a.b + b.b + c.b + d.b + e.b = 31 AND a.b | b.b | c.b | d.b | e.b = 31),
step AS (
  SELECT filter_order, i::INTEGER AS step, bs[i] AS bit, coalesce(list_sum(bs[1:i - 1]), 0)::INTEGER AS before
  FROM perm, (SELECT unnest(range(1, 6)) AS i)),
shown AS (
  SELECT part, filter_order, step, bit,
         sum(CASE WHEN bits & (before | bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN bits & bit <> 0 AND bits & before = 0 THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN bits & bit <> 0 AND bits & before <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN bits = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN bits & bit <> 0 AND bits & before = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN bits & bit <> 0 AND bits & before = 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM c, step GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM shown
"""


def _op2() -> str:
    """Placement in SQL; the table of slots is the operator's own, as text (its shares and moves have tests)."""
    from learner_scoring.llm import sharding

    table = ", ".join(map(str, sharding.lookup_table(sharding.shard_names(sharding.SHARDS))))
    return f"""
WITH t AS (SELECT [{table}] AS shards),
d AS (SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {sharding.SLOTS} AS slot FROM documents)
SELECT doc_id, slot, printf('shard-%05d', shards[slot + 1]) AS shard FROM d, t
"""


#: Documents of a source in order of their hashes; the group of equal hashes at the budget's edge goes to the nearer side.
OP3 = f"""
WITH d AS (
  SELECT doc_id, source, len({_WORDS})::BIGINT AS size,
         substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 9) AS place
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM d GROUP BY source),
fill AS (
  SELECT *, 2 * source_size AS most, 2 * source_size / weight AS ratio, 1.5::DOUBLE * sum(source_size) OVER () AS budget,
         coalesce(sum(2 * source_size) OVER o, 0) AS full_before, sum(weight) OVER () - coalesce(sum(weight) OVER o, 0) AS rest
  FROM s WINDOW o AS (ORDER BY 2 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT arg_min((budget - full_before) / rest, ratio) AS level FROM fill WHERE (budget - full_before) / rest <= ratio),
share AS (SELECT source, source_size, least(most::DOUBLE, weight * coalesce(level, 0)) AS target FROM fill, level),
want AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM share),
spread AS (
  SELECT source, place, sum(size) AS words, sum(sum(size)) OVER (PARTITION BY source ORDER BY place) AS upto FROM d GROUP BY source, place),
more AS (
  SELECT w.source, place, upto <= target - whole * source_size
         OR (upto - words <= target - whole * source_size AND upto - (target - whole * source_size) < target - whole * source_size - (upto - words)) AS extra
  FROM want w JOIN spread p ON w.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, (least(whole + extra::BIGINT, 2) * size)::BIGINT AS taken
FROM d JOIN want w ON d.source IS NOT DISTINCT FROM w.source
       JOIN more m ON d.source IS NOT DISTINCT FROM m.source AND d.place = m.place
"""

OP6 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + 3), ' ') AS x
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)),
reach AS (SELECT DISTINCT doc_id AS id, doc_id AS other FROM d UNION SELECT id, b FROM reach JOIN links ON other = a),
comp AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id FROM d LEFT JOIN n USING (doc_id) JOIN comp ON comp.id = d.doc_id
"""

OP8 = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
ok AS (
  SELECT r, vec_id, label, e, sqrt(list_dot_product(e, e)) AS norm FROM v
  WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(e, e) > 0),
links AS (
  SELECT a.r AS ar, b.r AS br FROM ok a JOIN ok b ON a.label = b.label AND a.r <> b.r AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) >= 0.98 * a.norm * b.norm),
reach AS (SELECT r, r AS other FROM v UNION SELECT reach.r, br FROM reach JOIN links ON other = ar),
comp AS (SELECT reach.r, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = other GROUP BY reach.r),
n AS (SELECT ar AS r, count(*) AS n FROM links GROUP BY ar)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN comp USING (r) LEFT JOIN n USING (r)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_substring_dedup": OP1, "op2_sharding": _op2(), "op3_mixing": OP3, "op4_line_dedup": OP4, "op6_ngram_jaccard": OP6,
        "op8_embed_dedup": OP8, "op9_quality_rules": OP9, "op11_hard_negatives": OP11, "op12_filter_audit": OP12,
    }
