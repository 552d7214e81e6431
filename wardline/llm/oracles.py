"""SQL twins of the operators that SQL can express. Rules and weights repeat the operators' fixed values."""

from __future__ import annotations

_NORM = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = """
WITH v AS (
 SELECT vec_id, row_number() OVER () AS row, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS vec FROM embeddings
 WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
 SELECT q.vec_id AS query_id, q.row AS query_row, c.vec_id, c.row, list_dot_product(q.vec, c.vec)::BIGINT AS score
 FROM v q JOIN v c ON q.row <> c.row WHERE q.vec_id % 100 = 0),
r AS (
 SELECT *, row_number() OVER (PARTITION BY query_id, query_row ORDER BY score DESC, vec_id, row)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

OP6 = f"""
WITH d AS (SELECT doc_id, {_NORM} AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS n FROM d GROUP BY norm)
SELECT doc_id, keep_id, n AS group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM d JOIN g USING (norm)
"""

_ANOVA = """CASE WHEN count(*) > 1 AND sum(n) > count(*) AND sum(y) > 0 AND sum(y) < sum(n) THEN
 1 / least(greatest(
  ((sum(y * y / n) - sum(y) * sum(y) / sum(n)) / (count(*) - 1) - (sum(y) - sum(y * y / n)) / (sum(n) - count(*)))
  / ((sum(y * y / n) - sum(y) * sum(y) / sum(n)) / (count(*) - 1)
     + ((sum(n) - sum(n * n) / sum(n)) / (count(*) - 1) - 1) * (sum(y) - sum(y * y / n)) / (sum(n) - count(*))),
  0.0001), 0.99) - 1 ELSE 10.0 END"""

OP8 = f"""
WITH u AS (
 SELECT page_id, coalesce(url, '') AS url FROM pages),
p AS (
 SELECT page_id,
  translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM u),
r AS (
 SELECT *, CASE
  WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
  WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
  WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
  WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
  WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule
 FROM p),
l AS (
 SELECT doc_id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS bad
 FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
h AS (
 SELECT host, count(bad)::DOUBLE AS n, coalesce(sum(bad), 0) AS y,
  string_split(host, '.') AS parts
 FROM r LEFT JOIN l ON page_id = doc_id GROUP BY host),
hosts AS (
 SELECT host, n, y, array_to_string(parts[greatest(len(parts) - 1, 1):], '.') AS domain, parts[-1] AS suffix FROM h),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(y) AS y FROM hosts GROUP BY domain, suffix),
suffixes AS (SELECT suffix, sum(n) AS n, sum(y) AS y FROM domains GROUP BY suffix),
rate AS (SELECT CASE WHEN sum(n) > 0 THEN (sum(y) + 0.5) / (sum(n) + 1) ELSE 0.5 END AS m FROM suffixes),
ks AS (SELECT {_ANOVA} AS k FROM suffixes WHERE n > 0),
kd AS (SELECT {_ANOVA} AS k FROM domains WHERE n > 0),
kh AS (SELECT {_ANOVA} AS k FROM hosts WHERE n > 0),
s1 AS (SELECT suffix, (y + k * m) / (n + k) AS prior FROM suffixes, rate, ks),
d1 AS (SELECT domain, (y + k * prior) / (n + k) AS prior FROM domains JOIN s1 USING (suffix), kd),
h1 AS (SELECT host, n, (y + k * prior) / (n + k) AS mean, n + k AS size FROM hosts JOIN d1 USING (domain), kh),
h2 AS (SELECT host, n, mean - 1.645 * sqrt(mean * (1 - mean) / (size + 1)) AS bound FROM h1)
SELECT page_id, host, path, rule,
 CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN bound > 0.5 THEN 'block' ELSE 'allow' END AS verdict, n::BIGINT AS labelled
FROM r JOIN h2 USING (host)
"""

OP9 = r"""
WITH sized AS (
 SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\v\f\r]+'))::BIGINT AS size FROM documents),
rows_ AS (SELECT *, row_number() OVER (PARTITION BY doc_id, source ORDER BY size) AS row FROM sized),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
named AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) AS rank FROM sizes),
weighed AS (SELECT *, [5, 2, 1][((rank - 1) % 3 + 1)::INT] AS weight, 3 * source_size AS cap FROM named),
open_ AS (
 SELECT *, row_number() OVER o AS k,
  sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_,
  sum(weight) OVER () - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS open_w
 FROM weighed WINDOW o AS (ORDER BY cap / weight, rank)),
first_ AS (SELECT k AS at_k, left_ AS at_left, open_w AS at_open FROM open_ WHERE left_ * weight <= cap * open_w ORDER BY k LIMIT 1),
targets AS (
 SELECT source, source_size, rank, CASE WHEN k < at_k THEN cap::DOUBLE ELSE (at_left * weight)::DOUBLE / at_open END AS target
 FROM open_, first_),
chunks AS (SELECT greatest(1, count(*) // 10000) AS c FROM sized),
placed AS (
 SELECT d.doc_id, d.row, d.size, t.source_size, t.rank, t.target,
  coalesce(sum(d.size) OVER (PARTITION BY t.rank ORDER BY (coalesce(d.doc_id, 0) % 2147483647) * 48271 % c, d.doc_id, d.row
   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
 FROM rows_ d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source, chunks),
sources AS (
 SELECT rank, ceil(source_size / 32)::BIGINT AS blocks, target * ceil(source_size / 32)::BIGINT / source_size AS wanted
 FROM targets WHERE source_size > 0),
parts AS (
 SELECT *, sum(wanted) OVER () AS total, sum(wanted) OVER (ORDER BY rank ROWS UNBOUNDED PRECEDING) AS upto FROM sources),
bounds AS (
 SELECT rank, blocks, least(upto / total, 1.0::DOUBLE) AS high, greatest((upto - wanted) / total, 0.0::DOUBLE) AS low,
  ceil(total)::BIGINT AS all_slots FROM parts WHERE wanted > 0),
shards AS (
 SELECT *, unnest(range(0, (all_slots - 1) // 65536 + 1)) AS shard FROM bounds),
slots AS (SELECT *, least(65536, all_slots - shard * 65536) AS n FROM shards),
ends AS (
 SELECT *, floor(high * n)::BIGINT AS ah, floor(low * n)::BIGINT AS al FROM slots),
drawn AS (
 SELECT rank, blocks, shard,
  least(n, ah + CASE WHEN (ah + ((shard * 69621 + ah + 1) % 2147483647 * 48271 % 2147483647) / 2147483647.0::DOUBLE) / n < high THEN 1 ELSE 0 END)
  - least(n, al + CASE WHEN (al + ((shard * 69621 + al + 1) % 2147483647 * 48271 % 2147483647) / 2147483647.0::DOUBLE) / n < low THEN 1 ELSE 0 END) AS cnt
 FROM ends),
taken_slots AS (
 SELECT rank, blocks, least(sum(cnt)::BIGINT, 3 * blocks) AS slots FROM drawn GROUP BY rank, blocks),
mapped AS (
 SELECT rank, blocks, unnest(range(0, slots)) AS slot FROM taken_slots),
times AS (
 SELECT rank, ((slot % blocks) * CASE WHEN blocks % 1000003 <> 0 THEN 1000003 ELSE 999983 END
   + (slot // blocks + 1) * 40503 + rank * 65599) % blocks AS block, count(*) AS times
 FROM mapped GROUP BY ALL),
cut AS (
 SELECT *, unnest(CASE WHEN size > 0 THEN range(start // 32, (start + size - 1) // 32 + 1) ELSE [-1] END) AS block FROM placed),
taken AS (
 SELECT c.*, CASE WHEN c.block >= 0 THEN
   (least(start + size, (c.block + 1) * 32) - greatest(start, c.block * 32)) * coalesce(times, 0) ELSE 0 END AS words
 FROM cut c LEFT JOIN times t ON c.rank = t.rank AND c.block = t.block)
SELECT doc_id, size, source_size, target, sum(words)::BIGINT AS taken
FROM taken GROUP BY doc_id, rank, row, size, source_size, target
"""

# crc32 of a number's decimal digits, byte by byte and bit by bit.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
  list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
  lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
   lambda x, bit: xor(x >> 1, 3988292384 * (x & 1)))))"""

OP12 = f"""
WITH t AS (
 SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
  [coalesce(role, ''), coalesce(text, '')] AS said
 FROM conversations WHERE conv_id IS NOT NULL),
c AS (
 SELECT conv_id, {_CRC} % 6 AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
 SELECT c.conv_id, 0 AS own, t.pos, t.said FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 AND t.pos <= c.h
 UNION ALL SELECT c.conv_id, 1, t.pos, t.said FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h),
s AS (
 SELECT c.conv_id, coalesce(list(r.said ORDER BY own, pos) FILTER (pos IS NOT NULL), []) AS said
 FROM c LEFT JOIN r USING (conv_id) GROUP BY c.conv_id),
p AS (
 SELECT conv_id, said, unnest(range(0, len(said) + 1)) AS depth FROM s),
m AS (
 SELECT said[:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
  sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(said) = depth), '')) AS ends_sha256
 FROM p GROUP BY ALL),
n AS (
 SELECT *, CASE WHEN depth > 0 THEN path[:depth - 1] END AS above,
  CASE WHEN depth > 0 THEN (n_convs - 1) * length(path[depth][2]) ELSE 0 END AS saved FROM m),
k AS (SELECT above, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY above),
f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k ON n.path = k.above),
e AS (SELECT path, saved, n_children, unnest(range(0, depth + 1)) AS upto FROM f),
u AS (
 SELECT path[:upto] AS path, sum(saved)::BIGINT AS saved_tokens, count_if(n_children = 0) AS n_leaves FROM e GROUP BY ALL)
SELECT f.conv_id, f.depth, b.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens, f.ends_sha256
FROM f JOIN u ON f.path = u.path LEFT JOIN f b ON f.above = b.path
"""

OP13 = """
WITH v AS (
 SELECT coalesce(vec_id, -9223372036854775808) AS vec_id, row_number() OVER () AS row,
  CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec
 FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
 SELECT q.vec_id AS anchor_id, q.row AS anchor, q.label = c.label AS same, c.vec_id, c.row,
  list_dot_product(q.vec, c.vec)::BIGINT AS score
 FROM v q JOIN v c ON q.row <> c.row WHERE q.vec_id % 50 = 0),
p AS (
 SELECT * FROM s WHERE same
 QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, row) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
 row_number() OVER (PARTITION BY p.anchor, p.row ORDER BY s.score DESC, s.vec_id, s.row)::INT AS rank
FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
QUALIFY rank <= 3
"""

ORACLES = {
    "op2_top_products": OP2,
    "op6_exact_dedup": OP6,
    "op8_url_filters": OP8,
    "op9_mixing": OP9,
    "op12_prefix_trie": OP12,
    "op13_hard_negatives": OP13,
}
