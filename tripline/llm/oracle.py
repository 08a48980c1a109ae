"""The operators' queries in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = (
    "regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS l, array_to_string(w[i:i + 12], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)
),
g AS (
  SELECT doc_id, i, l, array_to_string(w[i:i + l - 1], ' ') AS g
  FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS i
        FROM d, (SELECT DISTINCT l FROM win) WHERE len(w) >= l)
),
m AS (SELECT g.doc_id, g.i, g.l, win.item_id FROM g JOIN win USING (l, g)),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM m) GROUP BY doc_id
),
it AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""

SOURCE_MIX = r"""
WITH l AS (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id),
d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    -ln((CAST(CAST('0x' || substr(md5('mix|' || CAST(doc_id AS VARCHAR)), 1, 13) AS BIGINT) AS DOUBLE) + 0.5)
      / 4503599627370496.0) / CASE quality WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 ELSE 1.0 END AS draw,
    CAST(doc_id AS VARCHAR) AS tie
  FROM documents LEFT JOIN l USING (doc_id)
),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (
  SELECT *, [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT) + 1] AS w,
    2 * source_size AS most FROM s
),
v AS (
  SELECT *, (1.5 * CAST(sum(source_size) OVER () AS DOUBLE) - CAST(coalesce(sum(most) OVER before, 0) AS DOUBLE))
    / CAST(sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS DOUBLE) AS level
  FROM r WINDOW before AS (ORDER BY CAST(most AS DOUBLE) / w, source NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
t AS (
  SELECT source, source_size, least(CAST(most AS DOUBLE), max(level) OVER () * w) AS target FROM v
),
e AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM t
),
p AS (
  SELECT d.doc_id, d.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY draw, tie ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source
)
SELECT doc_id, size, source_size, target,
  CAST(size * (epochs + CASE WHEN upto <= rest
    OR (upto - size < rest AND upto - rest <= rest - (upto - size)) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM p
"""

WARC_RECORDS = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
),
d AS (SELECT page_id, octet_length(payload) AS size, sha1(payload) AS digest FROM p),
m AS (
  SELECT *, CASE WHEN size >= 1000 THEN max(page_id) OVER (PARTITION BY digest) ELSE page_id END AS most FROM d
)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN most = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN most <> page_id THEN most END AS refers_to
FROM m
"""

EMBEDDING_COMPONENTS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
link AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
    AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.93
),
reach(x, y) AS (SELECT x, y FROM link UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x),
n AS (SELECT x, count(*) AS n_links FROM link GROUP BY x),
c AS (SELECT x, min(y) AS least FROM reach GROUP BY x)
SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(least, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(least, vec_id)) AS kept
FROM embeddings LEFT JOIN n ON vec_id = n.x LEFT JOIN c ON vec_id = c.x
"""

def _vector_codes(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Lloyd's rounds, each one common table of assignments and one of moved entries."""
    steps = [
        f"""WITH v AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS MATERIALIZED (
  SELECT vec_id, p, list_slice(e, p * len(e) // {parts} + 1, (p + 1) * len(e) // {parts}) AS e
  FROM (SELECT vec_id, e, unnest(range({parts})) AS p FROM v)
),
b0 AS MATERIALIZED (
  SELECT p, CAST(row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS BIGINT) AS k, e
  FROM s WHERE vec_id IN (SELECT vec_id FROM v ORDER BY vec_id LIMIT {entries})
)"""
    ]
    for n in range(rounds + 1):
        steps.append(
            f"""a{n} AS MATERIALIZED (
  SELECT vec_id, p, min(d * 256 + k) AS dk FROM (
    SELECT s.vec_id, s.p, b.k, CAST(list_dot_product(s.e, s.e) - 2 * list_dot_product(s.e, b.e)
      + list_dot_product(b.e, b.e) AS BIGINT) AS d
    FROM s JOIN b{n} b ON s.p = b.p
  ) GROUP BY vec_id, p
)"""
        )
        if n < rounds:
            steps.append(
                f"""b{n + 1} AS MATERIALIZED (
  SELECT b.p, b.k, coalesce(m.e, b.e) AS e FROM b{n} b LEFT JOIN (
    SELECT p, k, list(floor(t / c) ORDER BY i) AS e FROM (
      SELECT s.p, a.dk % 256 AS k, i, sum(s.e[i]) AS t, count(*) AS c
      FROM (SELECT vec_id, p, e, unnest(range(1, len(e) + 1)) AS i FROM s) s JOIN a{n} a USING (vec_id, p)
      GROUP BY s.p, a.dk % 256, i
    ) GROUP BY p, k
  ) m ON b.p = m.p AND b.k = m.k
)"""
            )
    last = f"""c AS (
  SELECT vec_id, string_agg(printf('%02x', CAST(dk % 256 AS INT)), '' ORDER BY p) AS code, CAST(sum(dk // 256) AS BIGINT) AS error
  FROM a{rounds} GROUP BY vec_id
),
h AS (
  SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY p, k, i)) AS codebooks_sha256
  FROM (SELECT p, k, unnest(range(1, len(e) + 1)) AS i, unnest(e) AS x FROM b{rounds})
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM v JOIN c USING (vec_id), h
"""
    return ",\n".join([*steps, last])


FILTER_AUDIT = r"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY text) AS least FROM t),
l AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS bad,
    CASE WHEN len(w) < 50 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > least THEN 'E' ELSE '' END AS fails
  FROM w LEFT JOIN l USING (doc_id)
),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
  WHERE a.x NOT IN (b.x, c.x, d.x, e.x) AND b.x NOT IN (c.x, d.x, e.x) AND c.x NOT IN (d.x, e.x) AND d.x <> e.x
),
s AS (SELECT filter_order, step, filter_order[step] AS own FROM (SELECT filter_order, CAST(unnest(range(1, 6)) AS INT) AS step FROM o)),
g AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (bad) AS bad FROM f GROUP BY ALL),
r AS (
  SELECT part, filter_order, step, own, n, good, bad, fails,
    coalesce((SELECT 1 WHERE translate(left(filter_order, step - 1), fails, '') <> left(filter_order, step - 1)), 0) = 1 AS gone,
    contains(fails, own) AS failing
  FROM g, s
),
q AS (
  SELECT part, filter_order, step, own,
    coalesce(sum(n) FILTER (NOT gone AND NOT failing), 0) AS kept,
    coalesce(sum(n) FILTER (NOT gone AND failing), 0) AS removed,
    coalesce(sum(n) FILTER (gone AND failing), 0) AS redundant,
    coalesce(sum(n) FILTER (fails = own), 0) AS unique_fails,
    coalesce(sum(good) FILTER (NOT gone AND failing), 0) AS good_lost,
    coalesce(sum(bad) FILTER (NOT gone AND failing), 0) AS toxic_lost
  FROM r GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM q
"""

_DRAW = (
    "-ln((CAST(CAST('0x' || substr(md5({}), 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0)"
)

#: The tree is the query's: shard s of rack s // 5 % 4 of region s // 20, all alike; one more in a region of its own.
HASH_SHARDS = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce('=' || CAST(doc_id AS VARCHAR), 'null') AS name,
    CAST(coalesce(octet_length(encode(text)), 0) + 16 AS BIGINT) AS size, hex(encode(coalesce(text, ''))) AS hex
  FROM documents
),
bits(b, i, c) AS (
  SELECT unnest(range(256)), 0, unnest(range(256))
  UNION ALL SELECT b, i + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE i < 8
),
crc AS (SELECT list(c ORDER BY b) AS crc FROM bits WHERE i = 8),
t AS (
  SELECT id, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex, '..'),
    lambda x: CAST('0x' || x AS BIGINT))), lambda a, x: xor(a >> 8, crc[(xor(a, x) & 255) + 1]))) AS text_crc32
  FROM d, crc
),
leaf AS (
  SELECT s AS shard, CASE WHEN s < 40 THEN 'region' || (s // 20) ELSE 'added40' END AS region,
    CASE WHEN s < 40 THEN 'rack' || (s // 5 % 4) ELSE 'rack0' END AS rack
  FROM (SELECT CAST(unnest(range(41)) AS INT) AS s)
),
region AS (SELECT region, CAST(count(*) AS DOUBLE) AS w FROM leaf GROUP BY region),
rack AS (SELECT region, rack, CAST(count(*) AS DOUBLE) AS w FROM leaf GROUP BY region, rack),
grows AS (SELECT unnest([false, true]) AS g),
r AS (
  SELECT id, name, g, arg_min(region, {_DRAW.format("'shard|' || region || '|' || name")} / w) AS region
  FROM d, region, grows WHERE g OR region <> 'added40' GROUP BY id, name, g
),
k AS (
  SELECT id, name, g, region, arg_min(rack, {_DRAW.format("'shard|' || region || '/' || rack || '|' || name")} / w) AS rack
  FROM r JOIN rack USING (region) GROUP BY id, name, g, region
),
s AS (
  SELECT id, g, arg_min(shard, {_DRAW.format("'shard|' || region || '/' || rack || '/' || shard || '|' || name")}) AS shard
  FROM k JOIN leaf USING (region, rack) GROUP BY id, g
),
p AS (
  SELECT doc_id, size, text_crc32, a.shard, z.shard AS grown_shard,
    'slot|' || name || '|=' || size || '|=' || text_crc32 || '|=' || a.shard || '|=' || z.shard AS place
  FROM d JOIN t USING (id) JOIN s a ON a.id = d.id AND NOT a.g JOIN s z ON z.id = d.id AND z.g
)
SELECT doc_id, size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'key' AS law, shard,
  CAST(row_number() OVER (PARTITION BY shard ORDER BY substr(md5(place), 1, 13), doc_id NULLS FIRST, size, text_crc32) - 1 AS BIGINT) AS slot,
  grown_shard
FROM p
"""

ORACLE: dict[str, str] = {
    "op4_warc_records": WARC_RECORDS,
    "op5_decontamination": DECONTAMINATION,
    "op6_source_mix": SOURCE_MIX,
    "op8_embedding_components": EMBEDDING_COMPONENTS,
    "op11_vector_codes": _vector_codes(),
    "op12_filter_audit": FILTER_AUDIT,
    "op13_hash_shards": HASH_SHARDS,
}
