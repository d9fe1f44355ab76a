"""DuckDB SQL for the text queries that SQL can express; limits are written out, not shared."""

SOURCE_MIXING = r"""
WITH d AS (
  SELECT doc_id, source,
    len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t-\r]+'), lambda x: x <> ''))::BIGINT AS size
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, 3 * source_size AS cap,
    (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS kind, sum(source_size) OVER () AS total FROM s
), r AS (
  SELECT *, kind + 1 AS weight,
    total - coalesce(sum(cap) OVER (ORDER BY cap / (kind + 1), source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    sum(kind + 1) OVER (ORDER BY cap / (kind + 1), source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM w
), f AS (
  SELECT *, cap / weight <= rest / weights AS fits FROM r
), t AS (
  SELECT f.source, f.source_size, f.kind,
    CASE WHEN f.fits THEN f.cap::DOUBLE ELSE l.rest * f.weight / l.weights END AS target
  FROM f LEFT JOIN (SELECT rest, weights FROM f WHERE NOT fits ORDER BY cap / weight, source NULLS LAST LIMIT 1) l ON true
), p AS (
  SELECT d.*, t.source_size, t.kind, t.target,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(d.doc_id::VARCHAR), d.doc_id, d.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), k AS (
  SELECT *, CASE WHEN source_size > 0 THEN (floor(target)::BIGINT // source_size) * size
    + greatest(least(floor(target)::BIGINT % source_size - before, size), 0) ELSE 0 END AS taken,
    [1.5, 1.0, 0.5][kind + 1]::DOUBLE AS a, [0.5, 1.0, 1.5][kind + 1]::DOUBLE AS b
  FROM p
)
SELECT doc_id, size, source_size, target, taken::BIGINT AS taken,
  CASE WHEN taken > 0 THEN least(2 * (before / target) / (a + sqrt(a * a + 2 * (b - a) * (before / target))), 1.0::DOUBLE) END AS first_position
FROM k
"""

LINE_DEDUP = r"""
WITH l AS (
  SELECT doc_id, source, rn, pos, line, trim(line, E' \t\n\x0b\x0c\r') AS body
  FROM (SELECT doc_id, source, rn, unnest(lines) AS line, unnest(range(len(lines))) AS pos
        FROM (SELECT doc_id, source, string_split(text, chr(10)) AS lines, row_number() OVER () AS rn FROM documents))
), b AS (
  SELECT body, min(doc_id) AS keeper FROM l WHERE body <> ''
  GROUP BY body HAVING count(DISTINCT source) + max(CASE WHEN source IS NULL THEN 1 ELSE 0 END) >= 8
), m AS (
  SELECT l.*, b.body IS NOT NULL AND l.doc_id IS DISTINCT FROM b.keeper AS bad FROM l LEFT JOIN b ON l.body = b.body
)
SELECT doc_id, count(*) FILTER (WHERE body <> '')::BIGINT AS n_lines, count(*) FILTER (WHERE bad)::BIGINT AS n_removed,
  coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT bad), '') AS text
FROM m GROUP BY rn, doc_id
"""

QUALITY_RULES = r"""
WITH d AS (
  SELECT row_number() OVER () AS rn, doc_id, lang, source, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t-\r]+'), lambda x: x <> '') AS w
  FROM documents
), g AS (
  SELECT rn, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram
  FROM (SELECT rn, w, unnest(range(1, len(w) - 1)) AS i FROM d)
), rep AS (
  SELECT rn, count(DISTINCT p) AS n FROM (
    SELECT rn, unnest([i, i + 1, i + 2]) AS p
    FROM (SELECT rn, i, count(*) OVER (PARTITION BY rn, gram) AS c FROM g) WHERE c > 1)
  GROUP BY rn
), m AS (
  SELECT d.rn, doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \t-\r]')) AS lines,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN rep USING (rn)
), f AS (
  SELECT *, len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM m
), v AS (
  SELECT rn, lang, source, unnest([
      {m: 'symbols', x: n_symbols * 1000 // n_words, least: 20},
      {m: 'repeats', x: n_repeat_words * 1000 // n_words, least: 100},
      {m: 'dup_lines', x: n_dup_lines * 1000 // greatest(n_lines, 1), least: 100},
      {m: 'word_length', x: word_chars * 1000 // n_words, least: 300}], recursive := true)
  FROM f WHERE NOT base_failed
), n AS (
  SELECT *, (x >> greatest(length(bin(x)) - 6, 0)::INT) << greatest(length(bin(x)) - 6, 0)::INT AS cell FROM v
), a AS (
  SELECT 2 AS level, lang, source, m, least, cell FROM n UNION ALL
  SELECT 1, lang, NULL, m, least, cell FROM n UNION ALL
  SELECT 0, NULL, NULL, m, least, cell FROM n
), o AS (
  SELECT level, lang, source, m, least, cell,
    row_number() OVER (PARTITION BY level, lang, source, m ORDER BY cell) AS k,
    count(*) OVER (PARTITION BY level, lang, source, m) AS total
  FROM a
), q AS (
  SELECT level, lang, source, m, max(total) AS total, max(least) AS least,
    min(cell) FILTER (WHERE 4 * k >= total) AS q1, min(cell) FILTER (WHERE 4 * k >= 3 * total) AS q3
  FROM o GROUP BY level, lang, source, m
), b AS (
  SELECT level, lang, source, m, total, q1 - 4 * greatest(q3 - q1, least) AS low, q3 + 4 * greatest(q3 - q1, least) AS high FROM q
), j AS (
  SELECT v.rn, v.m, bool_and(v.x BETWEEN b.low AND b.high) FILTER (WHERE true) AS inside, b.level
  FROM v JOIN b ON v.m = b.m AND (b.level = 0 OR b.total >= 50)
    AND (b.level = 0 OR v.lang IS NOT DISTINCT FROM b.lang) AND (b.level < 2 OR v.source IS NOT DISTINCT FROM b.source)
  GROUP BY v.rn, v.m, b.level
), e AS (
  SELECT rn, bool_and(inside) AS inside FROM (SELECT rn, m, arg_max(inside, level) AS inside FROM j GROUP BY rn, m) GROUP BY rn
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(e.inside, false) AS kept
FROM f LEFT JOIN e USING (rn)
"""

NGRAM_JOIN = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rn, doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t-\r]+'), lambda x: x <> '') AS w
  FROM documents
), g AS (
  SELECT DISTINCT rn, [w[i], w[i + 1], w[i + 2]] AS gram
  FROM (SELECT rn, w, unnest(range(1, greatest(len(w) - 1, least(len(w), 1) + 1))) AS i FROM d)
), n AS (
  SELECT rn, count(*) AS n FROM g GROUP BY rn
), l AS (
  SELECT x.rn AS a, y.rn AS b
  FROM g x JOIN g y ON x.gram = y.gram AND x.rn <> y.rn JOIN n nx ON nx.rn = x.rn JOIN n ny ON ny.rn = y.rn
  GROUP BY x.rn, y.rn, nx.n, ny.n HAVING 100 * count(*) >= 90 * (nx.n + ny.n - count(*))
), reach AS (
  SELECT DISTINCT a, a AS b FROM l UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a
), c AS (
  SELECT reach.a, min(d.doc_id) AS low FROM reach JOIN d ON d.rn = reach.b GROUP BY reach.a
)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, CASE WHEN c.a IS NULL THEN doc_id ELSE c.low END AS component_id
FROM d LEFT JOIN n USING (rn) LEFT JOIN c ON c.a = d.rn
"""

IMPORTANCE = r"""
WITH texts AS (
  SELECT 'd' AS kind, row_number() OVER () AS rn, doc_id, text FROM documents
  UNION ALL SELECT 't', row_number() OVER (), NULL, text FROM benchmark
), words AS (
  SELECT kind, rn, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM texts
), runs AS (
  SELECT kind, rn, array_to_string(w[i:i + k], ' ') AS f
  FROM (SELECT kind, rn, w, k, unnest(range(1, len(w) + 1 - k)) AS i FROM words, (VALUES (0), (1), (2)) AS sizes(k))
), step AS (
  SELECT list_transform(range(256), lambda n: list_reduce(range(8),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS t
), crc AS (
  SELECT f, xor(4294967295, list_reduce(list_transform(range(len(h) // 2), lambda i: ('0x' || h[2 * i + 1:2 * i + 2])::BIGINT),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295)) % 10000 AS bucket
  FROM (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM runs)), step
), hashed AS (
  SELECT kind, rn, bucket FROM runs JOIN crc USING (f)
), gain AS (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (all_s + 10000)::DOUBLE) / ((s + 1)::DOUBLE * (all_t + 10000)::DOUBLE)))::BIGINT AS gain
  FROM (SELECT b.bucket, count(*) FILTER (WHERE kind = 'd') AS s, count(*) FILTER (WHERE kind = 't') AS t
        FROM range(10000) AS b(bucket) LEFT JOIN hashed USING (bucket) GROUP BY b.bucket),
    (SELECT count(*) FILTER (WHERE kind = 'd') AS all_s, count(*) FILTER (WHERE kind = 't') AS all_t FROM hashed)
), weights AS (
  SELECT rn, count(*)::BIGINT AS n_features, sum(gain)::BIGINT AS weight FROM hashed JOIN gain USING (bucket) WHERE kind = 'd' GROUP BY rn
), scores AS (
  SELECT doc_id, len(w) AS n, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('42:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score
  FROM words LEFT JOIN weights USING (rn) WHERE kind = 'd'
), places AS (
  SELECT *, CASE WHEN n >= 20 THEN row_number() OVER (PARTITION BY n >= 20 ORDER BY score DESC, doc_id) END AS place FROM scores
)
SELECT doc_id, n_features, weight, score,
  CASE WHEN place <= 5 * (SELECT count(*) FROM scores WHERE n >= 20) // 100 THEN place END AS rank
FROM places
"""


def _centroids(clusters: int = 8, rounds: int = 10) -> str:
    """The rounds are written out one after another; integers are wide, as nothing bounds their sums."""
    far = "row_number() OVER (PARTITION BY rn ORDER BY distance, cluster)"
    parts = ["""
WITH kept AS (
  SELECT row_number() OVER () AS rn, vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), v AS MATERIALIZED (
  SELECT rn, vec_id, unnest(range(64)) AS place, floor(1024 * unnest(embedding)::DOUBLE)::BIGINT AS x FROM kept
), starts AS (
  SELECT rn, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS cluster FROM kept
), c0 AS MATERIALIZED (
  SELECT cluster, place, x AS y FROM starts JOIN v USING (rn) WHERE cluster < """ + str(clusters) + "\n)"]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT rn, cluster, distance FROM (
    SELECT *, {far} AS near FROM (
      SELECT rn, cluster, sum((x - y) * (x - y)) AS distance FROM v JOIN c{i} USING (place) GROUP BY rn, cluster))
  WHERE near = 1
)""")
        if i < rounds:
            parts.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT cluster, place, CASE WHEN n IS NULL THEN y ELSE (s - ((s % n) + n) % n) // n END AS y
  FROM c{i} LEFT JOIN (SELECT cluster, place, sum(x) AS s, count(*) AS n FROM a{i} JOIN v USING (rn) GROUP BY cluster, place)
    USING (cluster, place)
)""")
    last = f"""
SELECT vec_id, a.cluster::INTEGER AS cluster, distance::BIGINT AS distance, (sum(distance) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia,
  (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{rounds} a JOIN kept USING (rn)
JOIN (SELECT cluster, sha256(string_agg(y::BIGINT::VARCHAR, ',' ORDER BY place)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster) h
  ON h.cluster = a.cluster
"""
    return ",\n".join(parts) + last


CENTROIDS = _centroids()
