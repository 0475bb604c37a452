"""DuckDB SQL for the queries that SQL can express."""

OP8 = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), bw AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), win AS (
  SELECT DISTINCT item, least(len(w), 10) AS size, array_to_string(w[p : p + least(len(w), 10) - 1], ' ') AS phrase
  FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p FROM bw WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM win
), spots AS (
  SELECT doc_id, size, p, array_to_string(w[p : p + size - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM dw, sizes WHERE len(w) >= size)
), hits AS (SELECT doc_id, p, win.size, item FROM spots JOIN win USING (size, phrase)
), covered AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + size)) AS q FROM hits) GROUP BY 1
), found AS (
  SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hits GROUP BY 1
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

OP2 = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS mix
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM sized GROUP BY source
), weighed AS (
  SELECT *, CASE rank % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight, 2 * source_size AS cap FROM sources
), levels AS (
  SELECT *, ((SELECT sum(source_size) FROM weighed) * CAST(1.5 AS DOUBLE)
             - coalesce(sum(cap) OVER (ORDER BY CAST(cap AS DOUBLE) / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY CAST(cap AS DOUBLE) / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed
), goals AS (
  SELECT *, least(CAST(cap AS DOUBLE), coalesce((SELECT level FROM levels WHERE cap >= level * weight
                                 ORDER BY CAST(cap AS DOUBLE) / weight, rank LIMIT 1) * weight, CAST(cap AS DOUBLE))) AS target
  FROM levels
), placed AS (
  SELECT doc_id, size, source_size, target, CAST(floor(target) AS BIGINT) AS most, rank,
         sum(size) OVER (PARTITION BY rank ORDER BY mix, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS ahead
  FROM sized JOIN goals ON sized.source IS NOT DISTINCT FROM goals.source
), parts AS (
  SELECT *, greatest(0, least(ahead + size, most) - ahead) AS once,
         greatest(0, least(source_size + ahead + size, most) - source_size - ahead) AS twice,
         CASE rank % 3 WHEN 0 THEN 1.5::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END AS s,
         CASE rank % 3 WHEN 0 THEN 0.5::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 1.5::DOUBLE END AS e
  FROM placed
), shares AS (
  SELECT *, (ahead + CAST(once AS DOUBLE) / 2) / most AS u1, (source_size + ahead + CAST(twice AS DOUBLE) / 2) / most AS u2 FROM parts
)
SELECT doc_id, size, source_size, target, CAST(once + twice AS BIGINT) AS taken,
       list_filter([CASE WHEN once > 0 THEN u1 * (s + e) / (s + sqrt(s * s + (e * e - s * s) * u1)) END,
                    CASE WHEN twice > 0 THEN u2 * (s + e) / (s + sqrt(s * s + (e * e - s * s) * u2)) END],
                   lambda p: p IS NOT NULL) AS positions
FROM shares
"""

OP4 = """
WITH sound AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM sound q JOIN sound c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
"""

OP7 = r"""
WITH cut AS (SELECT doc_id, text, md5(text) AS print, string_split(text, chr(10)) AS parts FROM documents
), numbered AS (
  SELECT doc_id, text, print, parts,
         list_filter(list_transform(parts, lambda l, i: {'pos': i - 1, 'line': trim(l, ' ' || chr(9) || chr(13))}), lambda x: x.line <> '') AS lines
  FROM cut
), spots AS (
  SELECT doc_id, print, lines, unnest(range(1, greatest(len(lines) - 3, 0) + 2)) AS i FROM numbered WHERE len(lines) > 0
), wins AS (
  SELECT doc_id, print, lines[i].pos AS first, lines[least(i + 2, len(lines))].pos AS last,
         least(len(lines), 3) || chr(10) || array_to_string(list_transform(lines[i : i + 2], lambda x: x.line), chr(10)) AS content
  FROM spots
), ranked AS (
  SELECT *, dense_rank() OVER (PARTITION BY content ORDER BY doc_id NULLS LAST, print, first) AS nth FROM wins
), covered AS (
  SELECT DISTINCT doc_id, print, unnest(range(first, last + 1)) AS pos FROM ranked WHERE nth > 1
), gone AS (
  SELECT doc_id, print, list(pos) AS pos, count(*) AS n, count(*) FILTER (opens) AS n_spans
  FROM (SELECT *, pos - 1 IS DISTINCT FROM lag(pos) OVER (PARTITION BY doc_id, print ORDER BY pos) AS opens FROM covered) GROUP BY ALL
)
SELECT n.doc_id, CAST(coalesce(len(parts), 0) AS BIGINT) AS n_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       md5(CASE WHEN n IS NULL THEN text
                ELSE coalesce(array_to_string(list_filter(parts, lambda l, i: NOT list_contains(pos, i - 1)), chr(10)), '') END) AS kept_md5
FROM numbered n LEFT JOIN gone g ON n.doc_id IS NOT DISTINCT FROM g.doc_id AND n.print IS NOT DISTINCT FROM g.print
"""

OP11 = r"""
WITH cut AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm FROM documents
), placed AS (
  SELECT doc_id, norm, first_value(doc_id) OVER best AS keep_id, row_number() OVER best = 1 AS kept, count(*) OVER (PARTITION BY norm) AS group_size
  FROM cut WINDOW best AS (PARTITION BY norm ORDER BY chars DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size, kept, sha256(norm) AS text_sha256 FROM placed
"""


def _lloyd(rounds: int) -> str:
    """Whole vectors, the first centroids, and for each round the nearest centroids and the floors of the means."""
    nearest = """near{i} AS (
  SELECT nr, vec_id, v, arg_min(number, (distance, number)) AS cluster, min(distance) AS distance
  FROM (SELECT v.*, c.number, CAST(list_sum(list_transform(list_zip(v.v, c.c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS distance
        FROM vectors v CROSS JOIN c{i} c) GROUP BY ALL
)"""
    moved = """sums{i} AS (
  SELECT cluster, place, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
  FROM (SELECT cluster, unnest(v) AS x, unnest(range(1, 65)) AS place FROM near{i}) GROUP BY ALL
), means{i} AS (
  SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY place) AS c FROM sums{i} GROUP BY ALL
), c{j} AS (SELECT number, coalesce(m.c, c{i}.c) AS c FROM c{i} LEFT JOIN means{i} m ON m.cluster = number)"""
    steps = [part.format(i=i, j=i + 1) for i in range(rounds) for part in (nearest, moved)]
    return ",\n".join([*steps, nearest.format(i=rounds)])


OP12 = f"""
WITH vectors AS (
  SELECT row_number() OVER () AS nr, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
), c0 AS (
  SELECT CAST(row_number() OVER (ORDER BY hash, v) - 1 AS INTEGER) AS number, v AS c
  FROM (SELECT sha256('1:' || CAST(vec_id AS VARCHAR)) AS hash, v FROM vectors WHERE vec_id IS NOT NULL ORDER BY hash, v LIMIT 16)
), {_lloyd(3)}, totals AS (
  SELECT cluster, CAST(sum(distance) AS BIGINT) AS cluster_inertia, CAST(sum(sum(distance)) OVER () AS BIGINT) AS inertia FROM near3 GROUP BY cluster
)
SELECT vec_id, cluster, distance, cluster_inertia, inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM near3 JOIN totals USING (cluster) JOIN c3 ON number = cluster
"""

OP13 = r"""
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), drawn AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS u,
         list_transform([0, 1, 2, 3], lambda i: CAST('0x' || substr(h, CAST(1 + 8 * i AS BIGINT), 8) AS BIGINT)) AS d
  FROM hashed
), cut AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n, least(d[1] % (len(u) + 1), d[2] % (len(u) + 1)) AS a, greatest(d[1] % (len(u) + 1), d[2] % (len(u) + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR d[3] % 100 >= 100 THEN 'plain'
              WHEN d[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), parts AS (
  SELECT *, array_to_string(u[1 : a], '') AS p, array_to_string(u[a + 1 : b], '') AS m, array_to_string(u[b + 1 : n], '') AS s FROM cut
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""

ORACLE_SQL = {
    "op2_mixing": OP2,
    "op4_topk": OP4,
    "op7_line_dedup": OP7,
    "op8_decontamination": OP8,
    "op11_exact_dedup": OP11,
    "op12_centroids": OP12,
    "op13_fill_in_middle": OP13,
}
