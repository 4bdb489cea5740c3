"""DuckDB SQL with the same results as the registered queries, where SQL can express them."""

from __future__ import annotations

OP8 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
           FROM documents),
r AS (SELECT *, row_number() OVER w AS place, first_value(doc_id) OVER w AS keep_id,
             count(*) OVER (PARTITION BY content) AS group_size
      FROM d WINDOW w AS (PARTITION BY content ORDER BY length(t) DESC, doc_id))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(content) AS text_sha256 FROM r
"""

OP4 = r"""
WITH d AS (SELECT doc_id, source,
                  CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
           FROM documents),
q AS (SELECT doc_id, max(quality) AS quality FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
k AS (SELECT d.*, -ln((CAST(CAST('0x' || substr(md5(coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 13) AS BIGINT)
                            AS DOUBLE) + 0.5) / 4503599627370496.0)
                  / CASE quality WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 ELSE 1.0 END AS draw
      FROM d LEFT JOIN q ON d.doc_id = q.doc_id),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS rate FROM s),
l AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5
                 - coalesce(CAST(sum(2 * source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS DOUBLE), 0))
                / CAST(sum(rate) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
      FROM r WINDOW w AS (ORDER BY 2 * source_size / CAST(rate AS DOUBLE), source NULLS LAST)),
f AS (SELECT arg_min(level, 2 * source_size / CAST(rate AS DOUBLE)) AS level FROM l
      WHERE level * rate <= 2 * source_size),
t AS (SELECT source, source_size, least(coalesce((SELECT level FROM f) * rate, 2.0 * source_size),
                                        CAST(2 * source_size AS DOUBLE)) AS target FROM r),
e AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM t),
p AS (SELECT k.*, source_size, target, epochs,
             CAST(sum(size) OVER (PARTITION BY k.source ORDER BY draw, k.doc_id
                                  ROWS UNBOUNDED PRECEDING) AS DOUBLE) - size / 2.0 AS reach
      FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
       size * (epochs + CASE WHEN reach <= target - epochs * source_size THEN 1 ELSE 0 END) AS taken FROM p
"""

OP7 = r"""
WITH d AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS parts FROM documents),
l AS (SELECT doc_id, source, length(text) AS total, unnest(parts) AS line,
             generate_subscripts(parts, 1) AS place FROM d WHERE text IS NOT NULL),
b AS (SELECT *, lower(trim(line, E' \t\r\x0b\x0c')) AS bare FROM l),
shared AS (SELECT bare FROM b WHERE bare <> '' GROUP BY bare HAVING count(DISTINCT source) >= 12),
cut AS (SELECT doc_id, list(place) AS places FROM b WHERE bare IN (SELECT bare FROM shared)
        GROUP BY doc_id HAVING sum(length(line)) <= 0.5 * any_value(total)),
r AS (SELECT doc_id, coalesce(len(parts), 0) AS n_lines, coalesce(len(places), 0) AS n_removed,
             CASE WHEN places IS NULL THEN text ELSE array_to_string(
                 [parts[i] FOR i IN range(1, len(parts) + 1) IF NOT list_contains(places, i)],
                 chr(10)) END AS kept
      FROM d LEFT JOIN cut USING (doc_id))
SELECT doc_id, n_lines, n_removed, length(kept) AS kept_chars, sha256(kept) AS kept_sha256 FROM r
"""

OP11 = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
           FROM documents),
t AS (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM t GROUP BY ALL HAVING count(DISTINCT id) >= 3),
l AS (SELECT *, 1 + 1000000000::HUGEINT * (total + 1) // (sum(total) OVER w + count(*) OVER w) AS q
      FROM k WINDOW w AS (PARTITION BY lang)),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL),
n AS (SELECT g.lang, g.source, l.term, l.q, coalesce(c.n, 0) AS n
      FROM g JOIN l ON g.lang = l.lang
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = l.term),
p AS (SELECT *, 1 + 1000000000::HUGEINT * (n + 1) // (sum(n) OVER w + count(*) OVER w) AS p
      FROM n WINDOW w AS (PARTITION BY lang, source)),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
v AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
      UNION ALL
      SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM v QUALIFY part = 'pair' OR rank <= 200
"""


def _clusters(rounds: int) -> str:
    """Assignments and moved centroids of each round, one after the other."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
    SELECT vec_id, id, point, cluster, distance FROM (
        SELECT v.*, c.cluster, CAST(list_sum(list_transform(list_zip(v.point, c.point),
                   lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS distance FROM v, c{r} c)
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY distance, cluster) = 1)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
    SELECT c.cluster, coalesce(m.point, c.point) AS point FROM c{r} c LEFT JOIN (
        SELECT cluster, list((s - (s % n + n) % n) // n ORDER BY i) AS point FROM (
            SELECT cluster, i, sum(point[i]) AS s, count(*) AS n
            FROM a{r}, range(1, 65) dims(i) GROUP BY ALL) GROUP BY cluster) m USING (cluster))""")
    return ",\n".join(steps)


OP13 = f"""
WITH v AS MATERIALIZED (
    SELECT vec_id, row_number() OVER () AS id,
           list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 64) AS BIGINT)) AS point
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY place NULLS LAST, point) - 1 AS cluster, point
    FROM (SELECT *, sha256('1:' || CAST(vec_id AS VARCHAR)) AS place FROM v)
    QUALIFY cluster < 16),
{_clusters(3)}
SELECT vec_id, CAST(a.cluster AS INTEGER) AS cluster, distance,
       CAST(sum(distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.point, ',')) AS centroid_sha256
FROM a3 a JOIN c3 c ON a.cluster = c.cluster
"""

OP5 = """
WITH RECURSIVE u AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
n AS (SELECT *, sqrt(list_dot_product(v, v)) AS norm FROM u),
p AS MATERIALIZED (
    SELECT a.vec_id AS a, b.vec_id AS b
    FROM n a JOIN n b ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
    WHERE CASE WHEN len(a.v) = len(b.v) THEN list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.93 END),
r(vec_id, low) AS (
    SELECT vec_id, vec_id FROM embeddings
    UNION SELECT p.a, r.low FROM r JOIN p ON p.b = r.vec_id WHERE r.low < p.a),
c AS (SELECT vec_id, min(low) AS component_id FROM r GROUP BY vec_id),
k AS (SELECT a AS vec_id, count(*) AS n FROM p GROUP BY a)
SELECT e.vec_id, coalesce(k.n, 0) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN c USING (vec_id) LEFT JOIN k USING (vec_id)
"""

OP9 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
u AS (SELECT doc_id, len(words) AS n, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM d),
x AS (SELECT doc_id, n, word, i, md5(string_agg(word, ' ') OVER (
                 PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)) AS passage
      FROM u),
f AS (SELECT passage, min(doc_id) AS first FROM x WHERE i <= n - 49 GROUP BY passage),
m AS (SELECT x.*, coalesce(x.i <= x.n - 49 AND f.first < x.doc_id, FALSE) AS opens
      FROM x LEFT JOIN f ON f.passage = x.passage),
g AS (SELECT *, bool_or(opens) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
      FROM m),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n_kept FROM g WHERE NOT gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""

LLM_ORACLES = {
    "op4_mixing": OP4,
    "op5_embedding_dedup": OP5,
    "op7_line_dedup": OP7,
    "op8_exact_dedup": OP8,
    "op9_substring_dedup": OP9,
    "op11_divergence_audit": OP11,
    "op13_centroid_clustering": OP13,
}
