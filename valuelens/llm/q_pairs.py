"""Queries op5, op7 and op9: copies, repeats and neighbours."""

from __future__ import annotations

from valuelens.llm import embed_dup, near_dup, substrings
from valuelens.llm.tables import register, table


@register("op5_superminhash", r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rn, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT rn, doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS g FROM (SELECT rn, doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT rn, any_value(doc_id) AS doc_id, count(*) AS n FROM s GROUP BY rn),
pr AS (SELECT a.rn AS a, b.rn AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.rn < b.rn GROUP BY a.rn, b.rn),
link AS (SELECT DISTINCT x.doc_id AS a, y.doc_id AS b FROM pr JOIN n x ON x.rn = pr.a JOIN n y ON y.rn = pr.b
         WHERE 100 * c >= 80 * (x.n + y.n - c) AND x.doc_id IS NOT NULL AND y.doc_id IS NOT NULL AND x.doc_id <> y.doc_id),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT a AS v, a AS r FROM edge UNION SELECT reach.v, edge.b FROM reach JOIN edge ON edge.a = reach.r),
comp AS (SELECT v, min(r) AS c FROM reach GROUP BY v)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, CASE WHEN n.n IS NULL THEN d.doc_id ELSE coalesce(comp.c, d.doc_id) END AS component_id,
       coalesce(n.n IS NULL OR comp.c IS NULL OR comp.c = d.doc_id, true) AS kept
FROM d LEFT JOIN n ON n.rn = d.rn LEFT JOIN comp ON comp.v = d.doc_id
""")
def op5_superminhash(spark, sf_dir):
    return near_dup.classes(table(spark, sf_dir, "documents"), k=2)


@register("op9_embedding_tiles", r"""
WITH RECURSIVE e AS (SELECT row_number() OVER () AS rn, vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
f AS (SELECT * FROM e WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
p AS (SELECT a.rn AS a, b.rn AS b FROM f a JOIN f b ON a.label = b.label AND len(a.v) = len(b.v) AND a.rn <> b.rn WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
c AS (SELECT a, count(*) AS n FROM p GROUP BY a),
reach AS (SELECT a AS x, a AS r FROM p UNION SELECT reach.x, p.b FROM reach JOIN p ON p.a = reach.r),
m AS (SELECT x, min(vec_id) AS id FROM reach JOIN e ON e.rn = r GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(m.id, vec_id) AS component_id, coalesce(vec_id = coalesce(m.id, vec_id), false) AS kept
FROM e LEFT JOIN c ON c.a = e.rn LEFT JOIN m ON m.x = e.rn
""")
def op9_embedding_tiles(spark, sf_dir):
    return embed_dup.near(table(spark, sf_dir, "embeddings"))


@register("op7_recompression", r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS rn FROM win) WHERE rn > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM dup),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id LEFT JOIN n ON d.doc_id = n.doc_id
""")
def op7_recompression(spark, sf_dir):
    return substrings.without_repeats(table(spark, sf_dir, "documents"), text_kept=False)
