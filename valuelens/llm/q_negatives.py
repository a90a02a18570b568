"""Query op12: hard negatives of every hundredth vector."""

from __future__ import annotations

from pyspark.sql import functions as F

from valuelens.llm.hard_negatives import mine
from valuelens.llm.tables import register, table


@register("op12_hard_negatives", """
WITH e AS (SELECT row_number() OVER () AS rn, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
      FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.rn AS anchor, a.vec_id AS anchor_id, x.vec_id, x.label = a.label AS same, CAST(list_dot_product(a.q, x.q) AS BIGINT) AS score
      FROM e a JOIN e x ON len(a.q) = len(x.q) AND a.rn <> x.rn WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST) AS k
      FROM s WHERE same QUALIFY k <= 5)
SELECT s.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY p.anchor, p.k ORDER BY s.score DESC, s.vec_id NULLS LAST) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10
""")
def op12_hard_negatives(spark, sf_dir):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, sf_dir, "embeddings"), anchors=F.col("vec_id") % 100 == 0, label=moved)
