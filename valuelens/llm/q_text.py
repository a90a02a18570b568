"""Queries op2 and op4: scans of whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from valuelens.llm import licenses
from valuelens.llm.decontaminate import decontaminate
from valuelens.llm.tables import register, table

_WORDS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@register("op2_decontamination", f"""
WITH d AS (SELECT row_number() OVER () AS rn, doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
b AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, {_WORDS.format("coalesce(text, '')")} AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
       FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
ns AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT rn, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM (SELECT rn, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, ns WHERE len(w) >= n)),
hits AS (SELECT rn, dw.n, i, item FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
pos AS (SELECT rn, count(DISTINCT p) AS n_hit FROM (SELECT rn, unnest(range(i, i + n)) AS p FROM hits) GROUP BY rn),
its AS (SELECT rn, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT rn, item FROM hits) GROUP BY rn)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (rn) LEFT JOIN its USING (rn)
""")
def op2_decontamination(spark, sf_dir):
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), clean_text=False)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@register("op4_license_rules")
def op4_license_rules(spark, sf_dir):
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
                        F.array_join("labels", ",").alias("labels"), "score", F.to_json("detections").alias("detections"))
