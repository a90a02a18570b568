"""Queries op8 and op10: conditional random fields over whole texts. A row without an id is never learnt from and not held out."""

from __future__ import annotations

from pyspark.sql import functions as F

from valuelens.llm import language, toxicity
from valuelens.llm.tables import register, table


@register("op8_toxic_spans")
def op8_toxic_spans(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.tag(docs, table(spark, sf_dir, "labels"), spans=False)
    return scored.select("doc_id", F.coalesce(~toxicity.train_rows(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@register("op10_language_id")
def op10_language_id(spark, sf_dir):
    found = language.identify(table(spark, sf_dir, "documents"), spans=False)
    return found.select("doc_id", F.coalesce(~language.train_rows(), F.lit(False)).alias("held_out"), "lang_pred", "score")
