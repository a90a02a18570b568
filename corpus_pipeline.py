"""Corpus cleaning pipeline: toxicity, near-dedup, decontamination, mixing, sharding.

``STAGES`` lists (name, function) pairs; a function takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next one's docs. All but the last
return the columns of documents. Stages work on all rows that their predecessor kept.

1. toxicity: documents with a toxicity score of 0.7 or more go (linear-chain conditional random field).
2. near_dedup: of each class of near duplicates (five-word shingles, similarity 0.8 or more) the
   document with the smallest doc_id stays (SuperMinHash).
3. decontamination: documents that hold ten consecutive words of a benchmark item go.
4. mixing: sources are mixed to their target weights; a document that the mix takes twice is there twice.
5. sharding: every row gets its shard and its slot in it (consistent-hash ring with bounded loads).

Null or empty texts pass stages 1 to 3; the mix counts them as size 0. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from valuelens.llm import decontaminate, mixing, near_dup, sharding, toxicity
from valuelens.llm.tables import table, written

#: No SQL: the stages fit models and choose by seeded hashes. tests/llm holds brute-force versions.
ORACLE_SQL = None


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.tag(docs, table(spark, sf_dir, "labels"), keep=0.7)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.deduplicated(docs, k=5)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard(docs)


STAGES = [
    ("toxicity", toxic),
    ("near_dedup", near_copies),
    ("decontamination", benchmark_passages),
    ("mixing", source_mix),
    ("sharding", shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written to the shared checkpoint folder."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
