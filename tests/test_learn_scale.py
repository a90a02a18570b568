"""Work that a query of models does once, and the size of training partitions."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from valuelens.operators import boost, learn, split
from valuelens.plans import q_learn


def test_rows_are_scored_once(spark):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def score(x):
        calls.add(1)
        return float(x)

    df = spark.range(40).select((F.col("id") % 2).alias("g"), F.col("id").cast("double").alias("y"), score("id").alias("predicted_value"))
    assert learn.score_summary(df).collect()[0][:] == (19.5, 19.5, 39.0, 0.0, 40)
    assert calls.value == 40
    calls.value = 0
    rows = learn.group_mispricing(df, "g", "y", "predicted_value", 10).orderBy("g").collect()
    assert [(r.g, r.mean_residual, r.median_residual, r["count"]) for r in rows] == [(0, 0.0, 0.0, 20), (1, 0.0, 0.0, 20)]
    assert calls.value <= 80  # at most once for each residual column


class Stub:
    def transform(self, df):
        return df.withColumn("prediction", F.col("p_size").cast("double"))


@pytest.mark.parametrize("name", ["gbt_scores", "model_comparison", "ensemble_rows", "group_mispricing"])
def test_model_table_is_joined_once(spark, monkeypatch, name):
    n = []

    def rows(spark, sf_dir):
        n.append(1)
        df = spark.range(60).select(F.col("id").cast("string").alias("row_key"), *[(F.col("id") + i).cast("double").alias(f) for i, f in enumerate(q_learn.FEATURES)],
                                    (F.col("id") % 2).alias("c_nationkey"), F.col("id").cast("double").alias("l_extendedprice"), F.log1p("id").alias(q_learn.LABEL))
        return split.hash_split(df, "row_key")

    monkeypatch.setattr(q_learn, "model_table", rows)
    app = spark.sparkContext.applicationId
    monkeypatch.setattr(q_learn, "_MODELS", {(app, "own rows", m): Stub() for m in ("rf", "gbt_x", "gbt_l")})
    assert getattr(q_learn, name)(spark, "own rows").count() > 0
    assert len(n) == 1


def test_training_partition_stays_small():
    """Bagged points take some 12 times the files' bytes: well under the 1,500 MB that a task may read."""
    assert learn.PARTITION_BYTES * 12 < 500e6


def test_training_partitions_follow_the_files(spark, tmp_path, monkeypatch):
    """As the tables grow there are more partitions, not larger ones: rows of a task stay the same."""
    largest = {}
    for rows in (40_000, 160_000):
        path = str(tmp_path / str(rows))
        spark.range(rows).select(F.rand(1).alias("x"), F.rand(2).alias("y")).repartition(2).write.parquet(path)
        monkeypatch.setattr(learn, "PARTITION_BYTES", 8 << 10)
        kept = learn.training_input(spark.read.parquet(path), ["x", "y"])
        largest[rows] = max(r["count"] for r in kept.groupBy(F.spark_partition_id()).count().collect())
        assert kept.count() == rows
        kept.unpersist()
    assert largest[160_000] < 1.2 * largest[40_000]


def test_split_hash_is_taken_once(spark):
    df = split.hash_split(spark.createDataFrame([("a",), (None,)], "k string"), "k")
    plan = df.filter(F.col("split") == "train")._jdf.queryExecution().optimizedPlan().toString()
    condition = next(x for x in plan.splitlines() if "Filter" in x)
    assert condition.count("md5") == 1
    assert {r.k: r.split for r in df.collect()}[None] == "train"


def test_stored_codes_of_a_slice():
    for kind in (pa.binary(), pa.large_binary()):
        column = pa.array([bytes([i, i + 1]) for i in range(6)], kind).slice(2, 3)
        assert boost._stored(column).tolist() == [[2, 3], [3, 4], [4, 5]]
