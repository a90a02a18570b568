"""End-to-end flows on the player table Spark derives from the sf0.001 tables."""

import glob
import os
import shutil
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from valuelens.plans import flows, players
from valuelens.schema import RAW_PLAYER
from valuelens.sinks import writers


@pytest.fixture(scope="module")
def raw(spark):
    p = players.players_from_tables(spark, SF_SMALL).persist()
    assert p.columns == [f.name for f in RAW_PLAYER.fields]
    return p


def test_ingest_by_name_and_dedupe(spark, raw):
    root = tempfile.mkdtemp(prefix="vl-ingest-")
    flat = os.path.join(root, "flat")
    os.makedirs(flat)
    # two CSV files, the second with its columns in reverse order and one player repeated
    writers.write_table(raw.coalesce(1), f"{root}/a", "csv")
    rev = raw.limit(5).select(*reversed(raw.columns)).withColumn("market_value", F.lit(99.0))
    writers.write_table(rev.coalesce(1), f"{root}/b", "csv")
    shutil.copy(glob.glob(f"{root}/a/*.csv")[0], f"{flat}/1.csv")
    shutil.copy(glob.glob(f"{root}/b/*.csv")[0], f"{flat}/2.csv")
    table, audit = flows.ingest(spark, flat)
    a = audit.first()
    assert (a.rows_in, a.rows_out) == (raw.count() + 5, raw.count())
    assert table.columns == raw.columns
    # the later file wins for the repeated ids, matched by column name despite the reversed order
    assert table.filter(F.col("market_value") == 99.0).count() == 5


def test_ingest_empty_folder(spark):
    table, _ = flows.ingest(spark, tempfile.mkdtemp(prefix="vl-empty-"))
    assert table.count() == 0


def test_clean_fit_transform(raw):
    plan = flows.fit_clean(raw)
    clean = flows.transform_clean(raw, plan)
    audit = {r.step: r for r in plan.audit.collect()}
    assert audit["drop_missing_target"].rows_out == clean.count()
    assert audit["drop_goalkeepers"].rows_in == raw.count()
    assert "market_value" == clean.columns[-1]
    assert not set(plan.drops()) & set(clean.columns)
    assert clean.filter(F.col("market_value").isNull()).count() == 0
    nulls = clean.select([F.count_if(F.col(c).isNull()).alias(c) for c in clean.columns]).first()
    assert sum(nulls) == 0
    assert "position" not in clean.columns and {"is_DF", "is_MF", "is_FW"} <= set(clean.columns)


def test_questions(raw):
    d = raw.dropna(subset=["market_value"])
    lc = flows.lifecycle(d)
    assert lc["curve"].count() == d.select("age").distinct().count()
    gc = flows.group_comparison(d, "position")
    assert gc["stats"].agg(F.max("pct_vs_top")).first()[0] == 100.0
    drv = flows.drivers(flows._prepare(d))
    assert drv["signs"].count() == 1
    fin = flows.finishing(flows._prepare(d))
    assert set(r.forward_type for r in fin["forwards"].select("forward_type").distinct().collect()) <= {
        "Volume Shooter", "Clinical Finisher", "Elite Striker", "Below Average"}
    ex = flows.exposure(d)
    assert ex["by_band"].agg(F.sum("n")).first()[0] == d.count()


def test_train_and_serve(raw):
    small = {"rf": dict(numTrees=5, maxDepth=4), "gbt_x": dict(maxIter=3), "gbt_l": dict(maxIter=3)}
    tr = flows.train(raw, model_params=small)
    m = tr["metrics"].collect()
    assert len(m) == 3 and sorted(r["rank"] for r in m) == [1, 2, 3]
    out = flows.serve(raw.limit(10), tr, actual="market_value")
    assert out["predictions"].count() == 30
    assert out["ensemble"].filter(F.col("ens_min") > F.col("ens_max")).count() == 0


def test_clean_plan_survives_a_save(spark, raw, tmp_path):
    from valuelens.plans import persist

    plan = flows.fit_clean(raw)
    persist.save_clean_plan(plan, str(tmp_path / "clean"))
    again = persist.load_clean_plan(spark, str(tmp_path / "clean"))
    a, b = flows.transform_clean(raw, plan), flows.transform_clean(raw, again)
    assert a.columns == b.columns and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert again.drops() == plan.drops()


def test_trained_models_survive_a_save_and_serve_without_the_training_rows(spark, raw, tmp_path):
    from valuelens.plans import persist

    path = str(tmp_path / "raw")
    raw.write.parquet(path)
    small = {"rf": dict(numTrees=4, maxDepth=3), "gbt_l": dict(maxIter=2)}
    tr = flows.train(spark.read.parquet(path), models=("rf", "gbt_l"), model_params=small, cross_validate=True)
    assert tr["metrics"].where("model = 'rf'").first().cv_r2_mean is not None
    persist.save_trained(tr, str(tmp_path / "trained"))
    again = persist.load_trained(spark, str(tmp_path / "trained"))
    batch = spark.createDataFrame(raw.limit(20).collect(), raw.schema)
    a = {(r.player_id, r.model): r.prediction for r in flows.serve(batch, tr)["predictions"].collect()}
    out = flows.serve(batch, again)["predictions"]
    assert {(r.player_id, r.model): r.prediction for r in out.collect()} == a and len(a) == 40
    assert not any(path in f for f in out.inputFiles())
    assert not any(path in f for f in flows.serve(batch, tr)["predictions"].inputFiles())
    # versions of a registry: a failed save leaves nothing visible, nothing published changes
    import pytest

    root = str(tmp_path / "registry")
    with pytest.raises(LookupError):
        persist.load_published(spark, root)
    assert persist.publish(spark, tr, root, ledger=spark.range(3)) == 1
    with pytest.raises(AttributeError):
        persist.publish(spark, {**tr, "models": {**tr["models"], "zz": None}}, root)
    assert [r.number for r in persist.versions(spark, root).collect()] == [1]
    first = persist.load_published(spark, root)
    assert first["number"] == 1 and first["ledger"].count() == 3
    assert persist.publish(spark, tr, root) == 2
    newest = persist.load_published(spark, root)
    assert newest["number"] == 2 and "ledger" not in newest and persist.load_published(spark, root, number=1)["number"] == 1
    assert {(r.player_id, r.model): r.prediction for r in flows.serve(batch, newest)["predictions"].collect()} == a
