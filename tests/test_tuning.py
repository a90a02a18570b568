"""Restartable grids, and pruning against brute force."""

import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from valuelens.operators import learn, prune, tuning
from valuelens.plans import q_learn


def rows(spark, n=600):
    df = spark.range(n).select((F.col("id") % 37).cast("double").alias("a"), F.pmod(F.xxhash64("id"), F.lit(100)).cast("double").alias("b"), (F.col("id") % 3).cast("int").alias("fold"))
    return df.withColumn("y", F.when(F.col("a") > 18, 5.0).otherwise(0.0) + F.col("b") / 50).repartition(4).cache()


class Counted:
    """An estimator that counts its fits, and stops the run after some."""

    fits, limit, lock = 0, None, threading.Lock()

    def __init__(self, params):
        self.inner = tuning.boosted(["a", "b"], "y", min_rows=1, l2=1.0, **params)

    def fit(self, df):
        with Counted.lock:
            if Counted.limit is not None and Counted.fits >= Counted.limit:
                raise RuntimeError("killed")
            Counted.fits += 1
        return self.inner.fit(df)


def test_a_killed_run_goes_on_where_it_was(spark, tmp_path):
    df, grid = rows(spark), {"rounds": [1, 2], "leaves": [2, 4]}
    run = lambda path, study="s": tuning.tune(Counted, grid, df, "y", str(tmp_path / path), study, k=3, parallelism=2)
    Counted.limit = 5
    with pytest.raises(RuntimeError, match="killed"):
        run("ledger")
    assert tuning.ledger(spark, str(tmp_path / "ledger")).count() == 5
    Counted.limit, Counted.fits = None, 0
    table = run("ledger")
    assert Counted.fits == 7 and table.count() == 4
    whole = run("fresh")
    pick = lambda t: [(r.grid_point, r.params, round(r.avg_r2, 6), r.rank) for r in t.orderBy("grid_point").collect()]
    assert pick(table) == pick(whole) and tuning.best_params(table) == {"leaves": 4, "rounds": 2}
    Counted.fits = 0
    assert pick(run("ledger")) == pick(whole) and Counted.fits == 0
    run("ledger", "other data")
    assert Counted.fits == 12
    df.unpersist()


def cut_all(left, right, rows, impurity, alpha):
    """Weakest links one by one, everything counted anew each time."""
    left, right = left.copy(), right.copy()
    cost = impurity * rows / rows[0]

    def leaves(i):
        return [i] if left[i] < 0 else leaves(left[i]) + leaves(right[i])

    def reach(i):
        return [i] + ([] if left[i] < 0 else reach(left[i]) + reach(right[i]))

    while True:
        links = [((cost[i] - sum(cost[j] for j in leaves(i))) / (len(leaves(i)) - 1), i) for i in reach(0) if left[i] >= 0]
        if not links or min(links)[0] > alpha:
            return set(reach(0))
        i = min(links)[1]
        left[i] = right[i] = -1


def test_weakest_links_equal_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(60):
        left, right, rows, impurity, todo = [-1], [-1], [int(rng.integers(20, 200))], [float(rng.random())], [0]
        while todo and len(left) < 60:
            i = todo.pop(0)
            if rows[i] > 3 and rng.random() < 0.8:
                a = int(rng.integers(1, rows[i]))
                left[i], right[i] = len(left), len(left) + 1
                for part in (a, rows[i] - a):
                    left.append(-1), right.append(-1), rows.append(part), impurity.append(float(impurity[i] * rng.random()))
                    todo.append(len(left) - 1)
        args = [np.array(x) for x in (left, right, rows, impurity)]
        alpha = float(rng.choice([0.0, 0.001, 0.01, 0.05, 1.0]))
        assert set(np.flatnonzero(prune.weakest_links(*args, alpha)).tolist()) == cut_all(*args, alpha)


def test_pruned_forest(spark):
    df = rows(spark, 900)
    noisy = df.withColumn("y", F.col("y") + F.pmod(F.xxhash64("b", "a"), F.lit(7)) / 10).cache()
    model = learn.random_forest(["a", "b"], "y", numTrees=5, maxDepth=8, minInstancesPerNode=1, minWeightFractionPerNode=0.0).fit(noisy)
    whole, cut = model.stages[-1], prune.pruned(model, alpha=0.01, min_split=10)
    forest = cut.stages[-1]
    assert forest.getNumTrees == 5 and 0 < forest.totalNumNodes < whole.totalNumNodes
    error = lambda m: m.transform(noisy).agg(F.avg(F.pow(F.col("y") - F.col("prediction"), 2))).first()[0]
    assert error(model) <= error(cut) < 0.5
    same = prune.pruned(model, alpha=-1.0, min_split=0)
    assert same.stages[-1].totalNumNodes == whole.totalNumNodes and abs(error(same) - error(model)) < 1e-12
    assert prune.pruned(model, alpha=1e9).stages[-1].totalNumNodes == 5
    df.unpersist(), noisy.unpersist()


def test_depths_of_a_grid_take_one_fit(spark, monkeypatch):
    df, fits, whole = rows(spark, 900), [], learn.Pipeline._fit
    cells = df.withColumn("y", F.col("y") + F.pmod(F.xxhash64("b", "a"), F.lit(7)) / 10).cache()
    forest = learn.random_forest(["a", "b"], "y", minInstancesPerNode=2, minWeightFractionPerNode=0.0)
    one = lambda grid: learn.grid_search(forest, grid, cells, "y", k=3)
    monkeypatch.setattr(learn.Pipeline, "_fit", lambda self, data: (fits.append(1), whole(self, data))[1])
    best, table = one({"maxDepth": [2, 6, 4], "numTrees": [3, 5]})
    assert len(fits) == 3 * 2 + 1  # three folds, two numbers of trees, the best point
    got = {r.params: (round(r.avg_r2, 9), round(r.std_r2, 9)) for r in table.collect()}
    assert len(got) == 6 and best.stages[-1].getMaxDepth() == 6
    for d in (2, 4, 6):  # each depth grown by itself
        for r in one({"maxDepth": [d], "numTrees": [3, 5]})[1].collect():
            assert got[r.params] == (round(r.avg_r2, 9), round(r.std_r2, 9))
    monkeypatch.setattr(learn, "_one_pass", lambda model, depth: False)
    fits.clear()
    one({"maxDepth": [2, 4], "numTrees": [3]})
    assert len(fits) == 3 * 2 + 1
    df.unpersist(), cells.unpersist()


@pytest.mark.parametrize("fold", [None, 3])
def test_folds_beyond_the_range_are_refused(spark, fold):
    df = rows(spark, 60).withColumn("fold", F.when(F.col("a") == 7, F.lit(fold).cast("int")).otherwise(F.col("fold")))
    with pytest.raises(Exception, match="Fold number must be in range"):
        learn.grid_search(learn.random_forest(["a", "b"], "y", numTrees=1), {"maxDepth": [1]}, df, "y", k=3)


def noisy_rows(spark, n=900):
    return rows(spark, n).withColumn("y", F.col("y") + F.pmod(F.xxhash64("b", "a"), F.lit(7)) / 10).cache()


@pytest.mark.parametrize("stages", ["pipeline", "forest"])
def test_ledger_grows_a_forest_once_for_all_depths(spark, tmp_path, monkeypatch, stages):
    df, fits, plain = noisy_rows(spark), [], learn.RandomForestRegressor._fit
    if stages == "forest":
        df = learn.VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df).cache()
    monkeypatch.setattr(learn.RandomForestRegressor, "_fit", lambda self, data: (fits.append(self.getMaxDepth()), plain(self, data))[1])

    def make(params):
        p = learn.random_forest(["a", "b"], "y", minInstancesPerNode=2, minWeightFractionPerNode=0.0, **params)
        return p if stages == "pipeline" else p.getStages()[-1]

    grid = {"maxDepth": [2, 6, 4], "numTrees": [3, 5]}
    run = lambda path, part, **o: tuning.tune(make, part, df, "y", str(tmp_path / path), k=3, **o)
    pick = lambda t: {r.params: (round(r.avg_r2, 9), round(r.std_r2, 9)) for r in t.collect()}
    run("l", {"maxDepth": [2], "numTrees": [3]}, whole=grid)
    assert fits == [6] * 3 and tuning.ledger(spark, str(tmp_path / "l")).count() == 3
    got = pick(run("l", grid))
    assert fits == [6] * 6 and len(got) == 6  # the second run's forests are those of the other number of trees
    assert pick(run("l", grid)) == got and len(fits) == 6
    alone = {}
    for d in (2, 4, 6):  # each depth grown by itself
        alone |= pick(run(f"alone{d}", {"maxDepth": [d], "numTrees": [3, 5]}))
    assert got == alone
    fits.clear()
    monkeypatch.setattr(learn, "_one_pass", lambda model, depth: False)
    assert pick(run("apart", {"maxDepth": [2, 4], "numTrees": [3]})) == {p: v for p, v in alone.items() if p in [tuning.json.dumps({"maxDepth": d, "numTrees": 3}, sort_keys=True) for d in (2, 4)]}
    assert sorted(fits) == [2] * 3 + [4] * 3
    spark.catalog.clearCache()


def test_every_point_of_the_ledger_query_is_fitted(spark, monkeypatch):
    def model_rows(spark, sf_dir):
        noise = F.pmod(F.xxhash64("id"), F.lit(100)) / 10
        return spark.range(900).select(*[F.pmod(F.xxhash64("id", F.lit(i)), F.lit(50)).cast("double").alias(f) for i, f in enumerate(q_learn.FEATURES)],
                                       (F.col("id") % 37 + noise).alias(q_learn.LABEL), F.lit("train").alias("split"), (F.col("id") % 3).cast("int").alias("fold"))

    fits, plain = [], learn.RandomForestRegressor._fit
    monkeypatch.setattr(q_learn, "model_table", model_rows)
    monkeypatch.setattr(learn.RandomForestRegressor, "_fit", lambda self, data: (fits.append(self.getMaxDepth()), plain(self, data))[1])
    assert q_learn.tuning_ledger(spark, "own rows").count() == 2
    assert sorted(fits) == [4] * 3 + [6] * 3


def test_a_forest_cut_short_in_writing_is_grown_again(spark, tmp_path):
    df, at = noisy_rows(spark), str(tmp_path / "kept")
    grown, fit = [], lambda: (grown.append(1), learn.random_forest(["a", "b"], "y", numTrees=2, maxDepth=3).fit(df))[1]
    fit().write().save(f"{at}/forest")  # no mark that it is whole
    grown.clear()
    a, b = tuning._kept(spark, at, fit), tuning._kept(spark, at, fit)
    assert len(grown) == 1 and a.stages[-1].toDebugString.split("\n")[1:] == b.stages[-1].toDebugString.split("\n")[1:]
    spark.catalog.clearCache()


def test_fits_of_large_inputs_wait_for_each_other(spark):
    cores = spark.sparkContext.defaultParallelism
    at_once = lambda n: learn.side_by_side(spark.range(n, numPartitions=n), 4)
    assert at_once(1) == 4 and at_once(4 * cores) == 4 and at_once(8 * cores) == 2 and at_once(40 * cores) == 1
