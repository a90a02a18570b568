"""Composite flows (C1-C11): the library's public entry points over player tables.

Each *fit* step is one aggregate job over a persisted input and returns a small
plan (drop lists, fill values, codes); every *transform* is lazy and reusable
on new batches or streams. Defaults carry the reference's thresholds.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuelens.functions import segment as sg
from valuelens.operators import dedupe as dd
from valuelens.operators import features as fe
from valuelens.operators import groupstats as gs
from valuelens.operators import learn as ml
from valuelens.operators import lifecycle as lc
from valuelens.operators import profile as pr
from valuelens.operators import split as sp
from valuelens.operators import stats as st
from valuelens.operators.quantiles import quantile_columns, quantile_row, with_quantiles
from valuelens.operators.themes import head_and_tail, sign_counts, theme_counts
from valuelens.schema import CLEAN_COLUMNS, KEEPER, RAW_PLAYER, order_columns
from valuelens.session import cut_lineage, settled
from valuelens.sinks import writers
from valuelens.sources import files

TARGET = "market_value"
META_COLUMNS = ["player_id", "player_name", "foot", "position", "position_category"]


# --- C1 ingest ------------------------------------------------------------------------------------

def ingest(spark: SparkSession, folder: str, out: str | None = None, quarantine: str | None = None) -> tuple[DataFrame, DataFrame]:
    """All CSVs of a folder (S2, by column name) -> conformed records -> keep the last record per
    player id in file order (A1) -> optional write (K1). Returns (table, audit). Files that cannot be loaded are
    written to the ``quarantine`` table (file, reason), or named in a warning without one."""
    if quarantine:
        found = files.ingest_folder(spark, folder, RAW_PLAYER)
        writers.write_table(found.quarantine, quarantine)
        raw = found.rows
    else:
        raw = files.read_csv_folder(spark, folder, RAW_PLAYER)
    # order = (file, split offset, position inside the split): the row order of the concatenated files
    ordered = raw.withColumn("_row", F.monotonically_increasing_id())
    deduped = dd.dedupe_keep_last(ordered, "player_id", ["_source_file", "_block_start", "_row"]).drop(
        "_row", "_source_file", "_block_start")
    audit = dd.step_audit(raw, deduped, "dedupe_player_id")
    if out:
        writers.write_table(deduped, out)
    return deduped, audit


def _settled(df: DataFrame) -> DataFrame:
    """A table of a row or of a row per column, computed once: later uses do not go back to its input."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


# --- C2 clean -------------------------------------------------------------------------------------

@dataclass
class CleanPlan:
    """Fitted cleaning plan: what to drop, how to fill, and the output order."""

    sparse_dropped: list[str] = field(default_factory=list)
    redundant_dropped: list[str] = field(default_factory=list)
    low_corr_dropped: list[str] = field(default_factory=list)
    derived_dropped: list[str] = field(default_factory=list)
    fills: DataFrame | None = None
    vif_report: DataFrame | None = None
    audit: DataFrame | None = None
    columns: list[str] = field(default_factory=list)

    def drops(self) -> list[str]:
        return list(dict.fromkeys(self.sparse_dropped + self.redundant_dropped + self.low_corr_dropped + self.derived_dropped))


def _prepare(df: DataFrame) -> DataFrame:
    """P9 -> P13 (no keepers) -> keeper columns dropped -> P10 indicators."""
    d = df.withColumn("position_category", sg.classify_position("position"))
    d = d.filter(F.col("position_category") != "GK")
    d = fe.drop_columns(d, KEEPER)
    return d.withColumns(sg.one_hot("position_category", ["DF", "MF", "FW"]))


def fit_clean(df: DataFrame, target: str = TARGET, sparse_pct: float = 50.0, pair_threshold: float = 0.95,
              low_threshold: float = 0.03, min_n: int = 30) -> CleanPlan:
    """C2 fit: each step is one aggregate over the (persisted) prepared table."""
    plan = CleanPlan()
    d = _prepare(df).persist()
    prof = fe.fit_prune_sparse(d, sparse_pct)
    plan.sparse_dropped = [r.column_name for r in prof.filter("dropped = 1").collect()]
    d = fe.drop_columns(d, plan.sparse_dropped).dropna(subset=[target])
    # A2: rows kept by each row-dropping step (three counts in one pass over the input)
    c = df.withColumn("__cat", sg.classify_position("position")).agg(
        F.count(F.lit(1)).alias("n_in"), F.count_if(F.col("__cat") != "GK").alias("n_outfield"),
        F.count_if((F.col("__cat") != "GK") & F.col(target).isNotNull()).alias("n_target")).first()
    plan.audit = df.sparkSession.createDataFrame([
        ("drop_goalkeepers", c.n_in, c.n_outfield), ("drop_missing_target", c.n_outfield, c.n_target)],
        "step string, rows_in long, rows_out long").withColumn("removed", F.col("rows_in") - F.col("rows_out")).withColumn(
        "kept_pct", F.try_divide(F.col("rows_out"), F.col("rows_in")) * 100)
    numeric = pr.numeric_columns(d, exclude=[target, "is_DF", "is_MF", "is_FW"])
    tc = st.target_correlations(d, numeric, target, min_n=min_n)
    pairs = st.high_corr_pairs(st.corr_matrix_long(d, numeric), pair_threshold)
    plan.redundant_dropped = [r.feature for r in st.redundant_drop_list(pairs, tc).collect()]
    rest = [c for c in numeric if c not in plan.redundant_dropped]
    tc2 = st.target_correlations(d, rest, target, min_n=min_n)  # too few rows: no r, so not dropped
    plan.low_corr_dropped = [r.feature for r in st.low_corr_drop_list(tc2, low_threshold).collect()]
    checks = []
    if {"minutes_per_game", "minutes_played", "appearances"} <= set(d.columns):
        checks.append(("minutes_per_game", F.col("minutes_played") / F.when(F.col("appearances") == 0, 1).otherwise(F.col("appearances")), 0.99))
    if {"npxg_xag_per90", "npxg_per90", "xag_per90"} <= set(d.columns):
        checks.append(("npxg_xag_per90", F.col("npxg_per90") + F.col("xag_per90"), 0.95))
    if checks:
        plan.derived_dropped = [r.column_name for r in st.derived_column_check(d, checks).filter("is_derived = 1").collect()]
    kept = fe.drop_columns(d, plan.drops() + META_COLUMNS)
    # VIF report only: all numeric columns (not target / indicators) under 30 % null, complete
    # rows, more than 100 of them
    cand = pr.numeric_columns(kept, exclude=[target, "is_DF", "is_MF", "is_FW"])
    if cand:
        rates = {r.column_name: r.null_pct for r in pr.null_profile(kept, cand).collect()}
        vif_cols = [c for c in cand if (rates.get(c) or 0.0) < 30.0]
        if len(vif_cols) > 1:
            plan.vif_report = _settled(st.vif(kept, vif_cols, min_rows=100))
    num = pr.numeric_columns(kept, exclude=[target])
    cat = pr.string_columns(kept)
    plan.fills = _settled(fe.fit_impute(kept, num, cat))
    plan.columns = order_columns(kept, CLEAN_COLUMNS, target).columns
    d.unpersist()
    return plan


def transform_clean(df: DataFrame, plan: CleanPlan, target: str = TARGET) -> DataFrame:
    """C2 transform: lazy, reusable on new batches."""
    d = _prepare(df)
    d = fe.drop_columns(d, plan.drops() + META_COLUMNS).dropna(subset=[target])
    d = fe.transform_impute(d, plan.fills)
    return d.select(*[c for c in plan.columns if c in d.columns])


# --- C3 profile -----------------------------------------------------------------------------------

def profile(df: DataFrame) -> dict[str, DataFrame]:
    """Shape, column profile, quality rules, text-number and constant detection, describe,
    moments with skew bands, per-column nulls and null total (each lazily defined)."""
    num = pr.numeric_columns(df)
    pct = [c for c in num if "pct" in c]
    ind = [c for c in df.columns if c.startswith("is_")]
    rules = pr.range_rules(df, pct, 0, 100) + pr.set_rules(df, ind, [0, 1])
    return {
        "shape": pr.shape(df),
        "columns": pr.column_profile(df),
        "rules": pr.quality_rules(df, rules) if rules else None,
        "text_numbers": pr.text_number_detect(df) if pr.string_columns(df) else None,
        "constants": pr.constant_columns(df),
        "describe": pr.describe_numeric(df, num),
        "moments": pr.skew_bands(pr.moments(df, num)),
        "nulls": pr.null_profile(df),
        "null_total": pr.null_total(df),
    }


# --- C4 drivers of value ----------------------------------------------------------------------------

def drivers(df: DataFrame, target: str = TARGET, top: int = 20) -> dict[str, DataFrame]:
    """C4: NULL -> 0, correlation of every numeric column with the target, significance, themes of
    the top features (multi-label) and sign counts."""
    from valuelens.plans.q_segment import THEMES

    num = pr.numeric_columns(df, exclude=[target])
    filled = df.fillna(0, subset=num)
    sig = st.corr_significance(filled, num, target)
    ranked = gs.rank_desc(sig.withColumn("abs_corr", F.abs("corr")), "abs_corr", ["feature"])
    top_n = ranked.filter(F.col("rank") <= top)
    return {
        "correlations": ranked,
        "themes": theme_counts(top_n, "feature", THEMES),
        "signs": sign_counts(top_n),
        "head_tail": head_and_tail(ranked, "rank", top, 3),
    }


# --- C5 group comparison ------------------------------------------------------------------------------

def group_comparison(df: DataFrame, group: str = "position", target: str = TARGET) -> dict[str, DataFrame]:
    """Quartile statistics per group (rounded first), % of the top group, one-way ANOVA, box plots."""
    stats = gs.group_stats_quartiles(df, group, target)
    return {
        "stats": gs.pct_of_top(stats, "median", 1),
        "anova": st.anova_oneway(df, group, target),
        "boxplot": st.boxplot_summary(df, group, target),
        "above_mean": gs.mean_above_mean(stats, "median"),
    }


# --- C6 life cycle --------------------------------------------------------------------------------------

def lifecycle(df: DataFrame, key: str = "age", target: str = TARGET, group: str = "position") -> dict[str, DataFrame]:
    """Value curve, prime keys, per-group prime, change / decline, stability, phases and returns."""
    curve = lc.value_curve(df, key, target)
    summary = lc.phase_summary(curve, key)
    return {
        "curve": curve,
        "top_keys": gs.top_k(curve, "mean", 10, [key]),
        "prime": lc.prime_key(curve, key, 20),
        "prime_by_group": lc.prime_key_by_group(df, group, key, target, 10),
        "decline": lc.decline_start(curve.filter(F.col("count") >= 20), key),
        "stability": lc.stability_rank(curve, key, 30),
        "phases": summary,
        "phase_roi": lc.phase_roi(summary),
    }


# --- C7 group mispricing ------------------------------------------------------------------------------

def mispricing(df: DataFrame, features: list[str], group: str = "league", target: str = TARGET, key: str = "player_id",
               num_trees: int = 200, max_depth: int = 15) -> DataFrame:
    """Forest without the group column, residuals, per-group mean / median / count / mean %."""
    data = sp.hash_split(df.dropna(subset=[target]), key, test_pct=20, val_pct=0)
    fills = fe.fit_impute(data, features, [])
    data = fe.transform_impute(data, fills)
    pipe = ml.random_forest(features, target, numTrees=num_trees, maxDepth=max_depth, minInstancesPerNode=1,
                            minWeightFractionPerNode=0.0, featureSubsetStrategy="auto")
    model = pipe.fit(data.filter(F.col("split") == "train"))
    scored = ml.predict_value(model, data, log_target=False)
    return ml.group_mispricing(scored, group, target, "predicted_value", 10)


def _ensure(df: DataFrame, cols) -> DataFrame:
    """Column-presence guard: absent inputs become NULL doubles (the reference skips or zero-fills them)."""
    missing = [c for c in cols if c not in df.columns]
    return df.withColumns({c: F.lit(None).cast("double") for c in missing}) if missing else df


# --- C8 exposure effect --------------------------------------------------------------------------------

def exposure(df: DataFrame, target: str = TARGET) -> dict[str, DataFrame]:
    """Minutes bands (right-closed), assists / 90 if absent, efficiency score, z-scores, correlation and
    significance, quadratic fit, and value per band after controlling for age (residual)."""
    from valuelens.plans.q_segment import MINUTE_EDGES, MINUTE_LABELS

    d = _ensure(df, ["goals_per_90", "key_passes_per90"]).dropna(subset=[target]).withColumn("minutes_band", sg.right_closed_bins("minutes_played", MINUTE_EDGES, MINUTE_LABELS))
    if "assists_per_90" not in d.columns:
        d = d.withColumn("assists_per_90", fe.rate_or_zero("assists", "minutes_played"))
    d = d.withColumn("efficiency", fe.weighted_score([("goals_per_90", 3), ("assists_per_90", 2), ("key_passes_per90", 1)]))
    ctrl = st.linear_residuals(d, target, "age", keep=["minutes_band"])
    return {
        "z": fe.standardize_pop(d, ["minutes_played", "efficiency"]),
        "correlation": st.corr_significance(d, ["minutes_played", "efficiency"], target),
        "quadratic": st.quadratic_fit(d, target, "minutes_played"),
        "by_band": ctrl.groupBy("minutes_band").agg(
            F.count(F.lit(1)).alias("n"), F.avg(target).alias("mean_value"), F.avg("residual").alias("mean_residual")),
    }


# --- C9 finishing effect --------------------------------------------------------------------------------

def finishing(df: DataFrame, target: str = TARGET) -> dict[str, DataFrame]:
    """Forwards only, finishing metrics, quadrants against medians (before the playing-time
    filter), significance of shooting metrics, summaries and undervalued clinical finishers."""
    fw = df.filter(F.col("is_FW") == 1).dropna(subset=[target]) if "is_FW" in df.columns else df.dropna(subset=[target])
    fw = _ensure(fw, ["shots_per90", "xg_per90", "shots_on_target_pct", "goals_per_90", "appearances", "minutes_played"])
    f = settled(fe.finishing_metrics(fw, "shots_per90", "minutes_played", "goals", "xg_per90", "shots_on_target_pct"))
    med = quantile_row(f, {"sm": ("shots_per90", 0.5), "cm": ("conversion_rate", 0.5)})
    f = f.crossJoin(F.broadcast(med)).withColumn("forward_type", sg.quadrant("shots_per90", "conversion_rate", "sm", "cm"))
    kept = f.filter((F.coalesce(F.col("appearances"), F.lit(0)) >= 5) & (F.coalesce(F.col("minutes_played"), F.lit(0)) >= 450))
    metrics = [c for c in ["shots_per90", "shots_on_target_per90", "conversion_rate", "xg_overperformance", "shot_accuracy",
                           "goals_per_90", "xg_per90"] if c in kept.columns]
    mv = quantile_columns(kept, [], target, {"mv": 0.5})
    clinical = kept.crossJoin(F.broadcast(mv)).filter((F.col("forward_type") == "Clinical Finisher") & (F.col(target) < F.col("mv")))
    return {
        "forwards": kept,
        "significance": st.corr_significance(kept, metrics, target),
        "fit": st.linear_fit(kept, target, "conversion_rate"),
        "summary": with_quantiles(
            kept.groupBy("forward_type").agg(F.count(target).alias("n"), F.avg(target).alias("mean"), F.stddev_samp(target).alias("std")),
            kept, ["forward_type"], target, {"median": 0.5}).select("forward_type", "n", "mean", "median", "std"),
        "top_value": gs.top_k(kept, target, 10, [c for c in ["player_id"] if c in kept.columns]),
        "undervalued": gs.top_k(clinical, "conversion_rate", 5, [c for c in ["player_id"] if c in kept.columns]),
    }


# --- C10 train / C11 serve ------------------------------------------------------------------------------

@dataclass
class FeaturePlan:
    """Fitted feature tables (M18): log columns, frequency / label codes, target codes, selected features."""

    log_columns: list[str]
    freq: dict[str, DataFrame]
    labels: dict[str, DataFrame]
    target_codes: dict[str, tuple[DataFrame, DataFrame, DataFrame]]
    selected: list[str]


def fit_features(train: DataFrame, target: str = TARGET, freq_cols=("nationality", "current_club", "league"),
                 label_cols=("league",), te_cols=("nationality", "current_club"), select_threshold: float = 0.05) -> FeaturePlan:
    """M18 fit on the training split only (no leakage into validation / test)."""
    # nothing made of the target, and no bookkeeping column, may become a feature
    held = [target, "__y", "fold", "split", "player_id"]
    logs = [r.column_name for r in fe.fit_auto_log(train, exclude=held).filter("selected = 1").collect()]
    d = fe.engineered(fe.transform_auto_log(train, logs))
    # code tables are cut from the training rows (shared checkpoint folder): serving never reads these again
    freq = {c: cut_lineage(fe.fit_frequency(d, c)) for c in freq_cols if c in d.columns}
    labels = {c: cut_lineage(fe.fit_label_codes(d, c)) for c in label_cols if c in d.columns}
    d2 = transform_features_base(d, freq, labels)
    tcodes = {c: tuple(cut_lineage(t) for t in fe.fit_target_codes(d2, c, "__y", "fold"))
              for c in te_cols if c in d2.columns} if "fold" in d2.columns else {}
    num = pr.numeric_columns(d2, exclude=held)
    tc = st.target_correlations(d2.fillna(0, subset=num), num, "__y")
    selected = [r.feature for r in st.select_features(tc, select_threshold).collect()]
    return FeaturePlan(logs, freq, labels, tcodes, selected)


def transform_features_base(d: DataFrame, freq: dict, labels: dict) -> DataFrame:
    for c, codes in freq.items():
        d = fe.transform_frequency(d, c, codes, default=1)
    for c, codes in labels.items():
        d = fe.transform_label_codes(d, c, codes, unseen=0)
    return d


def transform_features(df: DataFrame, plan: FeaturePlan, oof: bool = False) -> DataFrame:
    """M18 / M19 transform with the FITTED tables (same code path for training, batch and stream serving)."""
    d = fe.engineered(fe.transform_auto_log(df, plan.log_columns))
    d = transform_features_base(d, plan.freq, plan.labels)
    for c, (oof_codes, full, overall) in plan.target_codes.items():
        d = (fe.transform_target_oof(d, c, "fold", oof_codes, overall) if oof
             else fe.transform_target_full(d, c, full, overall))
    return d


def train(df: DataFrame, target: str = TARGET, key: str = "player_id", models=("rf", "gbt_x", "gbt_l"),
          model_params: dict | None = None, cross_validate: bool = False) -> dict:
    """C10 (with ``cross_validate``, M14 of every model, and the seconds it took): trim to the 1-99 % target band, hash split 64/16/20, fit feature tables on train, out-of-fold
    target codes, NULL -> 0, fit the tree models, compare on log-scale R^2 and original-scale errors."""
    model_params = model_params or {}
    d = fe.percentile_trim(df.dropna(subset=[target]), target, 0.01, 0.99)
    d = sp.hash_folds(sp.hash_split(d, key), key).withColumn("__y", F.log1p(target))
    tr = d.filter(F.col("split") == "train")
    plan = fit_features(tr, target)
    feats = list(dict.fromkeys(plan.selected + [f"{c}_target_enc" for c in plan.target_codes]))
    parts = {
        "train": transform_features(tr, plan, oof=True),
        "val": transform_features(d.filter(F.col("split") == "val"), plan),
        "test": transform_features(d.filter(F.col("split") == "test"), plan),
    }
    keep = [key, target, "__y", "split", "fold", *feats]
    # cut the feature lineage once: the tree learners scan the training set once per level, and the
    # three splits are scored by every model (reliable checkpoint in the shared folder)
    parts = {k: cut_lineage(v.fillna(0, subset=[c for c in feats if c in v.columns]).select(*[c for c in keep if c in v.columns]))
             for k, v in parts.items()}
    builders = {"rf": ml.random_forest, "gbt_x": ml.gbt_x, "gbt_l": ml.gbt_l}
    train_rows = ml.training_input(parts["train"], parts["train"].columns)
    fitted, rows = {}, []
    for name in models:
        m, secs = ml.fit_timed(builders[name](feats, "__y", **model_params.get(name, {})), train_rows)
        fitted[name] = m
        scored = {s: m.transform(p) for s, p in parts.items()}
        row = ml.model_metrics(name, scored, "__y", target).withColumn("train_s", F.lit(secs)).first().asDict()
        if cross_validate:
            began = time.time()
            cv = ml.cv_summary(ml.cv_fold_scores(builders[name](feats, "__y", **model_params.get(name, {})), train_rows, "__y")).first()
            row |= {"cv_r2_mean": cv.cv_r2_mean, "cv_r2_std": cv.cv_r2_std, "cv_s": time.time() - began}
        rows.append(row)
    train_rows.unpersist()
    spark = df.sparkSession
    names = list(dict.fromkeys(k for r in rows for k in r))
    metrics = spark.createDataFrame([tuple(r.get(k) for k in names) for r in rows], names)
    return {"plan": plan, "features": feats, "models": fitted, "metrics": ml.best_model(metrics, "test_r2")}


def serve(batch: DataFrame, trained: dict, key: str = "player_id", actual: str | None = None) -> dict[str, DataFrame]:
    """C11: score a batch with every trained model through the fitted feature tables; ensemble stats,
    value tier and difference to the actual value when present."""
    d = transform_features(batch, trained["plan"]).fillna(0, subset=[c for c in trained["features"]])
    for c in trained["features"]:
        if c not in d.columns:
            d = d.withColumn(c, F.lit(0.0))
    parts = []
    for name, m in trained["models"].items():
        s = ml.predict_value(m, d).select(key, F.lit(name).alias("model"), F.round("predicted_value", 2).alias("prediction"),
                                          *([actual] if actual else []))
        parts.append(s)
    long = parts[0]
    for p in parts[1:]:
        long = long.unionByName(p)
    ens = ml.ensemble(long, key, actual).withColumn("tier", sg.value_tier("ens_mean"))
    return {"predictions": long, "ensemble": ens, "summary": ml.score_summary(long, "prediction")}
