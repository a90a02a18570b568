"""Serving helpers (S7, S9, S3): sparse profile expansion, tolerant model loading, reject split.

S7: a scoring request gives ~15 fields; the rest of the model's inputs are
derived from them by fixed rules. The rules are SQL expression text, applied
with ``selectExpr`` (JVM, vectorised) to a DataFrame of partial profiles — any
number of requests at once, batch or stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fields derived for a partial profile (name, SQL expression over the given fields).
# Given: age, nationality, current_club, league, appearances, minutes_played, position (label),
# goals, assists, goals_per_90, progressive_carries_per90, progressive_passes_per90, sca_per90,
# passes_completed_per90.
DERIVED_DEFAULTS = [
    ("is_DF", "CAST(position = 'Defender' AS INT)"),
    ("is_MF", "CAST(position = 'Midfielder' AS INT)"),
    ("is_FW", "CAST(position = 'Forward' AS INT)"),
    ("npg_per90", "goals_per_90 * CAST(0.85 AS DOUBLE)"),
    ("xg_per90", "goals_per_90 * CAST(0.9 AS DOUBLE)"),
    ("xag_per90", "assists / greatest(appearances, 1) * 90 / greatest(minutes_played / greatest(appearances, 1), 1) * CAST(0.8 AS DOUBLE)"),
    ("shots_per90", "goals_per_90 * 4"),
    ("shots_on_target_per90", "goals_per_90 * 2"),
    ("shots_on_target_pct", "CAST(40.0 AS DOUBLE)"),
    ("avg_shot_distance", "CAST(16.0 AS DOUBLE)"),
    ("gca_per90", "sca_per90 * CAST(0.3 AS DOUBLE)"),
    ("key_passes_per90", "sca_per90 * CAST(0.5 AS DOUBLE)"),
    ("pass_completion_pct", "CAST(80.0 AS DOUBLE)"),
    ("passes_into_final_third_per90", "passes_completed_per90 * CAST(0.15 AS DOUBLE)"),
    ("passes_into_penalty_area_per90", "passes_completed_per90 * CAST(0.05 AS DOUBLE)"),
    ("progressive_passes_rec_per90", "progressive_passes_per90 * CAST(0.8 AS DOUBLE)"),
    ("take_ons_per90", "progressive_carries_per90 * CAST(0.5 AS DOUBLE)"),
    ("carries_into_final_third_per90", "progressive_carries_per90 * CAST(0.4 AS DOUBLE)"),
    ("touches_att_third_per90", "CAST(20.0 AS DOUBLE)"),
    ("touches_att_pen_per90", "CAST(5.0 AS DOUBLE)"),
    ("passes_received_per90", "passes_completed_per90 * CAST(0.8 AS DOUBLE)"),
    ("interceptions_per90", "CASE WHEN position = 'Defender' THEN CAST(1.5 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END"),
    ("blocks_per90", "CASE WHEN position = 'Defender' THEN CAST(1.5 AS DOUBLE) ELSE CAST(0.8 AS DOUBLE) END"),
    ("ball_recoveries_per90", "CAST(5.0 AS DOUBLE)"),
    ("aerials_won_per90", "CASE WHEN position = 'Defender' THEN CAST(2.0 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END"),
    ("yellow_cards_per90", "CAST(0.15 AS DOUBLE)"),
    ("fouls_committed_per90", "CAST(1.0 AS DOUBLE)"),
]


def expand_profiles(partial: DataFrame, keep_position: bool = False) -> DataFrame:
    """Add every derived field to each partial profile (given fields are kept)."""
    out = partial.selectExpr("*", *[f"{expr} AS {name}" for name, expr in DERIVED_DEFAULTS])
    return out if keep_position else out.drop("position")


def load_models(paths: dict[str, str]) -> dict:
    """Load each saved model; a missing or unreadable one is recorded as None."""
    from pyspark.ml import PipelineModel

    models = {}
    for name, path in paths.items():
        try:
            models[name] = PipelineModel.load(path)
        except Exception:
            models[name] = None
    return models


def model_registry(spark: SparkSession, paths: dict[str, str], models: dict) -> DataFrame:
    """(model, path, available) table of the models a serving job can use."""
    return spark.createDataFrame([(n, p, models.get(n) is not None) for n, p in paths.items()],
                                 "model string, path string, available boolean")


def input_features(models: dict, saved_list: DataFrame | None = None) -> list[str] | None:
    """Input names from the first available model's assembler, else from the saved feature table."""
    for m in models.values():
        if m is None:
            continue
        for st in m.stages:
            if hasattr(st, "getInputCols"):
                return list(st.getInputCols())
    if saved_list is not None:
        return [r.feature for r in saved_list.orderBy("position").collect()]
    return None


def split_rejects(df: DataFrame, corrupt_col: str = "_corrupt_record") -> tuple[DataFrame, DataFrame]:
    """S3: rows that parsed vs. rows kept only as raw text (PERMISSIVE scan with a corrupt-record
    column); the rejects go to their own table instead of failing the load."""
    if corrupt_col not in df.columns:
        return df, df.limit(0)
    good = df.filter(F.col(corrupt_col).isNull()).drop(corrupt_col)
    bad = df.filter(F.col(corrupt_col).isNotNull()).select(corrupt_col, *[c for c in df.columns if c.startswith("_source")])
    return good, bad
