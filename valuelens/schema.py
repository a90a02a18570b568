"""Fixed schemas of player records and schema conformance.

The raw record has 70 columns in a fixed order; counters default to 0, every
other field to NULL. The clean table has 42 columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, IntegerType, StringType, StructField, StructType

# Raw record columns in file order, grouped; types per group.
IDENTITY = ["player_id", "player_name"]
PROFILE = [("age", "double"), ("nationality", "string"), ("height", "double"), ("foot", "string"),
           ("position", "string"), ("current_club", "string"), ("league", "string")]
PLAYING_TIME = [("appearances", "int"), ("minutes_played", "int"), ("minutes_per_game", "double")]
TOTALS = ["goals", "assists"]
ATTACKING = ["goals_per_90", "assists_per_90", "npg_per90", "npxg_per90", "xag_per90", "npxg_xag_per90", "xg_per90",
             "shots_per90", "shots_on_target_per90", "shots_on_target_pct", "avg_shot_distance", "sca_per90", "gca_per90"]
PLAYMAKING = ["key_passes_per90", "passes_completed_per90", "pass_completion_pct", "passes_into_final_third_per90",
              "passes_into_penalty_area_per90", "progressive_passes_per90", "progressive_passes_rec_per90",
              "progressive_carries_per90"]
PROGRESSION = ["take_ons_per90", "take_on_success_pct", "carries_per90", "carries_into_final_third_per90", "touches_per90",
               "touches_att_third_per90", "touches_att_pen_per90", "passes_received_per90"]
DEFENSIVE = ["tackles_per90", "interceptions_per90", "blocks_per90", "ball_recoveries_per90"]
PHYSICAL = ["aerials_won_per90", "aerial_win_pct"]
DISCIPLINE = ["yellow_cards_per90", "red_cards_per90", "fouls_committed_per90"]
KEEPER = ["goals_against_per90", "shots_on_target_against_per90", "saves_per90", "save_percentage", "clean_sheet_pct",
          "psxg_per_shot", "psxg_ga_per90", "penalty_save_pct", "passes_attempted_per90", "launch_pct", "avg_pass_length",
          "def_actions_outside_pen_per90", "avg_distance_def_actions", "crosses_stopped_pct", "wins_per90", "draws_per90",
          "losses_per90"]
TARGET = "market_value"
COUNTERS = ["appearances", "minutes_played", "goals", "assists"]

# Clean table columns, in order.
CLEAN_COLUMNS = [
    "age", "nationality", "current_club", "league", "appearances", "minutes_played", "is_DF", "is_MF", "is_FW",
    "goals", "assists", "goals_per_90", "npg_per90", "xag_per90", "xg_per90", "shots_per90", "shots_on_target_per90",
    "shots_on_target_pct", "avg_shot_distance", "sca_per90", "gca_per90", "key_passes_per90", "passes_completed_per90",
    "pass_completion_pct", "passes_into_final_third_per90", "passes_into_penalty_area_per90", "progressive_passes_per90",
    "progressive_passes_rec_per90", "progressive_carries_per90", "take_ons_per90", "carries_per90",
    "carries_into_final_third_per90", "touches_att_third_per90", "touches_att_pen_per90", "passes_received_per90",
    "interceptions_per90", "blocks_per90", "ball_recoveries_per90", "aerials_won_per90", "yellow_cards_per90",
    "fouls_committed_per90", "market_value",
]

_TYPES: dict[str, DataType] = {"double": DoubleType(), "int": IntegerType(), "string": StringType()}


def _raw_fields() -> list[tuple[str, str]]:
    rates = ATTACKING + PLAYMAKING + PROGRESSION + DEFENSIVE + PHYSICAL + DISCIPLINE + KEEPER
    return ([(c, "string") for c in IDENTITY] + PROFILE + PLAYING_TIME + [(c, "int") for c in TOTALS]
            + [(c, "double") for c in rates] + [(TARGET, "double")])


RAW_PLAYER = StructType([StructField(n, _TYPES[t], True) for n, t in _raw_fields()])
RAW_DEFAULTS: dict[str, object] = {c: 0 for c in COUNTERS}

CLEAN_PLAYER = StructType([
    StructField(c, StringType() if c in ("nationality", "current_club", "league")
                else IntegerType() if c in ("is_DF", "is_MF", "is_FW") else DoubleType(), True)
    for c in CLEAN_COLUMNS
])


def conform_columns(df: DataFrame, schema: StructType = RAW_PLAYER, defaults: dict | None = None) -> list[Column]:
    """The K2 projection as column expressions (see :func:`conform`)."""
    defaults = RAW_DEFAULTS if defaults is None else defaults
    have = set(df.columns)
    cols: list[Column] = []
    for f in schema.fields:
        v = F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)
        if f.name in defaults:
            v = F.coalesce(v, F.lit(defaults[f.name]).cast(f.dataType))
        cols.append(v.alias(f.name))
    return cols


def conform(df: DataFrame, schema: StructType = RAW_PLAYER, defaults: dict | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """K2: project onto the schema's columns in order: unknown columns dropped (except ``keep``),
    missing ones added, values cast (try_cast: bad text -> NULL) and NULLs replaced by per-field
    defaults."""
    return df.select(*conform_columns(df, schema, defaults), *[F.col(f"`{k}`") for k in keep])


def complete_features(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Add absent required features with name-rule defaults, keep the required order, NULL -> 0.

    Defaults: names containing 'target_enc' -> 1.5, 'freq' -> 1, 'label_enc' -> 0, others 0.
    """
    have = set(df.columns)

    def default(name: str) -> float:
        if "target_enc" in name:
            return 1.5
        if "freq" in name:
            return 1.0
        return 0.0

    cols = []
    for c in required:
        v = F.col(f"`{c}`").cast("double") if c in have else F.lit(default(c))
        cols.append(F.coalesce(v, F.lit(0.0)).alias(c))
    return df.select(*cols)


def order_columns(df: DataFrame, leading: Sequence[str], target: str | None = None) -> DataFrame:
    """Leading columns (absent ones ignored), then the rest, target last."""
    lead = [c for c in leading if c in df.columns and c != target]
    rest = [c for c in df.columns if c not in lead and c != target]
    tail = [target] if target and target in df.columns else []
    return df.select(*[F.col(f"`{c}`") for c in lead + rest + tail])
