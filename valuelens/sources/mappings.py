"""Fixed dimension tables (S6): scouting-report stat labels -> record fields.

Two maps per player kind are merged (the later map wins on a shared label;
the lists below share none). Unmatched labels are dropped by the inner join
that uses this table (J5).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Outfield scouting-report labels and their fields.
OUTFIELD_SCOUTING = [
    ("Goals", "goals_per_90"),
    ("Assists", "assists_per_90"),
    ("Non-Penalty Goals", "npg_per90"),
    ("xG: Expected Goals", "xg_per90"),
    ("npxG: Non-Penalty xG", "npxg_per90"),
    ("xAG: Exp. Assisted Goals", "xag_per90"),
    ("npxG + xAG", "npxg_xag_per90"),
]
OUTFIELD_DETAILED = [
    ("Shots Total", "shots_per90"),
    ("Shots on Target", "shots_on_target_per90"),
    ("Shots on Target %", "shots_on_target_pct"),
    ("Average Shot Distance", "avg_shot_distance"),
    ("Shot-Creating Actions", "sca_per90"),
    ("Goal-Creating Actions", "gca_per90"),
    ("Key Passes", "key_passes_per90"),
    ("Passes into Final Third", "passes_into_final_third_per90"),
    ("Passes into Penalty Area", "passes_into_penalty_area_per90"),
    ("Passes Completed", "passes_completed_per90"),
    ("Pass Completion %", "pass_completion_pct"),
    ("Progressive Passes", "progressive_passes_per90"),
    ("Progressive Carries", "progressive_carries_per90"),
    ("Progressive Passes Rec", "progressive_passes_rec_per90"),
    ("Successful Take-Ons", "take_ons_per90"),
    ("Successful Take-On %", "take_on_success_pct"),
    ("Carries", "carries_per90"),
    ("Carries into Final Third", "carries_into_final_third_per90"),
    ("Touches", "touches_per90"),
    ("Touches (Att 3rd)", "touches_att_third_per90"),
    ("Touches (Att Pen)", "touches_att_pen_per90"),
    ("Passes Received", "passes_received_per90"),
    ("Tackles", "tackles_per90"),
    ("Interceptions", "interceptions_per90"),
    ("Blocks", "blocks_per90"),
    ("Ball Recoveries", "ball_recoveries_per90"),
    ("Clearances", "clearances_per90"),
    ("Aerials Won", "aerials_won_per90"),
    ("% of Aerials Won", "aerial_win_pct"),
    ("Yellow Cards", "yellow_cards_per90"),
    ("Red Cards", "red_cards_per90"),
    ("Fouls Committed", "fouls_committed_per90"),
]
# Goalkeeper scouting-report labels and their fields.
GOALKEEPER_SCOUTING = [
    ("Goals Against", "goals_against_per90"),
    ("Shots on Target Against", "shots_on_target_against_per90"),
    ("Saves", "saves_per90"),
    ("Save Percentage", "save_percentage"),
    ("Clean Sheet Percentage", "clean_sheet_pct"),
]
GOALKEEPER_DETAILED = [
    ("PSxG/SoT", "psxg_per_shot"),
    ("PSxG-GA", "psxg_ga_per90"),
    ("Save% (Penalty Kicks)", "penalty_save_pct"),
    ("Passes Attempted (GK)", "passes_attempted_per90"),
    ("Launch %", "launch_pct"),
    ("Average Pass Length", "avg_pass_length"),
    ("Def. Actions Outside Pen. Area", "def_actions_outside_pen_per90"),
    ("Avg. Distance of Def. Actions", "avg_distance_def_actions"),
    ("Crosses Stopped %", "crosses_stopped_pct"),
    ("Wins", "wins_per90"),
    ("Draws", "draws_per90"),
    ("Losses", "losses_per90"),
]


def stat_mapping_rows() -> list[tuple[str, str, str]]:
    merged: dict[tuple[str, str], str] = {}
    for kind, maps in (("outfield", (OUTFIELD_SCOUTING, OUTFIELD_DETAILED)), ("goalkeeper", (GOALKEEPER_SCOUTING, GOALKEEPER_DETAILED))):
        for m in maps:
            for label, field in m:
                merged[(kind, label)] = field
    return [(k, lab, f) for (k, lab), f in merged.items()]


def stat_mapping(spark: SparkSession) -> DataFrame:
    """(kind, stat_label, field): 56 rows, a broadcastable dimension."""
    return spark.createDataFrame(stat_mapping_rows(), "kind string, stat_label string, field string")


def mapped_fields() -> list[str]:
    return list(dict.fromkeys(f for _, _, f in stat_mapping_rows()))
