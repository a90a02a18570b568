"""Player records from stored pages (the collection stage re-aimed as one Spark plan).

profile pages --S12--> profile fields
             --S13/S14--> (label, per90) pairs --F2--> numbers --J5--> one column per field
club pages   --S11--> basics per player URL --J2--> overlay (non-NULL club values win)
then the stable id (F6), age as of a date (F7), per-90 rates from totals (F21), collision
suffixes per league (W9) and the fixed 70-column schema (K2).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuelens.functions.text import age_asof, signed_number, stable_id
from valuelens.operators.dedupe import collision_suffix
from valuelens.operators.features import minutes_per_game, per90_rate
from valuelens.operators.joins import label_to_wide, overlay
from valuelens.schema import RAW_PLAYER, conform
from valuelens.sources import html as hx
from valuelens.sources.mappings import mapped_fields, stat_mapping

BASICS = ["appearances", "minutes_played", "goals", "assists"]


def records_from_pages(player_pages: DataFrame, as_of: str, club_rows: DataFrame | None = None,
                       league: str | None = None, club: str | None = None, keep_person_id: bool = False) -> DataFrame:
    """70-column records; with ``keep_person_id`` the id WITHOUT the collision suffix is kept as
    ``person_id`` so a player who moved clubs can be deduplicated per person, not per stint."""
    spark = player_pages.sparkSession
    prof = hx.profile_fields(player_pages).withColumn(
        "kind", F.when(F.upper(F.coalesce(F.col("position"), F.lit(""))) == "GK", "goalkeeper").otherwise("outfield"))
    pairs = hx.stat_pairs(player_pages).join(prof.select("page_id", "kind"), "page_id")
    pairs = pairs.withColumn("value", signed_number("per90"))
    wide = label_to_wide(pairs, "page_id", "stat_label", "value", ["pos"], stat_mapping(spark), mapped_fields(), kind_col="kind")
    rec = prof.join(wide, "page_id", "left").join(player_pages.select("page_id", F.col("url").alias("player_url")), "page_id")
    rec = rec.withColumns({c: F.lit(None).cast("int") for c in BASICS})
    if club_rows is not None:
        basics = club_rows.select("player_url", *BASICS, *[c for c in ["league", "current_club"] if c in club_rows.columns])
        basics = basics.dropDuplicates(["player_url"])
        rec = overlay(rec, basics, "player_url", BASICS)
        for c in ["league", "current_club"]:
            if c in basics.columns:
                rec = rec.join(basics.select("player_url", F.col(c).alias(f"__{c}")), "player_url", "left").withColumn(
                    c, F.col(f"__{c}")).drop(f"__{c}")
    if "league" not in rec.columns:
        rec = rec.withColumn("league", F.lit(league))
    if "current_club" not in rec.columns:
        rec = rec.withColumn("current_club", F.lit(club))
    rec = rec.withColumn("age", age_asof("dob", as_of).cast("double"))
    rec = rec.withColumn("base_id", stable_id("player_name", "dob", "nationality"))
    rec = collision_suffix(rec, "base_id", ["league"], ["page_id"], "player_id")
    rec = rec.withColumns({
        "minutes_per_game": minutes_per_game("minutes_played", "appearances"),
        "goals_per_90": per90_rate("goals", "minutes_played", "goals_per_90"),
        "assists_per_90": per90_rate("assists", "minutes_played", "assists_per_90"),
    })
    if keep_person_id:
        return conform(rec.withColumnRenamed("base_id", "person_id"), RAW_PLAYER, keep=["person_id"])
    return conform(rec, RAW_PLAYER)
