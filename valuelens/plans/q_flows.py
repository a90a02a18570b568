"""Driver queries for the composite flows on the player table Spark derives from the test tables
(rows-only checks: the player table itself is built with Spark-specific id hashing)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from valuelens.plans import flows
from valuelens.plans.players import players_from_tables
from valuelens.plans.registry import register, round_doubles


@register("clean_players")
def clean_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit the cleaning plan on the player table (five aggregate fits) and apply it."""
    raw = players_from_tables(spark, sf_dir)
    plan = flows.fit_clean(raw)
    return round_doubles(flows.transform_clean(raw, plan), 6)


@register("value_drivers")
def value_drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4: every numeric column's correlation with the value, t, p, stars, ranked."""
    raw = players_from_tables(spark, sf_dir).dropna(subset=["market_value"])
    return round_doubles(flows.drivers(flows._prepare(raw))["correlations"], 6)


@register("player_lifecycle")
def player_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C6 on players: value curve by age."""
    raw = players_from_tables(spark, sf_dir).dropna(subset=["market_value"])
    return round_doubles(flows.lifecycle(raw)["curve"], 6)


@register("player_profile")
def player_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column profile (type, non-null, nulls, distinct, sample) of the raw player table."""
    return round_doubles(flows.profile(players_from_tables(spark, sf_dir))["columns"], 6)
