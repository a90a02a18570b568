"""A raw player table (70-column record schema) derived by Spark from the test tables.

One record per customer: orders give playing time and totals, line items give
per-90 rates, nation / region give nationality and league. Keeper-only
columns are filled for keeper rows only, so the null structure of real data
(GK columns mostly empty) is reproduced. Everything is a join + aggregate over
the whole tables; the result feeds the composite flows (C1-C11).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuelens.functions.text import stable_id
from valuelens.plans.registry import table
from valuelens.schema import ATTACKING, DEFENSIVE, DISCIPLINE, KEEPER, PHYSICAL, PLAYMAKING, PROGRESSION, RAW_PLAYER, conform


def players_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    o = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem")

    per_order = li.groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("q"), F.avg("l_discount").alias("d"), F.avg("l_tax").alias("t"), F.count(F.lit(1)).alias("lines"),
    )
    oo = o.join(per_order, o.o_orderkey == per_order.l_orderkey, "left")
    season = oo.groupBy("o_custkey").agg(
        F.count(F.lit(1)).cast("int").alias("appearances"),
        F.sum(F.floor(F.col("o_totalprice") / 1000)).cast("int").alias("minutes_played"),
        F.count_if(F.col("o_orderstatus") == "F").cast("int").alias("goals"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").cast("int").alias("assists"),
        F.avg("q").alias("q"), F.avg("d").alias("d"), F.avg("t").alias("t"), F.sum("lines").alias("lines"),
        (F.avg("o_totalprice") / 100000).alias("market_value"),
    )
    base = (c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
            .join(season, c.c_custkey == season.o_custkey, "left"))

    k = F.col("c_custkey")
    mins90 = F.col("minutes_played") / 90.0
    pos = (F.when(k % 10 == 0, "GK").when(F.col("c_mktsegment") == "AUTOMOBILE", "FW")
           .when(F.col("c_mktsegment") == "BUILDING", "DF").when(F.col("c_mktsegment") == "FURNITURE", "MF")
           .when(F.col("c_mktsegment") == "MACHINERY", "FW-MF").otherwise("DF-MF"))
    keeper = pos == "GK"
    rate_src = [F.col("q"), F.col("d") * 100, F.col("t") * 100, F.col("lines"), F.col("c_acctbal") / 1000]
    cols = {
        "player_name": F.col("c_name"),
        "age": (17 + (k % 19)).cast("double"),
        "nationality": F.col("n_name"),
        "height": F.when(F.col("c_acctbal") > 0, (165 + k % 36).cast("double")),
        "foot": F.when(k % 3 == 0, "Right").when(k % 3 == 1, "Left"),
        "position": pos,
        "current_club": F.concat(F.col("n_name"), F.lit(" "), F.initcap("c_mktsegment")),
        "league": F.initcap("r_name"),
        "appearances": F.col("appearances"), "minutes_played": F.col("minutes_played"),
        "minutes_per_game": F.round(F.col("minutes_played") / F.greatest(F.lit(1), F.col("appearances")), 1),
        "goals": F.col("goals"), "assists": F.col("assists"),
        "market_value": F.col("market_value"),
    }
    outfield = ATTACKING + PLAYMAKING + PROGRESSION + DEFENSIVE + PHYSICAL + DISCIPLINE
    for i, name in enumerate(outfield):
        src = rate_src[i % len(rate_src)]
        val = F.try_divide(src * ((i % 7) + 1), F.greatest(mins90, F.lit(1.0)))
        if name.endswith("_pct"):
            val = F.least(F.abs(src) * (i % 5 + 1), F.lit(100.0))
        # a sprinkling of gaps, as in scraped data
        cols[name] = F.when((k + i) % 23 != 0, val)
    cols["goals_per_90"] = F.when(F.col("minutes_played") > 0, F.round(F.col("goals") / mins90, 2))
    cols["assists_per_90"] = F.when(F.col("minutes_played") > 0, F.round(F.col("assists") / mins90, 2))
    for i, name in enumerate(KEEPER):
        cols[name] = F.when(keeper, F.try_divide(rate_src[i % len(rate_src)], F.greatest(mins90, F.lit(1.0))))
    out = base.select(stable_id(F.col("c_name"), None, F.col("n_name")).alias("player_id"), *[v.alias(kk) for kk, v in cols.items()])
    return conform(out, RAW_PLAYER)
