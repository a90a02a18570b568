"""Driver queries for group comparison, segmentation and season features (C5, C8, C9 pieces).

The "season" table turns orders into per-customer playing statistics
(appearances = orders, minutes from prices, goals = finished orders, ...), so
the player-level operators run on data Spark derives from the test tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuelens.functions import segment as sg
from valuelens.operators import features as fe
from valuelens.operators import groupstats as gs
from valuelens.operators.lifecycle import PHASE_EDGES, PHASE_LABELS
from valuelens.operators.quantiles import quantile_columns, quantile_row, with_quantiles
from valuelens.session import settled
from valuelens.plans.registry import register, round_doubles, table


def season(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    s = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("appearances"),
        F.sum(F.floor(F.col("o_totalprice") / 1000)).cast("bigint").alias("minutes_played"),
        F.count_if(F.col("o_orderstatus") == "F").alias("goals"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("assists"),
        F.count_if(F.col("o_orderpriority") == "2-HIGH").alias("key_passes"),
        F.count_if(F.col("o_orderstatus") != "P").alias("shots"),
        (F.avg("o_totalprice") / 100000).alias("market_value"),
    )
    m = F.col("minutes_played")
    return s.withColumns({
        "shots_per90": F.when(m > 0, F.col("shots") * 90.0 / m),
        "xg_per90": F.when(m > 0, F.col("assists") * 90.0 / m * 0.8),
        "shots_on_target_pct": F.col("goals") * 100.0 / F.col("appearances"),
    })


SEASON_SQL = """
season0 AS (
  SELECT o_custkey AS c_custkey, count(*) AS appearances,
         CAST(sum(floor(o_totalprice / 1000)) AS BIGINT) AS minutes_played,
         CAST(count_if(o_orderstatus = 'F') AS BIGINT) AS goals, CAST(count_if(o_orderpriority = '1-URGENT') AS BIGINT) AS assists,
         CAST(count_if(o_orderpriority = '2-HIGH') AS BIGINT) AS key_passes, CAST(count_if(o_orderstatus <> 'P') AS BIGINT) AS shots,
         avg(o_totalprice) / 100000 AS market_value
  FROM orders GROUP BY o_custkey),
season AS (
  SELECT *, CASE WHEN minutes_played > 0 THEN shots * 90.0::DOUBLE / minutes_played END AS shots_per90,
            CASE WHEN minutes_played > 0 THEN assists * 90.0::DOUBLE / minutes_played * 0.8::DOUBLE END AS xg_per90,
            goals * 100.0::DOUBLE / appearances AS shots_on_target_pct
  FROM season0)
"""


# --- A15 / W11 ----------------------------------------------------------------------------------

_GS_SQL = """
g AS (
  SELECT o_orderpriority, count(*) AS size,
    round(min(o_totalprice), 2) AS min, round(quantile_cont(o_totalprice, 0.25), 2) AS q1,
    round(quantile_cont(o_totalprice, 0.5), 2) AS median, round(avg(o_totalprice), 2) AS mean,
    round(quantile_cont(o_totalprice, 0.75), 2) AS q3, round(max(o_totalprice), 2) AS max,
    round(stddev_samp(o_totalprice), 2) AS std
  FROM orders GROUP BY o_orderpriority),
gs AS (SELECT *, round(q3 - q1, 2) AS iqr, round(std / nullif(mean, 0) * 100, 1) AS cv_pct FROM g)
"""


def _group_stats(spark, sf_dir):
    return gs.group_stats_quartiles(table(spark, sf_dir, "orders"), "o_orderpriority", "o_totalprice", round_inputs=2)


@register("group_stats_quartiles", "WITH " + _GS_SQL + " SELECT * FROM gs")
def group_stats_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(_group_stats(spark, sf_dir))


@register(
    "pct_of_top",
    "WITH " + _GS_SQL + """
SELECT o_orderpriority, size, median, mean, round(median / max(median) OVER () * 100, 1) AS pct_vs_top FROM gs""",
)
def pct_of_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = gs.pct_of_top(_group_stats(spark, sf_dir), "median", 1)
    return round_doubles(t.select("o_orderpriority", "size", "median", "mean", "pct_vs_top"))


# --- P9 / P10 / P11 / P12 -----------------------------------------------------------------------

# Part-name classes (a second rule set for the ordered-substring classifier).
PART_RULES = [("FASTENER", ["BOLT", "RING", "ROD"]), ("MECHANISM", ["GEAR", "GIZMO", "WIDGET"])]


def _sql_rules(col: str, rules, null_label: str, default: str) -> str:
    parts = [f"CASE WHEN {col} IS NULL THEN '{null_label}'"]
    for label, needles in rules:
        cond = " OR ".join(f"contains(upper({col}), '{n}')" for n in needles)
        parts.append(f"WHEN {cond} THEN '{label}'")
    return " ".join(parts) + f" ELSE '{default}' END"


@register(
    "classify_rules",
    f"""
SELECT p_partkey, {_sql_rules("nullif(p_type, 'PROMO')", sg.POSITION_RULES, 'UNKNOWN', 'UNKNOWN')} AS type_class,
       {_sql_rules('p_name', PART_RULES, 'UNKNOWN', 'OTHER')} AS name_class,
       {_sql_rules("concat(o, '-', p_type)", sg.POSITION_RULES, 'UNKNOWN', 'UNKNOWN')} AS combo_class
FROM (SELECT *, CASE p_size % 4 WHEN 0 THEN 'GK' WHEN 1 THEN 'fw-mf' WHEN 2 THEN 'DF-MF' ELSE 'lw' END AS o FROM part)""",
)
def classify_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    o = (F.when(F.col("p_size") % 4 == 0, "GK").when(F.col("p_size") % 4 == 1, "fw-mf")
         .when(F.col("p_size") % 4 == 2, "DF-MF").otherwise("lw"))
    return p.select(
        "p_partkey",
        sg.classify_position(F.nullif(F.col("p_type"), F.lit("PROMO"))).alias("type_class"),
        sg.ordered_substring_rules("p_name", PART_RULES, "UNKNOWN", "OTHER").alias("name_class"),
        sg.classify_position(F.concat(o, F.lit("-"), F.col("p_type"))).alias("combo_class"),
    )


_PRIO = {"1-URGENT": "FW", "2-HIGH": "MF", "3-MEDIUM": "DF"}


@register(
    "one_hot",
    """
SELECT o_orderkey, pos,
  coalesce(CAST(pos = 'DF' AS INTEGER), 0) AS is_DF, coalesce(CAST(pos = 'MF' AS INTEGER), 0) AS is_MF,
  coalesce(CAST(pos = 'FW' AS INTEGER), 0) AS is_FW
FROM (SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'FW' WHEN '2-HIGH' THEN 'MF' WHEN '3-MEDIUM' THEN 'DF' END AS pos FROM orders)""",
)
def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    pos = o.select("o_orderkey", sg.map_with_default("o_orderpriority", _PRIO, None).alias("pos"))
    return pos.withColumns(sg.one_hot("pos", ["DF", "MF", "FW"]))


@register(
    "inverse_one_hot",
    """
WITH oh AS (
  SELECT o_orderkey, CAST(o_orderpriority IN ('1-URGENT', '2-HIGH') AS INTEGER) AS is_FW,
         CAST(o_orderstatus = 'O' AS INTEGER) AS is_MF, CAST(o_orderstatus = 'F' AS INTEGER) AS is_DF FROM orders)
SELECT o_orderkey, CASE WHEN is_FW = 1 THEN 'FW' WHEN is_MF = 1 THEN 'MF' WHEN is_DF = 1 THEN 'DF' ELSE 'Unknown' END AS position,
  coalesce(CASE WHEN is_FW = 1 THEN 'FW' WHEN is_MF = 1 THEN 'MF' WHEN is_DF = 1 THEN 'DF' ELSE 'Unknown' END = 'FW', false)::INTEGER AS fw_flag,
  coalesce(CASE CASE WHEN is_FW = 1 THEN 'FW' WHEN is_MF = 1 THEN 'MF' WHEN is_DF = 1 THEN 'DF' ELSE 'Unknown' END
           WHEN 'DF' THEN 'Defender (DF)' WHEN 'MF' THEN 'Midfielder (MF)' WHEN 'FW' THEN 'Forward (FW)' END, 'Other') AS position_group
FROM oh""",
)
def inverse_one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    oh = o.select(
        "o_orderkey",
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").cast("int").alias("is_FW"),
        (F.col("o_orderstatus") == "O").cast("int").alias("is_MF"),
        (F.col("o_orderstatus") == "F").cast("int").alias("is_DF"),
    )
    pos = sg.inverse_one_hot([("FW", "is_FW"), ("MF", "is_MF"), ("DF", "is_DF")])
    out = oh.select("o_orderkey", pos.alias("position"))
    return out.select(
        "o_orderkey", "position", (F.col("position") == "FW").cast("int").alias("fw_flag"),
        sg.map_with_default("position", {"DF": "Defender (DF)", "MF": "Midfielder (MF)", "FW": "Forward (FW)"}, "Other").alias("position_group"),
    )


# --- F26 / A40 ------------------------------------------------------------------------------------

# Playing-time bands (right-closed) and labels.
MINUTE_EDGES = [0, 900, 2000, float("inf")]
MINUTE_LABELS = ["Low (<900 min)", "Medium (900-2000 min)", "High (>2000 min)"]


def _sql_bins(col: str, edges, labels) -> str:
    parts = []
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        hi_s = "'infinity'::DOUBLE" if hi == float("inf") else str(hi)
        parts.append(f"WHEN {col} > {lo} AND {col} <= {hi_s} THEN '{lab}'")
    return "CASE " + " ".join(parts) + " END"


@register(
    "right_closed_bins",
    "WITH " + SEASON_SQL + f"""
SELECT c_custkey, minutes_played, {_sql_bins('minutes_played', MINUTE_EDGES, MINUTE_LABELS)} AS minutes_band,
       CAST(appearances AS INTEGER) * 3 AS age, {_sql_bins('appearances * 3', PHASE_EDGES, PHASE_LABELS)} AS phase
FROM season""",
)
def right_closed_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = season(spark, sf_dir)
    age = (F.col("appearances") * 3).cast("int")
    return s.select(
        "c_custkey", "minutes_played", sg.right_closed_bins("minutes_played", MINUTE_EDGES, MINUTE_LABELS).alias("minutes_band"),
        age.alias("age"), sg.right_closed_bins(age, PHASE_EDGES, PHASE_LABELS).alias("phase"),
    )


@register(
    "domain_complete_groups",
    "WITH " + SEASON_SQL + """,
b AS (SELECT *, """ + _sql_bins("minutes_played / 10", MINUTE_EDGES, MINUTE_LABELS) + """ AS minutes_band FROM season),
s AS (SELECT minutes_band, count(*) AS n, avg(market_value) AS mean_value FROM b WHERE minutes_band IS NOT NULL GROUP BY 1),
d AS (""" + " UNION ALL ".join(f"SELECT '{lab}' AS minutes_band, {i} AS band_ord" for i, lab in enumerate(MINUTE_LABELS)) + """)
SELECT d.minutes_band, d.band_ord, coalesce(s.n, 0) AS n, round(s.mean_value, 4) AS mean_value FROM d LEFT JOIN s USING (minutes_band)""",
)
def domain_complete_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = season(spark, sf_dir).withColumn(
        "minutes_band", sg.right_closed_bins(F.col("minutes_played") / 10, MINUTE_EDGES, MINUTE_LABELS)
    )
    stats = s.filter(F.col("minutes_band").isNotNull()).groupBy("minutes_band").agg(
        F.count(F.lit(1)).alias("n"), F.avg("market_value").alias("mean_value")
    )
    # the category domain is the fixed label list (3 rows)
    labels = spark.createDataFrame([(lab, i) for i, lab in enumerate(MINUTE_LABELS)], "minutes_band string, band_ord int")
    out = gs.domain_complete(labels, "minutes_band", stats, {"n": 0})
    return round_doubles(out.select("minutes_band", "band_ord", "n", "mean_value"))


# --- F16 / F17 / F21 / F22 / F23 / F24 --------------------------------------------------------------

@register(
    "guarded_ratios",
    "WITH " + SEASON_SQL + """
SELECT c_custkey, round(goals / CASE WHEN shots = 0 THEN 0.01::DOUBLE ELSE shots END, 4) AS conversion,
       round(key_passes / CASE WHEN assists = 0 THEN 0.01::DOUBLE ELSE assists END, 4) AS key_pass_ratio,
       round(minutes_played / CASE WHEN appearances = 0 THEN 1 ELSE appearances END, 4) AS minutes_per_game
FROM season""",
)
def guarded_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = season(spark, sf_dir)
    return round_doubles(s.select(
        "c_custkey",
        fe.guarded_ratio("goals", "shots", 0.01).alias("conversion"),
        fe.guarded_ratio("key_passes", "assists", 0.01).alias("key_pass_ratio"),
        fe.guarded_ratio("minutes_played", "appearances", 1).alias("minutes_per_game"),
    ))


def _sql_py_round(expr: str, d: int) -> str:
    return f"(round_even(({expr}) * {10 ** d}.0::DOUBLE, 0) / {10 ** d}.0::DOUBLE)"


@register(
    "per_unit_rates",
    "WITH " + SEASON_SQL + f"""
SELECT c_custkey,
  CASE WHEN minutes_played > 0 AND goals > 0 THEN {_sql_py_round('goals / (minutes_played / 90.0::DOUBLE)', 2)} END AS goals_per_90,
  CASE WHEN minutes_played > 0 AND assists > 0 THEN {_sql_py_round('assists / (minutes_played / 90.0::DOUBLE)', 2)} ELSE xg_per90 END AS assists_per_90,
  CASE WHEN minutes_played <> 0 AND appearances <> 0 THEN {_sql_py_round('minutes_played / greatest(1, appearances)', 1)} END AS minutes_per_game
FROM season""",
)
def per_unit_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = season(spark, sf_dir)
    return s.select(
        "c_custkey",
        fe.per90_rate("goals", "minutes_played").alias("goals_per_90"),
        fe.per90_rate("assists", "minutes_played", existing="xg_per90").alias("assists_per_90"),
        fe.minutes_per_game("minutes_played", "appearances").alias("minutes_per_game"),
    ).transform(round_doubles)


@register(
    "totals_from_rates",
    "WITH " + SEASON_SQL + """,
t AS (SELECT c_custkey, shots_per90, minutes_played, nullif(key_passes, 0) AS total FROM season)
SELECT c_custkey, CAST(total IS NULL AS INTEGER) AS total_missing,
  CASE WHEN (total IS NULL OR total = 0) AND shots_per90 IS NOT NULL AND minutes_played > 0
       THEN CAST(round_even(shots_per90 * (minutes_played / 90.0::DOUBLE), 0) AS BIGINT) ELSE total END AS total_filled
FROM t""",
)
def totals_from_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = season(spark, sf_dir).select("c_custkey", "shots_per90", "minutes_played", F.nullif("key_passes", F.lit(0)).alias("total"))
    return s.select("c_custkey", F.col("total").isNull().cast("int").alias("total_missing"),
                    fe.total_from_rate("shots_per90", "minutes_played", "total").alias("total_filled"))


@register(
    "efficiency_score",
    "WITH " + SEASON_SQL + """,
r AS (SELECT c_custkey,
        coalesce(goals / nullif(minutes_played / 90.0::DOUBLE, 0), 0) AS g90,
        coalesce(assists / nullif(minutes_played / 90.0::DOUBLE, 0), 0) AS a90,
        coalesce(key_passes / nullif(minutes_played / 90.0::DOUBLE, 0), 0) AS kp90 FROM season)
SELECT c_custkey, round(g90, 4) AS g90, round(a90, 4) AS a90, round((g90 * 3 + a90 * 2 + kp90 * 1) / 6, 4) AS efficiency FROM r""",
)
def efficiency_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = season(spark, sf_dir)
    r = s.select(
        "c_custkey",
        fe.rate_or_zero("goals", "minutes_played").alias("g90"),
        fe.rate_or_zero("assists", "minutes_played").alias("a90"),
        fe.rate_or_zero("key_passes", "minutes_played").alias("kp90"),
    )
    return round_doubles(r.select("c_custkey", "g90", "a90", fe.weighted_score([("g90", 3), ("a90", 2), ("kp90", 1)]).alias("efficiency")))


# --- F25 / F27 / P15 / P16 / T3 -------------------------------------------------------------------

FORWARD_SEGMENT = "AUTOMOBILE"


def forwards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forwards with finishing metrics and quadrant (medians taken before the playing-time filter). They are written
    once: medians and what queries do with them read that table."""
    c = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == FORWARD_SEGMENT).select("c_custkey")
    s = season(spark, sf_dir).join(c, "c_custkey", "left_semi").filter(F.col("market_value").isNotNull())
    f = settled(fe.finishing_metrics(s, "shots_per90", "minutes_played", "goals", "xg_per90", "shots_on_target_pct"))
    med = quantile_row(f, {"shots_med": ("shots_per90", 0.5), "conv_med": ("conversion_rate", 0.5)})
    f = f.crossJoin(F.broadcast(med)).withColumn(
        "forward_type", sg.quadrant("shots_per90", "conversion_rate", "shots_med", "conv_med")
    ).drop("shots_med", "conv_med")
    return f.filter((F.coalesce(F.col("appearances"), F.lit(0)) >= 5) & (F.coalesce(F.col("minutes_played"), F.lit(0)) >= 450))


FORWARDS_SQL = SEASON_SQL + f""",
fw0 AS (SELECT s.* FROM season s WHERE c_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = '{FORWARD_SEGMENT}')
        AND market_value IS NOT NULL),
fw1 AS (SELECT *, coalesce(shots_per90 * (minutes_played / 90.0::DOUBLE), 0) AS shots_total FROM fw0),
fw2 AS (SELECT *, CASE WHEN shots_total > 0 THEN coalesce(goals::DOUBLE, 0) / shots_total * 100 ELSE 0 END AS conversion_rate,
               coalesce(xg_per90, 0) * (coalesce(minutes_played::DOUBLE, 0) / 90.0::DOUBLE) AS xg_total,
               coalesce(shots_on_target_pct, 0) AS shot_accuracy FROM fw1),
fw3 AS (SELECT *, CASE WHEN xg_total > 0 THEN (coalesce(goals::DOUBLE, 0) - xg_total) / xg_total * 100 ELSE 0 END AS xg_overperformance FROM fw2),
med AS (SELECT median(shots_per90) AS sm, median(conversion_rate) AS cm FROM fw3),
fw AS (SELECT fw3.*, CASE WHEN shots_per90 > sm AND conversion_rate < cm THEN 'Volume Shooter'
                          WHEN shots_per90 <= sm AND conversion_rate >= cm THEN 'Clinical Finisher'
                          WHEN shots_per90 > sm AND conversion_rate >= cm THEN 'Elite Striker' ELSE 'Below Average' END AS forward_type
       FROM fw3, med WHERE coalesce(appearances, 0) >= 5 AND coalesce(minutes_played, 0) >= 450)
"""


@register(
    "quadrant_classify",
    "WITH " + FORWARDS_SQL + """
SELECT c_custkey, round(shots_per90, 4) AS shots_per90, round(conversion_rate, 4) AS conversion_rate,
       round(xg_overperformance, 4) AS xg_overperformance, round(shot_accuracy, 4) AS shot_accuracy, forward_type FROM fw""",
)
def quadrant_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = forwards(spark, sf_dir)
    return round_doubles(f.select("c_custkey", "shots_per90", "conversion_rate", "xg_overperformance", "shot_accuracy", "forward_type"))


@register(
    "undervalued_topk",
    "WITH " + FORWARDS_SQL + """,
m AS (SELECT quantile_cont(market_value, 0.5) AS mv FROM fw)
SELECT c_custkey, round(market_value, 4) AS market_value, round(conversion_rate, 4) AS conversion_rate
FROM fw, m WHERE forward_type = 'Clinical Finisher' AND market_value < mv
ORDER BY round(conversion_rate, 6) DESC, c_custkey LIMIT 5""",
)
def undervalued_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = forwards(spark, sf_dir)
    m = quantile_columns(f, [], "market_value", {"mv": 0.5})
    c = f.crossJoin(F.broadcast(m)).filter((F.col("forward_type") == "Clinical Finisher") & (F.col("market_value") < F.col("mv")))
    # rank on the rate rounded to 6 decimals so rates equal up to float noise tie, then by key
    c = c.withColumn("__rate", F.round("conversion_rate", 6))
    top = gs.top_k(c, "__rate", 5, ["c_custkey"])
    return round_doubles(top.select("c_custkey", "market_value", "conversion_rate"))


@register(
    "forward_type_summary",
    "WITH " + FORWARDS_SQL + """
SELECT forward_type, count(market_value) AS n, round(avg(market_value), 2) AS mean_value, round(median(market_value), 2) AS median_value,
       round(avg(shots_per90), 2) AS mean_shots, round(avg(conversion_rate), 2) AS mean_conversion FROM fw GROUP BY forward_type""",
)
def forward_type_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A16 on the quadrant: count / mean / median value and mean shooting per forward type, rounded to 2."""
    f = forwards(spark, sf_dir)
    g = f.groupBy("forward_type").agg(
        F.count("market_value").alias("n"), gs.np_round(F.avg("market_value"), 2).alias("mean_value"),
        gs.np_round(F.avg("shots_per90"), 2).alias("mean_shots"), gs.np_round(F.avg("conversion_rate"), 2).alias("mean_conversion"),
    )
    g = with_quantiles(g, f, ["forward_type"], "market_value", {"median_value": 0.5})
    return g.withColumn("median_value", gs.np_round(F.col("median_value"), 2))


# --- A37 ------------------------------------------------------------------------------------------

# Feature themes and their keywords (a name may count in several themes).
THEMES = [
    ("attack", ["goal", "shot", "assist", "xg", "gca", "sca", "touches_att", "npg", "npxg"]),
    ("playing_time", ["minutes", "appearances"]),
    ("passing", ["pass", "key_pass", "progressive"]),
    ("dribbling", ["take_on", "carries", "dribble"]),
    ("defence", ["tackle", "interception", "block", "recover", "aerial", "foul"]),
    ("results", ["win", "draw", "loss", "result"]),
    ("discipline", ["yellow", "red", "card"]),
    ("profile", ["age", "height", "foot", "position", "nation"]),
]


@register(
    "theme_counts",
    "WITH d AS (SELECT doc_id, lower(text) AS t FROM documents),\nc AS (\n"
    + "\nUNION ALL\n".join(
        f"SELECT '{name}' AS theme, {i} AS theme_ord, CAST(count_if(" + " OR ".join(f"contains(t, '{k}')" for k in kws) + ") AS BIGINT) AS n_items FROM d"
        for i, (name, kws) in enumerate(THEMES)
    )
    + ")\nSELECT theme, theme_ord, n_items, round(n_items * 100.0 / sum(n_items) OVER (), 4) AS share_pct FROM c WHERE n_items > 0",
)
def theme_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from valuelens.operators.themes import theme_counts as tc

    docs = table(spark, sf_dir, "documents")
    return round_doubles(tc(docs, "text", THEMES))


@register(
    "groups_above_mean",
    "WITH " + _GS_SQL + " SELECT o_orderpriority, median FROM gs WHERE median > (SELECT avg(median) FROM gs)",
)
def groups_above_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups whose (rounded) median is above the mean of the group medians."""
    return round_doubles(gs.mean_above_mean(_group_stats(spark, sf_dir), "median").select("o_orderpriority", "median"))


@register(
    "template_export",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders ORDER BY o_orderkey LIMIT 3",
)
def template_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9: first 3 rows by key without the target column (a template for upload)."""
    from valuelens.sinks.writers import template

    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    return template(o, "o_orderkey", "o_totalprice", 3)


_PARTIAL_SQL = """
partial AS (
  SELECT s.c_custkey, CAST(17 + s.c_custkey % 19 AS DOUBLE) AS age, c.c_nationkey AS nationality, s.appearances,
         s.minutes_played, s.goals, s.assists,
         CASE WHEN s.minutes_played > 0 THEN s.goals * 90.0::DOUBLE / s.minutes_played ELSE 0.0::DOUBLE END AS goals_per_90,
         CAST(s.key_passes AS DOUBLE) AS progressive_carries_per90, CAST(s.shots AS DOUBLE) AS progressive_passes_per90,
         coalesce(s.shots_per90, 0.0::DOUBLE) AS sca_per90, CAST(s.appearances * 3 AS DOUBLE) AS passes_completed_per90,
         CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'Forward' WHEN 'BUILDING' THEN 'Defender' ELSE 'Midfielder' END AS position
  FROM season s JOIN customer c ON s.c_custkey = c.c_custkey)
"""


def _profile_sql() -> str:
    from valuelens.operators.serving import DERIVED_DEFAULTS

    cols = ", ".join(f"round({e}, 6) AS {n}" if "is_" not in n else f"{e} AS {n}" for n, e in DERIVED_DEFAULTS)
    return "WITH " + SEASON_SQL + "," + _PARTIAL_SQL + f"SELECT c_custkey, {cols} FROM partial"


@register("profile_expansion", _profile_sql().replace("AS INT)", "AS INTEGER)"))
def profile_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived defaults for partial scoring profiles built from the season table."""
    from valuelens.operators.serving import DERIVED_DEFAULTS, expand_profiles

    s = season(spark, sf_dir)
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    m = F.col("minutes_played")
    partial = s.join(c, "c_custkey").select(
        "c_custkey", (17 + F.col("c_custkey") % 19).cast("double").alias("age"), F.col("c_nationkey").alias("nationality"),
        "appearances", "minutes_played", "goals", "assists",
        F.when(m > 0, F.col("goals") * 90.0 / m).otherwise(0.0).alias("goals_per_90"),
        F.col("key_passes").cast("double").alias("progressive_carries_per90"),
        F.col("shots").cast("double").alias("progressive_passes_per90"),
        F.coalesce("shots_per90", F.lit(0.0)).alias("sca_per90"),
        (F.col("appearances") * 3).cast("double").alias("passes_completed_per90"),
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", "Forward").when(F.col("c_mktsegment") == "BUILDING", "Defender")
        .otherwise("Midfielder").alias("position"),
    )
    out = expand_profiles(partial).select("c_custkey", *[n for n, _ in DERIVED_DEFAULTS])
    return round_doubles(out, 6)


_ENG_SQL = """
p AS (
  SELECT c_custkey, CAST(17 + c_custkey % 19 AS DOUBLE) AS age, minutes_played, appearances, goals, assists,
         CASE WHEN minutes_played > 0 THEN goals * 90.0::DOUBLE / minutes_played END AS goals_per_90,
         shots_per90,
         CASE WHEN minutes_played > 0 THEN key_passes * 90.0::DOUBLE / minutes_played END AS key_passes_per90,
         CAST(appearances * 3 AS DOUBLE) AS passes_completed_per90,
         CAST(goals AS DOUBLE) AS interceptions_per90, CAST(assists AS DOUBLE) AS blocks_per90,
         CAST(shots AS DOUBLE) AS progressive_passes_per90, CAST(key_passes AS DOUBLE) AS progressive_carries_per90
  FROM season)
"""


def _player_like(spark, sf_dir):
    s = season(spark, sf_dir)
    m = F.col("minutes_played")
    return s.select(
        "c_custkey", (17 + F.col("c_custkey") % 19).cast("double").alias("age"), "minutes_played", "appearances", "goals", "assists",
        F.when(m > 0, F.col("goals") * 90.0 / m).alias("goals_per_90"), "shots_per90",
        F.when(m > 0, F.col("key_passes") * 90.0 / m).alias("key_passes_per90"),
        (F.col("appearances") * 3).cast("double").alias("passes_completed_per90"),
        F.col("goals").cast("double").alias("interceptions_per90"), F.col("assists").cast("double").alias("blocks_per90"),
        F.col("shots").cast("double").alias("progressive_passes_per90"), F.col("key_passes").cast("double").alias("progressive_carries_per90"),
    )


@register(
    "engineered_features",
    "WITH " + SEASON_SQL + "," + _ENG_SQL + """
SELECT c_custkey,
  round(goals_per_90 / CASE WHEN shots_per90 = 0 THEN 0.01::DOUBLE ELSE shots_per90 END, 6) AS conversion_rate,
  round(key_passes_per90 / CASE WHEN passes_completed_per90 = 0 THEN 0.01::DOUBLE ELSE passes_completed_per90 END, 6) AS key_pass_ratio,
  round(interceptions_per90 + blocks_per90, 6) AS defensive_contribution,
  round(progressive_passes_per90 + progressive_carries_per90, 6) AS total_progressive,
  round(age * ln(1 + minutes_played), 6) AS age_experience,
  round(minutes_played / CASE WHEN appearances = 0 THEN 1 ELSE appearances END, 6) AS minutes_per_game,
  round(power(goals, 2), 6) AS goals_squared, round(power(assists, 2), 6) AS assists_squared,
  round(power(minutes_played, 2), 6) AS minutes_played_squared
FROM p""",
)
def engineered_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Guarded ratios, sums, interaction and squares on player-like columns."""
    out = fe.engineered(_player_like(spark, sf_dir))
    cols = ["conversion_rate", "key_pass_ratio", "defensive_contribution", "total_progressive", "age_experience",
            "minutes_per_game", "goals_squared", "assists_squared", "minutes_played_squared"]
    return round_doubles(out.select("c_custkey", *cols), 6)


@register(
    "value_tiers",
    "SELECT o_orderkey, " + "CASE " + " ".join(
        f"WHEN o_totalprice / 5000 < {b} THEN '{lab}'" for b, lab in zip(sg.TIER_BOUNDS, sg.TIER_LABELS)
    ) + f" ELSE '{sg.TIER_LABELS[-1]}' END AS tier FROM orders",
)
def value_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """value tier of each predicted / actual value (price / 5000 as the value in millions)."""
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", sg.value_tier(F.col("o_totalprice") / 5000).alias("tier"))


_REQUIRED = ["age", "goals", "shots_per90", "nationality_target_enc", "league_freq", "league_label_enc", "minutes_played"]


@register(
    "complete_features",
    "WITH " + SEASON_SQL + "," + _ENG_SQL + """
SELECT coalesce(CAST(age AS DOUBLE), 0) AS age, coalesce(CAST(goals AS DOUBLE), 0) AS goals,
       coalesce(CAST(shots_per90 AS DOUBLE), 0) AS shots_per90, 1.5::DOUBLE AS nationality_target_enc,
       1.0::DOUBLE AS league_freq, 0.0::DOUBLE AS league_label_enc, coalesce(CAST(minutes_played AS DOUBLE), 0) AS minutes_played
FROM p""",
)
def complete_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Required model inputs in order; absent ones filled by name rule, NULL -> 0."""
    from valuelens.schema import complete_features as cf

    return cf(_player_like(spark, sf_dir), _REQUIRED)
