"""Rule-based classification as native column expressions.

Every function returns a ``Column``; nothing here is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ordered_substring_rules(col: Column | str, rules: Sequence[tuple[str, Sequence[str]]], null_label: str, default: str) -> Column:
    """First rule whose any needle is a substring of ``upper(col)`` wins."""
    up = F.upper(_c(col))
    expr = F.when(_c(col).isNull(), F.lit(null_label))
    for label, needles in rules:
        cond = None
        for n in needles:
            c = up.contains(n)
            cond = c if cond is None else (cond | c)
        expr = expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


# Position classes, checked in this order, and their substrings.
POSITION_RULES = [
    ("GK", ["GK"]),
    ("DF", ["DF", "CB", "LB", "RB", "WB"]),
    ("MF", ["MF", "CM", "DM", "AM"]),
    ("FW", ["FW", "ST", "CF", "LW", "RW"]),
]


def classify_position(col: Column | str, rules=POSITION_RULES) -> Column:
    """NULL -> UNKNOWN; otherwise first matching class; no match -> UNKNOWN."""
    return ordered_substring_rules(col, rules, "UNKNOWN", "UNKNOWN")


def one_hot(col: Column | str, values: Sequence[str], prefix: str = "is_") -> dict[str, Column]:
    """P10: integer 0/1 indicator per value; NULL input gives 0."""
    return {f"{prefix}{v}": F.coalesce((_c(col) == F.lit(v)).cast("int"), F.lit(0)) for v in values}


def inverse_one_hot(indicators: Sequence[tuple[str, str]], default: str = "Unknown") -> Column:
    """First indicator equal to 1 names the class, in the given priority order."""
    expr = None
    for label, ind in indicators:
        cond = F.col(ind) == 1
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


def map_with_default(col: Column | str, mapping: dict, default) -> Column:
    """Literal lookup; unmapped or NULL -> default."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(m[_c(col)], F.lit(default))


def right_closed_bins(col: Column | str, edges: Sequence[float], labels: Sequence) -> Column:
    """label i for edges[i] < x <= edges[i+1]; outside (including the lowest edge) -> NULL."""
    c = _c(col)
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (c > F.lit(lo)) & (c <= F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def threshold_tiers(col: Column | str, bounds: Sequence[float], labels: Sequence[str]) -> Column:
    """first bound with x < bound names the tier; the last label catches the rest."""
    c = _c(col)
    expr = None
    for b, lab in zip(bounds, labels):
        expr = F.when(c < F.lit(b), F.lit(lab)) if expr is None else expr.when(c < F.lit(b), F.lit(lab))
    return expr.otherwise(F.lit(labels[len(bounds)]))


# Value tiers (million) and their names.
TIER_BOUNDS = [1, 5, 15, 40, 80]
TIER_LABELS = [
    "Lower League / Youth Player",
    "Solid Squad Player",
    "First Team Regular",
    "Key Player / Star",
    "Elite Player",
    "World Class",
]


def value_tier(col: Column | str) -> Column:
    return threshold_tiers(col, TIER_BOUNDS, TIER_LABELS)


def quadrant(x: Column | str, y: Column | str, x_med: Column | str, y_med: Column | str) -> Column:
    """quadrant against two medians; a NULL comparison falls through to Below Average."""
    xc, yc, xm, ym = _c(x), _c(y), _c(x_med), _c(y_med)
    return (
        F.when((xc > xm) & (yc < ym), F.lit("Volume Shooter"))
        .when((xc <= xm) & (yc >= ym), F.lit("Clinical Finisher"))
        .when((xc > xm) & (yc >= ym), F.lit("Elite Striker"))
        .otherwise(F.lit("Below Average"))
    )


def strength_label(r: Column | str, strong: float = 0.2, medium: float = 0.1) -> Column:
    """F32: abs(r) >= strong -> strong, >= medium -> medium, else weak."""
    a = F.abs(_c(r))
    return F.when(a >= strong, F.lit("strong")).when(a >= medium, F.lit("medium")).otherwise(F.lit("weak"))


def band(col: Column | str, bounds: Sequence[float], labels: Sequence[str]) -> Column:
    """First ``x > bound`` (bounds descending) names the band, else the last label."""
    c = _c(col)
    expr = None
    for b, lab in zip(bounds, labels):
        expr = F.when(c > F.lit(b), F.lit(lab)) if expr is None else expr.when(c > F.lit(b), F.lit(lab))
    return expr.otherwise(F.lit(labels[len(bounds)]))
