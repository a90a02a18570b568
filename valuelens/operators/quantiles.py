"""Exact percentiles without a per-group value map and without moving rows.

Spark's exact ``percentile`` aggregate builds a value -> count map for every group and
merges the maps of a group in one task: a memory risk for a group holding a third of a
huge table with millions of distinct values. Here a sketch brackets each percentile and an
exact count settles it:

1. rows are counted per group; only groups of more than ACCURACY rows go on to step 2, of which there
   are at most (rows / ACCURACY);
2. for these, ``percentile_approx`` (whose rank error is at most ``rows / ACCURACY``) gives two values per
   probability that enclose the wanted rank. The brackets are counted before they are broadcast; if they are
   more than BROADCAST_GROUPS, step 3 counts distinct values first and meets the brackets by (group, salt);
3. one pass folds a large group's rows below a bracket into one count, drops those above it, and counts the rest by value,
   combined in every task before any shuffle; only about ``6 / ACCURACY`` of a large group's rows keep their value.
   A small group's rows are counted by value as they are;
4. the two values around rank ``p * (n - 1)`` are interpolated linearly (pandas / DuckDB
   ``quantile_cont`` semantics).

Steps 1 and 2 are run when a function is called (their results are of the size of a fit). Null groups are groups
like others; null values are skipped, and NaN sorts above all numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Sketch size: ranks are known to rows / ACCURACY after the first pass.
ACCURACY = 10000
#: Bracketed groups that are broadcast at most (some hundred bytes each), and salts beyond.
BROADCAST_GROUPS, SALTS = 20_000, 64


def exact_percentiles(df: DataFrame, group: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    """(group..., p, q): exact linear-interpolated percentiles of ``value`` per group (NULLs skipped).

    Groups without a value give no row."""
    probs = [float(p) for p in probs]
    found = _percentiles(df, group, value, probs)
    pairs = F.array(*[F.struct(F.lit(p).alias("p"), F.col(f"__q{k}").alias("q")) for k, p in enumerate(probs)])
    return found.where("__n > 0").select(*[F.col(f"__k{i}").alias(g) for i, g in enumerate(group)], F.inline(pairs))


def _same(names: Sequence[str]) -> Column:
    same = F.lit(True)
    for i, n in enumerate(names):
        same = same & F.col(n).eqNullSafe(F.col(f"__t{i}"))
    return same


def _brackets(src: DataFrame, names: list[str], probs: list[float]) -> tuple[DataFrame, bool] | None:
    """(table of __t0, ..., __br with a bracket per probability, whether it is small) of the groups of over ACCURACY rows; None if there is none."""
    margin = 3.0 / ACCURACY
    marks = [float(min(1.0, max(0.0, p + s * margin))) for p in probs for s in (-1, 1)]
    count, sketch = F.count(F.lit(1)).alias("__n"), F.percentile_approx("__v", marks, ACCURACY).alias("__b")
    if not names:
        large = src.agg(count, sketch).where(F.col("__n") > ACCURACY)
        rows = large.collect()
    else:
        sizes = src.groupBy(*names).agg(count).where(F.col("__n") > ACCURACY)
        rows = sizes.limit(BROADCAST_GROUPS + 1).collect()
        if 0 < len(rows) <= BROADCAST_GROUPS:
            keys = src.sparkSession.createDataFrame(rows, sizes.schema).select(*[F.col(n).alias(f"__t{i}") for i, n in enumerate(names)])
            large = src.join(F.broadcast(keys), _same(names), "left_semi").groupBy(*names).agg(count, sketch)
            rows = large.collect()
        else:
            large = src.groupBy(*names).agg(count, sketch).where(F.col("__n") > ACCURACY)
    if not rows:
        return None
    small = len(rows) <= BROADCAST_GROUPS
    table = src.sparkSession.createDataFrame(rows, large.schema) if small else large
    # open at the ends of the scale
    low, high = F.lit(float("-inf")), F.lit(float("nan"))
    br = F.array(*[F.struct(
        F.lit(i).alias("i"), F.col("__n").alias("n"),
        (low if p <= margin else F.col("__b")[2 * i]).alias("lo"),
        (high if p >= 1 - margin else F.col("__b")[2 * i + 1]).alias("hi")) for i, p in enumerate(probs)])
    return table.select(*[F.col(n).alias(f"__t{i}") for i, n in enumerate(names)], br.alias("__br")), small


def _counts(src: DataFrame, names: list[str], probs: list[float]) -> DataFrame:
    """(group..., i, n, v, c): rows per value. i is the probability of a large group's bracket (n: its rows), -1 in a small
    group; v is null for the rows below a bracket."""
    found = _brackets(src, names, probs)
    keys = [*names, "i", "n", "v"]
    plain = F.struct(F.lit(-1).alias("i"), F.lit(None).cast("long").alias("n"), F.col("__v").alias("v"))
    if found is None:
        return src.select(*names, F.inline(F.array(plain))).groupBy(*keys).agg(F.count(F.lit(1)).alias("c"))
    brackets, small = found
    # a row counts once below a bracket (value folded to NULL) or under its value within
    side = F.transform("__br", lambda b: F.when(F.col("__v") <= b["hi"], F.struct(
        b["i"].alias("i"), b["n"].alias("n"), F.when(F.col("__v") >= b["lo"], F.col("__v")).alias("v"))))
    cells = F.when(F.col("__br").isNull(), F.array(plain)).otherwise(F.filter(side, lambda s: s.isNotNull()))
    if small:
        joined = src.join(F.broadcast(brackets), _same(names), "left") if names else src.crossJoin(F.broadcast(brackets))
        return joined.select(*names, F.inline(cells)).groupBy(*keys).agg(F.count(F.lit(1)).alias("c"))
    values = src.groupBy(*names, "__v").agg(F.count(F.lit(1)).alias("__c")).withColumn("__s", F.pmod(F.xxhash64("__v"), F.lit(SALTS)))
    spread = brackets.withColumn("__u", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = values.join(spread, _same(names) & (F.col("__s") == F.col("__u")), "left")
    return joined.select(*names, "__c", F.inline(cells)).groupBy(*keys).agg(F.sum("__c").alias("c"))


def _percentiles(df: DataFrame, group: Sequence[str], value: str, probs: list[float]) -> DataFrame:
    """A row per group: __k0, __k1, ..., __n (its values) and __q0, __q1, ... by probability."""
    names = [f"__k{i}" for i in range(len(group))]
    src = df.select(*[F.col(f"`{g}`").alias(n) for g, n in zip(group, names)], F.col(f"`{value}`").cast("double").alias("__v")).where("__v is not null")
    part = Window.partitionBy(*names, "i")
    before = F.sum("c").over(part.orderBy(F.col("v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1))
    ranked = _counts(src, names, probs).withColumn("before", F.coalesce(before, F.lit(0))).withColumn("n", F.coalesce("n", F.sum("c").over(part)))

    def at(k: int, rank: Column) -> Column:
        here = F.col("v").isNotNull() & ((F.col("i") < 0) | (F.col("i") == k)) & (F.col("before") <= rank) & (rank < F.col("before") + F.col("c"))
        return F.max(F.when(here, F.col("v")))

    both = [e for k, p in enumerate(probs) for e in (at(k, F.floor(F.lit(p) * (F.col("n") - 1))).alias(f"__a{k}"), at(k, F.ceil(F.lit(p) * (F.col("n") - 1))).alias(f"__b{k}"))]
    wide = ranked.groupBy(*names).agg(F.coalesce(F.max("n"), F.lit(0)).alias("__n"), *both)

    def between(k: int, p: float) -> Column:
        a, b, pos = F.col(f"__a{k}"), F.col(f"__b{k}"), F.lit(p) * (F.col("__n") - 1)
        return F.when(a == b, a).otherwise(a + (b - a) * (pos - F.floor(pos)))

    return wide.select(*names, "__n", *[between(k, p).alias(f"__q{k}") for k, p in enumerate(probs)])


def measured(table: DataFrame) -> DataFrame:
    """A table of a row per group, computed now: to be broadcast if it has at most BROADCAST_GROUPS rows, else as it is."""
    rows = table.limit(BROADCAST_GROUPS + 1).collect()
    return F.broadcast(table.sparkSession.createDataFrame(rows, table.schema)) if len(rows) <= BROADCAST_GROUPS else table


def quantile_columns(df: DataFrame, group: Sequence[str], value: str, names: dict[str, float]) -> DataFrame:
    """One row per group with a column for each named probability. Without groups it is one row in all, computed at once."""
    wide = _wide(df, group, value, names)
    out = wide.select(*[F.col(f"__k{i}").alias(g) for i, g in enumerate(group)], *[F.col(f"__q_{n}").alias(n) for n in names])
    return out if group else df.sparkSession.createDataFrame(out.collect(), out.schema)


def quantile_row(df: DataFrame, wanted: dict[str, tuple[str, float]]) -> DataFrame:
    """One row with a column per name, the percentile (column, p) of ``df``: all of them over one long form, computed at once."""
    columns = sorted({c for c, _ in wanted.values()})
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("x")) for c in columns])))
    rows = exact_percentiles(long, ["column"], "x", sorted({float(p) for _, p in wanted.values()})).collect()
    found = {(r["column"], r.p): r.q for r in rows}
    return df.sparkSession.createDataFrame([tuple(found.get((c, float(p))) for c, p in wanted.values())], ", ".join(f"`{n}` double" for n in wanted))


def _wide(df: DataFrame, group: Sequence[str], value: str, names: dict[str, float]) -> DataFrame:
    q = _percentiles(df, group, value, [float(p) for p in names.values()])
    return q.select(*[f"__k{i}" for i in range(len(group))], *[F.col(f"__q{k}").alias(f"__q_{n}") for k, n in enumerate(names)])


def with_quantiles(stats: DataFrame, df: DataFrame, group: Sequence[str], value: str, names: dict[str, float]) -> DataFrame:
    """``stats`` (a row per group) with quantile columns of ``df`` joined on; null groups match."""
    q = _wide(df, group, value, names)
    if not group:
        joined = stats.crossJoin(F.broadcast(q))
    else:
        same = F.lit(True)
        for i, g in enumerate(group):
            same = same & F.col(f"`{g}`").eqNullSafe(F.col(f"__k{i}"))
        joined = stats.join(q, same, "left")
    return joined.withColumnsRenamed({f"__q_{n}": n for n in names}).drop(*[f"__k{i}" for i in range(len(group))])
