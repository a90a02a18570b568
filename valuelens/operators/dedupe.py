"""Keyed dedupe, step accounting, collision suffixes (A1, A2, W9) and set operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedupe_keep_last(df: DataFrame, key: Sequence[str] | str, order: Sequence[str]) -> DataFrame:
    """A1: one row per key, the one with the greatest ``order`` tuple.

    Written as ``groupBy(key).agg(max_by(row, order))`` rather than a
    ``row_number`` window: ``max_by`` is combined map-side, so a key holding a
    large share of all rows is reduced inside every map task before the
    shuffle instead of being sorted in a single task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    others = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in others])
    ordering = F.struct(*[F.col(c) for c in order])
    return df.groupBy(*keys).agg(F.max_by(row, ordering).alias("__row")).select(*keys, "__row.*")


def dedupe_keep_first(df: DataFrame, key: Sequence[str] | str, order: Sequence[str]) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    others = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in others])
    ordering = F.struct(*[F.col(c) for c in order])
    return df.groupBy(*keys).agg(F.min_by(row, ordering).alias("__row")).select(*keys, "__row.*")


def step_audit(before: DataFrame, after: DataFrame, step: str) -> DataFrame:
    """A2: rows in, rows out, removed and kept % for one cleaning step (two count aggregates, one row)."""
    a = before.agg(F.count(F.lit(1)).alias("rows_in"))
    b = after.agg(F.count(F.lit(1)).alias("rows_out"))
    return a.crossJoin(b).select(
        F.lit(step).alias("step"), "rows_in", "rows_out",
        (F.col("rows_in") - F.col("rows_out")).alias("removed"),
        (F.try_divide(F.col("rows_out"), F.col("rows_in")) * 100).alias("kept_pct"),
    )


def position_in_group(df: DataFrame, group: Sequence[str], order: Sequence[str], out: str = "_seq",
                      partitions: int | None = None, materialize: bool = True) -> DataFrame:
    """0-based position of each row inside its group by ``order``; exact and safe for hot groups.

    A ``row_number`` window would sort a whole group in one task. Instead the
    rows are range-partitioned on (group, order) -- the sampled range bounds
    split a hot group over many tasks -- numbered inside each (range
    partition, group), and shifted by the row counts of the same group in
    earlier range partitions (a small table: one row per partition and group
    present in it). ``order`` must make rows unique within a group for the
    result to be deterministic.
    """
    keys = [*group, *order]
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *keys).withColumn("__pid", F.spark_partition_id())
    if materialize:
        # the partition id must be the same for both consumers below (counts and numbering):
        # write it once to the shared checkpoint folder instead of relying on exchange reuse
        from valuelens.session import cut_lineage

        ranged = cut_lineage(ranged)
    counts = ranged.groupBy("__pid", *group).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*group).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__off", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    local = ranged.withColumn("__rn", F.row_number().over(Window.partitionBy("__pid", *group).orderBy(*order)))
    # null groups are groups like others
    before = offsets.select(F.col("__pid").alias("__p2"), "__off", *[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)])
    same = F.col("__pid") == F.col("__p2")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    j = local.join(before, same, "left")
    return j.withColumn(out, F.col("__off") + F.col("__rn") - 1).drop(
        "__pid", "__p2", "__rn", "__off", *[f"__g{i}" for i in range(len(group))])


def collision_suffix(df: DataFrame, base: str, scope: Sequence[str], order: Sequence[str], out: str = "id",
                     method: str = "range") -> DataFrame:
    """Ids unique within a scope: in ``order``, a row gets its base id if that is free, else base-1, base-2, ... whichever is the first free.

    ``range`` (default) numbers rows with :func:`position_in_group`, which
    spreads a hot group over many tasks; ``window`` is the plain
    ``row_number`` over (scope, base), one group per task.

    Rows of a base count up; only a base that reads like another one's suffixed id (``a`` and ``a-1``) can take a
    number from it or lose its plain id to it. Such pairs are found on the table of bases; who
    comes first is settled on them, in rounds until nothing changes, and later rows of the base move up. Rows with a null
    base keep a null id. ``order`` must make rows unique within a scope.
    """
    if method == "window":
        numbered = df.withColumn("__k", F.row_number().over(Window.partitionBy(*scope, base).orderBy(*order)) - 1)
    else:
        numbered = position_in_group(df, [*scope, base], order, "__k")
    names = [f"__s{i}" for i in range(len(scope))]
    slim = numbered.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(scope, names)], F.col(f"`{base}`").alias("__base"), F.col("__k"),
                           F.struct(*[F.col(f"`{c}`") for c in order]).alias("__t")).where("__base is not null")
    skips = _taken_numbers(slim, names)
    if skips is None:
        number = F.col("__k")
    else:
        same = F.col(f"`{base}`") == F.col("__base")
        for c, n in zip(scope, names):
            same = same & F.col(f"`{c}`").eqNullSafe(F.col(n))
        numbered = numbered.join(skips, same, "left")
        # the k-th number from the first one on that is not taken
        passed = F.size(F.filter(F.coalesce("__from", F.array().cast("array<bigint>")), lambda x: x <= F.col("__k")))
        number = F.coalesce("__first", F.lit(0)) + F.col("__k") + passed
    named = numbered.withColumn(out, F.when(number == 0, F.col(f"`{base}`")).otherwise(F.concat(F.col(f"`{base}`"), F.lit("-"), number.cast("string"))))
    return named.drop("__k", "__base", "__first", "__from", *names)


def _taken_numbers(rows: DataFrame, scope: list[str]) -> DataFrame | None:
    """(scope..., __base, __first, __from) of bases whose rows do not simply count from 0; None if no base reads like
    another one's suffixed id.

    __first: 1 if the base's plain id is gone before its first row; __from: the places of its rows from which on one more
    number is passed over.
    """
    from valuelens.session import settled

    bases = rows.groupBy(*scope, "__base").agg(F.min("__t").alias("__t0"))
    suffix = F.regexp_extract("__base", r"-([1-9][0-9]{0,17})$", 1)
    child = bases.select(*scope, F.col("__base").alias("child"), F.col("__t0").alias("ct"), suffix.try_cast("long").alias("j"),
                         F.expr("left(__base, length(__base) - length(regexp_extract(__base, '-([1-9][0-9]{0,17})$', 0)))").alias("parent")).where("j is not null")
    match = F.col("parent") == F.col("__base")
    up = bases.select("__base", *[F.col(n).alias(f"{n}u") for n in scope])
    for n in scope:
        match = match & F.col(n).eqNullSafe(F.col(f"{n}u"))
    pairs = child.join(up, match, "left_semi")
    if not pairs.take(1):
        return None
    # a pair: number j of the parent against the plain id of the child; taken: by the parent, skipped: lost to the child
    state = settled(pairs.withColumn("taken", F.lit(False)).withColumn("skipped", F.lit(False)))
    keys = [*scope, "parent"]
    order = Window.partitionBy(*keys).orderBy("j").rowsBetween(Window.unboundedPreceding, -1)

    def same(left: Sequence[str], right: Sequence[str]):
        cond = F.lit(True)
        for x, y in zip(left, right):
            cond = cond & F.col(x).eqNullSafe(F.col(y))
        return cond

    marks = [f"{n}m" for n in scope]
    while True:
        # does the parent itself begin with number 1?
        late = state.where("taken").select(*[F.col(n).alias(m) for n, m in zip(scope, marks)], F.col("child").alias("late"))
        at = state.join(late, same([*scope, "parent"], [*marks, "late"]), "left").withColumn("first", F.col("late").isNotNull().cast("long")).drop("late", *marks)
        at = at.withColumn("place", F.col("j") - F.col("first") - F.coalesce(F.sum(F.col("skipped").cast("long")).over(order), F.lit(0)))
        there = rows.select(*[F.col(n).alias(m) for n, m in zip(scope, marks)], F.col("__base").alias("pb"), F.col("__k").alias("pk"), F.col("__t").alias("pt"))
        met = at.join(there, same([*scope, "parent", "place"], [*marks, "pb", "pk"]), "left")
        # the child's first row needs its plain id at its own time
        new = settled(met.select(*scope, "child", "ct", "j", "parent", (F.col("pt").isNotNull() & (F.col("pt") < F.col("ct"))).alias("taken"),
                                 (F.col("pt").isNotNull() & (F.col("pt") >= F.col("ct"))).alias("skipped"), "first"))
        before = state.select(*[F.col(n).alias(m) for n, m in zip(scope, marks)], F.col("child").alias("c2"), F.col("taken").alias("t2"), F.col("skipped").alias("s2"))
        moved = new.join(before, same([*scope, "child"], [*marks, "c2"])).where("taken <> t2 or skipped <> s2").take(1)
        state = new.drop("first")
        if not moved:
            break
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("j")) - 1
    passed = new.where("skipped").withColumn("at", F.col("j") - F.col("first") - rank)
    passed = passed.groupBy(*scope, F.col("parent").alias("__base")).agg(F.sort_array(F.collect_list("at")).alias("__from"))
    late = new.where("taken").select(*scope, F.col("child").alias("__base"), F.lit(1).alias("__first"))
    renamed = late.select(*[F.col(n).alias(m) for n, m in zip(scope, marks)], F.col("__base").alias("b2"), "__first")
    both = passed.join(renamed, same([*scope, "__base"], [*marks, "b2"]), "full")
    return settled(both.select(*[F.coalesce(n, m).alias(n) for n, m in zip(scope, marks)], F.coalesce("__base", "b2").alias("__base"), "__first", "__from"))


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Union all by column name; columns missing in a frame become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def top_bottom_union(df: DataFrame, order_col: str, k: int, tiebreak: Sequence[str] = ()) -> DataFrame:
    """U2 + T3: top-k and bottom-k rows by ``order_col``; a row in both appears twice (union all)."""
    top = df.orderBy(F.col(order_col).desc(), *tiebreak).limit(k).withColumn("side", F.lit("top"))
    bottom = df.orderBy(F.col(order_col).asc(), *tiebreak).limit(k).withColumn("side", F.lit("bottom"))
    return top.unionByName(bottom)


def column_set_diff(a: Sequence[str], b: Sequence[str]) -> list[str]:
    """U4: columns of ``a`` not in ``b``, order kept."""
    bs = set(b)
    return [c for c in a if c not in bs]


def column_set_intersect(a: Sequence[str], b: Sequence[str]) -> list[str]:
    bs = set(b)
    return [c for c in a if c in bs]
