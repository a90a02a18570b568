"""Mixing sources to target weights (3): subset-sum budget fitting.

Documents are counted by exact length per source. A source's target is met by whole passes
over it plus a remaining budget. For that budget every length first gives its proportional
share of documents; what is left is fitted by longest-first steps down to ``window`` words
and by a bounded-knapsack table over the remaining counts from there, which finds the
largest reachable sum. The documents of a length are chosen in a seeded hash order.

Scale: texts are read once; sources are fitted in parallel from (length, count) rows, at most
one per distinct length; documents of one (source, length) are numbered across many tasks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from valuelens.llm import words as W
from valuelens.llm.tables import filtered_shuffles, map_arrow, position_in, written

#: Weights of the sources in code-point order, repeated.
WEIGHTS = (3, 1, 2)
#: Documents of each length that the proportional share leaves to the fit.
FREE = 8


def reach(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Copies of each size whose sum is the largest one not over ``budget`` (bounded knapsack).

    ``origin[s]`` holds the item that first reached sum s; an item is 1, 2, 4, ... copies of a size.
    """
    take = np.zeros(len(sizes), dtype=np.int64)
    origin = np.full(budget + 1, -1, dtype=np.int64)
    seen = np.zeros(budget + 1, dtype=bool)
    seen[0] = True
    items: list[tuple[int, int]] = []
    for i, (size, left) in enumerate(zip(sizes.tolist(), counts.tolist())):
        if size <= 0 or size > budget:
            continue
        left, copies = min(left, budget // size), 1
        while left > 0 and not seen[budget]:
            m = min(copies, left)
            step = m * size
            if step <= budget:
                new = np.flatnonzero(seen[:-step] & ~seen[step:]) + step
                origin[new] = len(items)
                seen[new] = True
                items.append((i, m))
            left -= m
            copies *= 2
        if seen[budget]:
            break
    at = int(np.flatnonzero(seen)[-1])
    while at > 0:
        i, m = items[origin[at]]
        take[i] += m
        at -= int(sizes[i]) * m
    return take


def fit(sizes: np.ndarray, counts: np.ndarray, target: float, window: int = 1 << 16) -> tuple[int, np.ndarray]:
    """Whole passes, and how many documents of each size to take once more, for a source."""
    total = int((sizes * counts).sum())
    take = np.zeros(len(sizes), dtype=np.int64)
    if total == 0:
        return 0, take
    passes = min(int(target // total), 2)
    budget = int(round(target - passes * total)) if passes < 2 else 0
    if budget >= total:
        return passes + 1, take
    # a proportional share, less a few documents of each length that stay free for the fit
    take = np.array([max(0, int(c) * budget // total - FREE) for c in counts.tolist()])
    take[sizes == 0] = 0
    budget -= int((take * sizes).sum())
    for i in np.argsort(-sizes, kind="stable").tolist():
        if budget <= window:
            break
        if sizes[i] > 0:
            more = min(int(counts[i] - take[i]), (budget - window) // int(sizes[i]))
            take[i] += more
            budget -= more * int(sizes[i])
    # longest first: the table then reaches far sums early
    order = np.argsort(-sizes, kind="stable")
    take[order] += reach(sizes[order], (counts - take)[order], min(budget, window + int(sizes.max())))
    return passes, take


def targets(sources: DataFrame, share: float, weights=WEIGHTS, cap: float = 2.0) -> DataFrame:
    """(source, source_size) rows with rank and target added.

    Targets share ``share`` times all sizes by weight; one stops at ``cap`` times its source's size
    and the rest is shared anew, until none is above. Each step is one sum over the sources.
    """
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = sources.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)  # a row per source
    ranked = written(ranked.withColumn("weight", w))
    full = F.col("source_size") * cap
    budget = float(ranked.agg(F.sum("source_size")).first()[0] or 0) * share
    level, last = 0.0, 0
    while True:
        above = F.col("weight") * level > full if level else F.lit(False)
        fixed, weight, n = ranked.agg(F.sum(F.when(above, full).otherwise(0.0)), F.sum(F.when(above, 0.0).otherwise(F.col("weight"))),
                                      F.sum(above.cast("int"))).first()
        if not weight:
            break
        new = (budget - fixed) / weight
        if level and n == last:
            break
        level, last = new, n
    return ranked.withColumn("target", F.least(F.col("weight") * level, full))


def sizes(docs: DataFrame, seed: int, text_column: str = "text") -> DataFrame:
    """(doc_id, source, key, size): key is a seeded hash of doc_id and text, size the number of words."""
    slim = docs.select("doc_id", "source", F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), F.col(text_column)).alias("key"),
                       F.col(text_column).alias("text"))

    def count(batches):
        for b in W.pieces(batches):
            n = W.split(b.column("text"), W.NONSPACE).counts
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(n, pa.int64())], names=["doc_id", "source", "key", "size"])

    kinds = {f.name: f.dataType.simpleString() for f in slim.schema}
    return map_arrow(slim, count, f"doc_id {kinds['doc_id']}, source {kinds['source']}, key long, size long")


def mix(docs: DataFrame, share: float = 1.5, weights=WEIGHTS, cap: float = 2.0, seed: int = 17, window: int = 1 << 16) -> DataFrame:
    """Per row of docs: doc_id, key, source, size, source_size, target, times (copies the mix takes), taken (words).

    docs needs doc_id, source and text; other columns are ignored. Null text has size 0 and is
    taken in whole passes only. Null sources are one source, last in order. Repeated rows are
    rows of their own; which of several equal rows is taken does not matter. Empty docs: no rows.
    """
    slim = written(sizes(docs, seed))
    lengths = slim.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    goal = targets(lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), share, weights, cap)

    def plan(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("size", ignore_index=True)
        passes, take = fit(pdf["size"].to_numpy(), pdf["n"].to_numpy(), float(pdf["target"].iloc[0]), window)
        return pdf[["rank", "size"]].assign(passes=passes, more=take)

    by_rank = lengths.alias("l").join(goal.alias("g"), F.col("l.source").eqNullSafe(F.col("g.source"))).select("rank", "size", "n", "target")
    plans = by_rank.groupBy("rank").applyInPandas(plan, "rank int, size long, passes int, more long")
    numbered = position_in(slim, ["source", "size"], ["key"], "place")
    ranked = numbered.alias("d").join(goal.alias("g"), F.col("d.source").eqNullSafe(F.col("g.source"))).select("d.*", "rank", "source_size", "target")
    out = ranked.join(plans, ["rank", "size"])
    times = F.col("passes") + (F.col("place") < F.col("more")).cast("int")
    return out.select("doc_id", "key", "source", "size", "source_size", "target", times.alias("times"), (times * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, seed: int = 17, **options) -> DataFrame:
    """The rows of docs as often as the mix takes them, with docs' columns only, whatever their names.

    Rows equal in doc_id and text share their copies: each gets the same number, the first ones by place one more."""
    chosen = mix(docs, seed=seed, **options).groupBy("doc_id", "key").agg(F.sum("times").alias("total"), F.count(F.lit(1)).alias("n")).where("total > 0")
    chosen = written(chosen.select(F.col("doc_id").alias("of"), F.col("key").alias("of_key"), F.col("total").cast("long").alias("total"), "n"))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"),
                        F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), F.col("text")).alias("key"))
    # a row per document: never to be broadcast, however small it is once
    joined = keyed.join(chosen.hint("merge"), (F.col("key") == F.col("of_key")) & F.col("id").eqNullSafe(F.col("of"))).drop("of", "of_key")
    copies = joined.where("n = 1").select("row", F.col("total").alias("times"))
    if chosen.where("n > 1").take(1):
        with filtered_shuffles(docs.sparkSession):  # only such rows are shuffled once more
            many = position_in(joined.where("n > 1"), ["key", "id"], [], "place")
        many = many.select("row", (F.floor(F.col("total") / F.col("n")) + (F.col("place") < F.col("total") % F.col("n")).cast("long")).alias("times"))
        copies = copies.unionByName(many.where("times > 0"))
    return copies.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).select("row.*")
