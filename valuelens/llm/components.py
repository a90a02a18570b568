"""Connected components of a link table: union-find within tasks, then star contraction across them."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuelens.llm.tables import map_arrow, written


def _forest(pairs) -> dict:
    """Union-find with path halving: node -> smallest node of its tree, for nodes that are not roots."""
    parent: dict = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(parent) if parent[x] != x}


def _stars(batches):
    for b in batches:
        forest = _forest(zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(forest), b.schema.field(0).type), pa.array(list(forest.values()), b.schema.field(1).type)], names=["u", "v"])


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of (a, b) links but components' smallest ones.

    Links may repeat, run in either direction or join a node to itself; rows with a null end are
    left out. Each batch first shrinks to the star forest of its own union-find. Then two
    steps alternate until nothing changes: every larger neighbour of a node is tied to the
    node's smallest neighbour, and every node's smaller neighbours are tied to the smallest. Each step
    is a grouped minimum (combined before the shuffle) and a join, so no node's links meet in one task.
    """
    kind = links.schema["a"].dataType.simpleString()
    ends = links.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = written(map_arrow(ends, _stars, f"u {kind}, v {kind}").distinct())
    size = F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    state = edges.agg(*size).first()
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.withColumnRenamed("m", "v"))
        edges = written(small.distinct())
        new = edges.agg(*size).first()
        if new == state:
            break
        state = new
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
