"""Sharding (6): a consistent-hash ring with virtual nodes and bounded loads.

Every shard stands at ``replicas`` places on a 64-bit ring. A key belongs to the next place
clockwise; keys of a shard that is full go on clockwise to the next shard that is not. Loads
are bounded by floor or ceil of the mean, so row counts differ by one at most, and a change
of the shard count moves few keys besides those that a plain ring would move.

Scale: only the rows per arc (shards times replicas of them) reach the driver, where the walk
is done on counts: an arc's keys, in ring order, are cut into ranges that go to one shard each.
Rows get their place in the arc across many tasks and meet the ranges in a broadcast join.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuelens.llm.tables import position_in, small_batches
from valuelens.session import ship_package


@dataclass
class Ring:
    """Places of the virtual nodes in ring order, and the shard of each."""

    at: np.ndarray
    shard: np.ndarray

    @classmethod
    def of(cls, shards: int, replicas: int) -> "Ring":
        points = sorted((int.from_bytes(hashlib.sha256(f"{s}#{r}".encode()).digest()[:8], "big"), s)
                        for s in range(shards) for r in range(replicas))
        return cls(np.array([p[0] for p in points], dtype=np.uint64), np.array([p[1] for p in points]))

    def arc(self, key: np.ndarray) -> np.ndarray:
        """Number of the next place clockwise of each key."""
        return np.searchsorted(self.at, key, side="left") % len(self.at)


def walk(ring: Ring, rows: np.ndarray, shards: int) -> list[tuple[int, int, int, int, int]]:
    """(arc, first place, end place, shard, first slot): where each arc's keys go.

    All arcs step clockwise together. At each step a shard takes waiting keys in ring order of
    their arcs, and in ring order within an arc, while it has room.
    """
    total = int(rows.sum())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    filled = [0] * shards
    owner = ring.shard.tolist()
    n = len(owner)
    waiting = [(a, a, 0, int(c)) for a, c in enumerate(rows.tolist()) if c]  # arc, now at, first place, end place
    out = []
    while waiting:
        still = []
        for arc, at, first, end in waiting:
            s = owner[at]
            k = min(end - first, room[s] - filled[s])
            if k:
                out.append((arc, first, first + k, s, filled[s]))
                filled[s] += k
                first += k
            if first < end:
                at = (at + 1) % n
                while filled[owner[at]] == room[owner[at]]:
                    at = (at + 1) % n
                still.append((arc, at, first, end))
        waiting = still
    return out


def shard(docs: DataFrame, shards: int = 24, replicas: int = 128) -> DataFrame:
    """The rows of docs with ``shard`` (int) and ``slot`` (long, gapless from 0 in each shard).

    docs needs doc_id; all columns are kept (columns named shard or slot are replaced). Null
    ids are one key of the ring; repeated ids share a place on it but are spread over tasks, and
    over shards when theirs is full. Empty docs give no rows.
    """
    spark = docs.sparkSession
    ring = Ring.of(shards, replicas)
    n = len(ring.at)
    names = [c for c in docs.columns if c not in ("shard", "slot")]
    # places sort as unsigned: shift them into the signed order that Spark sorts by; the row's own columns travel as one, so no name clashes
    place = F.xxhash64(F.col("doc_id").cast("string")).bitwiseXOR(F.lit(-(1 << 63)))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), place.alias("pos"), F.lit(0).alias("arc"))

    def arcs(b: pa.RecordBatch) -> pa.RecordBatch:
        """Arc 0 in two parts, as rows come in ring order: n stands for its keys behind the last place."""
        key = np.asarray(b.column("pos")).view(np.uint64) ^ np.uint64(1 << 63)
        return b.set_column(b.schema.get_field_index("arc"), "arc", pa.array(np.searchsorted(ring.at, key, side="left"), pa.int32()))

    small_batches(spark)
    ship_package(spark)
    numbered = position_in(keyed, ["arc"], ["pos"], "place", derive=arcs)
    rows = np.zeros(n + 1, dtype=np.int64)
    for arc, count in numbered.groupBy("arc").count().collect():  # one row per arc at most
        rows[arc] = count
    ahead = int(rows[0])
    rows[0] += rows[n]
    last = F.col("arc") == n
    numbered = numbered.withColumn("place", F.col("place") + F.when(last, ahead).otherwise(0)).withColumn("arc", F.when(last, 0).otherwise(F.col("arc")))
    ranges = spark.createDataFrame(walk(ring, rows[:n], shards) or [(-1, 0, 0, 0, 0)], "of int, lo long, hi long, shard int, slot0 long")
    inside = (F.col("arc") == F.col("of")) & (F.col("place") >= F.col("lo")) & (F.col("place") < F.col("hi"))
    dealt = numbered.join(F.broadcast(ranges), inside)  # about one row per arc
    return dealt.select("row.*", "shard", (F.col("slot0") + F.col("place") - F.col("lo")).alias("slot"))


def write_shards(dealt: DataFrame, path: str, shards: int = 24) -> None:
    """One folder per shard, rows of a shard in slot order within each file."""
    dealt.repartition(shards, "shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
