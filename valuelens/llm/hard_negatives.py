"""Hard negatives (12): an inverted multi-index with certified score windows.

Vectors are cut into two halves; each half has a codebook, and a pair of codes is a cell. Rows are dealt
into shards of consecutive cells, of bounded size, and every anchor of a stated set meets every shard (rows are
never paired among themselves in a join). Within a shard an anchor visits cells by a multi-sequence heap
in order of the sum of two half-score bounds: product with the centre of a code's rows plus the anchor's norm
times their radius. It stops as soon as the next bound is below everything still wanted: the
last of the positives, or the last negative of every window. So codebooks decide about speed only; results are exact.

Two passes: the first finds each anchor's positives, the second the negatives of each positive's score window.
"""

from __future__ import annotations

from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from valuelens.llm.tables import map_arrow, partitions, position_in, written

#: Codes of a half; rows and values of the sample that fits the codebooks; values of a shard at most; rows scored together.
CODES, SAMPLE_ROWS, SAMPLE_VALUES, SHARD_VALUES, TOGETHER = 16, 4096, 1 << 19, 1 << 22, 1024

LEAST, MOST = -(1 << 63), (1 << 63) - 1


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _centres(x: np.ndarray, rounds: int = 8) -> np.ndarray:
    """k-means of the rows of x from their first distinct rows."""
    _, first = np.unique(x, axis=0, return_index=True)
    c = x[np.sort(first)[:CODES]].copy()
    for _ in range(rounds):
        code = _nearest(x, c)
        for k in range(len(c)):
            if (code == k).any():
                c[k] = x[code == k].mean(axis=0)
    return c


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    with np.errstate(all="ignore"):
        return np.argmin(np.nan_to_num((c * c).sum(axis=1)[None, :] - 2 * (x @ c.T), nan=np.inf, posinf=np.inf, neginf=-np.inf), axis=1)


def codebooks(rows: DataFrame, n: int, widest: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per dimension the centres of both halves, fitted on distinct vectors drawn by hash; bounded in rows and values."""
    most = min(SAMPLE_ROWS, max(CODES, SAMPLE_VALUES // max(widest, 1)))
    one_in = -(-n // most) or 1
    drawn = rows.select("dim", "q").where(F.pmod(F.xxhash64("q"), F.lit(one_in)) == 0).distinct().limit(most).collect()
    out = {}
    for d in {r.dim for r in drawn if r.dim}:
        x = np.array([r.q for r in drawn if r.dim == d], dtype=np.float64).reshape(-1, d)
        out[d] = _centres(x[:, : d // 2]), _centres(x[:, d // 2 :])
    return out


class Shard:
    """Rows of one dimension, ordered by cell, and the search over them."""

    def __init__(self, table: pa.Table):
        self.q = _matrix(table.column("q").combine_chunks())
        self.ids = np.asarray(table.column("vec_id").fill_null(0)).astype(np.int64)
        self.no_id = np.asarray(table.column("vec_id").is_null())
        self.label, self.place = np.asarray(table.column("label")), np.asarray(table.column("place"))
        c1, c2 = np.asarray(table.column("c1")), np.asarray(table.column("c2"))
        half = self.q.shape[1] // 2
        self.half = half
        self.one, n1 = self._codes(self.q[:, :half], c1)
        self.two, n2 = self._codes(self.q[:, half:], c2)
        edge = np.flatnonzero(np.concatenate([[True], (c1[1:] != c1[:-1]) | (c2[1:] != c2[:-1])]))
        stop = np.append(edge[1:], len(c1))
        self.cells = {(i, j): (a, b) for i, j, a, b in zip(n1[edge].tolist(), n2[edge].tolist(), edge.tolist(), stop.tolist())}
        with np.errstate(all="ignore"):
            self.norm = float(np.sqrt((self.q * self.q).sum(axis=1)).max(initial=0))
        self.wide = None

    @staticmethod
    def _codes(x: np.ndarray, code: np.ndarray):
        """Centres and radii of the codes present, and each row's code among them."""
        present, at = np.unique(code, return_inverse=True)
        with np.errstate(all="ignore"):
            centre = np.stack([x[at == k].mean(axis=0) for k in range(len(present))])
            away = np.sqrt(((x - centre[at]) ** 2).sum(axis=1))
        radius = np.zeros(len(present))
        np.maximum.at(radius, at, np.where(np.isnan(away), np.inf, away))
        return (centre, radius), at

    def visit(self, a: np.ndarray, need):
        """Row numbers and scores of a by falling bound, some rows at a time, while the bound is not below need()."""
        with np.errstate(all="ignore"):
            size = float(np.sqrt(a @ a))
            exact = size * self.norm < 2.0**52  # every partial sum is then a whole number that double holds
            b = []
            for (centre, radius), part in ((self.one, a[: self.half]), (self.two, a[self.half :])):
                bound = centre @ part + float(np.sqrt(part @ part)) * radius
                b.append(np.where(np.isnan(bound), np.inf, bound))
            slack = 1e-6 + 1e-9 * size * self.norm
        slack = slack if np.isfinite(slack) else np.inf
        o1, o2 = np.argsort(-b[0], kind="stable").tolist(), np.argsort(-b[1], kind="stable").tolist()
        s1, s2 = b[0][o1].tolist(), b[1][o2].tolist()
        heap, held, n = [(-(s1[0] + s2[0]), 0, 0)], [], 0
        while heap:
            negative, i, j = heappop(heap)
            if -negative + slack < need():
                break
            if j + 1 < len(s2):
                heappush(heap, (-(s1[i] + s2[j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(s1):
                heappush(heap, (-(s1[i + 1] + s2[0]), i + 1, 0))
            cell = self.cells.get((o1[i], o2[j]))
            if cell:
                held.append(cell)
                n += cell[1] - cell[0]
                if n >= TOGETHER:
                    yield self._scores(a, held, exact)
                    held, n = [], 0
        if held:
            yield self._scores(a, held, exact)

    def _scores(self, a: np.ndarray, cells: list[tuple[int, int]], exact: bool):
        rows = np.concatenate([np.arange(lo, hi) for lo, hi in cells])
        if exact:
            return rows, (self.q[rows] @ a).astype(np.int64)
        if self.wide is None:
            self.wide = [[int(v) for v in r] for r in self.q.tolist()]
        whole = [int(v) for v in a.tolist()]
        return rows, np.array([min(max(sum(x * y for x, y in zip(self.wide[r], whole)), LEAST), MOST) for r in rows.tolist()], dtype=np.int64)


class Best:
    """The first k rows by falling score, then smaller id (null last), with scores in low .. high."""

    def __init__(self, k: int, low: int = LEAST, high: int = MOST):
        self.k, self.low, self.high = k, low, high
        self.score, self.id, self.no_id = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def need(self) -> int:
        """Scores below this cannot enter."""
        return max(self.low, int(self.score[-1])) if len(self.score) == self.k else self.low

    def add(self, shard: Shard, rows: np.ndarray, score: np.ndarray) -> None:
        fit = (score >= self.need) & (score <= self.high)
        if fit.any():
            rows = rows[fit]
            score, ids, no_id = np.append(self.score, score[fit]), np.append(self.id, shard.ids[rows]), np.append(self.no_id, shard.no_id[rows])
            first = np.lexsort((ids, no_id, ~score))[: self.k]  # ~score: falling, without overflow
            self.score, self.id, self.no_id = score[first], ids[first], no_id[first]

    def found(self) -> list[tuple[int | None, int]]:
        return [(None if z else i, s) for i, z, s in zip(self.id.tolist(), self.no_id.tolist(), self.score.tolist())]


def _search(shards: DataFrame, anchors: DataFrame, find, fields: str) -> DataFrame:
    """find(shard, anchor row as a dict) for each anchor against each shard; shards' rows come first in their task."""
    spark, keys = shards.sparkSession, ["dim", "shard"]
    rows = shards.select(*keys, F.lit(0).alias("kind"), "c1", "c2", "vec_id", "label", "place", "q", F.lit(None).cast("array<struct<id:bigint,score:bigint>>").alias("positives"))
    asks = anchors.select(*keys, F.lit(1).alias("kind"), "c1", "c2", "vec_id", "label", "place", "q", "positives")
    dealt = rows.unionByName(asks).repartition(partitions(spark), *keys).sortWithinPartitions(*keys, "kind", "c1", "c2")
    names = [f.split()[0] for f in fields.split(", ")]

    def run(batches):
        key, held, shard = None, [], None
        for b in batches:
            if not b.num_rows:
                continue
            dim, number, kind = (np.asarray(b.column(c)) for c in (*keys, "kind"))
            edge = np.flatnonzero((dim[1:] != dim[:-1]) | (number[1:] != number[:-1]) | (kind[1:] != kind[:-1])) + 1
            for lo, hi in zip([0, *edge.tolist()], [*edge.tolist(), len(dim)]):
                if (dim[lo], number[lo]) != key:
                    key, held, shard = (dim[lo], number[lo]), [], None
                part = b.slice(lo, hi - lo)
                if kind[lo] == 0:
                    held.append(part)
                    continue
                if shard is None:
                    if not held:
                        continue
                    shard, held = Shard(pa.Table.from_batches(held)), []
                out = []
                q = _matrix(part.column("q"))
                for ask, a in zip(part.select(["dim", "vec_id", "label", "place", "positives"]).to_pylist(), q):
                    out += find(shard, ask, a)
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=names)

    return map_arrow(dealt, run, fields)


def _positives(k: int):
    def find(shard: Shard, ask: dict, a: np.ndarray):
        best = Best(k)
        for rows, score in shard.visit(a, lambda: best.need):
            on = (shard.label[rows] == ask["label"]) & (shard.place[rows] != ask["place"])
            best.add(shard, rows[on], score[on])
        return [(ask["dim"], ask["place"], i, s) for i, s in best.found()]

    return find


def _negatives(k: int, low: int, high: int):
    def find(shard: Shard, ask: dict, a: np.ndarray):
        # whole scores s with low * p <= 100 * s <= high * p; none if the window is empty
        windows = [(n, p, Best(k, -(-low * p["score"] // 100), high * p["score"] // 100)) for n, p in enumerate(ask["positives"])]
        windows = [(n, p, w) for n, p, w in windows if w.low <= w.high]
        if not windows:
            return []
        for rows, score in shard.visit(a, lambda: min(w.need for _, _, w in windows)):
            on = shard.label[rows] != ask["label"]
            rows, score = rows[on], score[on]
            for _, _, w in windows:
                w.add(shard, rows, score)
        return [(ask["dim"], ask["place"], n, ask["vec_id"], p["id"], p["score"], i, s) for n, p, w in windows for i, s in w.found()]

    return find


def _first(df: DataFrame, group: list[str], score: str, name: str, k: int, rank: str) -> DataFrame:
    """The first k rows of each group; a group has k rows a shard at most."""
    order = Window.partitionBy(*group).orderBy(F.col(score).desc(), F.col(name).asc_nulls_last())
    return df.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= k)


def mine(embeddings: DataFrame, anchors: Column | None = None, label: Column | None = None, positives: int = 5, negatives: int = 10,
         low: int = 30, high: int = 90) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the rows where ``anchors`` holds.

    Components x become floor(256 * x); a score is the whole inner product. An anchor's positives are its first ``positives`` other
    rows of its label; a positive's negatives are the first ``negatives`` rows of other labels with
    low * positive_score <= 100 * negative_score <= high * positive_score. Higher scores come first, then smaller ids, null ids last.
    ``label`` (default: the column) and ``anchors`` (default: vec_id divisible by 100) are expressions over the table.

    Rows with a null label, a null vector, or a component that is null, not finite, or too large to be multiplied take no part.
    Vectors of different dimensions never meet; empty vectors score 0. Repeated rows are rows of their own, also as
    anchors. Scores beyond a long are held at its ends. An empty table, or one without anchors, gives no rows. Extra columns are ignored.
    """
    spark = embeddings.sparkSession
    anchors = F.col("vec_id") % 100 == 0 if anchors is None else anchors
    label = F.col("label") if label is None else label
    v = F.col("embedding").cast("array<double>")
    base = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), v.alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * 256) < float("inf")))
    base = base.where(F.col("label").isNotNull() & F.col("v").isNotNull() & F.coalesce(fine, F.lit(False)))
    floor = F.transform("v", lambda x: F.when(F.abs(x * 256) < 2.0**52, F.floor(x * 256).cast("double")).otherwise(x * 256))
    rows = base.select("vec_id", label.cast("long").alias("label"), floor.alias("q"), F.size("v").alias("dim"), F.coalesce(anchors, F.lit(False)).alias("anchor"))
    n, widest, largest = rows.agg(F.count(F.lit(1)), F.max("dim"), F.max(F.aggregate("q", F.lit(0.0), lambda m, x: F.greatest(m, F.abs(x))))).first()
    kind = "float" if (largest or 0) < 2.0**24 else "double"  # both hold the whole numbers exactly
    rows = rows.withColumn("q", F.col("q").cast(f"array<{kind}>"))
    books = spark.sparkContext.broadcast(codebooks(rows, n, widest or 0))

    def coded(batches):
        for b in batches:
            sizes = np.asarray(b.column("dim"))
            codes = np.zeros((2, b.num_rows), dtype=np.int32)
            for d in np.unique(sizes).tolist():
                if d in books.value and d:
                    on = np.flatnonzero(sizes == d)
                    x = _matrix(b.column("q").take(pa.array(on)))
                    for i, part in enumerate((x[:, : d // 2], x[:, d // 2 :])):
                        codes[i, on] = _nearest(part, books.value[d][i])
            yield pa.RecordBatch.from_arrays([*b.columns, *map(pa.array, codes)], names=[*b.schema.names, "c1", "c2"])

    flat = map_arrow(rows, coded, f"vec_id long, label long, q array<{kind}>, dim int, anchor boolean, c1 int, c2 int")
    placed = position_in(flat, ["dim"], ["c1", "c2", "vec_id"], "place")
    sizes = placed.groupBy("dim").agg(F.count(F.lit(1)).alias("n"))
    per = F.least(F.ceil(F.col("n") / (3 * partitions(spark))), F.floor(F.lit(SHARD_VALUES) / F.greatest("dim", F.lit(1))))
    sizes = sizes.select("dim", F.greatest(per, F.lit(1)).alias("per"), F.ceil(F.col("n") / F.greatest(per, F.lit(1))).alias("shards"))
    placed = written(placed.join(sizes, "dim").withColumn("shard", F.floor(F.col("place") / F.col("per")).cast("long")).drop("per"))
    every = placed.where("anchor").withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)))

    none = F.lit(None).cast("array<struct<id:bigint,score:bigint>>")
    found = _search(placed, every.withColumn("positives", none), _positives(positives), "dim long, place long, id long, score long")
    group = ["dim", "place"]
    best = _first(found, group, "score", "id", positives, "k").groupBy(*group).agg(F.sort_array(F.collect_list(F.struct("k", "id", "score"))).alias("top"))
    best = best.select(F.col("dim").cast("int").alias("dim"), "place", F.transform("top", lambda t: F.struct(t["id"].alias("id"), t["score"].alias("score"))).alias("positives"))
    asks = every.join(written(best), group)
    fields = "dim long, place long, k long, anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    pairs = _search(placed, asks, _negatives(negatives, low, high), fields)
    out = _first(pairs, ["dim", "place", "k"], "negative_score", "negative_id", negatives, "rank")
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
