"""Embedding near-dedup (9): PCA-ordered tiled comparison with early stops.

Vectors are scaled to length one and turned into the axes of a principal component
analysis over all vectors, so that the leading coordinates carry most of every product. Rows
of a label are cut into tiles; two tiles are compared in slices of coordinates: after a
slice, the rest of a product is at most the product of the two suffix norms, and pairs that
cannot reach the threshold any more stop; when no pair of the tiles is left, the tiles stop.
Survivors are checked by the cosine of the vectors as given, in double precision.

Equal vectors of a label are one node with a count. A task compares two tiles and returns link
counts per node and a spanning forest, not pairs. Tiles follow the first coordinate, so most pairs
of far tiles are left out by their coordinate ranges before any row is sent.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuelens.llm.components import _forest, connected_components
from valuelens.llm.tables import grouped, map_arrow, partitions, position_in, written

#: Rows of a tile, coordinates per slice, and vectors' largest dimension for which the axes are turned.
TILE, SLICE, TURNED = 1024, 8, 2048


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def _level(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two that bring their largest component to between a half and one: cosines stay the same to the
    last bit, and no square is too large or too small to be held."""
    exponent = np.frexp(np.abs(x).max(axis=1, initial=0))[1]
    half = exponent // 2  # in two steps: the factor alone may be out of range
    return np.ldexp(np.ldexp(x, -half[:, None]), (half - exponent)[:, None])


def _unit(x: np.ndarray) -> np.ndarray:
    x = _level(x)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Per dimension, the principal axes (columns, largest variance first) over all unit vectors."""

    def second_moments(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            sizes = np.asarray(b.column("dim"))
            for d in np.unique(sizes[sizes <= TURNED]).tolist():
                x = _unit(_matrix(b.column("v").filter(pa.array(sizes == d))))
                total[d] = total.get(d, 0) + x.T @ x
        for d, m in total.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(d, d), pa.int32()), pa.array(np.arange(d), pa.int32()), pa.array(list(m), pa.list_(pa.float64()))],
                                             names=["dim", "row", "m"])

    parts = map_arrow(vectors.select("dim", "v"), second_moments, "dim int, row int, m array<double>")
    summed = parts.select("dim", "row", F.posexplode("m")).groupBy("dim", "row", "pos").agg(F.sum("col").alias("s"))
    out: dict[int, np.ndarray] = {}
    for d, row, pos, s in summed.collect():  # the square of a dimension, whatever the number of rows
        out.setdefault(d, np.zeros((d, d)))[row, pos] = s
    for d, m in out.items():
        value, vector = np.linalg.eigh(m)
        out[d] = vector[:, np.argsort(-value, kind="stable")]
    return out


def tile_links(x: np.ndarray, y: np.ndarray, px: np.ndarray, py: np.ndarray, threshold: float, upper: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of rows of x and y with cosine >= threshold. px, py: unit rows in principal axes; upper: only i < j."""
    slack = 1e-9
    d = px.shape[1]
    tails = lambda p: np.sqrt(np.maximum(np.cumsum((p * p)[:, ::-1], axis=1)[:, ::-1], 0))
    tx, ty = tails(px), tails(py)
    product = px[:, :SLICE] @ py[:, :SLICE].T
    at = min(SLICE, d)
    i, j = None, None
    while True:
        if i is None:
            bound = product + (tx[:, at][:, None] * ty[:, at][None, :] if at < d else 0)
            alive = bound >= threshold - slack
            if upper:
                alive &= np.arange(len(px))[:, None] < np.arange(len(py))[None, :]
            n = int(alive.sum())
            if n == 0:
                return np.zeros(0, np.int64), np.zeros(0, np.int64)
            if at >= d or n * 8 < alive.size:  # few pairs are left: go on pair by pair
                i, j = np.nonzero(alive)
                product = product[i, j]
        else:
            bound = product + (tx[i, at] * ty[j, at] if at < d else 0)
            keep = bound >= threshold - slack
            i, j, product = i[keep], j[keep], product[keep]
            if not len(i):
                return i, j
        if at >= d:
            break
        to = min(at + SLICE, d)
        product = product + (px[:, at:to] @ py[:, at:to].T if i is None else np.einsum("nd,nd->n", px[i, at:to], py[j, at:to]))
        at = to
    x, y = _level(x), _level(y)
    nx, ny = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    cosine = np.einsum("nd,nd->n", x[i], y[j]) / (nx[i] * ny[j])
    ok = cosine >= threshold
    return i[ok], j[ok]


def near(embeddings: DataFrame, threshold: float = 0.98) -> DataFrame:
    """Per row: vec_id, n_links (other vectors linked directly), component_id (smallest vec_id reachable), kept.

    embeddings needs vec_id, embedding (array of numbers) and label; other columns are ignored.
    Rows link if labels are equal, dimensions are equal and the cosine is at least threshold. Null
    labels, null or empty vectors, zero vectors and vectors with a null or non-finite component
    link with nothing. Repeated rows are vectors of their own and link with each other; a null
    vec_id has a null component unless its vector has a row with an id. An empty table gives no rows.
    """
    spark = embeddings.sparkSession
    id_type = embeddings.schema["vec_id"].dataType.simpleString()
    v = F.col("embedding").cast("array<double>")
    base = embeddings.select("vec_id", "label", v.alias("v"))
    fine = F.col("label").isNotNull() & F.col("v").isNotNull() & F.coalesce(
        F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0), F.lit(False))
    rows = base.withColumn("ok", F.coalesce(fine, F.lit(False)))
    # equal vectors of a label are one node
    key = F.sha2(F.concat_ws(",", F.col("label").cast("string"), F.col("v").cast("array<string>").cast("string")), 256)
    rows = written(rows.withColumn("key", F.when(F.col("ok"), F.unhex(key))).select("vec_id", "key", "label", "v"))
    nodes = rows.where("key is not null").groupBy("key").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("n"), F.first("label").alias("label"), F.first("v").alias("v"))
    nodes = nodes.withColumn("dim", F.size("v"))
    turned = spark.sparkContext.broadcast(axes(rows.where("key is not null").select("v", F.size("v").alias("dim"))))

    def turn(batches):
        for b in batches:
            if not b.num_rows:
                continue
            sizes, place = np.asarray(b.column("dim")), np.zeros(b.num_rows)
            p = np.empty(b.num_rows, dtype=object)
            for d in np.unique(sizes).tolist():
                on = np.flatnonzero(sizes == d)
                x = _unit(_matrix(b.column("v").take(pa.array(on))))
                x = x @ turned.value[d] if d in turned.value else x
                place[on] = x[:, 0]
                for r, values in zip(on.tolist(), x):
                    p[r] = values
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(place), pa.array(list(p), pa.list_(pa.float64()))], names=[*b.schema.names, "lead", "p"])

    kinds = {f.name: f.dataType.simpleString() for f in nodes.schema}
    flat = map_arrow(nodes.select("key", "id", "n", "label", "v", "dim"), turn,
                     f"key binary, id {id_type}, n long, label {kinds['label']}, v array<double>, dim int, lead double, p array<double>")
    placed = position_in(flat, ["label", "dim"], ["lead"], "place").withColumn("tile", F.floor(F.col("place") / F.lit(TILE)).cast("int"))
    placed = placed.withColumn("cell", F.xxhash64("label", "dim"))
    placed = written(placed)
    # tiles whose ranges on the first axis are further apart than the threshold allows do not meet
    reach = (2 - 2 * threshold) ** 0.5 + 1e-9
    tiles = placed.groupBy("cell", "label", "dim", "tile").agg(F.min("lead").alias("lo"), F.max("lead").alias("hi"))
    a, b = tiles.alias("a"), tiles.alias("b")
    meet = a.join(b, (F.col("a.cell") == F.col("b.cell")) & F.col("a.label").eqNullSafe(F.col("b.label")) & (F.col("a.dim") == F.col("b.dim"))
                  & (F.col("a.tile") <= F.col("b.tile")) & (F.col("b.lo") - F.col("a.hi") <= reach))
    meet = meet.select(F.col("a.cell").alias("cell"), F.col("a.tile").alias("i"), F.col("b.tile").alias("j"))
    sides = meet.select("*", F.col("i").alias("tile")).unionByName(meet.where("i <> j").select("*", F.col("j").alias("tile")))
    cells = placed.select("cell", "tile", "key", "id", "n", "v", "p").join(sides, ["cell", "tile"])
    keys = ["cell", "i", "j"]
    cells = cells.repartition(partitions(spark), *keys).sortWithinPartitions(*keys)

    def compare(batches):
        for g in grouped(batches, keys):
            tile, n, key = np.asarray(g.column("tile")), np.asarray(g.column("n")), g.column("key")
            i, j = int(g.column("i")[0].as_py()), int(g.column("j")[0].as_py())
            left, right = np.flatnonzero(tile == i), np.flatnonzero(tile == j)
            x, p = _matrix(g.column("v")), _matrix(g.column("p"))
            s, t = tile_links(x[left], x[right], p[left], p[right], threshold, i == j)
            if not len(s):
                continue
            s, t = left[s], right[t]
            count = np.zeros(len(n), dtype=np.int64)
            np.add.at(count, s, n[t])
            np.add.at(count, t, n[s])
            forest = _forest(zip(s.tolist(), t.tolist()))
            at = np.flatnonzero(count)
            name = key.take(pa.array(at))
            up = key.take(pa.array([forest.get(q, q) for q in at.tolist()], pa.int64()))
            yield pa.RecordBatch.from_arrays([name, up, pa.array(count[at])], names=["key", "up", "links"])

    found = written(map_arrow(cells, compare, "key binary, up binary, links long"))
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    ids = placed.select("key", "id", "n")
    groups = connected_components(found.select(F.col("key").alias("a"), F.col("up").alias("b")))
    label_of = ids.join(groups.select(F.col("node").alias("key"), "component"), "key", "left").select(
        "key", "id", "n", F.coalesce("component", "key").alias("component"))
    smallest = label_of.groupBy("component").agg(F.min("id").alias("component_id"))
    per_key = label_of.join(smallest, "component").join(links, "key", "left").select(
        "key", "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    out = rows.select("vec_id", "key").join(per_key, "key", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
