"""MinHash near-dedup (5): SuperMinHash signatures, banding, verification, union-find groups.

1. Each text gives its distinct word shingles, a SuperMinHash signature and an
   order-free 128-bit fingerprint of the set. Equal sets become one node (smallest doc_id).
2. Nodes that share a band hash are bucket mates. Every node is paired with the first node of each of its
   buckets; distinct pairs (not one per bucket) are compared by signature, and those that agree enough are
   verified on full shingle sets and grouped by union-find.
3. Buckets of three or more whose other members are still in several groups are dealt to pairs of blocks: a task holds
   at most two blocks of a bucket, compares signatures in arrays, and names the members with a possible link to
   another group; these are compared exactly, again in blocks. So links which do not run through a
   first node are found, and buckets are never expanded into all pairs as rows; the groups are then final.

No cap applies to buckets, partners or texts. With 24 bands of 5 rows, a pair at similarity 0.8 shares
no band with probability 7e-5, one at 0.85 with 2e-6. The signature test discards pairs whose estimate
is 4.5 standard errors below the threshold. Scale: signatures cost some hundred bytes per distinct text and are shuffled
once per node and once per pair; texts are shuffled only of nodes with a possible link.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuelens.llm import words as W
from valuelens.llm.components import _forest, connected_components
from valuelens.llm.superminhash import signatures
from valuelens.llm.tables import filtered_shuffles, grouped, map_arrow, partitions, written

BANDS, ROWS = 24, 5
SLOTS = BANDS * ROWS
#: Rows of a bucket that a task holds per block.
BLOCK = 1024


def shingles(texts: pa.Array, k: int, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(text, fingerprint) of the distinct shingles, by text; a text of fewer than k words has its whole sequence as one."""
    w = W.split(texts, kind)
    h, doc, counts = w.hashes(), w.doc_of(), w.counts
    s = W.chain(h, k)
    at = np.flatnonzero(doc[: len(s)] == doc[k - 1 :]) if len(s) else np.zeros(0, np.int64)
    own, e = [doc[at]], [s[at]]
    for n in range(1, k):
        short = np.flatnonzero(counts == n)
        if len(short):
            own.append(short)
            e.append(W.chain(h, n)[w.first[:-1][short]] ^ np.uint64(n))
    own, e = np.concatenate(own), np.concatenate(e)
    order = np.lexsort((e, own)) if len(texts) > 1 << 16 else np.argsort((own.astype(np.uint64) << np.uint64(48)) | (e >> np.uint64(16)), kind="stable")
    own, e = own[order], e[order]
    new = np.ones(len(e), dtype=bool)
    new[1:] = (e[1:] != e[:-1]) | (own[1:] != own[:-1])
    return own[new], e[new]


def _pack(values: np.ndarray) -> pa.Array:
    """Rows of a two-dimensional array as binaries."""
    rows = np.ascontiguousarray(values)
    width = rows.shape[1] * rows.itemsize if len(rows) else 0
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(max(width, 1)), len(rows), [None, pa.py_buffer(rows.tobytes())]).cast(pa.binary())


def _three(values: np.ndarray) -> np.ndarray:
    """The low three bytes of each value (little-endian)."""
    return np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(*values.shape, 8)[..., :3].reshape(len(values), -1)


def _unpack(column: pa.Array, slots: int) -> np.ndarray:
    raw = np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(len(column), slots, 3)
    out = np.zeros((len(column), slots, 4), dtype=np.uint8)
    out[..., :3] = raw
    return out.view("<u4")[..., 0]


def _sums(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of x over first[i]:first[i + 1], modulo 2^64."""
    return np.diff(np.concatenate([np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)])[first])


def signed(docs: DataFrame, k: int, kind: str) -> DataFrame:
    """doc_id, n (distinct shingles), s1 and s2 (fingerprint of the set), slots (binary, three bytes each)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in W.pieces(batches):
            n = b.num_rows
            own, e = shingles(b.column("text"), k, kind)
            first = np.searchsorted(own, np.arange(n + 1))
            sig = signatures(e, own, n, SLOTS)
            slot = W.mix64(sig.ravel()).reshape(n, SLOTS)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(np.diff(first)), pa.array(_sums(W.mix64(e), first).view(np.int64)),
                 pa.array(_sums(W.mix64(e ^ np.uint64(0xD6E8FEB86659FD93)), first).view(np.int64)), _pack(_three(slot))],
                names=["doc_id", "n", "s1", "s2", "slots"])

    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {id_type}, n long, s1 long, s2 long, slots binary")


def _explode_bands(batches):
    """A row per band: the hash of its slots."""
    for b in batches:
        n = b.num_rows
        if n:
            slot = _unpack(b.column("slots"), SLOTS).astype(np.uint64).reshape(n, BANDS, ROWS)
            band = np.broadcast_to(W.mix64(np.arange(1, BANDS + 1, dtype=np.uint64)), (n, BANDS)).copy()
            for r in range(ROWS):
                band = W.mix64((band ^ slot[:, :, r]).ravel()).reshape(n, BANDS)
            node = pa.array(np.repeat(np.arange(n), BANDS))
            yield pa.RecordBatch.from_arrays([pa.array(band.ravel().view(np.int64)), b.column("node").take(node), b.column("s1").take(node),
                                              pa.array(np.tile(np.arange(BANDS, dtype=np.int32), n))], names=["bucket", "node", "s1", "band"])


def _blocks(rows: DataFrame, size: str) -> DataFrame:
    """rows of buckets (bucket, node, size), dealt to block pairs i <= j: every two rows of a bucket meet in one."""
    n = F.ceil(F.col(size) / F.lit(BLOCK)).cast("int")
    mine = F.pmod(F.xxhash64("node", F.lit(7)), n).cast("int")
    pair = F.transform(F.sequence(F.lit(0), F.col("__n") - 1), lambda o: F.struct(F.least(o, F.col("__b")).alias("i"), F.greatest(o, F.col("__b")).alias("j")))
    dealt = rows.withColumn("__n", n).withColumn("__b", mine).withColumn("__p", F.explode(pair))
    return dealt.select("*", F.col("__p.i").alias("i"), F.col("__p.j").alias("j")).withColumnRenamed("__b", "block").drop("__n", "__p")


def _dealt(cells: DataFrame) -> DataFrame:
    keys = ["bucket", "i", "j"]
    return cells.repartition(partitions(cells.sparkSession), *keys).sortWithinPartitions(*keys)


def _salted(pairs: DataFrame) -> DataFrame:
    """(center, salt, role, node, s1) of (center, node, s1) pairs: the center (role 0, s1 null) once for each BLOCK of its partners (role 1)."""
    sizes = pairs.groupBy("center").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("salts"))
    salt = F.pmod(F.xxhash64("node", "s1"), F.col("salts")).cast("int")
    partners = pairs.join(sizes, "center").select("center", salt.alias("salt"), F.lit(1).alias("role"), "node", "s1")
    heads = sizes.select("center", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("role"),
                         F.col("center").alias("node"), F.lit(None).cast("long").alias("s1"))
    return heads.unionByName(partners)


def _stars(rows: DataFrame) -> DataFrame:
    """Rows of a center and some of its partners in one task, the center's first."""
    return rows.repartition(partitions(rows.sparkSession), "center", "salt").sortWithinPartitions("center", "salt", "role")


def _compare_stars(least: float, margin: float):
    """(center, node, s1) of the pairs whose signatures agree enough; an id may come with several sets."""

    def run(batches):
        key, heads, size = None, None, None
        for b in batches:
            n, sig = np.asarray(b.column("n")), _unpack(b.column("slots"), SLOTS)
            keep = np.zeros(b.num_rows, dtype=bool)
            for i, (center, salt, role) in enumerate(zip(*(b.column(c).to_pylist() for c in ("center", "salt", "role")))):
                if role == 0:
                    same = key == (center, salt)
                    heads = np.vstack([heads, sig[i : i + 1]]) if same else sig[i : i + 1]
                    size = np.append(size, n[i]) if same else n[i : i + 1]
                    key = (center, salt)
                elif key == (center, salt):
                    near = np.minimum(size, n[i]) >= least * np.maximum(size, n[i])
                    keep[i] = (near & ((heads == sig[i]).sum(axis=1) >= margin * SLOTS)).any()
            yield b.select(["center", "node", "s1"]).filter(pa.array(keep))

    return run


def _compare(least: float, margin: float):
    """Signature comparison of a block pair: (bucket, node, s1) of the nodes with a possible link to one of another group."""

    def run(batches):
        for g in grouped(batches, ["bucket", "i", "j"]):
            n, block, band = np.asarray(g.column("n")), np.asarray(g.column("block")), int(g.column("band")[0].as_py())
            group = np.unique(np.array(g.column("component").to_pylist()), return_inverse=True)[1]
            i, j = int(g.column("i")[0].as_py()), int(g.column("j")[0].as_py())
            sig = _unpack(g.column("slots"), SLOTS)
            marked = np.zeros(len(n), dtype=bool)
            right = np.flatnonzero(block == j)
            for x in np.flatnonzero(block == i).tolist():
                other = right[right > x] if i == j else right
                other = other[(group[other] != group[x]) & (np.minimum(n[other], n[x]) >= least * np.maximum(n[other], n[x]))]
                other = other[(sig[other] == sig[x]).sum(axis=1) >= margin * SLOTS]
                if len(other):
                    # only in the first band that the two share
                    shared = (sig[other] == sig[x]).reshape(len(other), BANDS, ROWS).all(axis=2)
                    other = other[shared.argmax(axis=1) == band]
                    marked[x] |= len(other) > 0
                    marked[other] = True
            yield g.select(["bucket", "node", "s1"]).filter(pa.array(marked))

    return run


def _sets(b: pa.RecordBatch, k: int, kind: str) -> list[np.ndarray]:
    own, e = shingles(b.column("text"), k, kind)
    first = np.searchsorted(own, np.arange(b.num_rows + 1)).tolist()
    return [np.sort(e[a:z]) for a, z in zip(first[:-1], first[1:])]


def _whole(keys: list[str], k: int, kind: str):
    """Of rows (keys..., node, text, __n, __s) those whose text has the wanted set, one of repeated ones in a task (a join brings
    those of a node to one task, in a row)."""

    def run(batches):
        seen = set()
        for b in W.pieces(batches):
            own, e = shingles(b.column("text"), k, kind)
            first = np.searchsorted(own, np.arange(b.num_rows + 1))
            same = (np.diff(first) == np.asarray(b.column("__n"))) & (_sums(W.mix64(e), first).view(np.int64) == np.asarray(b.column("__s")))
            names = list(zip(*(b.column(c).to_pylist() for c in (*keys, "node", "__s"))))
            for i in np.flatnonzero(same).tolist():
                same[i] = names[i] not in seen
                if len(seen) > 1 << 17:
                    seen.clear()
                seen.add(names[i])
            yield b.drop_columns(["__n", "__s"]).filter(pa.array(same))

    return run


def _verify_stars(threshold: tuple[int, int], k: int, kind: str):
    """Rows of a center and some partners, sorted so that it comes first: pairs whose sets are similar enough."""
    num, den = threshold

    def run(batches):
        key, mine = None, []  # the center's sets: an id may come with several texts
        for b in W.pieces(batches):
            a, d = [], []
            for center, salt, role, node, s in zip(*(b.column(c).to_pylist() for c in ("center", "salt", "role", "node")), _sets(b, k, kind)):
                if role == 0:
                    mine = [*mine, s] if key == (center, salt) else [s]
                    key = (center, salt)
                elif key == (center, salt):
                    both = [len(np.intersect1d(m, s, assume_unique=True)) for m in mine]
                    if any(den * n >= num * (len(m) + len(s) - n) for m, n in zip(mine, both)):
                        a.append(center)
                        d.append(node)
            yield pa.RecordBatch.from_arrays([pa.array(a, b.schema.field("node").type), pa.array(d, b.schema.field("node").type)], names=["a", "b"])

    return run


def intersections(x: list[np.ndarray], y: list[np.ndarray], width: int = 8192) -> np.ndarray:
    """Sizes of the intersections of all sets of x with all of y, by products of 0/1 matrices over slices of the elements."""
    ex, ey = np.concatenate(x), np.concatenate(y)
    rx, ry = np.repeat(np.arange(len(x)), [len(s) for s in x]), np.repeat(np.arange(len(y)), [len(s) for s in y])
    names = np.intersect1d(ex, ey)
    out = np.zeros((len(x), len(y)), dtype=np.float32)
    cx, cy = np.searchsorted(names, ex), np.searchsorted(names, ey)
    okx = (cx < len(names)) & (names[np.minimum(cx, max(len(names) - 1, 0))] == ex) if len(names) else np.zeros(len(ex), bool)
    oky = (cy < len(names)) & (names[np.minimum(cy, max(len(names) - 1, 0))] == ey) if len(names) else np.zeros(len(ey), bool)
    rx, cx, ry, cy = rx[okx], cx[okx], ry[oky], cy[oky]
    ox, oy = np.argsort(cx, kind="stable"), np.argsort(cy, kind="stable")
    rx, cx, ry, cy = rx[ox], cx[ox], ry[oy], cy[oy]
    for a in range(0, len(names), width):
        e = min(width, len(names) - a)
        mx, my = np.zeros((len(x), e), dtype=np.float32), np.zeros((len(y), e), dtype=np.float32)
        lo, hi = np.searchsorted(cx, [a, a + e])
        mx[rx[lo:hi], cx[lo:hi] - a] = 1
        lo, hi = np.searchsorted(cy, [a, a + e])
        my[ry[lo:hi], cy[lo:hi] - a] = 1
        out += mx @ my.T
    return out


def _verify_blocks(threshold: tuple[int, int], k: int, kind: str):
    """Exact comparison of a block pair: links between different groups, as a forest over the block's nodes."""
    num, den = threshold

    def run(batches):
        for g in grouped(batches, ["bucket", "i", "j"]):
            block = np.asarray(g.column("block"))
            i, j = int(g.column("i")[0].as_py()), int(g.column("j")[0].as_py())
            sets = [s for p in W.pieces(iter([g])) for s in _sets(p, k, kind)]
            node, comp = g.column("node").to_pylist(), np.unique(np.array(g.column("component").to_pylist()), return_inverse=True)[1]
            left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
            if not len(left) or not len(right):
                continue
            n = np.array([len(s) for s in sets])
            both = intersections([sets[x] for x in left], [sets[x] for x in right]).astype(np.int64)
            hit = den * both >= num * (n[left][:, None] + n[right][None, :] - both)
            hit &= comp[left][:, None] != comp[right][None, :]
            x, y = np.nonzero(hit)
            forest = _forest((node[left[a]], node[right[b]]) for a, b in zip(x.tolist(), y.tolist()))
            yield pa.RecordBatch.from_arrays([pa.array(list(forest), g.schema.field("node").type), pa.array(list(forest.values()), g.schema.field("node").type)],
                                             names=["a", "b"])

    return run


def classes(docs: DataFrame, k: int = 5, threshold: tuple[int, int] = (4, 5), kind: str = W.NONSPACE_LOWER) -> DataFrame:
    """Per row of docs: doc_id, n_shingles, component_id (smallest doc_id reachable), kept.

    Documents link if (shared shingles) / (all shingles) is at least threshold, a fraction of
    two integers. docs needs doc_id and text; other columns are ignored. Null and empty texts have
    an empty set and link with nothing; so do rows with null doc_id, whose component is null
    and which are kept. Rows that share a doc_id are one node. Empty docs give no rows.
    """
    num, den = threshold
    least = num / den
    margin = max(0.0, least - 4.5 * (least * (1 - least) / SLOTS) ** 0.5) if least < 1 else 1.0
    id_type = docs.schema["doc_id"].dataType.simpleString()
    spark = docs.sparkSession
    sigs = written(signed(docs, k, kind))
    # equal sets have equal signatures: a node is a set, named by its smallest doc_id (an id with several texts names several, told apart by s1)
    nodes = written(sigs.where("n > 0 and doc_id is not null").groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("node"), F.first("slots").alias("slots")))
    places = map_arrow(nodes.select("node", "s1", "slots"), _explode_bands, f"bucket long, node {id_type}, s1 long, band int")
    sizes = written(places.groupBy("bucket").agg(F.min("node").alias("center"), F.max("node").alias("top"), F.count(F.lit(1)).alias("size")).where("top > center"))
    with filtered_shuffles(spark):
        mates = written(places.join(sizes.where("top > center").drop("top"), "bucket").where("node <> center"))

    pairs = written(mates.select("center", "node", "s1").distinct())
    slots = nodes.select("node", F.col("s1").alias("of"), "n", "slots")
    with filtered_shuffles(spark):
        meant = F.col("s1").isNull() | (F.col("s1") == F.col("of"))  # a center comes with all its sets
        signed_pairs = written(_salted(pairs)).where("salt >= 0").join(slots, "node").where(meant)
        compared = signed_pairs.select("center", "salt", "role", "node", F.col("of").alias("s1"), "n", "slots")
        near = written(map_arrow(_stars(compared), _compare_stars(least, margin), f"center {id_type}, node {id_type}, s1 long"))

    def texts_of(rows: DataFrame, keys: list[str]) -> DataFrame:
        """rows (keys..., node, s1; s1 null: all sets of the node) with the texts, one for each set."""
        wanted = rows.join(nodes.select("node", F.col("n").alias("__n"), F.col("s1").alias("__s")), "node").where(F.col("s1").isNull() | (F.col("s1") == F.col("__s"))).drop("s1")
        wanted = written(wanted).where("__n > 0")
        met = docs.where("text is not null").select(F.col("doc_id").alias("node"), "text").join(wanted, "node")
        kinds = {f.name: f.dataType.simpleString() for f in met.schema}
        return map_arrow(met.select(*keys, "node", "text", "__n", "__s"), _whole(keys, k, kind), ", ".join(f"{c} {kinds[c]}" for c in (*keys, "node", "text")))

    with filtered_shuffles(spark):
        links = written(map_arrow(_stars(texts_of(_salted(near), ["center", "salt", "role"])), _verify_stars(threshold, k, kind), f"a {id_type}, b {id_type}"))
    groups = connected_components(links)

    # buckets of three or more whose members, but for the first one, are in several groups
    open_ = written(mates.where("size > 2").join(groups, "node", "left").select("bucket", "band", "node", "s1", F.coalesce("component", "node").alias("component")))
    mixed = open_.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("size")).where("lo <> hi")
    cells = open_.join(mixed.select("bucket", "size"), "bucket").join(slots, ["node"]).where("s1 = of").drop("of")
    possible = written(map_arrow(_dealt(_blocks(cells, "size")), _compare(least, margin), f"bucket long, node {id_type}, s1 long").distinct())
    final = groups
    if possible.take(1):
        rest = possible.join(open_.select("bucket", "node", "s1", "component"), ["bucket", "node", "s1"])
        rest = rest.join(possible.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")), "bucket")
        keys = ["bucket", "i", "j", "block", "component"]
        with filtered_shuffles(spark):
            more = written(map_arrow(_dealt(texts_of(_blocks(rest, "size").select(*keys, "node", "s1"), keys)), _verify_blocks(threshold, k, kind), f"a {id_type}, b {id_type}"))
        # groups found so far are links of their own: a second contraction starts from them
        final = connected_components(groups.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))

    rows = sigs.select("doc_id", "n", "s1", "s2").join(nodes.drop("slots"), ["n", "s1", "s2"], "left")
    rows = rows.join(final, "node", "left")
    component = F.when(F.col("doc_id").isNull() | (F.col("n") == 0), F.col("doc_id")).otherwise(F.coalesce("component", "node"))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                       F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs that stay: of each class, those of the smallest doc_id. Rows of one id with different texts all stay, of
    rows equal in doc_id and text one does; rows without an id stay."""
    gone = classes(docs, **options).where("not kept").select(F.col("doc_id").alias("__gone")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"))
    stay = rows.join(gone, F.col("id") == F.col("__gone"), "left_anti")
    often = written(docs.where("doc_id is not null").groupBy(F.col("doc_id").alias("again")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("again"))
    if not often.take(1):  # no id comes twice: nothing to fold, and the texts are shuffled once
        return stay.select("row.*")
    some = stay.join(often, F.col("id") == F.col("again"), "left_semi").groupBy("id", F.md5("row.text").alias("t")).agg(F.first("row").alias("row"))
    return stay.join(often, F.col("id") == F.col("again"), "left_anti").select("row").unionByName(some.select("row")).select("row.*")
