"""Conversation prefix trie (11): shared prefixes, rolled up by centroid decomposition of the parent-edge forest.

A turn at depth i has a 128-bit fingerprint of (i, role, text); a prefix is named by the exclusive or of
its turns' fingerprints, so names come from a running exclusive or over rows dealt by range, however long a
conversation is. Nodes are the distinct names; a node is owned by its smallest member, and the nodes that one
conversation owns are the lower end of its path.

Subtree totals. Each round takes from every component of more than LOCAL nodes its centroid (the deepest node
with at least half of the component below it), splits the component there, adds up the totals of the components
hanging under the centroid, and adds that sum to the nodes on the path from the centroid to the component's
top. Path and membership are read from the owner's rows, so a round is a few joins whatever the depth,
and sizes at least halve. Components of at most LOCAL nodes are decomposed the same way inside tasks.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from valuelens.llm.tables import map_arrow, partitions, position_in, written

#: Components of at most this many nodes are decomposed inside a task; bytes of a block of joined ids; turns borrowed at most.
LOCAL, BLOCK_BYTES, HEAD = 20_000, 8192, 3

WORD = r"[^\x20\x09-\x0D]+"
KEY = ["k1", "k2"]


def _turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, digest, words): the turns of each conversation numbered from 0."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    rows = rows.select(
        "conv_id", "turn", F.substring("role", 1, 64).alias("r"), F.substring("text", 1, 64).alias("t"),
        F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)).alias("digest"),
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"))
    return written(position_in(rows, ["conv_id"], ["turn", "r", "t", "digest"], "pos").select("conv_id", "pos", "digest", "words"))


def rebuilt(conversations: DataFrame, period: int = 20) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, n_turns) and their rebuilt turns (conv_id, n_turns, depth from 1, digest, words).

    The first h turns come from conversation c - c % period (at most HEAD, so a base reaches a fixed number of rows),
    the rest are c's own turns after its first h; h = crc32(decimal c) % (HEAD + 1).
    """
    own = _turns(conversations)
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (HEAD + 1)
    base = F.col("conv_id") - F.col("conv_id") % period
    heads = own.where((F.col("pos") < HEAD) & (F.col("conv_id") % period == 0)).groupBy(F.col("conv_id").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "digest", "words"))).alias("head"))
    convs = own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).withColumn("base", base).join(heads, "base", "left")
    convs = convs.withColumn("h", h).withColumn("head", F.expr("slice(coalesce(head, array()), 1, cast(h as int))"))
    convs = convs.withColumn("shift", F.size("head") - F.col("h")).withColumn("n_turns", F.size("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    convs = written(convs.select("conv_id", "shift", "n_turns", "head"))
    mine = own.where(F.col("pos") >= h).join(convs.select("conv_id", "shift", "n_turns"), "conv_id")
    mine = mine.select("conv_id", "n_turns", (F.col("pos") + 1 + F.col("shift")).alias("depth"), "digest", "words")
    lent = convs.select("conv_id", "n_turns", F.inline("head")).select("conv_id", "n_turns", (F.col("pos") + 1).alias("depth"), "digest", "words")
    return convs.select("conv_id", "n_turns"), mine.unionByName(lent)


def memberships(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, depth, words, k1, k2, p1, p2) per conversation and depth from 1: names of its prefix and of the prefix before."""
    named = turns.select("conv_id", "n_turns", "depth", "words", *[F.xxhash64(F.lit(i), "depth", "digest").alias(f"x{i}") for i in (1, 2)])
    ranged = named.repartitionByRange(partitions(turns.sparkSession), "conv_id", "depth").sortWithinPartitions("conv_id", "depth")
    ranged = ranged.select("*", *[F.col(f"x{i}").alias(k) for i, k in enumerate(KEY, 1)], F.spark_partition_id().alias("pid"))

    def running(batches):
        last, carry = None, [0, 0]
        for b in batches:
            if not b.num_rows:
                continue
            conv = np.asarray(b.column("conv_id"))
            at = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
            begin = np.repeat(at, np.diff(np.append(at, len(conv))))
            for i, k in enumerate(KEY):
                total = np.bitwise_xor.accumulate(np.asarray(b.column(k)))
                before = np.where(begin > 0, total[begin - 1], 0)
                run = total ^ before
                if conv[0] == last:
                    run[begin == 0] ^= carry[i]
                carry[i] = run[-1]
                b = b.set_column(b.schema.get_field_index(k), k, pa.array(run, pa.int64()))
            last = conv[-1]
            yield b

    local = written(ranged.mapInArrow(running, ranged.schema))
    parts = local.groupBy("pid", "conv_id").agg(*[F.bit_xor(f"x{i}").alias(f"s{i}") for i in (1, 2)])
    earlier = Window.partitionBy("conv_id").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("pid", "conv_id", F.count(F.lit(1)).over(earlier).alias("n"), *[F.bit_xor(f"s{i}").over(earlier).alias(f"o{i}") for i in (1, 2)])
    offsets = offsets.where("n > 0").drop("n")  # a range has one conversation at most that began before it
    full = local.join(F.broadcast(offsets), ["pid", "conv_id"], "left")
    keys = [F.col(k).bitwiseXOR(F.coalesce(f"o{i}", F.lit(0))) for i, k in enumerate(KEY, 1)]
    return written(full.select("conv_id", "n_turns", "depth", "words", *[c.alias(k) for c, k in zip(keys, KEY)],
                               *[c.bitwiseXOR(F.col(f"x{i}")).alias(f"p{i}") for i, c in enumerate(keys, 1)]))


def _nodes(convs: DataFrame, member: DataFrame) -> DataFrame:
    inner = member.groupBy(*KEY).agg(
        F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("words").alias("words"))
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        zero.alias("k1"), zero.alias("k2"), zero.alias("depth"), "conv_id", "n_convs", F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"), zero.alias("words"))
    nodes = written(inner.unionByName(root))
    children = nodes.where("depth > 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    up = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    nodes = nodes.join(up, ["p1", "p2"], "left")
    return written(nodes.select("k1", "k2", "p1", "p2", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children",
                                (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved")))


def centroid_sums(parent: list[int], values: list[list[int]]) -> list[list[int]]:
    """Subtree sums of each value column over a forest whose parents come before their children (-1: none).

    Level by level: each component's total goes to the centroid cut off above it, each centroid's sum to
    the path up to the top of the component that it split; then new centroids are taken out.
    """
    n = len(parent)
    up, above, size, top, centre = list(parent), [-1] * n, [0] * n, [0] * n, [0] * n
    total, out = [list(v) for v in values], [[0] * n for _ in values]
    alive, cut, gone = list(range(n)), [], bytearray(n)
    while alive or cut:
        for i in alive:
            size[i], top[i] = 1, i if up[i] < 0 else top[up[i]]
            g = above[top[i]]
            if g >= 0:
                for t, v in zip(total, values):
                    t[g] += v[i]
        for g, t in cut:
            i = g
            while True:
                for o, s in zip(out, total):
                    o[i] += s[g]
                if i == t:
                    break
                i = parent[i]
        for i in reversed(alive):
            if up[i] >= 0:
                size[up[i]] += size[i]
        for i in alive:
            if 2 * size[i] >= size[top[i]]:
                centre[top[i]] = i
        cut = [(centre[i], i) for i in alive if up[i] < 0]
        for g, _ in cut:
            gone[g] = 1
        rest = []
        for i in alive:
            if not gone[i]:
                if up[i] < 0:
                    above[i] = -1
                elif gone[up[i]]:
                    above[i], up[i] = up[i], -1
                rest.append(i)
        alive = rest
    return out


def _local(parts: DataFrame) -> DataFrame:
    """Totals of nodes within their components (t1, t2), each of at most LOCAL nodes."""
    keys = ["t1", "t2"]
    dealt = parts.select(*keys, "depth", "k1", "k2", "p1", "p2", "leaves", "saved").repartition(partitions(parts.sparkSession), *keys)

    def sums(table: pa.Table) -> pa.RecordBatch:
        t1, t2, k1, k2, p1, p2, leaves, saved = (table.column(c).to_pylist() for c in (*keys, "k1", "k2", "p1", "p2", "leaves", "saved"))
        place = {k: i for i, k in enumerate(zip(k1, k2))}
        parent = [-1 if k1[i] == t1[i] and k2[i] == t2[i] else place[p1[i], p2[i]] for i in range(len(k1))]
        done = centroid_sums(parent, [leaves, saved])
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (k1, k2, *done)], names=["k1", "k2", "leaves", "saved"])

    def decompose(batches):
        held: list[pa.RecordBatch] = []
        for b in batches:
            if not b.num_rows:
                continue
            last = [b.column(c)[b.num_rows - 1] for c in keys]
            same = np.logical_and(*[np.asarray(b.column(c)) == x.as_py() for c, x in zip(keys, last)])
            at = int(np.argmax(same))  # the batch's last component may go on in the next one
            if at or not held or [held[-1].column(c)[held[-1].num_rows - 1] for c in keys] != last:
                whole = [*held, b.slice(0, at)] if at else held
                if whole:
                    yield sums(pa.Table.from_batches(whole))
                held = [b.slice(at)]
            else:
                held.append(b)
        if held:
            yield sums(pa.Table.from_batches(held))

    return map_arrow(dealt.sortWithinPartitions(*keys, "depth"), decompose, "k1 long, k2 long, leaves long, saved long")


def _rollup(nodes: DataFrame, member: DataFrame) -> DataFrame:
    """(k1, k2, leaves, saved): each node's subtree totals."""
    zero = F.lit(0).cast("long")
    state = nodes.select("k1", "k2", "p1", "p2", "depth", F.col("conv_id").alias("owner"), "leaves", "saved", zero.alias("t1"), zero.alias("t2"), zero.alias("td"))
    n = nodes.count()
    if n <= LOCAL:
        return _local(state)
    # nodes below a node: of each member, the nodes it owns there
    chains = nodes.groupBy("conv_id").agg(F.min("depth").alias("first"), F.count(F.lit(1)).alias("owned"))
    below = F.when(F.col("depth") >= F.col("first"), F.col("n_turns") - F.col("depth") + 1).otherwise(F.coalesce("owned", F.lit(0)))
    sizes = member.join(chains, "conv_id", "left").groupBy(*KEY).agg(F.sum(below).alias("size"))
    large = written(state.join(sizes, KEY, "left").withColumn("size", F.coalesce("size", F.lit(n))).withColumn("n", F.lit(n).cast("long")))
    small, added = [], []
    while large.take(1):
        half = large.where("2 * size >= n").withColumn("me", F.struct("k1", "k2", "depth", "owner", "size", "leaves", "saved"))
        cut = half.groupBy("t1", "t2").agg(F.min("td").alias("td"), F.min_by("me", F.struct("size", -F.col("depth"), "k1", "k2")).alias("g"))
        cut = written(cut.select("t1", "t2", "td", *[F.col(f"g.{c}").alias(f"g{c}") for c in ("k1", "k2", "depth", "owner", "size", "leaves", "saved")]))
        # conversations that go on below a centroid, and the child through which they go
        through = member.join(cut.select("t1", "t2", "gk1", "gk2"), (F.col("p1") == F.col("gk1")) & (F.col("p2") == F.col("gk2"))).select(
            "t1", "t2", F.col("conv_id").alias("owner"), F.col("k1").alias("c1"), F.col("k2").alias("c2"))
        split = large.join(cut.select("t1", "t2", "gk1", "gk2", "gdepth", "gsize"), ["t1", "t2"]).join(through, ["t1", "t2", "owner"], "left")
        split = written(split.where("not (k1 = gk1 and k2 = gk2)").withColumn("under", F.col("c1").isNotNull() & (F.col("depth") > F.col("gdepth"))))
        parts = written(split.where("under").groupBy("t1", "t2", "c1", "c2").agg(F.count(F.lit(1)).alias("m"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")))
        sums = parts.groupBy("t1", "t2").agg(F.sum("leaves").alias("pl"), F.sum("saved").alias("ps"))
        cut = cut.join(sums, ["t1", "t2"], "left").select(
            "t1", "t2", "td", "gk1", "gk2", "gdepth", "gowner", "gsize",
            (F.col("gleaves") + F.coalesce("pl", zero)).alias("leaves"), (F.col("gsaved") + F.coalesce("ps", zero)).alias("saved"))
        cut = written(cut)
        # the path from the centroid's parent to the component's top, read from the centroid's owner
        path = member.select("conv_id", "depth", "k1", "k2").join(cut, (F.col("conv_id") == F.col("gowner")) & (F.col("depth") >= F.col("td")) & (F.col("depth") < F.col("gdepth")))
        path = path.select("k1", "k2", "leaves", "saved", "gsize").unionByName(
            cut.where("td = 0 and gdepth > 0").select(zero.alias("k1"), zero.alias("k2"), "leaves", "saved", "gsize"))
        path = written(path)
        added += [path.drop("gsize"), cut.select(F.col("gk1").alias("k1"), F.col("gk2").alias("k2"), "leaves", "saved")]
        keep = ["k1", "k2", "p1", "p2", "depth", "owner", "leaves", "saved"]
        lower = split.where("under").drop("t1", "t2", "n").join(parts.select("c1", "c2", F.col("m").alias("n")), ["c1", "c2"])
        lower = lower.select(*keep, F.col("c1").alias("t1"), F.col("c2").alias("t2"), (F.col("gdepth") + 1).alias("td"), "size", "n")
        upper = split.where("not under").withColumn("n", F.col("n") - F.col("gsize")).drop("gsize").join(path.select("k1", "k2", "gsize"), KEY, "left")
        upper = upper.select(*keep, "t1", "t2", "td", (F.col("size") - F.coalesce("gsize", zero)).alias("size"), "n")
        state = written(lower.unionByName(upper))
        small.append(state.where(F.col("n") <= LOCAL))
        large = state.where(F.col("n") > LOCAL)
    inside = _local(reduce(DataFrame.unionByName, [s.select("t1", "t2", "depth", "k1", "k2", "p1", "p2", "leaves", "saved") for s in small]))
    return reduce(DataFrame.unionByName, [*added, inside]).groupBy(*KEY).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def _end_digests(convs: DataFrame, member: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256) of nodes at which conversations end: ids are joined into blocks by range, blocks are hashed in order."""
    zero = F.lit(0).cast("long")
    ends = member.where("depth = n_turns").select("k1", "k2", "conv_id").unionByName(convs.where("n_turns = 0").select(zero.alias("k1"), zero.alias("k2"), "conv_id"))
    order = [*KEY, "conv_id"]
    dealt = ends.repartitionByRange(partitions(ends.sparkSession), *order).sortWithinPartitions(*order)

    def blocks(batches):
        for b in batches:
            out: list[list] = [[], [], [], []]
            key, ids, size, first = None, [], 0, 0
            for k1, k2, c in zip(*(b.column(x).to_pylist() for x in order)):
                if (k1, k2) != key or size >= BLOCK_BYTES:
                    if ids:
                        for o, x in zip(out, (*key, first, ",".join(ids))):
                            o.append(x)
                    key, ids, size, first = (k1, k2), [], 0, c
                ids.append(str(c))
                size += len(ids[-1]) + 1
            if ids:
                for o, x in zip(out, (*key, first, ",".join(ids))):
                    o.append(x)
            yield pa.RecordBatch.from_arrays([*[pa.array(o, pa.int64()) for o in out[:3]], pa.array(out[3], pa.string())], names=[*KEY, "first", "ids"])

    joined = map_arrow(dealt, blocks, "k1 long, k2 long, first long, ids string")
    joined = joined.repartition(partitions(ends.sparkSession), *KEY).sortWithinPartitions(*KEY, "first")

    def digests(batches):
        key, h = None, None
        for b in batches:
            out: list[list] = [[], [], []]
            for k1, k2, ids in zip(*(b.column(x).to_pylist() for x in (*KEY, "ids"))):
                if (k1, k2) == key:
                    h.update(b",")
                else:
                    if key is not None:
                        for o, x in zip(out, (*key, h.hexdigest())):
                            o.append(x)
                    key, h = (k1, k2), hashlib.sha256()
                h.update(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())], names=[*KEY, "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()), pa.array([h.hexdigest()])], names=[*KEY, "ends_sha256"])

    return map_arrow(joined, digests, "k1 long, k2 long, ends_sha256 string")


def trie(conversations: DataFrame, period: int = 20) -> DataFrame:
    """Per node of the prefix trie of rebuilt conversations: conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens (long), ends_sha256.

    conversations needs conv_id (integer), turn, role and text; other columns are ignored. Turns go by turn, null first; equal turns by
    role, then by the first 64 characters of the text, then by a digest of role and text; repeated rows are turns of their own.
    The remainder of a negative id is negative, as in SQL.
    Null role or text is empty. Rows with a null conv_id take no part. An empty table has no root and gives no rows.
    The ids hashed per node are streamed, never held: a hot node costs one task the hashing of its joined ids, in blocks.
    """
    convs, turns = rebuilt(conversations, period)
    member = memberships(turns)
    nodes = _nodes(convs, member)
    out = nodes.join(_rollup(nodes, member).select(*KEY, F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens")), KEY)
    out = out.join(_end_digests(convs, member), KEY, "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))
