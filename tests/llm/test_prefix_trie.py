import hashlib
import random
import re
import zlib

import duckdb
import pytest

from valuelens.llm import prefix_trie
from valuelens.llm.catalogue import ORACLE

SCHEMA = "conv_id long, turn long, role string, text string, depth string, k1 string, owner int"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    members = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        s = tuple(own.get(int(c / 20) * 20, [])[:h] + turns[h:])  # remainders as in SQL: a negative id keeps its sign
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append((c, d == len(s)))
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    leaves, saved, out = {}, {}, []
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids.get(p, [])) or 1
        saved[p] = sum(saved[k] for k in kids.get(p, [])) + ((len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0)
        ends = ",".join(map(str, sorted(c for c, e in members[p] if e)))
        out.append((min(members[p])[0], len(p), min(members[p[:-1]])[0] if p else None, len(members[p]), len(kids.get(p, [])), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA).repartition(5)
    return sorted((tuple(r[c] for c in COLUMNS) for r in prefix_trie.trie(df).collect()), key=str)


def talks(rng, n, long=0):
    rows = [(c, t, rng.choice(["user", "assistant"]), rng.choice(["hi", "hi there", "a b  c", ""])) for c in rng.sample(range(3 * n), n) for t in range(rng.randrange(1, 7))]
    rows += [(7, t, "user", f"turn {t}") for t in range(long)] + [(11, t, "user", f"turn {t}") for t in range(long // 2)]
    return rows


EDGE = [(None, 1, "user", "lost"), (1, None, None, None), (1, 1, "user", "x"), (1, 1, "user", "x"), (1, None, "a", "b"), (2, 5, "user", "é ß"), (20, 1, "user", "w " * 5000),
        (20, 2, None, ""), (21, 1, "user", "x"), (23, 9, "user", "y"), (39, 1, "r", "t"), (-3, 1, "user", "x"), (0, 1, "user", "x"), (400, 1, "only", "one")]


@pytest.mark.parametrize("local", [1, 3, 20_000])
def test_equals_brute_force(spark, monkeypatch, local):
    """With a tiny LOCAL the distributed rounds do the work: a bushy trie, long chains, and edge rows."""
    monkeypatch.setattr(prefix_trie, "LOCAL", local)
    monkeypatch.setattr(prefix_trie, "BLOCK_BYTES", 4)
    rows = EDGE + (talks(random.Random(1), 40, 24) if local < 10 else talks(random.Random(2), 300, 500))
    assert run(spark, rows) == brute(rows)


def test_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, 1, "user", "x")]) == []


def test_many_copies_of_one_conversation(spark):
    rows = [(c, t, "user", f"t{t}") for c in range(600) for t in range(3)] + [(5, t, "user", "same") for t in range(3, 900)]
    assert run(spark, rows) == brute(rows)


def test_query_equals_sql(spark):
    path = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{path}/conversations.parquet'")
    got = prefix_trie.trie(spark.read.parquet(f"{path}/conversations.parquet")).select(*COLUMNS).collect()
    want = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({ORACLE['op11_prefix_trie']})").fetchall()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str) and len(want) > 50


def test_centroid_sums_of_random_forests():
    rng = random.Random(3)
    for n in [1, 2, 3, 10, 200]:
        for shape in ("random", "path", "star"):
            parent = [-1 if i == 0 or rng.random() < 0.05 else (i - 1 if shape == "path" else 0 if shape == "star" else rng.randrange(i)) for i in range(n)]
            values = [[rng.randrange(-5, 9) for _ in range(n)] for _ in range(2)]
            want = [list(v) for v in values]
            for i in reversed(range(n)):
                if parent[i] >= 0:
                    for w in want:
                        w[parent[i]] += w[i]
            assert prefix_trie.centroid_sums(parent, values) == want
