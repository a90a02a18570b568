"""A table kept by micro-batches: bounded files, replays without effect, readers that see one version."""

import os
import random

import pytest

from valuelens.streaming import jobs
from valuelens.streaming.snapshots import SnapshotTable, keep_last_table


def state(table, spark):
    return {r.k: (r.t, r.v) for r in table.read(spark).collect()}


def files(root):
    return sum(name.startswith("part-") for _, _, names in os.walk(root) for name in names)


def test_many_batches(spark, tmp_path):
    rng, want = random.Random(1), {}
    table = SnapshotTable(str(tmp_path / "t"), ["k"], ["t"], compact_every=4, versions=2)
    with pytest.raises(LookupError):
        table.read(spark)
    most, old = 0, None
    for b in range(24):
        rows = [(rng.randrange(20), b * 100 + i, f"v{b}-{i}") for i in range(10)]
        for k, t, v in rows:
            want[k] = (t, v)
        df = spark.createDataFrame(rows, "k int, t long, v string").coalesce(1)
        if b == 10:
            old, before = table.read(spark), dict(state(table, spark))
        assert table.upsert(df, b)
        if b == 11:  # a reader that began before the last writes still sees its version
            assert {r.k: (r.t, r.v) for r in old.collect()} == before
        if b % 6 == 0:
            assert not table.upsert(df, b) and not table.upsert(df.selectExpr("k", "t + 1000000 AS t", "v"), b - 1)
            assert state(table, spark) == want
        most = max(most, files(tmp_path / "t" / "parts"))
    assert state(table, spark) == want and most <= 2 * 4 * 2
    assert len(os.listdir(tmp_path / "t" / "manifest")) <= 4


def test_keys_expire(spark, tmp_path):
    table = SnapshotTable(str(tmp_path / "t"), ["k"], ["t"], compact_every=2, keep=("t", "10 days"))
    for b, day in enumerate(["2024-01-01", "2024-01-05", "2024-01-14", "2024-01-15"]):
        table.upsert(spark.sql(f"SELECT {b} AS k, timestamp '{day}' AS t"), b)
    assert sorted(r.k for r in table.read(spark).collect()) == [1, 2, 3]


def test_a_write_cut_short_is_not_seen(spark, tmp_path, monkeypatch):
    table = SnapshotTable(str(tmp_path / "t"), ["k"], ["t"])
    one = spark.createDataFrame([(1, 1, "a")], "k int, t long, v string")
    table.upsert(one, 0)
    with monkeypatch.context() as m:
        m.setattr(SnapshotTable, "_write", lambda self, rows: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            table.upsert(spark.createDataFrame([(1, 2, "b")], "k int, t long, v string"), 1)
    assert state(table, spark) == {1: (1, "a")}
    assert table.upsert(spark.createDataFrame([(1, 2, "b")], "k int, t long, v string"), 1)
    assert state(table, spark) == {1: (2, "b")}


def test_stream_keeps_the_table(spark, tmp_path):
    schema = "k int, t long, v string"
    for n in range(3):
        spark.createDataFrame([(i % 5, n * 10 + i, f"{n}") for i in range(10)], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = jobs.file_stream(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema, max_files_per_trigger=1)
    table = SnapshotTable(str(tmp_path / "t"), ["k"], ["t"], compact_every=2)
    keep_last_table(stream, table, str(tmp_path / "ck"))
    assert state(table, spark) == {i: (25 + i, "2") for i in range(5)}
