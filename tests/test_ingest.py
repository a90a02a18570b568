"""Folders of CSV files: headers by name, bad files set aside, bad lines reported."""

import gzip
import random

import pytest
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from valuelens.sources import files

SCHEMA = StructType([StructField("id", LongType()), StructField("name", StringType()), StructField("score", DoubleType())])


def write(folder, name, text, mode="w"):
    with open(folder / name, mode, **({} if "b" in mode else {"newline": ""})) as f:
        f.write(text)


def test_many_files_few_headers(spark, tmp_path):
    rng = random.Random(1)
    want, orders = [], [["id", "name", "score"], ["score", "note", "id", "name"], ["name", "id"]]
    for k in range(200):
        header, lines = orders[k % 3], []
        for i in range(3):
            row = {"id": k * 10 + i, "name": f"n{rng.randrange(9)}", "score": rng.random(), "note": "z"}
            lines.append(",".join(str(row[h]) for h in header))
            want.append((row["id"], row["name"], row["score"] if "score" in header else None))
        write(tmp_path, f"part [{k}].csv", ",".join(header) + "\n" + "\n".join(lines) + ("\n" if k % 2 else ""))
    write(tmp_path, "broken.csv", b"id,name,score\n1,\xff\xfe,2\n", "wb")
    found = files.ingest_folder(spark, str(tmp_path), SCHEMA)
    assert sorted(map(tuple, found.rows.select("id", "name", "score").collect()), key=str) == sorted(want, key=str)
    assert [(r.file.rsplit("/", 1)[1], r.reason) for r in found.quarantine.collect()] == [("broken.csv", "not UTF-8: 1 lines")]
    assert found.rows._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 3


def test_reasons_and_rejects(spark, tmp_path):
    write(tmp_path, "a.csv", "id,name,score\r\n1,x,1.5\r\n2,y,n/a\r\n3,z,1,2\r\n4,w\r\n")
    write(tmp_path, "bom.csv", "﻿name,id,id\nq,5,6\n")
    write(tmp_path, "empty.csv", "")
    write(tmp_path, "other.csv", "a,b\n1,2\n")
    write(tmp_path, "blank.csv", "\n1,2\n")
    packed = gzip.compress(b"id,name,score\n7,g,0.5\n" + b"8,h,0.25\n" * 1000)
    write(tmp_path, "good.csv.gz", packed, "wb")
    write(tmp_path, "cut.csv.gz", packed[:-20], "wb")
    write(tmp_path, "junk.csv.gz", b"no archive at all", "wb")
    found = files.ingest_folder(spark, str(tmp_path), SCHEMA, "*.csv*")
    why = {r.file.rsplit("/", 1)[1]: r.reason for r in found.quarantine.collect()}
    assert set(why) == {"empty.csv", "other.csv", "blank.csv", "cut.csv.gz", "junk.csv.gz"}
    assert (why["empty.csv"], why["blank.csv"], why["other.csv"], why["cut.csv.gz"]) == ("empty file", "empty file", "no known column in the header", "archive ends early")
    assert why["junk.csv.gz"].startswith("broken archive")
    rows = {r.id: (r.name, r.score) for r in found.rows.distinct().collect()}
    assert rows == {1: ("x", 1.5), 2: ("y", None), 3: ("z", 1.0), 4: ("w", None), 5: ("q", None), 7: ("g", 0.5), 8: ("h", 0.25)}
    assert sorted(r._corrupt_record for r in found.rejects().collect()) == ["2,y,n/a", "3,z,1,2", "4,w"]
    with pytest.warns(UserWarning, match="5 files not loaded"):
        assert files.read_csv_folder(spark, str(tmp_path), SCHEMA, "*.csv*").count() == 1006


def test_missing_folder_is_empty_and_other_errors_are_raised(spark, tmp_path):
    assert files.list_files(spark, str(tmp_path / "none")) == []
    found = files.ingest_folder(spark, str(tmp_path / "none"), SCHEMA)
    assert found.rows.collect() == found.quarantine.collect() == [] and found.rejects().collect() == []
    with pytest.raises(Exception, match="nosuchscheme"):
        files.list_files(spark, "nosuchscheme://host/folder")
    with pytest.raises(Exception, match="nosuchscheme"):
        files.ingest_folder(spark, "nosuchscheme://host/folder", SCHEMA)


def test_flow_writes_the_quarantine(spark, tmp_path):
    from valuelens.plans import flows

    (tmp_path / "in").mkdir()
    write(tmp_path / "in", "a.csv", "player_name,player_id\nA,1\nB,1\n")
    write(tmp_path / "in", "b.csv", b"player_id\n\xff\n", "wb")
    table, _ = flows.ingest(spark, str(tmp_path / "in"), quarantine=str(tmp_path / "q"))
    assert [r.player_name for r in table.collect()] == ["B"]
    assert [r.reason for r in spark.read.parquet(str(tmp_path / "q")).collect()] == ["not UTF-8: 1 lines"]
