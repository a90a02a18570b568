"""File sources (S1-S5, S8): typed CSV / JSON scans with header validation and bad-file tolerance."""

from __future__ import annotations

import bz2
import csv
import re
import warnings
import zlib
from collections import Counter
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from valuelens.schema import RAW_PLAYER


def list_files(spark: SparkSession, folder: str, pattern: str = "*.csv") -> list[str]:
    """Paths under ``folder`` matching ``pattern``, sorted (file listing only: the binary
    content column is never selected, so no file body is read). A missing folder has none; any other
    error (no permission, unknown file system) is raised."""
    df = _listing(spark, folder, pattern)
    return sorted(r.path for r in df.select("path").collect()) if df is not None else []


def _listing(spark: SparkSession, folder: str, pattern: str) -> DataFrame | None:
    try:
        return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType = RAW_PLAYER, with_source: bool = True,
             bad_records: bool = False) -> DataFrame:
    """Header CSV with an explicit schema; empty fields -> NULL; unparsable values -> NULL
    (PERMISSIVE). With ``bad_records`` a ``_corrupt_record`` column keeps the raw line of rows
    that failed to parse. A file that cannot be read raises; ``ingest_folder`` sets such files aside."""
    sch = schema
    if bad_records:
        sch = StructType(list(schema.fields) + [StructField("_corrupt_record", StringType(), True)])
    r = (spark.read.schema(sch).option("header", True).option("mode", "PERMISSIVE")
         .option("enforceSchema", False))
    if bad_records:
        r = r.option("columnNameOfCorruptRecord", "_corrupt_record")
    df = r.csv(path)
    if with_source:
        # file and split offset give the file order of rows (splits of one file are not read in order)
        df = df.withColumn("_source_file", F.col("_metadata.file_path")).withColumn(
            "_block_start", F.col("_metadata.file_block_start"))
    return df


@contextmanager
def _file_per_partition(spark: SparkSession):
    """Jobs planned inside read no two files in one partition."""
    key = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, spark.conf.get("spark.sql.files.maxPartitionBytes"))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _broken_archives(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """Compressed files that do not unpack to their end -> reason. Content is unpacked in the tasks, a piece at a time."""
    files = spark.read.format("binaryFile").load([_literal(p) for p in paths]).select("path", "content")

    def check(batches):
        for b in batches:
            bad: list[tuple[str, str]] = []
            for path, content in zip(b.column("path").to_pylist(), b.column("content")):
                unpack, at, data = None, 0, memoryview(content.as_buffer())
                try:
                    while at < len(data):
                        if unpack is None or unpack.eof:  # archives may hold several members
                            unpack = zlib.decompressobj(31) if path.endswith(".gz") else bz2.BZ2Decompressor()
                        piece = data[at : at + (1 << 16)]
                        unpack.decompress(piece)
                        at += len(piece) - len(unpack.unused_data)
                    if unpack is not None and not unpack.eof:
                        bad.append((path, "archive ends early"))
                except (zlib.error, OSError, EOFError) as e:
                    bad.append((path, f"broken archive: {e}"))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in bad], pa.string()) for i in range(2)], names=["path", "reason"])

    return {r.path: r.reason for r in files.mapInArrow(check, "path string, reason string").collect()}


def _literal(path: str) -> str:
    """A path as a reader's pattern that matches just it."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def file_index(spark: SparkSession, folder: str, schema: StructType, pattern: str = "*.csv") -> list[tuple[str, list[str], str | None]]:
    """(path, header fields, reason) of every file of a folder; the reason says why a file cannot be loaded.

    Two jobs, whatever the number of files: one lists them, one reads the raw lines of all of them and reduces them, inside the
    tasks that read them, to the first line, the bytes read and the lines that are no UTF-8. Archives (.gz, .bz2)
    take a third, which unpacks them. Reasons: an empty file, lines that are not UTF-8, a file that could not be read to
    its end, a broken archive, a header without any column of ``schema``.
    """
    listing = _listing(spark, folder, pattern)
    if listing is None:
        return []
    files = {r.url: (r.path, r.length) for r in listing.select("path", "length", F.col("_metadata.file_path").alias("url")).collect()}
    read_by_scan = {path for path, _ in files.values()}
    every = {re.sub("^file:/+", "file:/", unquote(url)) for url in listing.inputFiles()}
    files |= {path: (path, 0) for path in every - read_by_scan}  # a scan leaves empty files out
    if not files:
        return []
    with _file_per_partition(spark):
        lines = spark.read.option("lineSep", "\n").option("pathGlobFilter", pattern).option("ignoreCorruptFiles", True).text(folder)
        row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        top = (F.col("start") == 0) & (F.col("row") == 0)
        lines = lines.select("value", F.col("_metadata.file_path").alias("url"), F.col("_metadata.file_block_start").alias("start"), row.alias("row"))
        # the first line is a group of its own: no text is kept in an aggregate, so rows are hashed, not sorted
        found = lines.groupBy("url", F.when(top, F.col("value")).alias("header")).agg(
            F.sum(F.octet_length("value") + 1).alias("bytes"), F.sum((~F.is_valid_utf8("value")).cast("long")).alias("bad")).collect()
    headers, read, bad = {}, Counter(), Counter()
    for r in found:
        read[r.url] += r.bytes
        bad[r.url] += r.bad
        if r.header is not None:
            headers[r.url] = r.header.rstrip("\r").lstrip("\ufeff")
    packed = [p for p, _ in files.values() if p.endswith((".gz", ".bz2"))]
    broken = _broken_archives(spark, packed) if packed else {}
    expected, out = {f.name for f in schema.fields}, []
    for url, (path, length) in sorted(files.items(), key=lambda x: x[1]):
        fields = next(csv.reader([headers.get(url, "")]), [])
        reason = None
        if path in broken:
            reason = broken[path]
        elif not length or not any(fields):
            reason = "empty file"
        elif bad[url]:
            reason = f"not UTF-8: {bad[url]} lines"
        elif path not in packed and not length - 3 <= read[url] <= length + 1:  # a byte order mark, a last line without end
            reason = f"incomplete: {read[url]} of {length} bytes read"
        elif not expected & set(fields):
            reason = "no known column in the header"
        out.append((path, fields, reason))
    return out


@dataclass
class Ingested:
    """What became of a folder of files: ``rows`` of all loadable ones, and the files left out."""

    rows: DataFrame
    quarantine: DataFrame  # file, reason
    parsed: DataFrame  # rows with _corrupt_record, the raw line of a row that does not fit the types

    def rejects(self) -> DataFrame:
        """(_source_file, _corrupt_record) of lines with a value or a number of fields that does not fit. Such rows are in
        ``rows`` too, with NULL for what did not parse."""
        from valuelens.session import cut_lineage

        bad = cut_lineage(self.parsed.where(F.col("_corrupt_record").isNotNull()))  # Spark gives the raw line with whole rows only
        return bad.select("_source_file", "_corrupt_record")


def ingest_folder(spark: SparkSession, folder: str, schema: StructType = RAW_PLAYER, pattern: str = "*.csv") -> Ingested:
    """S2 + S3: all CSV files of a folder, matched to the schema by column NAME, bad ones reported.

    Files are grouped by distinct header; each group is one typed scan in its own column order, so the plan has as
    many branches as there are different headers. Columns that a header lacks are NULL, unknown ones are not read, of
    repeated names the first counts. Files that cannot be loaded are not read and stand in ``quarantine``.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    bad = []
    for path, fields, reason in file_index(spark, folder, schema, pattern):
        if reason:
            bad.append((path, reason))
        else:
            groups.setdefault(tuple(fields), []).append(path)
    meta = StructType([StructField("_corrupt_record", StringType()), StructField("_source_file", StringType()), StructField("_block_start", LongType())])
    frames = [_typed_scan(spark, list(h), paths, schema) for h, paths in sorted(groups.items())]
    parsed = reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], StructType([*schema.fields, *meta.fields]))
    quarantine = spark.createDataFrame(bad, "file string, reason string")
    return Ingested(parsed.drop("_corrupt_record"), quarantine, parsed)


def _typed_scan(spark: SparkSession, header: list[str], paths: list[str], schema: StructType) -> DataFrame:
    kinds = {f.name: f.dataType for f in schema.fields}
    place = {name: i for i, name in reversed(list(enumerate(header)))}
    fields = [StructField(f"_f{i}", kinds[n] if n in kinds and place[n] == i else StringType()) for i, n in enumerate(header)]
    scan = (spark.read.schema(StructType([*fields, StructField("_corrupt_record", StringType())])).option("header", True)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").csv([_literal(p) for p in paths]))
    columns = [(F.col(f"_f{place[n]}") if n in place else F.lit(None).cast(t)).alias(n) for n, t in kinds.items()]
    return scan.select(*columns, "_corrupt_record", F.col("_metadata.file_path").alias("_source_file"), F.col("_metadata.file_block_start").alias("_block_start"))


def read_csv_folder(spark: SparkSession, folder: str, schema: StructType = RAW_PLAYER, pattern: str = "*.csv") -> DataFrame:
    """S2 + S3 + S4: the rows of ``ingest_folder``; a warning names files left out. No files -> empty typed DataFrame."""
    found = ingest_folder(spark, folder, schema, pattern)
    left_out = found.quarantine.collect()
    if left_out:
        warnings.warn(f"{len(left_out)} files not loaded: " + "; ".join(f"{r.file} ({r.reason})" for r in left_out[:10]), stacklevel=2)
    return found.rows


def read_json_records(spark: SparkSession, path: str, schema: StructType = RAW_PLAYER) -> DataFrame:
    """JSON Lines records with a fixed schema (reads what K3 writes)."""
    return spark.read.schema(schema).json(path)


def landing_batch(spark: SparkSession, landing_dir: str, schema: StructType = RAW_PLAYER) -> DataFrame:
    """An uploaded batch is a CSV file dropped in a landing folder."""
    return read_csv(spark, landing_dir, schema)


def load_feature_list(spark: SparkSession, path: str) -> DataFrame:
    """Saved feature list (position, feature, is_categorical)."""
    return spark.read.parquet(path)
