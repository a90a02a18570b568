"""A keyed table that a stream keeps up to date and that stays small.

The table is a folder of Parquet parts and of numbered manifests. A manifest is one row, written in one step: the parts that
make up the table, and the last micro-batch in them. A micro-batch writes its changed rows as a part and then the next manifest; every
``compact_every`` batches the parts are reduced to one (the last row per key, and none older than ``keep`` if that is given)
in the same step. So a reader takes the newest manifest and sees that version whole, whatever is written meanwhile; a batch
that is replayed after a failure finds itself in the manifest and changes nothing; and files are bounded: parts that none
of the last ``versions`` manifests names are removed, with manifests older than these.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuelens.operators.dedupe import dedupe_keep_last

_MANIFEST = "parts array<string>, batch long, schema string, version int"


@dataclass
class SnapshotTable:
    """``order``: columns by which a row is newer. ``keep``: (column, interval as text), e.g. ("ts", "30 days"): at a compaction, keys
    whose row lies further behind the newest one are dropped."""

    root: str
    key: Sequence[str]
    order: Sequence[str]
    compact_every: int = 8
    versions: int = 4
    keep: tuple[str, str] | None = None

    def _manifests(self, spark: SparkSession) -> list:
        try:
            table = spark.read.schema(_MANIFEST).parquet(f"{self.root}/manifest")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return table.orderBy(F.col("version").desc()).collect()  # a few rows: older ones are removed

    def read(self, spark: SparkSession) -> DataFrame:
        """The newest version: one row per key. A table without any batch raises."""
        found = self._manifests(spark)
        if not found:
            raise LookupError(f"no version below {self.root}")
        return self._rows(spark, found[0])

    def _rows(self, spark: SparkSession, manifest) -> DataFrame:
        from pyspark.sql.types import StructType

        rows = spark.read.schema(StructType.fromDDL(manifest.schema)).parquet(*[f"{self.root}/parts/{p}" for p in manifest.parts])
        return dedupe_keep_last(rows, list(self.key), list(self.order)) if len(manifest.parts) > 1 else rows

    def upsert(self, changed: DataFrame, batch: int) -> bool:
        """Take the rows of a micro-batch over (for ``foreachBatch``); False if it is in the table already."""
        spark = changed.sparkSession
        found = self._manifests(spark)
        last = found[0] if found else None
        if last is not None and last.batch >= batch:
            return False
        part = self._write(dedupe_keep_last(changed, list(self.key), list(self.order)).select(*changed.columns))
        parts = [*(last.parts if last else []), part]
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in changed.schema.fields)
        if len(parts) >= self.compact_every:
            whole = spark.read.schema(changed.schema).parquet(*[f"{self.root}/parts/{p}" for p in parts])
            whole = dedupe_keep_last(whole, list(self.key), list(self.order)).select(*changed.columns)
            if self.keep:
                column, interval = self.keep
                newest = whole.agg(F.max(column).alias("__newest"))
                whole = whole.crossJoin(F.broadcast(newest)).where(F.col(column) >= F.col("__newest") - F.expr(f"interval {interval}")).drop("__newest")
            parts = [self._write(whole)]
        number = last.version + 1 if last else 1
        row = spark.createDataFrame([(parts, batch, ddl)], "parts array<string>, batch long, schema string").coalesce(1)
        row.write.mode("errorifexists").parquet(f"{self.root}/manifest/version={number}")  # the switch
        self._remove_old(spark)
        return True

    def _write(self, rows: DataFrame) -> str:
        name = uuid.uuid4().hex
        rows.write.option("compression", "zstd").parquet(f"{self.root}/parts/{name}")
        return name

    def _remove_old(self, spark: SparkSession) -> None:
        """Manifests before the last ``versions``, then the parts that none of those that stay names."""
        found = self._manifests(spark)
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
        fs = path(self.root).getFileSystem(conf)
        for m in found[self.versions :]:
            fs.delete(path(f"{self.root}/manifest/version={m.version}"), True)
        named = {p for m in found[: self.versions] for p in m.parts}
        for status in fs.listStatus(path(f"{self.root}/parts")):
            if status.getPath().getName() not in named:
                fs.delete(status.getPath(), True)


def keep_last_table(stream: DataFrame, table: SnapshotTable, checkpoint: str, available_now: bool = True):
    """R2: a stream's last row per key, kept as a ``SnapshotTable``. A micro-batch is reduced by itself and merged with the table
    when it is read or compacted, so the stream holds no state of its own that could grow."""
    w = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda batch, number: table.upsert(batch, number))
    if available_now:
        w = w.trigger(availableNow=True)
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q
