"""Structured Streaming jobs.

Every job reads files incrementally (``readStream`` with a fixed schema), keeps
its progress and state in a checkpoint folder under the shared
``spark.checkpoint.dir`` and writes Parquet, so a restarted job resumes exactly
where it stopped. ``trigger(availableNow=True)`` processes what is there and
stops (batch-like runs); drop it for a continuous job.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from valuelens.operators.dedupe import dedupe_keep_last
from valuelens.session import ensure_checkpoint_dir


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder for one job run under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def file_stream(spark: SparkSession, folder: str, schema: StructType, fmt: str = "parquet", glob: str | None = None,
                max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        r = r.option("header", True).option("mode", "PERMISSIVE")
    return r.load(folder)


def run_to_parquet(stream: DataFrame, out: str, checkpoint: str, mode: str = "append", available_now: bool = True):
    w = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode(mode)
    if available_now:
        w = w.trigger(availableNow=True)
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q


def ingest(spark: SparkSession, stream: DataFrame, out: str, checkpoint: str, conform_fn=None, available_now: bool = True):
    """Incremental ingest with a conformed schema, appended to a Parquet table."""
    s = conform_fn(stream) if conform_fn else stream
    return run_to_parquet(s, out, checkpoint, "append", available_now)


def dedupe_keep_last_stream(stream: DataFrame, key: str, order: Sequence[str], changelog: str, checkpoint: str,
                            available_now: bool = True):
    """R2: streaming keyed dedupe, keep-last.

    A streaming aggregation keeps, per key, the row with the greatest order
    tuple (``max_by`` state, one entry per key). Each micro-batch emits only
    the keys it changed (update mode) and appends them to a changelog table;
    ``current_rows`` reduces the changelog to the latest row per key.
    foreachBatch is at-least-once: a micro-batch replayed after a failure
    appends the same rows again, which the keep-last reduction absorbs.
    """
    others = [c for c in stream.columns if c != key]
    agg = stream.groupBy(key).agg(F.max_by(F.struct(*[F.col(c) for c in others]), F.struct(*[F.col(o) for o in order])).alias("row"))
    flat = agg.select(key, "row.*")

    def append_batch(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("_batch_id", F.lit(batch_id)).write.mode("append").parquet(changelog)

    w = flat.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(append_batch)
    if available_now:
        w = w.trigger(availableNow=True)
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q


def current_rows(spark: SparkSession, changelog: str, key: str, order: Sequence[str]) -> DataFrame:
    """Latest row per key from an R2 changelog."""
    return dedupe_keep_last(spark.read.parquet(changelog), key, list(order) + ["_batch_id"]).drop("_batch_id")


def score_stream(model, stream: DataFrame, out: str, checkpoint: str, log_target: bool = True, available_now: bool = True):
    """Apply a fitted PipelineModel to a stream (same transform as batch) and append predictions."""
    from valuelens.operators.learn import predict_value

    scored = predict_value(model, stream, log_target)
    return run_to_parquet(scored.drop("features"), out, checkpoint, "append", available_now)


def group_profile_stream(stream: DataFrame, keys: Sequence[str], value: str, out_changelog: str, checkpoint: str,
                         available_now: bool = True):
    """Running per-group profile (count, non-null count, sum, mean, min, max) with algebraic
    aggregates only; updated groups are appended to a changelog each micro-batch."""
    agg = stream.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.count(value).alias("n_value"), F.sum(value).alias("sum_value"),
        F.avg(value).alias("mean_value"), F.min(value).alias("min_value"), F.max(value).alias("max_value"),
    )

    def append_batch(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("_batch_id", F.lit(batch_id)).write.mode("append").parquet(out_changelog)

    w = agg.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(append_batch)
    if available_now:
        w = w.trigger(availableNow=True)
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q


def current_groups(spark: SparkSession, changelog: str, keys: Sequence[str]) -> DataFrame:
    """Latest profile per group from an R4 changelog."""
    df = spark.read.parquet(changelog)
    others = [c for c in df.columns if c not in keys and c != "_batch_id"]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*others), F.col("_batch_id")).alias("r")).select(*keys, "r.*")


def windowed_profile_stream(stream: DataFrame, ts: str, window: str, keys: Sequence[str], value: str, delay: str,
                            out_changelog: str, checkpoint: str, available_now: bool = True):
    """R4 with event time: per (tumbling window, keys) count / sum / mean / min / max.

    The watermark (``delay`` behind the latest event time seen) lets Spark drop
    the state of windows that can no longer change; late rows within the delay
    still update their window. Updated windows are appended to a changelog
    (update mode), reduced by ``current_groups``.
    """
    from pyspark.sql.types import TimestampNTZType

    ntz = isinstance(stream.schema[ts].dataType, TimestampNTZType)
    if ntz:  # watermarks need instants: read wall-clock event times in the session time zone
        stream = stream.withColumn("__event_time", F.col(ts).cast("timestamp"))
        ts = "__event_time"
    agg = (stream.withWatermark(ts, delay)
           .groupBy(F.window(ts, window).alias("w"), *keys)
           .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("sum_value"), F.avg(value).alias("mean_value"),
                F.min(value).alias("min_value"), F.max(value).alias("max_value")))
    start, end = F.col("w.start"), F.col("w.end")
    if ntz:
        start, end = start.cast("timestamp_ntz"), end.cast("timestamp_ntz")
    flat = agg.select(start.alias("window_start"), end.alias("window_end"), *keys,
                      "n", "sum_value", "mean_value", "min_value", "max_value")

    def append_batch(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("_batch_id", F.lit(batch_id)).write.mode("append").parquet(out_changelog)

    w = flat.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(append_batch)
    if available_now:
        w = w.trigger(availableNow=True)
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q


def dedupe_keep_last_bounded(stream: DataFrame, key: str, order: Sequence[str], ts: str, horizon: str,
                             changelog: str, checkpoint: str, available_now: bool = True):
    """R2 with bounded state: keep-last per key through ``applyInPandasWithState``.

    Each key's state is its current latest row; a key not seen for ``horizon``
    of event time (past the watermark) times out and its state is dropped, so
    state stays proportional to the recently active keys. Changed keys are
    appended to a changelog each micro-batch (reduce it with ``current_rows``).
    A key's rows of one micro-batch arrive as an iterator of Arrow chunks and
    are reduced chunk by chunk (bounded memory), but in one task: for keys
    that may hold a large share of every batch, ``dedupe_keep_last_stream``
    (partial aggregation, unbounded state) is the skew-safe choice.
    """
    import pandas as pd
    from pyspark.sql.streaming.state import GroupStateTimeout
    from pyspark.sql.types import TimestampNTZType

    cols = stream.columns
    schema = stream.schema
    et = F.col(ts).cast("timestamp") if isinstance(schema[ts].dataType, TimestampNTZType) else F.col(ts)
    src = stream.withColumn("__et", et).withWatermark("__et", horizon)
    order_idx = [cols.index(o) for o in order]

    def _ms(text: str) -> int:
        n, unit = text.split()
        mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]
        return int(float(n) * mult * 1000)

    span = _ms(horizon)

    def latest(k, pdfs, state):
        if state.hasTimedOut:
            state.remove()
            return
        best = state.get if state.exists else None
        for pdf in pdfs:
            pdf = pdf[cols]
            top = pdf.sort_values(list(order), kind="mergesort").iloc[-1]
            cand = tuple(top[c] for c in cols)
            if best is None or tuple(cand[i] for i in order_idx) > tuple(best[i] for i in order_idx):
                best = cand
        if best is None:
            return
        state.update(best)
        state.setTimeoutTimestamp(state.getCurrentWatermarkMs() + span)
        yield pd.DataFrame([best], columns=cols)

    out = src.groupBy(key).applyInPandasWithState(latest, schema, schema, "Update", GroupStateTimeout.EventTimeTimeout)

    def append_batch(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("_batch_id", F.lit(batch_id)).write.mode("append").parquet(changelog)

    w = out.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(append_batch)
    if available_now:
        w = w.trigger(availableNow=True)
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q
