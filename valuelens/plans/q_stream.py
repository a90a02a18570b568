"""Driver queries for the streaming jobs (R1, R2, R4): each runs the stream over the events
file to completion (availableNow) and returns the final table, checked with SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from valuelens.plans.registry import register, round_doubles, table
from valuelens.streaming import jobs


def _events_stream(spark: SparkSession, sf_dir: str):
    schema = table(spark, sf_dir, "events").schema
    return jobs.file_stream(spark, sf_dir, schema, "parquet", glob="events.parquet")


@register(
    "stream_ingest_dedupe",
    """
SELECT user_id, event_id, ts, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def stream_ingest_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = jobs.scratch(spark, "ingest-dedupe")
    raw = f"{root}/raw"
    jobs.ingest(spark, _events_stream(spark, sf_dir), raw, f"{root}/ck-ingest")
    landed = jobs.file_stream(spark, raw, table(spark, sf_dir, "events").schema, "parquet")
    jobs.dedupe_keep_last_stream(landed, "user_id", ["ts", "event_id"], f"{root}/changelog", f"{root}/ck-dedupe")
    out = jobs.current_rows(spark, f"{root}/changelog", "user_id", ["ts", "event_id"])
    return out.select("user_id", "event_id", "ts", "event_type", "value", "props")


@register(
    "stream_snapshot_table",
    """
SELECT user_id, event_id, ts, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def stream_snapshot_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1 + R2: events land in eight files, arrive file by file, and are kept as a table of versioned snapshots."""
    from valuelens.streaming.snapshots import SnapshotTable, keep_last_table

    root = jobs.scratch(spark, "snapshots")
    events = table(spark, sf_dir, "events")
    events.repartition(8).write.parquet(f"{root}/landed")
    stream = jobs.file_stream(spark, f"{root}/landed", events.schema, "parquet", max_files_per_trigger=1)
    kept = SnapshotTable(f"{root}/table", ["user_id"], ["ts", "event_id"], compact_every=4)
    keep_last_table(stream, kept, f"{root}/ck")
    return kept.read(spark).select("user_id", "event_id", "ts", "event_type", "value", "props")


@register(
    "stream_group_profile",
    """
SELECT event_type, count(*) AS n, count(value) AS n_value, round(sum(value), 4) AS sum_value, round(avg(value), 4) AS mean_value,
       round(min(value), 4) AS min_value, round(max(value), 4) AS max_value
FROM events GROUP BY event_type""",
)
def stream_group_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = jobs.scratch(spark, "group-profile")
    jobs.group_profile_stream(_events_stream(spark, sf_dir), ["event_type"], "value", f"{root}/changelog", f"{root}/ck")
    return round_doubles(jobs.current_groups(spark, f"{root}/changelog", ["event_type"]))


@register("stream_score")
def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fitted forest applied to line items arriving as a stream (stream-static joins to
    part / orders / customer), test split only; predictions land in Parquet (rows-only check)."""
    from pyspark.sql import functions as F

    from valuelens.plans import q_learn

    model = q_learn._fitted(spark, sf_dir, "rf")
    li = jobs.file_stream(spark, sf_dir, table(spark, sf_dir, "lineitem").schema, "parquet", glob="lineitem.parquet")
    rows = q_learn.model_table(spark, sf_dir, li).filter(F.col("split") == "test")
    root = jobs.scratch(spark, "stream-score")
    jobs.score_stream(model, rows, f"{root}/out", f"{root}/ck")
    return round_doubles(spark.read.parquet(f"{root}/out").select("row_key", "prediction", "predicted_value"))


@register(
    "stream_window_profile",
    """
SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, event_type,
       count(*) AS n, round(sum(value), 4) AS sum_value, round(avg(value), 4) AS mean_value,
       round(min(value), 4) AS min_value, round(max(value), 4) AS max_value
FROM events GROUP BY 1, 2, event_type""",
)
def stream_window_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R4 (event time): daily tumbling windows per event type with a 1-hour watermark."""
    root = jobs.scratch(spark, "window-profile")
    jobs.windowed_profile_stream(_events_stream(spark, sf_dir), "ts", "1 day", ["event_type"], "value", "1 hour",
                                 f"{root}/changelog", f"{root}/ck")
    return round_doubles(jobs.current_groups(spark, f"{root}/changelog", ["window_start", "window_end", "event_type"]))
