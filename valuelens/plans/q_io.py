"""Driver queries for sources and sinks: whole tables written and read back through the library's
writers and readers, in a fresh folder under the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuelens.plans.registry import register, table
from valuelens.sinks import writers
from valuelens.sources import files
from valuelens.streaming.jobs import scratch

_CUSTOMER_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


@register("csv_roundtrip", _CUSTOMER_SQL)
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 + K5 + S1/S2: customers written as per-segment CSV folders, two of them with the columns in
    reverse order, then read back as one table matched by column NAME with the fixed schema."""
    c = table(spark, sf_dir, "customer")
    root = scratch(spark, "csv-roundtrip")
    flipped = F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING")
    writers.write_table(c.filter(~flipped), f"{root}/landing", "csv")
    # a second batch lands in the same folder with its columns in another order
    c.filter(flipped).select(*reversed(c.columns)).write.mode("append").option("header", True).csv(f"{root}/landing")
    return files.read_csv_folder(spark, f"{root}/landing", c.schema).drop("_source_file", "_block_start")


@register("json_roundtrip", _CUSTOMER_SQL)
def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 + K6: JSON Lines written and read back with the fixed schema."""
    c = table(spark, sf_dir, "customer")
    root = scratch(spark, "json-roundtrip")
    assert writers.write_json_lines(c, f"{root}/json")
    return files.read_json_records(spark, f"{root}/json", c.schema)


@register("partitioned_write", _CUSTOMER_SQL + " WHERE c_mktsegment = 'BUILDING'")
def partitioned_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: one folder per segment (spaces -> '_'); reading one segment back prunes the others
    (the filter on the partition column becomes a partition filter, not a scan of every file)."""
    c = table(spark, sf_dir, "customer")
    root = scratch(spark, "by-league")
    writers.write_by_league(c, f"{root}/out", col="c_mktsegment")
    back = spark.read.parquet(f"{root}/out").filter(F.col("c_mktsegment_part") == "BUILDING")
    return back.select(*c.columns)


@register(
    "csv_rejects",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus <> 'P'",
)
def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: orders written as CSV where pending orders carry a non-numeric price; the typed read keeps
    the parsable rows and routes the others to a rejects table instead of failing the load."""
    from pyspark.sql.types import DoubleType, LongType, StructField, StructType

    from valuelens.operators.serving import split_rejects

    o = table(spark, sf_dir, "orders")
    root = scratch(spark, "csv-rejects")
    price = F.when(F.col("o_orderstatus") == "P", F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    writers.write_table(o.select("o_orderkey", "o_custkey", price.alias("o_totalprice")), f"{root}/in", "csv")
    schema = StructType([StructField("o_orderkey", LongType()), StructField("o_custkey", LongType()),
                         StructField("o_totalprice", DoubleType())])
    raw = files.read_csv(spark, f"{root}/in", schema, with_source=False, bad_records=True)
    # materialise the parse once (the corrupt-record column is only visible on a stored copy)
    from valuelens.session import cut_lineage

    good, bad = split_rejects(cut_lineage(raw))
    writers.write_table(bad, f"{root}/rejects")
    return good


@register("ingest_quarantine", """
SELECT 'row' AS kind, c_mktsegment AS what, c_custkey, c_name, CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE c_acctbal END AS c_acctbal
FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'
UNION ALL SELECT 'file', 'not UTF-8: ' || count(*) || ' lines', -1, NULL, NULL FROM customer WHERE c_mktsegment = 'HOUSEHOLD' HAVING count(*) > 0
UNION ALL SELECT 'file', 'no known column in the header', -1, NULL, NULL
UNION ALL SELECT 'line', c_custkey || ',' || c_name || ',AUTOMOBILE,n/a,x', -1, NULL, NULL FROM customer WHERE c_mktsegment = 'AUTOMOBILE' AND c_acctbal < 0
UNION ALL SELECT 'row', 'AUTOMOBILE', c_custkey, c_name, NULL FROM customer WHERE c_mktsegment = 'AUTOMOBILE' AND c_acctbal < 0
""")
def ingest_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 + S3 + C1: customers in one folder of files with four different headers (order, a missing and an unknown column), a
    file that is no UTF-8, one of another table, and debtors once more with a balance that is no number and a field too
    many; the loaded rows, the files set aside with their reason, and the rejected lines."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    root = f"{scratch(spark, 'quarantine')}/in"
    part = lambda *segments: c.where(F.col("c_mktsegment").isin(*segments))
    put = lambda df: df.write.mode("append").option("header", True).csv(root)
    put(part("MACHINERY", "AUTOMOBILE"))
    put(part("BUILDING").select("c_acctbal", "c_mktsegment", "c_name", "c_custkey"))
    put(part("FURNITURE").select("c_name", "c_custkey", F.lit("x").alias("note"), "c_mktsegment"))
    put(spark.range(3).withColumnRenamed("id", "elsewhere").coalesce(1))
    # files written as raw lines: one with bytes that are no UTF-8, one with values that do not fit
    top = spark.createDataFrame([("c_custkey,c_name,c_mktsegment,c_acctbal",)], "value string")
    lines = lambda segment, *fields: part(segment).select(F.concat_ws(",", "c_custkey", *fields).alias("value"), "c_acctbal")
    odd = lines("HOUSEHOLD", F.unhex(F.lit("FFFE")).cast("string"), F.lit("HOUSEHOLD"), F.lit("1.0"))
    debts = lines("AUTOMOBILE", "c_name", F.lit("AUTOMOBILE"), F.lit("n/a"), F.lit("x")).where("c_acctbal < 0")
    for df in (odd, debts):
        top.unionByName(df.select("value")).coalesce(1).write.mode("append").text(root)
    found = files.ingest_folder(spark, root, c.schema, "part-*")
    none = lambda kind: F.lit(None).cast(kind)
    extra = [F.lit(-1).cast("long").alias("c_custkey"), none("string").alias("c_name"), none("double").alias("c_acctbal")]
    rows = found.rows.select(F.lit("row").alias("kind"), F.col("c_mktsegment").alias("what"), "c_custkey", "c_name", "c_acctbal")
    return rows.unionByName(found.quarantine.select(F.lit("file").alias("kind"), F.col("reason").alias("what"), *extra)).unionByName(
        found.rejects().select(F.lit("line").alias("kind"), F.col("_corrupt_record").alias("what"), *extra))
