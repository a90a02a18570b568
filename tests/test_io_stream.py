"""Sources, sinks, HTML extraction on synthetic pages, and batch == stream for the streaming jobs."""

import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from valuelens.operators import dedupe as dd
from valuelens.plans.registry import table
from valuelens.sources import html as hx
from valuelens.streaming import jobs

PAGE = """<html lang="en"><body><h1>Jan Novák</h1>
<table id="stats_standard"><tr class="thead"><th>Player</th></tr>
<tr><td><a href="/players/1">A</a></td><td>10</td></tr><tr><td>no link</td></tr></table>
<!-- <table id="scout_full_FW"><tr><th data-stat="statistic">Goals</th><td data-stat="per90">0.45</td></tr>
<tr><th data-stat="statistic">xG</th><td data-stat="per90">+0.30</td></tr><tr><th data-stat="statistic">x</th></tr></table> -->
<div><a href="/scout/x">scout</a> <a href="/scout/Scouting-Report-1">r</a></div>
<table><tr><td>€1,5m</td></tr><tr><td>€-</td></tr></table></body></html>"""


def pages(spark):
    return spark.createDataFrame([(1, "https://site.example/p/1", PAGE)], "page_id long, url string, html string")


def test_table_rows_skip_header_and_linkless(spark):
    rows = hx.extract_table_rows(pages(spark)).collect()
    assert [r.href for r in rows] == ["/players/1"]
    assert rows[0].cells == ["A", "10"]


def test_stat_pairs_from_comment(spark):
    got = [(r.stat_label, r.per90) for r in hx.stat_pairs(pages(spark)).orderBy("pos").collect()]
    assert got == [("Goals", "0.45"), ("xG", "+0.30")]


def test_link_predicate_and_abs_url(spark):
    links = hx.extract_links(pages(spark))
    first = hx.first_link_matching(links, ["/scout/", "Scouting-Report"]).first()
    assert first.href == "/scout/Scouting-Report-1"
    assert links.filter("pos = 1").first().abs_url == "https://site.example/players/1"


def test_first_valid_price(spark):
    cells = spark.createDataFrame([(1, 1, "€-"), (1, 2, "€1,5m"), (1, 3, "€2m")], "id int, pos int, t string")
    assert hx.first_valid_price(cells, "id", "pos", "t").first().value_m == 1.5


def test_stream_dedupe_equals_batch(spark):
    ev = table(spark, SF_SMALL, "events")
    root = jobs.scratch(spark, "t-dedupe")
    s = jobs.file_stream(spark, SF_SMALL, ev.schema, "parquet", glob="events.parquet")
    jobs.dedupe_keep_last_stream(s, "user_id", ["ts", "event_id"], f"{root}/log", f"{root}/ck")
    streamed = jobs.current_rows(spark, f"{root}/log", "user_id", ["ts", "event_id"]).select(*ev.columns)
    batch = dd.dedupe_keep_last(ev, "user_id", ["ts", "event_id"]).select(*ev.columns)
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_stream_scoring_equals_batch(spark):
    from valuelens.operators import learn as ml

    li = table(spark, SF_SMALL, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax", "l_extendedprice")
    model = ml.random_forest(["l_quantity", "l_tax"], "l_extendedprice", numTrees=3, maxDepth=3).fit(li)
    root = jobs.scratch(spark, "t-score")
    s = jobs.file_stream(spark, SF_SMALL, table(spark, SF_SMALL, "lineitem").schema, "parquet", glob="lineitem.parquet")
    s = s.select("l_orderkey", "l_linenumber", "l_quantity", "l_tax", "l_extendedprice")
    jobs.score_stream(model, s, f"{root}/out", f"{root}/ck", log_target=False)
    streamed = spark.read.parquet(f"{root}/out").select("l_orderkey", "l_linenumber", "predicted_value")
    batch = ml.predict_value(model, li, log_target=False).select("l_orderkey", "l_linenumber", "predicted_value")
    assert streamed.exceptAll(batch).count() == 0 and streamed.count() == li.count()


def test_model_loading_tolerates_missing(spark):
    from valuelens.operators import learn as ml
    from valuelens.operators.serving import input_features, load_models, model_registry
    from valuelens.sinks.writers import save_model

    li = table(spark, SF_SMALL, "lineitem").select("l_quantity", "l_tax", "l_extendedprice")
    m = ml.random_forest(["l_quantity", "l_tax"], "l_extendedprice", numTrees=2, maxDepth=2).fit(li)
    root = jobs.scratch(spark, "t-models")
    save_model(m, f"{root}/rf")
    paths = {"rf": f"{root}/rf", "gbt": f"{root}/missing"}
    models = load_models(paths)
    assert models["gbt"] is None and models["rf"] is not None
    assert {r.model: r.available for r in model_registry(spark, paths, models).collect()} == {"rf": True, "gbt": False}
    assert input_features(models) == ["l_quantity", "l_tax"]


def test_bad_rows_go_to_rejects(spark):
    from pyspark.sql.types import DoubleType, StructField, StructType

    from valuelens.operators.serving import split_rejects
    from valuelens.sources.files import read_csv

    root = tempfile.mkdtemp(prefix="vl-bad-")
    with open(f"{root}/a.csv", "w") as fh:
        fh.write("a,b\n1.5,2\nnot-a-number,3\n4,5\n")
    schema = StructType([StructField("a", DoubleType()), StructField("b", DoubleType())])
    df = read_csv(spark, root, schema, bad_records=True).cache()
    good, bad = split_rejects(df)
    assert good.count() == 2 and bad.count() == 1


def test_partitioned_write_prunes_on_read(spark):
    import contextlib
    import io

    from valuelens.sinks.writers import write_by_league

    c = table(spark, SF_SMALL, "customer")
    root = jobs.scratch(spark, "t-part")
    write_by_league(c.withColumn("c_mktsegment", F.concat(F.lit("Seg "), "c_mktsegment")), f"{root}/out", col="c_mktsegment")
    back = spark.read.parquet(f"{root}/out").filter(F.col("c_mktsegment_part") == "Seg_BUILDING")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        back.explain(mode="formatted")
    assert "PartitionFilters: [isnotnull(c_mktsegment_part" in buf.getvalue()
    assert back.count() == c.filter(F.col("c_mktsegment") == "BUILDING").count()


def test_bounded_state_dedupe_equals_batch(spark):
    ev = table(spark, SF_SMALL, "events")
    root = jobs.scratch(spark, "t-bounded")
    s = jobs.file_stream(spark, SF_SMALL, ev.schema, "parquet", glob="events.parquet")
    jobs.dedupe_keep_last_bounded(s, "user_id", ["ts", "event_id"], "ts", "400 days", f"{root}/log", f"{root}/ck")
    streamed = jobs.current_rows(spark, f"{root}/log", "user_id", ["ts", "event_id"]).select(*ev.columns)
    batch = dd.dedupe_keep_last(ev, "user_id", ["ts", "event_id"]).select(*ev.columns)
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
