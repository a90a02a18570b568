import random

import corpus_pipeline
from llm_rows import EDGE

from test_crf_models import toxic_corpus
from test_near_dup import brute


def test_stages_on_planted_rows(spark, tmp_path):
    """Toxic rows, near copies and benchmark passages go; clean rows stay; the mix and the shards keep their bounds."""
    rng = random.Random(11)
    rows, labels = toxic_corpus(rng, 700)
    long = {i: t.split() for i, t in rows if len(t.split()) > 40}
    truth = dict(labels)
    clean = [i for i in long if truth[i] == 0][:30]
    copies = [(2000 + n, " ".join([*long[i][:-1], "zz"])) for n, i in enumerate(clean[:10])] + [(2100 + n, dict(rows)[i]) for n, i in enumerate(clean[10:15])]
    passage = " ".join(f"bench{i}" for i in range(14))
    leaks = [(3000 + n, dict(rows)[i][:60] + f" {n} " + passage.upper()) for n, i in enumerate(clean[15:20])]
    docs = [*rows, *copies, *leaks, *[(None if i is None else 9000 + i, t) for i, t in EDGE]]
    full = [(i, t, "en", rng.choice(["a", "b", None]), len(t or "")) for i, t in docs]
    spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    now = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns, ids = now.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, str(tmp_path))
        if name != "sharding":
            assert out.columns == columns
        out.write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        ids[name] = [r.doc_id for r in now.select("doc_id").collect()]
    toxic = {i for i, y in labels if y}
    assert len(toxic & set(ids["toxicity"])) < 0.05 * len(toxic)
    assert len({i for i, y in labels if not y} - set(ids["toxicity"])) < 10
    before = spark.read.parquet(str(tmp_path / "toxicity")).where("doc_id is not null").collect()
    want = {i for i, (_, c) in brute([(r.doc_id, r.text) for r in before], 5).items() if i == c}
    assert sorted(i for i in ids["near_dedup"] if i is not None) == sorted(want)
    assert set(ids["near_dedup"]) - set(ids["decontamination"]) == {i for i, _ in leaks} & set(ids["near_dedup"])
    times = {i: ids["mixing"].count(i) for i in set(ids["mixing"])}
    assert max(times.values()) <= 2 and set(times) <= set(ids["decontamination"])
    loads = [r["count"] for r in now.groupBy("shard").count().collect()]
    assert sum(loads) == len(ids["mixing"]) and max(loads) - min(loads) <= 1
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixing", "sharding"]
