
from pyspark.sql import functions as F

import corpus_pipeline as pipeline

from fixtures import SF_DIR, awkward, documents
from test_minhash import brute as components
from test_packing import check, token_sizes
from test_quality import brute as counts
from test_secrets import base


def stage(name):
    return dict(pipeline.STAGES)[name]


def test_order_and_columns(spark):
    assert [n for n, _ in pipeline.STAGES] == ["quality_rules", "toxicity", "minhash_near_dedup", "secret_scans", "packing"]


def test_each_stage_against_brute_force(spark, tmp_path):
    docs = documents(spark)
    before = {r.doc_id: r.text for r in docs.collect()}
    for name, function in pipeline.STAGES:
        function(spark, docs, SF_DIR).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name == "packing":
            check(docs.collect(), token_sizes(before), 4096, 32768)
            break
        assert docs.columns == pipeline.COLUMNS
        after = {r.doc_id: r.text for r in docs.collect()}
        if name == "quality_rules":
            failed = {i for i, t in before.items() if (c := counts(t))["n_words"] < 20 or 100 * c["n_repeat_words"] > 30 * c["n_words"]}
            assert set(after) == set(before) - failed
        elif name == "toxicity":
            labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
            gone = set(before) - set(after)
            assert sum(labels.get(i, 1) for i in gone) >= 0.8 * len(gone) and len(gone) < 0.3 * len(before)
        elif name == "minhash_near_dedup":
            component, _ = components(before.items())
            assert set(after) == {i for i in before if component[i] == i}
        else:
            assert set(after) == set(before) and all(not base(t) for t in after.values())
            assert all(after[i] == t for i, t in before.items() if not base(t))
            assert docs.where(F.length("text") != F.col("n_chars")).count() == 0
        before = after


def test_run_is_the_stages(spark):
    rows = pipeline.run(spark, SF_DIR).collect()
    assert rows and len({(r.doc_id, r.piece) for r in rows}) == len(rows)


def test_awkward_rows(spark):
    docs = awkward(spark).select(*pipeline.COLUMNS, "label")
    for name, function in pipeline.STAGES[:-1]:
        out = function(spark, docs, SF_DIR)
        assert out.columns == pipeline.COLUMNS
        assert out.where("doc_id is null").count() == 1
        assert function(spark, docs.limit(0), SF_DIR).count() == 0
    assert stage("packing")(spark, docs, SF_DIR).where("doc_id is null").count() == 1
    assert stage("minhash_near_dedup")(spark, docs, SF_DIR).where("doc_id = 6").count() == 2
