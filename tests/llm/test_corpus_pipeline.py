import pytest

import corpus_pipeline
from opslog.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.conftest import ODD, documents

SF = "/root/testdata/sf0.001"


def test_stages_are_named_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixing", "sharding"]


def test_run_is_the_stages_one_after_another(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    counts = [docs.count()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(i))
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        counts.append(docs.count())
        if i < 4:
            assert docs.columns == columns
    assert counts[0] > counts[1] >= counts[2] >= counts[3] > counts[4] == counts[5] > 0
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(corpus_pipeline.run(spark, SF)) == key(docs)


def test_stages_take_no_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


@pytest.mark.parametrize("stage", [stage for _, stage in corpus_pipeline.STAGES])
def test_stages_take_odd_rows_and_extra_columns(spark, stage):
    plain, wide = documents(spark, ODD), documents(spark, ODD, extra=True)
    wide = wide.withColumnRenamed("key", "a.b")
    out = stage(spark, wide, SF)
    same = stage(spark, plain, SF)
    assert same.count() == out.count() > 0
    if stage is not corpus_pipeline.sharding:
        assert out.columns == wide.columns
        assert {r["a.b"] for r in out.select("`a.b`").collect()} == {"x"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_registered_queries_run(spark, name):
    df = QUERIES[name](spark, SF)
    assert len(df.columns) >= 3 and df.count() > 0


def test_every_operator_is_registered_once():
    assert {n.split("_")[0] for n in QUERIES if n != "pipeline"} == {f"op{i}" for i in range(1, 14)}
    assert set(ORACLE_SQL) <= set(QUERIES)
