"""Every registered query equals its oracle SQL on the given tables."""

import glob
import math
import os
from pathlib import Path

import duckdb
import pytest
from conftest import ROOT, SF_DIR

import __spark_entry__ as entry
from opslog.plans.oracle import ORACLE_SQL as ORACLE
from opslog.plans.registry import QUERIES


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        connection.sql(f"CREATE VIEW {Path(path).stem} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def comparable(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 12)
    return value


def rows(columns, tuples):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(comparable(t[i]) for i in order) for t in tuples), key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= entry.queries().items() and ORACLE.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_the_data_reach_every_branch(spark, sf):
    folder = f"/root/testdata/{sf}"
    statuses = {r.status for r in QUERIES["ingest_decisions"](spark, folder).collect()}
    assert statuses == {"bad_month", "not_found", "wrong_format", "already_ingested", "conflict", "ingested"}
    gate = QUERIES["quality_gate"](spark, folder).collect()
    assert {r.status for r in gate} == {"success", "failed"}
    assert any("no valid lines" in r.message for r in gate) and any("dropped" in r.message for r in gate)
    assert QUERIES["message_templates"](spark, folder).count() >= 20
    busiest = QUERIES["quarterly_features"](spark, folder).agg({"events_total": "max"}).first()[0]
    assert busiest >= (100 if sf == "sf0.01" else 10)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, database, name):
    frame = QUERIES[name](spark, SF_DIR)
    expected = database.sql(ORACLE[name])
    assert sorted(frame.columns) == sorted(expected.columns)
    ours, theirs = frame.collect(), expected.fetchall()
    assert len(ours) == len(theirs) > 0
    assert rows(frame.columns, ours) == rows(expected.columns, theirs)


def test_entry_is_lazy_and_has_rows(spark):
    assert len(entry.entry(spark).take(1)) == 1


def test_no_python_workers_and_no_cross_joins(spark):
    for name, query in QUERIES.items():
        plan = query(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        for word in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "NestedLoop"):
            assert word not in plan, (name, word)


def test_the_engine_never_keeps_rows_on_one_machine():
    for path in (ROOT / "opslog").rglob("*.py"):
        text = path.read_text(encoding="utf-8")
        for word in ("localCheckpoint", "toPandas", "pandas_udf", "crossJoin(", ".rdd"):
            assert word not in text, (os.fspath(path), word)
