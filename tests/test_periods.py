import pytest
from pyspark.sql import functions as F

from opslog.functions import periods as P

QUARTERS = {"2005-06": "2005Q2", "2005-07": "2005Q3", "2006-01": "2006Q1", "2005-12": "2005Q4"}


def columns(spark, values, **expressions):
    frame = spark.createDataFrame([(v,) for v in values], "p string")
    return frame.select("p", *(e.alias(n) for n, e in expressions.items())).collect()


def test_quarter_of(spark):
    rows = columns(spark, QUARTERS, q=P.quarter_of(F.col("p")))
    assert {r.p: r.q for r in rows} == QUARTERS == {m: P.quarter_name(m) for m in QUARTERS}


def test_months_of_quarter(spark):
    expected = {
        "2005Q3": ["2005-07", "2005-08", "2005-09"], "2005Q4": ["2005-10", "2005-11", "2005-12"],
        "2005Q1": ["2005-01", "2005-02", "2005-03"], "2005Q5": None, "2005-07": None,
    }
    rows = columns(spark, expected, m=P.months_of_quarter(F.col("p")))
    assert {r.p: r.m for r in rows} == expected
    assert P.month_names("2005Q3") == expected["2005Q3"]


def test_quarter_ends(spark):
    months = [f"2005-{n:02d}" for n in range(1, 13)]
    ends = ["2005-03", "2005-06", "2005-09", "2005-12"]
    assert [m for m in months if P.closes_quarter(m)] == ends
    assert [r.p for r in columns(spark, months, e=P.is_quarter_end(F.col("p"))) if r.e] == ends


def test_ready_quarter(spark):
    rows = columns(
        spark, ["2005-06", "2005-08", "2006-01"], q=P.ready_quarter(F.col("p"), F.lit("2006-01"))
    )
    assert [r.q for r in rows] == ["2005Q2", None, "2006Q1"]


BAD = ["2005-13", "2005-00", "05-06", "2005/06", "", "2005Q5", "2005-06\n", "x2005-06", "２００５-06"]


@pytest.mark.parametrize("bad", BAD)
def test_bad_periods_are_refused(bad):
    for check in (P.require_month, P.require_quarter, P.quarter_name, P.month_names, P.closes_quarter):
        with pytest.raises(ValueError):
            check(bad)


def test_bad_periods_as_columns(spark):
    p = F.col("p")
    for row in columns(spark, BAD, m=P.is_month(p), q=P.is_quarter(p), of=P.quarter_of(p)):
        assert (row.m, row.q, row.of) == (False, False, None), row.p


def test_landing_names(spark):
    row = columns(spark, ["2005-06"], n=P.landing_name(F.col("p")))[0]
    assert row.n == "BGL_2005-06.log"
    assert columns(spark, [row.n], m=P.month_of_landing_name(F.col("p")))[0].m == "2005-06"
