"""Quarters are published from checked months only."""

import random

import pytest
from test_pipeline import make_place, month_lines, table

from opslog.fixed import BUILD_SCHEMA, VERDICT_SCHEMA
from opslog.operators import features as H
from opslog.operators import verdicts as V
from opslog.plans import pipeline as P
from opslog.plans.audit import StepFailed

MONTHS = ["2005-06", "2005-07", "2005-08", "2005-09"]


@pytest.fixture
def place(spark, tmp_path):
    return make_place(spark, tmp_path)


def spoil(landing, month):
    """A month that is log text but loses four percent of its lines."""
    lines = [*month_lines(month, 288), *month_lines(month, 0, bad=12)]
    (landing / f"BGL_{month}.log").write_text("\n".join(lines) + "\n")


def quarters_of(lake):
    return sorted(r.quarter for r in lake.features().select("quarter").distinct().collect())


def test_a_failed_month_keeps_its_quarter_back(place):
    lake, landing = place
    spoil(landing, "2005-08")
    done = P.backfill(lake, str(landing), MONTHS, "2005-09")
    assert done["quality_check"]["2005-08"].error
    assert done["aggregate"]["2005Q3"].error == (
        "2005Q3 is not complete: 2005-08 failed: 2005-08: 4.00% of lines dropped (limit 1%)")
    assert quarters_of(lake) == ["2005Q2"] and "2005Q3" not in done["deliver"]
    told = lake.audit().filter("step = 'aggregate' and period = '2005Q3'").first()
    assert told.status == "failed" and "2005-08 failed" in told.message
    with pytest.raises(StepFailed, match="no curated rows"):
        P.deliver_quarters(lake, ["2005Q3"])


def test_asked_for_it_is_published_without_the_month(place):
    lake, landing = place
    spoil(landing, "2005-08")
    done = P.backfill(lake, str(landing), MONTHS, allow_incomplete=True)
    assert not done["deliver"]["2005Q3"].error and done["aggregate"]["2005Q3"].rows_in == 600
    assert done["aggregate"]["2005Q3"].message.startswith("without 2005-08 failed")
    shown = lake.features().filter("quarter = '2005Q3'")
    assert table(shown) == table(H.hourly_features(lake.processed(["2005-07", "2005-09"])))
    # Delivering it again without asking is refused, and what was published stays.
    before = table(lake.features())
    with pytest.raises(StepFailed, match="not complete: 2005-08 failed"):
        P.deliver_quarters(lake, ["2005Q3"])
    assert table(lake.features()) == before


def test_a_repaired_month_completes_its_quarter(place):
    lake, landing = place
    good = (landing / "BGL_2005-08.log").read_text()
    (landing / "BGL_2005-08.log").write_text("no log at all\n" * 300)
    done = P.backfill(lake, str(landing), MONTHS)
    assert "was never cleaned" in done["aggregate"]["2005Q3"].error and quarters_of(lake) == ["2005Q2"]
    (landing / "BGL_2005-08.log").write_text(good)
    done = P.backfill(lake, str(landing), ["2005-08"])
    assert list(done["deliver"]) == ["2005Q3"] and not done["deliver"]["2005Q3"].error
    assert quarters_of(lake) == ["2005Q2", "2005Q3"]


def test_september_alone_publishes_nothing(place):
    lake, landing = place
    done = P.backfill(lake, str(landing), ["2005-09"])
    assert not done["quality_check"]["2005-09"].error and done["deliver"] == {}
    assert done["aggregate"]["2005Q3"].error == (
        "2005Q3 is not complete: 2005-07 was never cleaned; 2005-08 was never cleaned")
    done = P.backfill(lake, str(landing), ["2005-09"], first_month="2005-09")
    assert not done["deliver"]["2005Q3"].error and quarters_of(lake) == ["2005Q3"]


def test_a_month_that_was_cleaned_again_must_be_checked_again(place):
    lake, landing = place
    P.backfill(lake, str(landing), MONTHS)
    before = table(lake.features())
    again = P.clean_months(lake, ["2005-07"])
    with pytest.raises(StepFailed, match="2005-07 was cleaned but not checked"):
        P.aggregate_quarters(lake, ["2005Q3"])
    with pytest.raises(StepFailed, match="2005-07 was cleaned but not checked"):
        P.deliver_quarters(lake, ["2005Q3"])
    P.check_quality(lake, again)
    with pytest.raises(StepFailed, match="2005-07 is not in the curated rows, aggregate again"):
        P.deliver_quarters(lake, ["2005Q3"])
    P.aggregate_quarters(lake, ["2005Q3"])
    P.deliver_quarters(lake, ["2005Q3"])
    assert table(lake.features()) == before


def test_last_month_ends_the_data_inside_a_quarter(place):
    lake, landing = place
    done = P.backfill(lake, str(landing), MONTHS[:3], "2005-08")
    assert not done["deliver"]["2005Q3"].error and quarters_of(lake) == ["2005Q2", "2005Q3"]
    with pytest.raises(StepFailed, match="2005-09 was never cleaned"):
        P.deliver_quarters(lake, ["2005Q3"])
    P.deliver_quarters(lake, ["2005Q3"], last_month="2005-08")


# ---- operators -----------------------------------------------------------

def plain_current(rows):
    out = {}
    for month in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == month]
        begun = {load: min(r[4] for r in mine if r[1] == load) for load in {r[1] for r in mine}}
        load = max(begun, key=lambda k: (begun[k], k))
        last = max((r for r in mine if r[1] == load), key=lambda r: r[4])
        out[month] = (month, load, last[2], last[3])
    return sorted(out.values())


def test_current_verdicts_equal_a_plain_loop(spark):
    rng = random.Random(4)
    rows = [(f"200{rng.randrange(3)}-0{rng.randrange(1, 4)}", rng.choice("abcd"), rng.choice(V.VERDICTS), f"m{i}", i, None)
            for i in range(200)]
    rng.shuffle(rows)
    got = V.current_verdicts(spark.createDataFrame(rows, VERDICT_SCHEMA))
    assert sorted(map(tuple, got.collect())) == plain_current(rows)


def test_gaps_respect_bounds_and_builds(spark):
    verdicts = spark.createDataFrame(
        [("2005-07", "a", "passed", None, 1, None), ("2005-08", "b", "failed", None, 2, None),
         ("2005-10", "c", "pending", None, 3, None)], VERDICT_SCHEMA)
    quarters = spark.createDataFrame([("2005Q3",), ("2005Q4",), ("no",), (None,)], "quarter string")
    current = V.current_verdicts(verdicts)
    gaps = lambda *a: sorted((r.quarter, r.month, r.reason) for r in V.quarter_gaps(quarters, current, *a).collect())
    assert gaps("2005-07", "2005-10") == [
        ("2005Q3", "2005-08", "failed: no reason given"), ("2005Q3", "2005-09", "was never cleaned"),
        ("2005Q4", "2005-10", "was cleaned but not checked")]
    assert len(gaps()) == 5
    builds = spark.createDataFrame(
        [("2005Q3", "x", "2005-07", "a", 1), ("2005Q3", "y", "2005-07", "old", 2)], BUILD_SCHEMA)
    assert gaps("2005-07", "2005-07", V.newest_builds(builds)) == [
        ("2005Q3", "2005-07", "is not in the curated rows, aggregate again")]
    assert gaps("2005-07", "2005-07", V.newest_builds(builds.filter("build_id = 'x'"))) == []
