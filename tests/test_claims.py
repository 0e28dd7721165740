"""Exclusive claims, appends of several runs, and compaction of the operational tables."""

import threading
import time

import pytest
from test_pipeline import make_place, outcome, table

from opslog.fixed import AUDIT_SCHEMA, FEATURE_COLUMNS
from opslog.operators import reports as R
from opslog.plans import pipeline as P
from opslog.plans.audit import StepFailed, audited
from opslog.sources import files
from opslog.sources.claims import Claims, ClaimLost
from opslog.sources.lake import Lake


@pytest.fixture
def claims(spark, tmp_path):
    return Claims(spark, str(tmp_path / "claims"))


def together(count, work):
    """Run ``work(i)`` in threads that start at the same moment; the results in order."""
    gate, out = threading.Barrier(count), [None] * count

    def run(i):
        gate.wait()
        try:
            out[i] = work(i)
        except Exception as error:  # noqa: BLE001
            out[i] = error

    threads = [threading.Thread(target=run, args=(i,)) for i in range(count)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    return out


def test_only_one_of_many_gets_a_claim(claims):
    for _ in range(5):
        got = [c for c in together(12, lambda _: claims.take("2005-06", 60)) if c is not None]
        assert len(got) == 1 and claims.is_held(got[0])
        assert claims.holder("2005-06").owner == got[0].owner and claims.holder("2005-07") is None
        claims.release(got[0])
        assert claims.holder("2005-06") is None and not claims.is_held(got[0])
    left = files.entries(claims.spark, f"{claims.root}/2005-06")
    assert len(left) == 2  # the newest claim and its marker


def test_a_claim_that_ran_out_is_taken_once_and_noticed(claims):
    old = claims.take("m", 0.3)
    assert claims.take("m", 60) is None
    time.sleep(0.4)
    got = [c for c in together(12, lambda _: claims.take("m", 60)) if c is not None]
    assert len(got) == 1 and got[0].number == old.number + 1
    with pytest.raises(ClaimLost):
        claims.check(old)
    claims.release(old)  # a late release of the old claim does not free the new one
    assert claims.is_held(got[0]) and claims.take("m", 60) is None


def test_holding_waits_and_releases_after_an_error(claims):
    first = claims.take("a", 60)
    with claims.hold(["a", "b"], 60) as held:
        assert set(held) == {"b"}
    threading.Timer(0.5, lambda: claims.release(first)).start()
    with pytest.raises(RuntimeError), claims.hold(["b", "a"], 60, wait=20) as held:
        assert set(held) == {"a", "b"}
        raise RuntimeError
    assert claims.holder("a") is None and claims.holder("b") is None


def test_a_claim_without_text_counts_as_being_written(claims):
    files.create_new(claims.spark, f"{claims.root}/x/000000001", "")
    assert claims.holder("x").owner == "unknown" and claims.take("x", 60) is None


def test_an_entry_is_created_once(claims):
    path = f"{claims.root}/once"
    assert sorted(together(10, lambda i: files.create_new(claims.spark, path, str(i)))) == [False] * 9 + [True]
    assert files.read_text(claims.spark, path).isdigit() and files.read_text(claims.spark, path + "2") is None


@pytest.mark.parametrize("wait", [0, 60])
def test_concurrent_ingests_of_a_month_store_it_once(spark, tmp_path, wait):
    lake, landing = make_place(spark, tmp_path)

    def ingest(_):
        mine = Lake(spark.newSession(), lake.root, claim_wait=wait)
        return outcome(P.ingest(mine, str(landing), ["2005-06", "2005-07"], strict=False))

    got = together(2, ingest)
    assert not [g for g in got if isinstance(g, Exception)], got
    for month in ("2005-06", "2005-07"):
        results = sorted(g[month] for g in got)
        assert ("success", "ingested") in results
        other = next(r for r in results if r != ("success", "ingested"))
        assert other[1] == "already_ingested" or "claimed" in other[1]
        assert wait == 0 or other == ("success", "already_ingested")
    assert sorted(r.month for r in lake.manifest().collect()) == ["2005-06", "2005-07"]
    assert lake.raw(["2005-06"]).count() == 300
    assert lake.audit().filter("step = 'ingest'").count() == 4
    assert lake.claims.holder("2005-06") is None


def test_runs_on_different_periods_do_not_disturb_each_other(spark, tmp_path):
    lake, landing = make_place(spark, tmp_path)
    months = ["2005-06", "2005-07", "2005-08", "2005-09"]
    together(4, lambda i: P.ingest(Lake(spark.newSession(), lake.root), str(landing), [months[i]]))
    assert sorted(r.month for r in lake.manifest().collect()) == months
    P.check_quality(lake, P.clean_months(lake, months))
    P.aggregate_quarters(lake, ["2005Q2", "2005Q3"])
    got = together(2, lambda i: P.deliver_quarters(Lake(spark.newSession(), lake.root), [["2005Q2", "2005Q3"][i]]))
    assert not [g for g in got if isinstance(g, Exception)], got
    assert sorted(r.quarter for r in lake.published().collect()) == ["2005Q2", "2005Q3"]
    assert table(lake.features()) == table(lake.curated(["2005Q2", "2005Q3"]).select(*FEATURE_COLUMNS))
    assert lake.audit().filter("status = 'success'").count() == 4 + 4 + 4 + 2 + 2


def test_a_lost_claim_keeps_results_hidden(spark, tmp_path, monkeypatch):
    lake, landing = make_place(spark, tmp_path)
    store = P._store

    def slow(*args):
        out = store(*args)
        monkeypatch.setattr(Claims, "is_held", lambda self, claim: claim.name != "2005-07")
        return out

    monkeypatch.setattr(P, "_store", slow)
    runs = P.ingest(lake, str(landing), ["2005-06", "2005-07"], strict=False)
    assert runs["2005-06"].message == "ingested" and "ran out" in runs["2005-07"].error
    assert [r.month for r in lake.manifest().collect()] == ["2005-06"]


def test_a_claimed_period_fails_and_the_others_go_on(spark, tmp_path):
    lake, landing = make_place(spark, tmp_path)
    P.ingest(lake, str(landing), ["2005-06", "2005-07"])
    with lake.claims.hold(["2005-07"], 60):
        runs = P.clean_months(lake, ["2005-06", "2005-07"], strict=False)
        assert runs["2005-06"].rows_out == 300 and runs["2005-07"].error.startswith("2005-07 is claimed by ")
        P.check_quality(lake, runs)
        with pytest.raises(StepFailed, match="2005-07 is claimed"):
            P.aggregate_quarters(lake, ["2005Q3"])
    assert lake.audit().filter("status = 'failed'").count() == 2


# ---- compaction ----------------------------------------------------------

def test_many_audit_files_become_one_and_reports_stay(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    for i in range(25):
        with audited(lake, "clean", [f"20{i:02d}-06"]) as runs:
            runs[f"20{i:02d}-06"].rows_in, runs[f"20{i:02d}-06"].rows_out = 10, 9
    lake.create_views()
    reports = lambda: [table(f(lake.audit())) for f in (R.status_grid, R.lines_per_month, R.recent_runs, R.latest_runs)]
    before, opened = reports(), lake.audit()
    assert len(opened.inputFiles()) == 25 and spark.table("pipeline_runs").count() == 25
    assert P.compact_logs(lake)["ops/pipeline_runs"] == 25
    assert len(lake.audit().inputFiles()) == 1 and reports() == before
    assert opened.count() == 25  # readers that listed the table before go on
    with audited(lake, "deliver", ["2005Q3"]):
        pass
    assert spark.table("pipeline_runs").count() == lake.audit().count() == 26
    assert lake.compact("ops/pipeline_runs", AUDIT_SCHEMA) == 2
    assert spark.table("pipeline_runs").count() == 26
    assert len(files.entries(spark, lake.path("ops/pipeline_runs"))) == 2  # this version and the one before
    assert lake.compact("ops/pipeline_runs", AUDIT_SCHEMA) == 1
    assert P.compact_logs(Lake(spark, str(tmp_path / "none")))["serving/published"] == 0


def test_appends_during_compactions_are_kept(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))

    def work(i):
        if i == 0:
            return [lake.compact("ops/pipeline_runs", AUDIT_SCHEMA) for _ in range(4)]
        for n in range(3):
            with audited(lake, "clean", [f"200{i}-0{n + 1}"]):
                pass
        return None

    got = together(4, work)
    assert not [g for g in got if isinstance(g, Exception)], got
    assert lake.audit().select("period").distinct().count() == lake.audit().count() == 9
