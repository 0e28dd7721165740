"""The steps on real small files: decisions, copies, reruns, gate, publishing."""

import pytest
from conftest import LINE, SF_DIR
from pyspark.sql import functions as F

from opslog.fixed import AUDIT_SCHEMA, FEATURE_COLUMNS, column_names
from opslog.operators import features as H
from opslog.operators import publish as D
from opslog.operators import reports as R
from opslog.plans import pipeline as P
from opslog.plans.audit import StepFailed, audited
from opslog.plans import table_lines as B
from opslog.session import sized_for
from opslog.sources.lake import Lake


def month_lines(month, count=60, alerts=0, bad=0):
    year, number = month.split("-")
    for n in range(count):
        label = "KERNDTLB" if n < alerts else "-"
        yield (f"{label} 1117838570 {year}.{number}.03 R02-M1-N0 {month}-{n % 28 + 1:02d}-{n % 24:02d}.42.50."
               f"{n:06d} R02-M1-N0 RAS KERNEL INFO cache error {n}")
    for n in range(bad):
        yield f"- {n} {year}.{number}.03 broken"


def make_place(spark, folder):
    """A landing folder with four good months and two that are no log, and an empty lake."""
    landing = folder / "landing"
    landing.mkdir()
    for month, alerts in {"2005-06": 0, "2005-07": 5, "2005-08": 3, "2005-09": 7}.items():
        (landing / f"BGL_{month}.log").write_text("\n".join(month_lines(month, 300, alerts)) + "\n")
    (landing / "BGL_2005-10.log").write_text("## meeting notes, page 3\n" * 50)
    (landing / "BGL_2005-11.log").write_text("")
    (landing / "notes.txt").write_text("ignored\n")
    (landing / "old").mkdir()
    (landing / "old" / "BGL_2005-06.log").write_text("\n".join(month_lines("2005-06", 30)) + "\n")
    return Lake(spark, str(folder / "lake")), landing


@pytest.fixture
def place(spark, tmp_path):
    return make_place(spark, tmp_path)


def outcome(runs):
    return {p: (r.status, r.message or r.error.split(":")[0]) for p, r in runs.items()}


def table(df):
    return sorted(map(str, df.collect()))


# ---- ingest --------------------------------------------------------------

def test_ingest_decides_every_month(place):
    lake, landing = place
    months = ["2005-06", "2005-10", "2005-11", "2005-12"]
    expected = {
        "2005-06": ("success", "ingested"), "2005-10": ("failed", "422 wrong_format"),
        "2005-11": ("failed", "422 wrong_format"), "2005-12": ("failed", "404 not_found"),
    }
    assert outcome(P.ingest(lake, str(landing), months, strict=False)) == expected
    again = P.ingest(lake, str(landing), ["2005-06"])
    assert outcome(again) == {"2005-06": ("success", "already_ingested")}
    assert lake.manifest().count() == 1

    path = landing / "BGL_2005-06.log"
    path.write_text(path.read_text() + "extra\n")
    with pytest.raises(StepFailed, match="409 conflict"):
        P.ingest(lake, str(landing), ["2005-06"])
    assert lake.raw(["2005-06"]).count() == 300
    with pytest.raises(ValueError, match="expected a month"):
        P.ingest(lake, str(landing), ["June"])


def test_manifest_row_and_copy(place):
    lake, landing = place
    P.ingest(lake, str(landing), ["2005-06", "2005-07"])
    text = (landing / "BGL_2005-06.log").read_bytes()
    row = lake.manifest().filter("month = '2005-06'").first()
    assert len(row.sha256) == 64
    assert (row.file_name, row.line_count, row.size_bytes) == ("BGL_2005-06.log", 300, len(text))
    assert row.hdfs_path.endswith("lake/raw/month=2005-06") and row.ingested_at is not None
    assert sorted(r.value for r in lake.raw(["2005-06"]).collect()) == sorted(text.decode().splitlines())


def test_one_hash_for_the_same_lines(place, setting):
    lake, landing = place
    P.ingest(lake, str(landing), ["2005-06", "2005-07"])
    path = landing / "BGL_2005-06.log"
    lines = path.read_text().splitlines()
    again = lambda: P.ingest(lake, str(landing), ["2005-06"], strict=False)["2005-06"]

    path.write_text("\n".join(lines))  # without the last newline
    setting("spark.sql.files.maxPartitionBytes", "700")
    setting("spark.sql.files.openCostInBytes", "700")
    assert again().message == "already_ingested"
    path.unlink()
    folder = landing / "month=2005-06"
    folder.mkdir()
    for n, (a, b) in enumerate(((0, 70), (70, 71), (71, 300))):
        (folder / f"part-{n:05d}.txt").write_text("\n".join(lines[a:b]) + "\n")
    assert again().message == "already_ingested"
    (folder / "part-00001.txt").write_text(lines[71] + "\n")
    assert again().error.startswith("409")
    (folder / "part-00001.txt").write_text(lines[70] + "\n")
    (folder / "part-00000.txt").write_text("\n".join([lines[1], lines[0], *lines[2:70]]) + "\n")
    assert again().error.startswith("409")
    path.write_text("\n".join(lines) + "\n")
    assert "as a file and as a folder" in again().error
    assert not (landing.parent / "lake" / "work").exists() or not list((landing.parent / "lake" / "work").iterdir())


def test_landing_text_is_inspected_in_one_scan(place, monkeypatch):
    lake, landing = place
    scans = []
    read = P.L.read_log_lines
    monkeypatch.setattr(P.L, "read_log_lines", lambda *a, **k: scans.append(a[1:]) or read(*a, **k))
    landed = list(P.L.landed_months(lake.spark, str(landing)).values())
    with lake.working() as keep:
        splits = keep(P._splits(lake, [x for x in landed if x.month < "2005-10"], 100), "s")
        P.inspect_landing(lake, [x for x in landed if x.month == "2005-06"], splits.filter("file_name like '%2005-06%'"), 100).collect()
    assert len(scans) == 1 and not any("old" in path or "notes" in path for path in scans[0])


def test_an_incomplete_copy_is_not_recorded(place, monkeypatch):
    lake, landing = place
    write = Lake.write_raw
    monkeypatch.setattr(Lake, "write_raw", lambda self, lines: write(
        self, lines.filter((F.col("month") != "2005-07") | ~F.col("value").endswith(" 9"))))
    runs = P.ingest(lake, str(landing), ["2005-06", "2005-07"], strict=False)
    assert outcome(runs)["2005-07"] == ("failed", "copy of BGL_2005-07.log is incomplete")
    assert [r.month for r in lake.manifest().collect()] == ["2005-06"]
    monkeypatch.undo()
    assert outcome(P.ingest(lake, str(landing), ["2005-07"]))["2005-07"] == ("success", "ingested")
    assert lake.raw(["2005-07"]).count() == 300


def test_landing_status(place):
    lake, landing = place
    P.ingest(lake, str(landing), ["2005-07"])
    rows = [(r.file_name, r.ingested) for r in P.landing_status(lake, str(landing)).collect()]
    assert rows == [(f"BGL_2005-{n}.log", n == "07") for n in ("06", "07", "08", "09", "10", "11")]


# ---- clean and gate ------------------------------------------------------

def test_clean_counts_and_reruns(place):
    lake, landing = place
    months = ["2005-06", "2005-07"]
    P.ingest(lake, str(landing), months)
    runs = P.clean_months(lake, months)
    assert {m: (r.rows_in, r.rows_out) for m, r in runs.items()} == {m: (300, 300) for m in months}
    before = table(lake.processed(months))
    P.clean_months(lake, ["2005-06"])
    P.clean_months(lake, months)
    assert table(lake.processed(months)) == before
    with pytest.raises(StepFailed, match="2005-08 is not in the raw zone"):
        P.clean_months(lake, ["2005-06", "2005-08"])


def test_a_month_without_valid_lines_is_emptied_on_rerun(place, spark):
    lake, landing = place
    P.ingest(lake, str(landing), ["2005-06", "2005-07"])
    P.clean_months(lake, ["2005-06", "2005-07"])
    broken = spark.createDataFrame([("nothing", "2005-07")], "value string, month string")
    lake.write_raw(broken)
    runs = P.clean_months(lake, ["2005-06", "2005-07"])
    assert {m: r.rows_out for m, r in runs.items()} == {"2005-06": 300, "2005-07": 0}
    gate = P.check_quality(lake, runs, strict=False)
    assert outcome(gate) == {"2005-06": ("success", "drop rate 0.000%"), "2005-07": ("failed", "2005-07")}
    assert gate["2005-07"].error == "2005-07: no valid lines after cleaning"


@pytest.mark.parametrize("bad, status", [(2, "success"), (4, "failed")])
def test_gate_limit(place, bad, status):
    lake, landing = place
    lines = [*month_lines("2005-12", 300 - bad), *list(month_lines("2005-12", 0, bad=bad))]
    (landing / "BGL_2005-12.log").write_text("\n".join(lines) + "\n")
    P.ingest(lake, str(landing), ["2005-12"])
    gate = P.check_quality(lake, P.clean_months(lake, ["2005-12"]), strict=False)["2005-12"]
    assert gate.status == status and (gate.rows_in, gate.rows_out) == (300, 300 - bad)
    if bad == 4:
        assert gate.error == "2005-12: 1.33% of lines dropped (limit 1%)"


# ---- aggregate and deliver -----------------------------------------------

@pytest.fixture(scope="module")
def quarter(spark, tmp_path_factory):
    """One whole run, shared: the tests below may add loads but leave the visible table as it is."""
    lake, landing = make_place(spark, tmp_path_factory.mktemp("quarter"))
    done = P.backfill(lake, str(landing), ["2005-06", "2005-07", "2005-08", "2005-09", "2005-10"], "2005-09")
    return lake, landing, done


def test_whole_run(quarter):
    lake, _, done = quarter
    assert {s: sorted(r) for s, r in done.items()} == {
        "ingest": ["2005-06", "2005-07", "2005-08", "2005-09", "2005-10"],
        "clean": ["2005-06", "2005-07", "2005-08", "2005-09"],
        "quality_check": ["2005-06", "2005-07", "2005-08", "2005-09"],
        "aggregate": ["2005Q2", "2005Q3"], "deliver": ["2005Q2", "2005Q3"],
    }
    assert done["aggregate"]["2005Q3"].rows_in == 900
    months = ["2005-07", "2005-08", "2005-09"]
    direct = H.hourly_features(lake.processed(months))
    assert table(lake.features().filter("quarter = '2005Q3'")) == table(direct)
    assert table(R.latest_quarter(lake.features())) == table(direct)
    audit = lake.audit()
    assert audit.columns == column_names(AUDIT_SCHEMA)
    assert audit.groupBy("step").count().count() == 5
    assert audit.filter("status = 'failed'").select("step", "period").collect() == [("ingest", "2005-10")]
    dropped = {r.step for r in audit.filter("rows_dropped is null").collect()}
    assert dropped == {"aggregate", "ingest"}  # the refused file has no counts
    shrunk = done["aggregate"]["2005Q2"]
    assert shrunk.rows_out < shrunk.rows_in


def test_delivering_again_gives_the_same_table(quarter):
    lake, _, _ = quarter
    before = table(lake.features())
    P.deliver_quarters(lake, ["2005Q3"], load_id="second")
    assert table(lake.features()) == before
    unused = D.unused_loads(lake.loads(), lake.published()).collect()
    assert [r.quarter for r in unused] == ["2005Q3"] and unused[0].load_id != "second"


def test_old_loads_are_removed_after_their_grace_time(quarter):
    lake, _, _ = quarter
    P.deliver_quarters(lake, ["2005Q2", "2005Q3"], load_id="old", last_month="2005-09")
    reader = lake.features()
    P.deliver_quarters(lake, ["2005Q3"], load_id="new")
    lake.add_load(D.delivery_rows(lake.curated(["2005Q2"]), "never"))
    before = table(lake.features())
    assert P.remove_old_loads(lake, 3600) == [] and table(reader) == before  # an open reader goes on
    with lake.claims.hold(["2005Q2"], 60):
        assert {q for q, _ in P.remove_old_loads(lake, 0)} == {"2005Q3"}
    assert ("2005Q2", "never") in P.remove_old_loads(lake, 0)
    assert {load for load in lake.load_folders() if load[0] != "none"} == {("2005Q2", "old"), ("2005Q3", "new")}
    assert table(lake.features()) == before and D.unused_loads(lake.loads(), lake.published()).isEmpty()


def test_superseded_loads_follow_the_publish_log(spark):
    rows = [("2005Q1", "a", 1, 1), ("2005Q1", "b", 1, 2), ("2005Q1", "a", 1, 3), ("2005Q1", "c", 1, 9), ("2005Q2", "a", 1, 4)]
    log = spark.createDataFrame(rows, "quarter string, load_id string, row_count bigint, published_at int")
    assert sorted(map(tuple, D.superseded_loads(log).collect())) == [("2005Q1", "a", 9), ("2005Q1", "b", 3)]


def test_the_latest_quarter_comes_from_the_publish_log(quarter):
    lake, _, _ = quarter
    assert table(lake.latest_quarter()) == table(lake.features().filter("quarter = '2005Q3'")) != []
    plan = lake.latest_quarter()._jdf.queryExecution().executedPlan().toString()
    assert "(quarter" in plan.split("PartitionFilters: [")[1].split("]")[0] and "Subquery" in plan


def test_the_raw_zone_keeps_the_line_order(spark, tmp_path, setting):
    """Read by file name and row, the copy is the landing file, for files and part files."""
    lake, landing = make_place(spark, tmp_path)
    (landing / "month=2006-01").mkdir()
    lines = list(month_lines("2006-01", 500))
    for n in range(4):
        (landing / "month=2006-01" / f"part-{n:05d}.txt").write_text("\n".join(lines[n * 125:n * 125 + 125]) + "\n")
    for key in ("maxPartitionBytes", "openCostInBytes"):
        setting(f"spark.sql.files.{key}", "5000")
    setting("spark.sql.files.minPartitionNum", "1")
    setting("spark.sql.shuffle.partitions", "16")
    P.ingest(lake, str(landing), ["2005-06", "2005-07", "2006-01"])
    wanted = {"2006-01": lines, "2005-07": (landing / "BGL_2005-07.log").read_text().splitlines()}
    for month, values in wanted.items():
        parts = sorted((tmp_path / "lake" / "raw" / f"month={month}").glob("part-*"))
        assert len(parts) > 1
        assert "".join(p.read_text() for p in parts) == "\n".join(values) + "\n"
    loose = Lake(spark, str(tmp_path / "loose"))
    P.ingest(loose, str(landing), ["2005-06"], keep_order=False)
    assert loose.raw(["2005-06"]).count() == 300


def test_an_unpublished_load_is_invisible(quarter):
    lake, _, _ = quarter
    before = table(lake.features())
    lake.add_load(D.delivery_rows(lake.curated(["2005Q2"]), "half"))
    assert lake.loads().filter("load_id = 'half'").count() > 0
    assert table(lake.features()) == before


def test_an_empty_quarter_is_an_error(quarter):
    lake, _, _ = quarter
    with pytest.raises(StepFailed, match="no processed data for 2004Q1"):
        P.aggregate_quarters(lake, ["2004Q1", "2005Q3"])
    assert lake.audit().filter("period = '2004Q1' and status = 'failed'").count() == 1


def test_july_alone_publishes_nothing(place):
    lake, landing = place
    done = P.backfill(lake, str(landing), ["2005-07"])
    assert done["quality_check"]["2005-07"].status == "success"
    assert done["aggregate"] == {} and done["deliver"] == {} and lake.features().isEmpty()
    assert P.backfill(lake, str(landing), ["2005-07"], "2005-07")["deliver"]["2005Q3"].status == "success"


def test_an_absent_or_emptied_quarter_keeps_the_old_load(quarter):
    lake, _, _ = quarter
    before = table(lake.features())
    with pytest.raises(StepFailed, match="no curated rows for 1999Q1"):
        P.deliver_quarters(lake, ["1999Q1", "2005Q3"])
    elsewhere = Lake(lake.spark, lake.root + "-none")
    with pytest.raises(StepFailed, match="no curated rows for 2005Q3"):
        P.deliver_quarters(elsewhere, ["2005Q3"])
    assert table(lake.features()) == before
    assert lake.audit().filter("period = '1999Q1' and status = 'failed'").count() == 1


def test_views_show_later_deliveries(spark, place):
    lake, landing = place
    lake.create_views()
    assert spark.table("midplane_hourly").isEmpty() and spark.table("latest_quarter").isEmpty()
    P.backfill(lake, str(landing), ["2005-06"])
    first = spark.table("midplane_hourly").count()
    assert first == lake.features().count() > 0
    assert {r.quarter for r in spark.table("latest_quarter").collect()} == {"2005Q2"}
    P.backfill(lake, str(landing), ["2005-07", "2005-08", "2005-09"])
    assert spark.table("midplane_hourly").count() == lake.features().count() > first
    assert {r.quarter for r in spark.table("latest_quarter").collect()} == {"2005Q3"}
    assert spark.table("ingested_files").count() == 4


def test_sql_users_find_the_serving_tables(quarter, spark):
    lake, _, _ = quarter
    lake.create_views()
    newest = spark.sql("SELECT * FROM midplane_hourly WHERE quarter = (SELECT max(quarter) FROM midplane_hourly)")
    assert table(spark.table("latest_quarter")) == table(newest) != []
    assert spark.sql("SELECT count(*), sum(line_count) FROM ingested_files").first()[0] == 4
    assert spark.sql("SELECT DISTINCT step FROM pipeline_runs").count() == 5


def test_readers_prune_folders(quarter):
    lake, _, _ = quarter
    plan = lake.processed(["2005-07"]).select("node")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan or "PartitionFilters: [month" in plan
    events = lake.processed(["2005-07"])
    plan = H.hourly_measures(events)._jdf.queryExecution().executedPlan().toString()
    assert "message" not in plan and "Not(EqualTo(midplane,UNKNOWN))" in plan


def test_a_broken_load_is_not_published(quarter):
    lake, _, _ = quarter
    before = table(lake.features())
    curated = lake.curated(["2005Q2"])
    rows = curated.collect()
    twice = lake.spark.createDataFrame([*rows, rows[0]], curated.schema)
    lake.write_curated(twice, ["2005Q2"])
    with pytest.raises(StepFailed, match="duplicate midplane, hour_start"):
        P.deliver_quarters(lake, ["2005Q2", "2005Q3"])
    after = table(lake.features())
    assert after == before


# ---- audit ---------------------------------------------------------------

def test_an_exception_is_audited_and_raised(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    with pytest.raises(RuntimeError), audited(lake, "clean", ["2005-06"]) as runs:
        runs["2005-06"].rows_in = 7
        raise RuntimeError("x" * 600)
    row = lake.audit().first()
    assert (row.status, row.rows_in, row.rows_out, row.rows_dropped) == ("failed", 7, None, None)
    assert row.message == "x" * 500 and row.finished_at >= row.started_at


def test_wide_measures_go_through_all_zones(spark, place):
    narrow, landing = place
    lake = Lake(spark, narrow.root, measure_type="bigint")
    done = P.backfill(lake, str(landing), ["2005-06"])
    assert not done["deliver"]["2005Q2"].error
    types = dict(lake.features().dtypes)
    assert types["events_total"] == "bigint" and lake.features().agg(F.sum("events_total")).first()[0] == 300


def test_a_replay_keeps_the_order(spark, tmp_path):
    lines = [LINE.replace("675872", f"{n:06d}") for n in (7, 3, 999_999, 5)] + ["no time"]
    (tmp_path / "sample.log").write_text("\n".join(lines))
    P.write_replay(Lake(spark, str(tmp_path)), str(tmp_path / "sample.log"), str(tmp_path / "out"), 3)
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*")))
    micros = [int(line.split(" ")[4][-6:]) if "RAS" in line else None for line in text.splitlines()]
    assert micros == [7, 8, 9, 3, 4, 5, 999_999, 0, 1, 5, 6, 7, None, None, None]


def test_the_months_of_the_tables_run_end_to_end(spark, tmp_path):
    """Unsplit log -> month folders -> whole run; the quarters equal the operators applied directly."""
    lines = B.order_lines(spark, SF_DIR).filter(
        (F.substring("month", 1, 4) == "1996") & ~F.col("value").startswith("garbage")).cache()
    lines.orderBy("month", "line_no").select("value").coalesce(1).write.text(str(tmp_path / "source"))
    lake, landing = Lake(spark, str(tmp_path / "lake")), str(tmp_path / "landing")
    P.split_log(lake, str(tmp_path / "source"), landing, 2)
    months = [f"1996-{n:02d}" for n in range(1, 13)]
    assert not [r.error for r in P.ingest(lake, landing, months).values() if r.error]
    cleaned = P.clean_months(lake, months)
    P.check_quality(lake, cleaned, max_drop_rate=0.2)
    quarters = P.ready_quarters(months, "1996-12")
    P.aggregate_quarters(lake, quarters)
    P.deliver_quarters(lake, quarters)
    from opslog.operators.clean import clean
    assert table(lake.features()) == table(H.hourly_features(clean(lines)))


def test_shuffles_are_sized_by_the_input(spark):
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = [spark.conf.get(k, None) for k in keys]
    with sized_for(spark, 1000):
        assert [spark.conf.get(k, None) for k in keys] == before
    with sized_for(spark, 10**14):
        assert [spark.conf.get(k) for k in keys] == [str(-(-10**14 // (256 * 1024**2))), "512m"]
    with pytest.raises(ValueError), sized_for(spark, 10**10):
        assert spark.conf.get(keys[0]) == "38"
        raise ValueError
    assert [spark.conf.get(k, None) for k in keys] == before
