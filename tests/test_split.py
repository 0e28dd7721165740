import random
import re

import pytest
from conftest import SF_DIR, plan_of
from pyspark.sql import functions as F

from opslog.operators import split as S
from opslog.plans.pipeline import split_log
from opslog.plans.registry import QUERIES
from opslog.sources import log_files as L
from opslog.sources.lake import Lake

DATE = re.compile(r"^\S+ \d+ (\d{4})\.(\d{2})\.\d{2} ", re.ASCII)


def sequential(lines):
    """What a single reader going down the file would do."""
    month, out = None, {}
    for line in lines:
        match = DATE.match(line)
        month = f"{match[1]}-{match[2]}" if match else month
        if month:
            out.setdefault(month, []).append(line)
    return out


def junk_log(count, seed, dated=0.5):
    rng = random.Random(seed)
    for n in range(count):
        if rng.random() < dated:
            yield f"- {n} 200{rng.randrange(3)}.{rng.randrange(1, 13):02d}.01 line {n}"
        else:
            yield rng.choice(["", "junk", f"- {n} 2005.6.01 x", f"  - {n} 2005.06.01 x", f"tail\r{n}"])


def small_splits(setting, size=200):
    setting("spark.sql.files.maxPartitionBytes", str(size))
    setting("spark.sql.files.openCostInBytes", str(size))
    setting("spark.sql.files.minPartitionNum", "1")


@pytest.mark.parametrize("dated, seed", [(0.5, 1), (0.02, 2), (0.98, 3), (0.0, 4)])
def test_split_equals_a_sequential_reader(spark, setting, tmp_path, dated, seed):
    lines = [*junk_log(1500, seed, dated), "end"]
    (tmp_path / "whole.log").write_text("\n".join(lines), newline="\n")
    small_splits(setting)
    frame = L.read_log_lines(spark, str(tmp_path / "whole.log"))
    assert frame.select("split").distinct().count() > 20
    got = {}
    for row in S.split_by_month(frame).orderBy("split", "line_id").collect():
        got.setdefault(row.month, []).append(row.value)
    assert got == sequential(lines)


def test_same_named_files_are_carried_apart(spark, tmp_path):
    for folder, month in (("a", "2001.02"), ("b", "2001.03")):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "x.log").write_text(f"head\n- 1 {month}.01 x\ntail {folder}\n")
    frame = L.read_log_lines(spark, str(tmp_path / "a"), str(tmp_path / "b"))
    assert {(r.month, r.value) for r in S.split_by_month(frame).collect() if "tail" in r.value} == {
        ("2001-02", "tail a"), ("2001-03", "tail b")}


def test_other_months_and_files_of_the_landing_folder_stay(spark, tmp_path):
    landing = tmp_path / "landing"
    (landing / "month=1999-01").mkdir(parents=True)
    (landing / "month=1999-01" / "part-0.txt").write_text("- 1 1999.01.01 x\n")
    (landing / "month=2000-02").mkdir()
    (landing / "month=2000-02" / "part-0.txt").write_text("old\n")
    (landing / "BGL_2004-01.log").write_text("- 1 2004.01.01 x\n")
    (landing / "notes.txt").write_text("n\n")
    (tmp_path / "whole.log").write_text("- 1 2000.02.01 new\n- 1 2000.03.01 new\n")
    lake = Lake(spark, str(tmp_path / "lake"))
    split_log(lake, str(tmp_path / "whole.log"), str(landing))
    left = sorted(str(p.relative_to(landing)) for p in landing.iterdir() if not p.name.startswith((".", "_")))
    assert left == ["BGL_2004-01.log", "month=1999-01", "month=2000-02", "month=2000-03", "notes.txt"]
    text = "".join(p.read_text() for p in (landing / "month=2000-02").glob("part-*"))
    assert text == "- 1 2000.02.01 new\n"
    (tmp_path / "more.log").write_text("- 1 2004.01.01 y\n- 1 2005.01.01 y\n")
    with pytest.raises(ValueError, match="2004-01"):
        split_log(lake, str(tmp_path / "more.log"), str(landing))
    assert not (landing / "month=2005-01").exists()


def test_written_months_keep_the_line_order(spark, setting, tmp_path):
    lines = list(junk_log(4000, 5))
    (tmp_path / "whole.log").write_text("\n".join(lines) + "\n", newline="\n")
    small_splits(setting, 2000)
    landing = tmp_path / "landing"
    counts = split_log(Lake(spark, str(tmp_path / "lake")), str(tmp_path / "whole.log"), str(landing), 5)
    expected = sequential(lines)
    assert {r.month: r.line_count for r in counts.collect()} == {m: len(v) for m, v in expected.items()}
    for month, values in expected.items():
        parts = sorted((landing / f"month={month}").glob("part-*"))
        assert len(parts) > 1
        text = "".join(p.read_bytes().decode() for p in parts)
        assert text == "".join(v + "\n" for v in values)


def test_numbered_splits_are_carried_over_files(spark):
    lines = [*junk_log(400, 12, 0.05), "end"]
    rows = [("a", n // 4, n, line) for n, line in enumerate(lines)]
    frame = spark.createDataFrame(rows, "file_name string, split long, line_id long, value string")
    got = {}
    for row in S.split_by_month(frame).orderBy("line_id").collect():
        got.setdefault(row.month, []).append(row.value)
    assert got == sequential(lines)


def test_files_are_carried_separately(spark):
    rows = [("b.log", 0, 0, "junk"), ("a.log", 0, 0, "- 1 2005.06.01 x"), ("a.log", 9, 1, "junk"),
            ("b.log", 5, 2, "- 1 2005.07.01 x"), ("b.log", 7, 0, "junk")]
    frame = spark.createDataFrame(rows, "file_name string, split long, line_id long, value string")
    got = {(r.file_name, r.split, r.month) for r in S.split_by_month(frame).collect()}
    assert got == {("a.log", 0, "2005-06"), ("a.log", 9, "2005-06"),
                   ("b.log", 5, "2005-07"), ("b.log", 7, "2005-07")}


def in_order(spark, path, carried=None):
    frame = L.read_log_lines(spark, str(path))
    carried = S.carried_months(frame) if carried is None else carried
    return S.split_in_file_order(frame, 3, carried, S.SplitOrder.of(carried))


def test_writing_shuffles_the_lines_once_and_samples_nothing(spark, setting, tmp_path):
    (tmp_path / "a.log").write_text("\n".join(junk_log(300, 1)) + "\n")
    small_splits(setting, 1000)
    carried = S.carried_months(L.read_log_lines(spark, str(tmp_path / "a.log")))
    carried.write.parquet(str(tmp_path / "carried"))
    plan = plan_of(in_order(spark, tmp_path / "a.log", spark.read.parquet(str(tmp_path / "carried"))))
    assert plan.count("Exchange shufflepartitionidpassthrough") == 1 and "rangepartitioning" not in plan
    assert plan.count("Exchange") - plan.count("BroadcastExchange") == 1
    assert plan.count("FileScan text") == 1
    by_range = plan_of(S.split_in_file_order(spark.range(9).selectExpr("'a' file_name", "id split", "id line_id", "'x' value"), 4, spark.range(9).selectExpr("'a' file_name", "id split", "'2000-01' month")))
    assert by_range.count("Exchange rangepartitioning") == 1 and by_range.count("Exchange") == 1


def test_text_is_read_twice_by_a_split(spark, tmp_path, monkeypatch):
    (tmp_path / "a.log").write_text("\n".join(junk_log(300, 1)) + "\n")
    jobs = []
    for name in ("carried_months", "split_in_file_order"):
        work = getattr(S, name)
        monkeypatch.setattr(S, name, lambda *a, work=work: jobs.append(out := work(*a)) or out)
    split_log(Lake(spark, str(tmp_path / "lake")), str(tmp_path / "a.log"), str(tmp_path / "landing"))
    assert [plan_of(job).count("FileScan text") for job in jobs] == [1, 1]


def test_places_follow_files_and_splits(spark, setting, tmp_path):
    """Several files, several splits a partition, heads without a month: all in order."""
    small_splits(setting, 300)
    everything = []
    for k, name in enumerate(("b.log", "a.log", "c.log", "d.log")):
        lines = ["head", *junk_log(90 * k, 20 + k, 0.3), "end"]
        (tmp_path / name).write_text("\n".join(lines) + "\n", newline="\n")
        everything.append((name, lines))
    rows = in_order(spark, tmp_path).withColumn("task", F.spark_partition_id()).collect()
    assert len({r.task for r in rows}) == 3
    order = {}
    for r in sorted(rows, key=lambda r: r.task):  # a stable sort: rows of a task stay in their order
        order.setdefault((r.month, r.file_name.split("/")[-1]), []).append(r.value)
    for name, lines in everything:
        for month, values in sequential(lines).items():
            assert order[month, name] == values
    tasks = {}
    for r in rows:
        tasks.setdefault(r.file_name, set()).add(r.task)
    ranges = [(min(t), max(t)) for _, t in sorted(tasks.items())]
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))


def test_tally_counts_exactly_or_says_so(spark, monkeypatch):
    rows = spark.range(1000).selectExpr("cast(id % 13 as string) m", "if(id % 5 = 0, null, cast(id % 7 as string)) n")
    for column in ("m", "n"):
        tally = S.Tally(F.col(column))
        tally.watch(rows.repartition(3)).write.format("noop").mode("overwrite").save()
        want = {r[0]: r[1] for r in rows.where(f"{column} is not null").groupBy(column).count().collect()}
        assert tally.counts() == want
    monkeypatch.setattr(S.Tally, "MOST", 13)
    tally = S.Tally(F.col("m"))
    tally.watch(rows).write.format("noop").mode("overwrite").save()
    assert tally.counts() is None


def test_inspection_reads_each_line_twice_at_most(spark):
    queries = {"inspect_files": 2, "file_fingerprints": 1, "ingest_decisions": 4, "split_by_month": 2, "split_counts": 2}
    for name, most in queries.items():
        assert plan_of(QUERIES[name](spark, SF_DIR)).count("FileScan") <= most, name


def test_latest_quarter_is_computed_once(spark):
    spark.catalog.clearCache()  # lines that another test has cached would be read instead
    frame = QUERIES["latest_quarter"](spark, SF_DIR)
    frame.collect()
    execution = frame._jdf.queryExecution()
    shown = spark._jvm.PythonSQLUtils.explainString(execution, "formatted")
    assert "ReusedExchange" in shown and execution.executedPlan().toString().split("== Initial")[0].count("FileScan") <= 1


# ---- inspection ----------------------------------------------------------

def test_line_counts_and_first_lines_over_many_splits(spark, setting, tmp_path):
    files = {"BGL_2005-06.log": list(junk_log(900, 6, 0.7)), "BGL_2005-07.log": list(junk_log(90, 7, 0.3))}
    for name, lines in files.items():
        (tmp_path / name).write_text("\n".join(lines) + "\n", newline="\n")
    small_splits(setting, 300)
    for check in (1, 50, 250, 10_000):
        got = {r.file_name: (r.line_count, r.valid_share)
               for r in S.inspect_files(L.read_log_lines(spark, str(tmp_path), landing=True), check).collect()}
        for name, lines in files.items():
            first = lines[:check]
            share = sum(bool(DATE.match(line)) for line in first) / len(first)
            assert got[name] == (len(lines), pytest.approx(share, abs=1e-12))


def fingerprints(spark, folder):
    lines = L.read_log_lines(spark, str(folder))
    files = S.files_from_splits(S.place_splits(S.split_sums(lines, 10, S.line_digest)), 10)
    return {r.file_name.split("/")[-1]: r.fingerprint for r in files.collect()}


def test_fingerprint_sees_content_and_order_but_not_splits(spark, setting, tmp_path):
    lines = list(junk_log(800, 8))
    swapped = lines[:100] + [lines[101], lines[100]] + lines[102:]
    far = [lines[700], *lines[1:700], lines[0], *lines[701:]]
    changed = [*lines[:500], lines[500] + "!", *lines[501:]]
    for name, content in {"a": lines, "same": lines, "swapped": swapped, "far": far, "changed": changed}.items():
        (tmp_path / f"{name}.log").write_text("\n".join(content) + "\n", newline="\n")
    small_splits(setting, 10_000_000)
    whole = fingerprints(spark, tmp_path)
    assert whole["a.log"] == whole["same.log"]
    assert len(set(whole.values())) == 4
    for size in (333, 1000, 7000):
        small_splits(setting, size)
        assert fingerprints(spark, tmp_path) == whole


def test_the_first_scan_tells_the_first_lines(spark, setting, tmp_path):
    lines = list(junk_log(500, 9, 0.7))
    (tmp_path / "BGL_2005-06.log").write_text("\n".join(lines) + "\n", newline="\n")
    for size, told in ((10_000_000, True), (4000, True), (300, False)):
        small_splits(setting, size)
        frame = L.read_log_lines(spark, str(tmp_path), landing=True)
        splits = S.place_splits(S.split_sums(frame, 40))
        row = S.files_from_splits(splits, 40).first()
        want = sum(bool(DATE.match(line)) for line in lines[:40])
        assert row.line_count == 500 and row.starts == (want if told else None)
        assert S.head_starts(frame, splits, 40).first().starts == want


def test_carried_months_are_hash_aggregated(spark, tmp_path):
    (tmp_path / "a.log").write_text("x\n" * 10)
    lines = L.read_log_lines(spark, str(tmp_path / "a.log"))
    over_lines = r"HashAggregate\(keys=\[file_name#\d+, split#\d+\], functions=\[partial_max_by"
    assert re.search(over_lines, plan_of(S.split_by_month(lines)))


def test_csv_export(spark, tmp_path):
    rows = spark.sql("select timestamp_ntz'2005-06-03 15:00:00' hour_start, 3 alerts, true alert_next_hour")
    L.write_csv(rows, str(tmp_path / "out"))
    text = next((tmp_path / "out").glob("part-*")).read_text()
    assert text == "hour_start,alerts,alert_next_hour\n2005-06-03 15:00:00,3,True\n"
