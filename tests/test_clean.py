from conftest import LINE, plan_of, text_frame
from pyspark.sql import functions as F

from opslog.fixed import EVENT_SCHEMA
from opslog.operators import clean as C
from opslog.plans import table_lines as B
from conftest import SF_DIR


def message_line(message):
    return LINE.rsplit(" INFO ", 1)[0] + " INFO " + message


def test_broken_impossible_and_repeated_lines_are_dropped(spark):
    lines = [LINE, LINE, "this is not a log line", LINE.replace("06-03-15.42", "06-31-15.42")]
    assert C.clean(text_frame(spark, lines, "2005-06")).count() == 1


def test_lines_of_another_month_are_dropped(spark):
    other = LINE.replace("2005-06-03-", "2005-07-03-")
    kept = C.clean(text_frame(spark, [LINE, other], "2005-06")).collect()
    assert [r.month for r in kept] == ["2005-06"]
    assert C.clean(text_frame(spark, [LINE, other], "2005-07")).count() == 1


def test_lines_that_differ_only_in_the_seconds_field_both_stay(spark):
    lines = [LINE, LINE.replace("1117838570", "1117838571")]
    assert C.clean(text_frame(spark, lines, "2005-06")).count() == 2


def test_there_is_no_year_zero(spark):
    line = LINE.replace("2005-06-03-", "0000-06-03-")
    assert C.clean(text_frame(spark, [line], "0000-06")).count() == 0


def test_columns_and_types(spark):
    events = C.clean(text_frame(spark, [LINE], "2005-06"))
    ours = ", ".join(f"{n} {t}" for n, t in events.drop("month").dtypes)
    assert ours == EVENT_SCHEMA
    row = events.first()
    assert (row.rack, row.midplane, row.is_alert, row.alert_category) == ("R02", "R02-M1", False, None)
    assert str(row.event_time) == "2005-06-03 15:42:50.675872"


def test_unknown_locations_alerts_and_levels(spark):
    line = LINE.replace("R02-M1-N0-C:J12-U11", "UNKNOWN_LOCATION").replace("- 1117", "KERNDTLB 1117", 1)
    row = C.clean(text_frame(spark, [line.replace("INFO", "info")], "2005-06")).first()
    assert (row.rack, row.midplane, row.level) == ("UNKNOWN", "UNKNOWN", "INFO")
    assert (row.is_alert, row.alert_category) == (True, "KERNDTLB")
    rack_only = LINE.replace("R02-M1-N0-C:J12-U11", "R02")
    row = C.clean(text_frame(spark, [rack_only], "2005-06")).first()
    assert (row.rack, row.midplane) == ("R02", "UNKNOWN")


def test_masking_and_templates(spark):
    cases = {
        "from 172.16.96.116:33569": ("from <IP>:33569", "from <IP>:<NUM>"),
        "v1.2.3.4.5": ("v1.<IP>", "v<NUM>.<IP>"),
        "999.999.999.999": ("<IP>", "<IP>"),
        "mail a.b+c@d-e.org now": ("mail <EMAIL> now", "mail <EMAIL> now"),
        "a@1.2.3.4": ("<EMAIL>", "<EMAIL>"),
        "interrupt at 0x1F3a, 0xZZ": ("interrupt at 0x1F3a, 0xZZ", "interrupt at <HEX>, <NUM>xZZ"),
        "é1.2.3.4": ("é1.2.3.4", "é<NUM>.<NUM>.<NUM>.<NUM>"),
        "plain": ("plain", "plain"),
        "": ("", ""),
    }
    events = C.clean(text_frame(spark, [message_line(m) for m in cases], "2005-06"))
    assert {(r.message, r.template) for r in events.collect()} == set(cases.values())


def test_messages_with_line_separators_do_not_match(spark):
    lines = [message_line("a\u0085b"), message_line("a\u2028b"), message_line("a\rb")]
    assert C.clean(text_frame(spark, lines, "2005-06")).count() == 0
    assert C.clean(text_frame(spark, [message_line("a\u0085")], "2005-06")).first().message == "a"


def test_all_months_in_one_job_equal_month_by_month(spark):
    lines = B.order_lines(spark, SF_DIR).cache()
    counted = C.count_lines(lines).collect()
    months = [r.month for r in counted]
    spread = C.MonthTasks({m: 1 + i % 3 for i, m in enumerate(months)}, tuple(h for r in counted for h in r.hot))
    together = C.clean(lines, spread).cache()
    for month in sorted(months)[:4]:
        alone = C.clean(lines.filter(F.col("month") == month))
        ours = together.filter(F.col("month") == month)
        assert alone.count() == ours.count() > 0
        assert alone.exceptAll(ours).count() == 0


def test_lines_of_months_are_dealt_in_one_exchange(spark):
    lines = B.order_lines(spark, SF_DIR)
    spread = C.MonthTasks({"1996-02": 3, "1996-01": 2})
    chosen = lines.filter(F.col("month").isin("1996-01", "1996-02"))
    plan = plan_of(C.clean(chosen, spread))
    assert plan.count("Exchange") == 1 == plan.count("Exchange shufflepartitionidpassthrough")
    tasks = C.clean(chosen, spread).select("month", F.spark_partition_id().alias("task")).distinct().collect()
    assert sorted(map(tuple, tasks)) == [("1996-01", 0), ("1996-01", 1), ("1996-02", 2), ("1996-02", 3), ("1996-02", 4)]
    # A hot line takes a second, small exchange that merges its copies before they are dealt.
    hot = plan_of(C.clean(chosen, C.MonthTasks(spread.tasks, (1, 2))))
    assert hot.count("Exchange hashpartitioning") == 1 and hot.count("shufflepartitionidpassthrough") == 1


def test_hot_lines_are_found_and_kept_once(spark, monkeypatch):
    monkeypatch.setattr(C, "HOT_COPIES", 4_000)
    usual = spark.range(30_000).select(F.replace(F.lit(LINE), F.lit("675872"), F.lpad("id", 6, "0")).alias("value"))
    often = spark.range(5_000).select(F.lit(LINE).alias("value"))
    raw = usual.unionByName(often).withColumn("month", F.lit("2005-06"))
    counted = C.count_lines(raw).first()
    assert counted["count"] == 35_000 and counted.hot == [spark.range(1).select(F.xxhash64(F.lit(LINE))).first()[0]]
    for hot in ((), tuple(counted.hot)):
        assert C.clean(raw, C.MonthTasks({"2005-06": 4}, hot)).count() == 30_001


def test_a_hot_line_is_merged_before_the_shuffle(spark):
    raw = spark.range(200_000).select(F.lit(LINE).alias("value"), F.lit("2005-06").alias("month"))
    assert C.clean(raw).count() == 1


def test_plan_has_hash_aggregates_and_no_python(spark):
    plan = plan_of(C.clean(text_frame(spark, [LINE], "2005-06")))
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    assert "Python" not in plan and "ArrowEval" not in plan
    assert plan.count("Exchange") == 1


def test_rows_per_month_counts_months_without_clean_rows(spark):
    raw = text_frame(spark, ["x", "y"], "2005-05").unionByName(text_frame(spark, [LINE, LINE], "2005-06"))
    counts = C.rows_per_month(raw).collect()
    assert sorted(map(tuple, counts)) == [("2005-05", 2, 0), ("2005-06", 2, 1)]
