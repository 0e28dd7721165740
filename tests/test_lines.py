"""Reading a line with string functions gives what the ten-group regex gives."""

import random
import re

import pytest
from conftest import LINE, text_frame
from pyspark.sql import functions as F

from opslog.fixed import EMAIL_MASK, EMAIL_PATTERN, LINE_FIELDS, LINE_PATTERN
from opslog.functions import lines as L
from opslog.functions.text import mask_email
from opslog.operators.clean import parse_lines
from opslog.operators.replicate import replicate_lines

ODD = ["\t", "\x0b", "\x0c", "\r", "\r\n", "\u0085", "\u2028", "\u2029", "  ", " ", "", " ", "é"]


def junk_lines(count=3000, seed=7):
    rng = random.Random(seed)
    fields = LINE.split(" ", 9)
    for _ in range(count):
        parts = [*fields[:9], f"{fields[9]} {rng.randrange(10**6)}"]
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            i = rng.choice([8, 9, 9, *range(10)])
            parts[i] = rng.choice([
                parts[i] + rng.choice(ODD), rng.choice(ODD) + parts[i], rng.choice(ODD),
                "x", "2005.6.03", "12", parts[i][:3] + rng.choice(ODD) + parts[i][3:],
            ])
        line = rng.choice([" "] * 8 + ["\t", "  "]).join(parts[: rng.choice([10, 10, 10, 9, 8])])
        yield line + rng.choice(["", "", "", "\r", "\r\n", "\u0085", "\u2028", "\u2029", " ", "\n", "\n\n"])


def test_fields_equal_the_regex_on_junk(spark):
    raw = text_frame(spark, sorted(set(junk_lines())) + [LINE, ""]).cache()
    ours = parse_lines(raw)
    regex = raw.select(F.col("value").alias("raw_line"), *(
        F.regexp_extract("value", LINE_PATTERN, i + 1).alias(n) for i, n in enumerate(LINE_FIELDS)
    ))
    assert ours.filter("unix_ts != ''").count() > 500
    assert ours.filter("unix_ts = ''").count() > 500
    assert ours.exceptAll(regex).count() == 0 and regex.exceptAll(ours).count() == 0


def test_the_example_line_is_parsed(spark):
    row = parse_lines(text_frame(spark, [LINE])).first()
    assert row.level == "INFO" and row.message == "instruction cache parity error corrected"
    assert row.event_ts_raw == "2005-06-03-15.42.50.675872" and row.raw_line == LINE


def test_leading_fields_need_no_array(spark):
    names = LINE_FIELDS[:8]
    row = text_frame(spark, [LINE]).select(
        *(L.leading_field(F.col("value"), n).alias(n) for n in names)
    ).first()
    assert list(row) == LINE.split(" ")[:8]


TIMES = [
    "2005-06-03-15.42.50.675872", "2005-06-31-15.42.50.675872", "2005-02-29-00.00.00.000000",
    "2004-02-29-23.59.59.999999", "2005-13-01-00.00.00.000000", "2005-00-10-00.00.00.000000",
    "2005-06-03-24.00.00.000000", "2005-06-03-15.60.00.000000", "2005-06-03-15.42.60.000000",
    "1965-06-03-15.42.50.000001", "9999-12-31-23.59.59.999999", "2005-04-03-02.30.00.000000",
]


def test_event_time_agrees_with_pattern_parsing(spark):
    frame = spark.createDataFrame([(t,) for t in TIMES], "t string")
    rows = frame.select(
        "t", L.event_time(F.col("t")).alias("ours"),
        F.try_to_timestamp("t", F.lit("yyyy-MM-dd-HH.mm.ss.SSSSSS")).cast("timestamp_ntz").alias("spark"),
    ).collect()
    assert all(r.ours == r.spark for r in rows)
    assert sum(r.ours is None for r in rows) == 7


def test_event_time_does_not_depend_on_the_session_zone(spark, setting):
    setting("spark.sql.session.timeZone", "America/Los_Angeles")
    frame = spark.createDataFrame([("2005-04-03-02.30.00.000000",)], "t string")
    assert str(frame.select(L.event_time(F.col("t")).alias("t")).first().t) == "2005-04-03 02:30:00"


@pytest.mark.parametrize("line, month", [
    (LINE, "2005-06"),
    ("- 1 2005.99.03 rest", "2005-99"),
    ("- 1 2005.06.03", None),
    ("- x 2005.06.03 rest", None),
    (" - 1 2005.06.03 rest", None),
    ("", None),
    ("a b 1 2005.06.03 \t", "2005-06"),
])
def test_dated_month(spark, line, month):
    assert text_frame(spark, [line]).select(L.dated_month(F.col("value")).alias("m")).first().m == month


def test_copies_shift_the_first_time_only(spark):
    late = LINE.replace("675872", "999998").replace("error", "at 2005-06-03-15.42.50.000000")
    stamp = re.compile(r"(\d{4}-\d{2}-\d{2}-\d{2}\.\d{2}\.\d{2}\.)(\d{6})", re.ASCII)
    lines = [LINE, late, "no time", "", "é" + LINE, "12005-06-03-15.42.50.000000 7"]
    expected = sorted(
        (line, copy, stamp.sub(lambda m: m[1] + f"{(int(m[2]) + copy) % 10**6:06d}", line, count=1))
        for line in lines for copy in range(4)
    )
    frame = text_frame(spark, lines).withColumn("line", F.col("value"))
    for partitions in (None, 3):
        got = replicate_lines(frame, 4, partitions).select("line", "copy", "value").collect()
        assert sorted(map(tuple, got)) == expected
    assert replicate_lines(frame, 0).count() == 0
    many = replicate_lines(text_frame(spark, [LINE]), 5000, 2)
    assert many.select("copy").distinct().count() == many.select("value").distinct().count() == 5000


def test_email_search_equals_the_plain_pattern(spark):
    rng = random.Random(9)
    texts = ["".join(rng.choice("ab.+-_@@ é1,") for _ in range(rng.randrange(60))) for _ in range(20_000)]
    texts += ["a@b.c+x@y.z", "a@b.cd@e.f", "@a@b.c", "x" * 5000 + "@y.z", "a@b.c.@d.e"]
    frame = text_frame(spark, texts)
    plain = F.regexp_replace("value", EMAIL_PATTERN, EMAIL_MASK)
    different = frame.filter(mask_email(F.col("value")) != plain)
    assert frame.filter(plain != F.col("value")).count() > 1000
    assert different.count() == 0
