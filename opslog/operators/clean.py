"""Raw lines -> parsed lines and clean, masked events, for any number of months in one job."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslog.fixed import EVENT_COLUMNS, LINE_FIELDS, NO_ALERT
from opslog.functions import lines as L
from opslog.functions import text as T


def parse_lines(raw: DataFrame) -> DataFrame:
    """``raw_line`` and the ten fields; a line that does not match gets empty fields."""
    matched = raw.select(
        F.col("value").alias("raw_line"),
        F.when(L.is_log_line(F.col("value")), L.field_array(F.col("value"))).alias("parts"),
    )
    return matched.select("raw_line", *(L.field(F.col("parts"), n).alias(n) for n in LINE_FIELDS))


def event_text(value: Column) -> Column:
    return L.leading_field(value, "event_ts_raw")


#: A line is hot with more than one part in so many of its month's lines, and more copies than
#: a task would notice.
HOT_PARTS = 2_000
HOT_COPIES = 10_000


@dataclass(frozen=True)
class MonthTasks:
    """How many tasks the lines of each month are dealt to, and the hashes of hot lines."""

    tasks: Mapping[str, int]
    hot: tuple[int, ...] = ()

    def place(self, month: Column, value: Column) -> Column:
        """The task of a line: those of a month follow each other, its line hash picks one."""
        bases, before = {}, 0
        for name, count in sorted(self.tasks.items()):
            bases[name] = before
            before += count
        pairs = lambda numbers: F.create_map(*(F.lit(x) for pair in numbers.items() for x in pair))
        bucket = F.pmod(F.xxhash64(value), F.element_at(pairs(dict(self.tasks)), month))
        return (F.element_at(pairs(bases), month) + bucket).cast("int")


def count_lines(raw: DataFrame) -> DataFrame:
    """month, count, and the hashes of its hot lines, from one pass without a shuffle of lines.

    The hashes come from Spark's sketch of frequent values, which holds every value of more
    than one part in ``HOT_PARTS``; a line that is not hot has at most that share or
    ``HOT_COPIES`` copies in its task.
    """
    top = F.call_function("approx_top_k", F.xxhash64("value"), F.lit(HOT_PARTS), F.lit(5 * HOT_PARTS))
    counted = raw.groupBy("month").agg(F.count("*").alias("count"), top.alias("top"))
    often = F.filter("top", lambda t: t["count"] > F.greatest(F.col("count") / F.lit(HOT_PARTS), F.lit(HOT_COPIES)))
    return counted.select("month", "count", F.transform(often, lambda t: t["item"]).alias("hot"))


def keep_valid_lines(raw: DataFrame, spread: MonthTasks | None = None) -> DataFrame:
    """Distinct lines that match, have a possible time, and belong to their ``month``.

    Only the line itself goes through the shuffle of the distinct: the month is part of the
    line, and everything else is cut out of the line afterwards. Copies of one hot line are
    already merged before the shuffle.

    With ``spread`` the lines are dealt to tasks of one month each, which serves the distinct
    and a writer by month at once. Here lines are not merged before the shuffle, but hot lines
    are: they have become distinct on the way, and join the others as one row each.
    """
    kept = raw
    for rule in _rules():
        kept = kept.filter(rule)
    if spread is None:
        return kept.select("value").distinct()
    lines = kept.select("month", "value")
    if spread.hot:
        is_hot = F.xxhash64("value").isin(list(spread.hot))
        lines = lines.filter(~is_hot).unionByName(lines.filter(is_hot).distinct())
    return (
        lines.withColumn("place", spread.place(F.col("month"), F.col("value")))
        .repartitionById(sum(spread.tasks.values()), "place")
        .dropDuplicates(["place", "value"]).select("value")
    )


def _rules() -> list[Column]:
    value = F.col("value")
    return [
        ~F.col("month").startswith("0000"),  # there is no year zero
        L.is_log_line(value),
        F.substring(event_text(value), 1, 7) == F.col("month"),
        L.event_time(event_text(value)).isNotNull(),
    ]


def mask_pii(text: Column) -> Column:
    return T.mask_ip(T.mask_email(text))


def log_template(masked: Column) -> Column:
    return T.mask_numbers(T.mask_hex(masked))


def to_events(lines: DataFrame) -> DataFrame:
    """Valid lines (``value``) -> the eleven event columns plus ``month``.

    Time and node come straight from the line, so that a filter on time or midplane moves
    below the distinct as a short expression. Text is masked in separate projections because
    each step refers to the one before it more than once.
    """
    value, parts = F.col("value"), F.col("parts")
    named = lines.select(
        L.event_time(event_text(value)).alias("event_time"),
        F.substring(event_text(value), 1, 7).alias("month"),
        L.leading_field(value, "node").alias("node"),
        L.field_array(value).alias("parts"),
    )
    label = L.field(parts, "alert_label")
    located = named.select(
        "event_time", "month", "node",
        T.rack(F.col("node")).alias("rack"),
        T.midplane(F.col("node")).alias("midplane"),
        (label != NO_ALERT).alias("is_alert"),
        F.when(label != NO_ALERT, label).alias("alert_category"),
        L.field(parts, "event_type").alias("event_type"),
        L.field(parts, "component").alias("component"),
        F.upper(L.field(parts, "level")).alias("level"),
        L.field(parts, "message").alias("message"),
    )
    masked = located
    for mask in (T.mask_email, T.mask_ip):
        masked = masked.withColumn("message", mask(F.col("message")))
    templated = masked.withColumn("template", T.mask_hex(F.col("message")))
    return templated.withColumn("template", T.mask_numbers(F.col("template"))).select(
        *EVENT_COLUMNS, "month"
    )


def clean(raw: DataFrame, spread: MonthTasks | None = None) -> DataFrame:
    """``raw`` has ``value`` and ``month``.

    ``spread`` is for writing many months at once: it names the months that are there and the
    number of tasks for each, so that no writing task opens files of several months.
    """
    return to_events(keep_valid_lines(raw, spread))


def rows_per_month(raw: DataFrame) -> DataFrame:
    """Rows in and out by month, from one scan; a month without a clean row has 0.

    Copies of a line are merged before the shuffle, and each distinct line is tested once.
    """
    valid = F.lit(True)
    for rule in _rules():
        valid = F.when(valid, rule).otherwise(F.lit(False))
    per_line = raw.groupBy("month", "value").agg(F.count("*").alias("copies"))
    return per_line.groupBy("month").agg(
        F.sum("copies").alias("raw_lines"), F.count_if(valid).alias("clean_rows"))
