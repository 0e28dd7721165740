"""Volume data: repeat log lines with shifted microseconds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslog.functions.lines import around_microseconds, shifted_line

COPIES_PER_ROW = 1024


def replicate_lines(
    lines: DataFrame, copies: int, partitions: int | None = None, order: Sequence[str] = ()
) -> DataFrame:
    """Every line ``copies`` times; copy ``k`` moves the line's first event time by ``k`` µs.

    A line is taken apart once and its copies are made where the line is, without a shuffle.
    ``partitions`` first spreads a small source over that many tasks; a line with many copies
    is then divided into ranges of copies, so the work is even however few lines there are.
    With ``order`` columns the tasks and their rows follow that order, then the copy number.
    """
    before, micro, after = around_microseconds(F.col("value"))
    first = F.sequence(
        F.lit(0).cast("bigint"), F.lit(max(copies, 1) - 1).cast("bigint"),
        F.lit(COPIES_PER_ROW).cast("bigint"),
    )
    ranges = lines.filter(F.lit(copies > 0)).select(
        *(F.col(name) for name in lines.columns if name != "value"),
        before.alias("_before"), micro.alias("_micro"), after.alias("_after"),
        F.explode(first).alias("_first"),
    )
    if partitions and order:
        keys = (*order, "_first")
        ranges = ranges.repartitionByRange(partitions, *keys).sortWithinPartitions(*keys)
    elif partitions:
        ranges = ranges.repartition(partitions)
    last = F.least(F.col("_first") + F.lit(COPIES_PER_ROW - 1), F.lit(copies - 1).cast("bigint"))
    copied = ranges.withColumn("copy", F.explode(F.sequence(F.col("_first"), last, F.lit(1).cast("bigint"))))
    value = shifted_line(F.col("_before"), F.col("_micro"), F.col("_after"), F.col("copy"))
    return copied.withColumn("value", value).select(*lines.columns, "copy")
