"""Which months of a quarter are clean and checked, from the stored verdicts on their loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslog.fixed import VERDICTS
from opslog.functions.periods import months_of_quarter

PENDING, PASSED, FAILED = VERDICTS


def current_verdicts(verdicts: DataFrame) -> DataFrame:
    """One row per month: the last verdict on the load that was begun last.

    A verdict that arrives late for a replaced load says nothing about the newer one.
    """
    per_load = verdicts.groupBy("month", "load_id").agg(
        F.min("sequence").alias("begun"),
        F.max_by(F.struct("status", "message"), "sequence").alias("last"),
    )
    newest = F.max_by(F.struct("load_id", "last"), F.struct("begun", "load_id"))
    return per_load.groupBy("month").agg(newest.alias("newest")).select(
        "month", "newest.load_id", "newest.last.status", "newest.last.message")


def _within(month: Column, first_month: Column | str | None, last_month: Column | str | None) -> Column:
    inside = F.lit(True)
    if first_month is not None:
        inside &= month >= (F.lit(first_month) if isinstance(first_month, str) else first_month)
    if last_month is not None:
        inside &= month <= (F.lit(last_month) if isinstance(last_month, str) else last_month)
    return inside


def quarter_gaps(
    quarters: DataFrame, current: DataFrame, first_month: Column | str | None = None,
    last_month: Column | str | None = None, built: DataFrame | None = None,
) -> DataFrame:
    """(quarter, month, reason) for every month that keeps a quarter from being complete.

    Months before ``first_month`` or after ``last_month`` of all data are not asked for; the
    bounds are texts or columns of ``quarters``. A month counts when its newest load passed
    the gate and, with ``built`` (quarter, month, load_id), that load is in the quarter's rows.
    """
    months = quarters.withColumn("month", F.explode(months_of_quarter(F.col("quarter")))).filter(
        _within(F.col("month"), first_month, last_month)).select("quarter", "month")
    known = current.select("month", "load_id", "status", "message")
    status = F.col("status")
    reason = (
        F.when(status.isNull(), "was never cleaned")
        .when(status == PENDING, "was cleaned but not checked")
        .when(status == FAILED, F.concat(F.lit("failed: "), F.coalesce("message", F.lit("no reason given"))))
    )
    joined = months.join(known, "month", "left")
    if built is not None:
        joined = joined.join(
            built.select("quarter", "month", "load_id").withColumn("is_built", F.lit(True)),
            ["quarter", "month", "load_id"], "left")
        reason = reason.when(F.col("is_built").isNull(), "is not in the curated rows, aggregate again")
    return joined.select("quarter", "month", reason.alias("reason")).filter(F.col("reason").isNotNull())


def newest_builds(builds: DataFrame) -> DataFrame:
    """quarter, month, load_id of the newest build of every quarter."""
    newest = builds.groupBy("quarter").agg(F.max_by("build_id", "sequence").alias("build_id"))
    return builds.join(newest, ["quarter", "build_id"], "left_semi").select("quarter", "month", "load_id")
