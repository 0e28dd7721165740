"""Reporting queries over the manifest, the audit trail and the delivered features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslog.fixed import (
    MESSAGE_LENGTH,
    NO_STATUS_LABEL,
    RECENT_RUNS,
    STATUS_LABELS,
    STEPS,
    TOP_MIDPLANES,
)
from opslog.operators.quality import percent


def _zero(total: Column) -> Column:
    return F.coalesce(total, F.lit(0).cast("bigint"))


# ---- key figures --------------------------------------------------------

def manifest_kpis(manifest: DataFrame) -> DataFrame:
    return manifest.agg(F.count("*").alias("files"), _zero(F.sum("line_count")).alias("lines"))


def feature_kpis(features: DataFrame) -> DataFrame:
    return features.agg(
        F.count("*").alias("rows"), F.count_distinct("quarter").alias("quarters")
    )


def pipeline_kpis(audit: DataFrame) -> DataFrame:
    succeeded = F.when(F.col("status") == "success", F.col("finished_at"))
    return audit.agg(
        F.max(succeeded).alias("last_success"),
        F.count_if(F.col("status") == "failed").alias("failed_runs"),
    )


# ---- audit trail --------------------------------------------------------

def audit_rows(runs: DataFrame) -> DataFrame:
    """Add rows_dropped (not for 'aggregate', which shrinks on purpose) and cut long messages."""
    lost = F.when(F.col("step") != "aggregate", F.col("rows_in") - F.col("rows_out"))
    return runs.withColumn("rows_dropped", lost).withColumn(
        "message", F.substring("message", 1, MESSAGE_LENGTH)
    )


def _newest(column: str) -> Column:
    """The value of the run that finished last; ties go to the larger run id."""
    return F.max_by(column, F.struct("finished_at", "run_id"))


def latest_runs(audit: DataFrame) -> DataFrame:
    return audit.groupBy("period", "step").agg(_newest("status").alias("status"))


def status_grid(audit: DataFrame) -> DataFrame:
    """One row per period, one column per step, with the label of the latest result."""
    newest = audit.groupBy("period").pivot("step", list(STEPS)).agg(_newest("status"))

    def label(step: str) -> Column:
        shown = F.col(step)
        for status, text in STATUS_LABELS.items():
            shown = F.when(F.col(step) == status, F.lit(text)).otherwise(shown)
        return F.coalesce(shown, F.lit(NO_STATUS_LABEL)).alias(step)

    return newest.select("period", *(label(step) for step in STEPS)).orderBy("period")


def lines_per_month(audit: DataFrame) -> DataFrame:
    """Lines before and after the latest successful cleaning of each month."""
    cleaned = audit.filter((F.col("step") == "clean") & (F.col("status") == "success"))
    newest = F.max_by(F.struct("rows_in", "rows_out"), F.struct("finished_at", "run_id"))
    dropped = F.col("raw_lines") - F.col("clean_rows")
    return (
        cleaned.groupBy(F.col("period").alias("month")).agg(newest.alias("run"))
        .select("month", F.col("run.rows_in").alias("raw_lines"),
                F.col("run.rows_out").alias("clean_rows"))
        .withColumn("dropped", dropped)
        .withColumn("drop_rate", F.when(
            F.col("raw_lines") > 0, percent(F.col("dropped") / F.col("raw_lines"), 3)))
        .orderBy("month")
    )


def recent_runs(audit: DataFrame, count: int = RECENT_RUNS) -> DataFrame:
    return (
        audit.orderBy(F.desc("finished_at"), F.desc("run_id")).limit(count)
        .select("finished_at", "step", "period", "status", "rows_in", "rows_out", "message")
    )


# ---- features -----------------------------------------------------------

def quarters(features: DataFrame) -> DataFrame:
    return features.select("quarter").distinct().orderBy("quarter")


def latest_quarter(features: DataFrame, published: DataFrame | None = None) -> DataFrame:
    """Rows of the newest quarter of a stored table; only the folder of that quarter is read.

    The publish log tells the newest quarter where there is one, without a look at the table.
    """
    if published is None:
        newest = features.agg(F.max("quarter")).scalar()
    else:
        newest = published.filter(F.col("row_count") > 0).agg(F.max("quarter")).scalar()
    return features.filter(F.col("quarter") == newest)


def newest_of(features: DataFrame) -> DataFrame:
    """Rows of the newest quarter of features that are being computed, not read.

    A plain filter on the quarter would be pushed below the aggregates on one side only, and
    the features would be computed twice. So the quarter is compared together with the label,
    which is known after the last shuffle, and the newest quarter is taken from whole rows:
    both sides are one plan up to there, and its shuffles are reused.
    """
    row = F.max(F.struct("quarter", *(c for c in features.columns if c != "quarter")))
    newest = features.agg(row.alias("row")).select("row.quarter").scalar()
    label = F.coalesce("alert_next_hour", F.lit(False))
    return features.filter(F.struct(F.col("quarter"), label) >= F.struct(newest, F.lit(False)))


def midplane_sums(features: DataFrame) -> DataFrame:
    """Alerts and events by quarter and midplane."""
    return features.groupBy("quarter", "midplane").agg(
        F.sum("alerts").alias("alerts"), F.sum("events_total").alias("events"))


def midplane_ranking(features: DataFrame) -> DataFrame:
    """Alerts and events by quarter and midplane, most alerts first within a quarter."""
    return midplane_sums(features).orderBy("quarter", F.desc("alerts"), F.desc("events"), "midplane")


def top_midplanes(features: DataFrame, quarter: str, count: int = TOP_MIDPLANES) -> DataFrame:
    chosen = features.filter(F.col("quarter") == quarter)
    return midplane_ranking(chosen).limit(count).select("midplane", "alerts", "events")


def feature_rows(features: DataFrame, quarter: str, midplane: str) -> DataFrame:
    chosen = (F.col("quarter") == quarter) & (F.col("midplane") == midplane)
    return features.filter(chosen).orderBy("hour_start")


def midplane_kpis(features: DataFrame) -> DataFrame:
    """Hours, events, alert lines and the share of hours before an alert, per midplane page."""
    return features.groupBy("quarter", "midplane").agg(
        F.count("*").alias("hours"),
        F.sum("events_total").alias("events"),
        F.sum("alerts").alias("alert_lines"),
        F.avg(F.col("alert_next_hour").cast("int")).alias("alert_share"),
    )
