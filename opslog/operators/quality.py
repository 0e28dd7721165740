"""Quality gate and table constraints, as reports over whole tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslog.fixed import (
    DROP_RATE,
    FEATURE_COLUMNS,
    MANIFEST_SCHEMA,
    MAX_DROP_RATE,
    NO_VALID_LINES,
    STATUSES,
    STEPS,
    TOO_MANY_DROPPED,
    column_names,
)


def percent(ratio: Column, digits: int) -> Column:
    """'3.12%' for 0.03125: ``format_number`` rounds exact halves to even, ``printf`` does not."""
    number = F.replace(F.format_number(ratio * F.lit(100.0), digits), F.lit(","), F.lit(""))
    return F.concat(number, F.lit("%"))


def quality_gate(counts: DataFrame, max_drop_rate: float = MAX_DROP_RATE) -> DataFrame:
    """``counts`` has month, raw_lines, clean_rows; adds drop_rate, status and message.

    A month fails without any clean row, or when more than ``max_drop_rate`` was dropped.
    """
    rate = F.when(
        F.col("raw_lines") > 0, F.lit(1.0) - F.col("clean_rows") / F.col("raw_lines")
    )
    empty, too_many = F.col("clean_rows") == 0, F.col("drop_rate") > max_drop_rate
    limit = F.lit(f"{max_drop_rate:.0%}")
    message = (
        F.when(empty, F.format_string(NO_VALID_LINES, "month"))
        .when(too_many, F.format_string(TOO_MANY_DROPPED, "month", percent(F.col("drop_rate"), 2), limit))
        .otherwise(F.format_string(DROP_RATE, percent(F.col("drop_rate"), 3)))
    )
    return (
        counts.withColumn("drop_rate", rate)
        .withColumn("status", F.when(empty | too_many, "failed").otherwise("success"))
        .withColumn("message", message)
    )


def _nulls(columns) -> dict[str, Column]:
    return {f"{c} is null": F.count_if(F.col(c).isNull()) for c in columns}


def _rule_rows(counts: DataFrame, checks: dict[str, Column], by: Sequence[str]) -> DataFrame:
    """One (rule, violations) row per check, from one pass over the table."""
    totals = counts.groupBy(*by).agg(*(check.alias(f"c{i}") for i, check in enumerate(checks.values())))
    pairs = F.array(*(
        F.struct(F.lit(rule).alias("rule"), F.col(f"c{i}").cast("bigint").alias("violations"))
        for i, rule in enumerate(checks)
    ))
    return totals.select(*by, F.inline(pairs))


def _duplicate_keys(table: DataFrame, keys: list[str], rule: str, by: Sequence[str]) -> DataFrame:
    """Number of keys that occur more than once. The count per key is merged before the shuffle."""
    per_key = table.groupBy(*by, *keys).agg(F.count("*").alias("n"))
    return per_key.groupBy(*by).agg(F.count_if(F.col("n") > 1).alias("violations")).select(
        *by, F.lit(rule).alias("rule"), "violations"
    )


def _report(
    table: DataFrame, checks: dict[str, Column], unique: dict[str, list[str]], by: Sequence[str] = ()
) -> DataFrame:
    parts = [_duplicate_keys(table, keys, rule, by) for rule, keys in unique.items()]
    return reduce(DataFrame.unionByName, parts, _rule_rows(table, checks, by))


def feature_violations(features: DataFrame, by: str | None = None) -> DataFrame:
    """Violations of the feature constraints, for the whole table or for each value of ``by``."""
    checks = _nulls(FEATURE_COLUMNS)
    checks["events_total < alerts"] = F.count_if(F.col("events_total") < F.col("alerts"))
    key = {"duplicate midplane, hour_start": ["midplane", "hour_start"]}
    return _report(features, checks, key, [by] if by else ())


def manifest_violations(manifest: DataFrame) -> DataFrame:
    checks = _nulls(column_names(MANIFEST_SCHEMA))
    return _report(manifest, checks, {"duplicate file_name": ["file_name"]})


def audit_violations(audit: DataFrame) -> DataFrame:
    checks = _nulls(["run_id", "step", "period", "status", "started_at", "finished_at"])
    checks["unknown step"] = F.count_if(~F.col("step").isin(*STEPS))
    checks["unknown status"] = F.count_if(~F.col("status").isin(*STATUSES))
    return _report(audit, checks, {"duplicate run_id": ["run_id"]})
