"""All-or-nothing delivery: rows of a load stay invisible until the load is published."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opslog.fixed import FEATURE_COLUMNS


def delivery_rows(curated: DataFrame, load_id: str) -> DataFrame:
    return curated.select(*FEATURE_COLUMNS).withColumn("load_id", F.lit(load_id))


def current_loads(published: DataFrame) -> DataFrame:
    """The newest published load of each quarter; one row per quarter."""
    newest = F.max_by("load_id", F.struct("published_at", "load_id"))
    return published.groupBy("quarter").agg(newest.alias("load_id"))


def visible_features(loads: DataFrame, published: DataFrame) -> DataFrame:
    """Rows of the newest published load of every quarter.

    Both join keys are partition folders of the serving table, so with the small load list on
    the build side Spark prunes the folders of unpublished and replaced loads.
    """
    return loads.join(current_loads(published), ["quarter", "load_id"]).select(*FEATURE_COLUMNS)


def superseded_loads(published: DataFrame) -> DataFrame:
    """quarter, load_id, superseded_at of the loads that were visible once and are not now.

    A load is superseded when the next publish row of its quarter came; one that was published
    several times, by the last of them. A window holds the publish rows of one quarter.
    """
    following = F.lead("published_at").over(
        Window.partitionBy("quarter").orderBy("published_at", "load_id"))
    ended = published.withColumn("ended", following).groupBy("quarter", "load_id").agg(
        F.max("ended").alias("superseded_at"))
    return ended.join(current_loads(published), ["quarter", "load_id"], "left_anti").select(
        "quarter", "load_id", "superseded_at")


def unused_loads(loads: DataFrame, published: DataFrame) -> DataFrame:
    """Loads that no reader can see any more, for an administrator to remove."""
    return (
        loads.select("quarter", "load_id").distinct()
        .join(current_loads(published), ["quarter", "load_id"], "left_anti")
    )
