"""Reading tables, keeping intermediate tables in the shared folder, sizing, components."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors see. Only a local session may go without the setting."""
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that driver and executors share")
    folder = f"file://{tempfile.gettempdir()}/opslog-{os.getpid()}"
    spark.conf.set(CHECKPOINT_DIR, folder)
    return folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives executors."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tasks_for(spark: SparkSession, rows: int, rows_per_task: int) -> int:
    """Shuffle width for ``rows``: grows with them, never below the session's setting."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_per_task))


def set_aside(docs: DataFrame, *used: str) -> tuple[DataFrame, list[Column]]:
    """``docs`` with every column but ``used`` under a neutral name, and the columns that give
    the first names and order back: extra columns then clash with nothing an operator adds."""
    neutral = {c: c if c in used else f"extra_{i}" for i, c in enumerate(docs.columns)}
    renamed = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in neutral.items()))
    return renamed, [F.col(n).alias(c) for c, n in neutral.items()]


def spans(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose sizes add up to ``limit`` or hold one larger item."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def small(batches: Iterator[pa.RecordBatch], rows: int = 1_000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, without copying: bounds what a task holds
    as Python objects at once."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the undirected graph of ``edges`` (a, b: long); component is the
    smallest node. Minimum labels travel along the edges and are shortened by pointer jumps,
    so a chain of n nodes takes about log n rounds. All tables stay on the cluster; a node
    with very many edges only meets partial minima.
    """
    both = stored(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .where("a != b").distinct(), "edges",
    )
    labels = stored(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
        .select("node", F.least("node", "near").alias("component")), "labels",
    )
    while True:
        seen = labels.select(F.col("node").alias("b"), "component")
        heard = (
            both.join(seen, "b").groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("heard"))
        )
        lower = labels.join(heard, "node").select(
            "node", F.col("component").alias("before"), F.least("component", "heard").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("component").alias("jumped"))
        after = stored(
            lower.join(jump, "low").select("node", "before", F.least("low", "jumped").alias("component")),
            "labels",
        )
        changed = after.where("before != component").isEmpty()
        labels = after.select("node", "component")
        if changed:
            return labels
