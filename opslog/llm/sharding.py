"""Contiguous shards of near equal byte size from global prefix sums (operator 1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opslog.llm.common import stored, tasks_for

ROWS_PER_TASK = 2_000_000


def plan_shards(docs: DataFrame, shards: int = 8, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: key, size, text_crc32, law, shard, slot, grown_shard.

    Documents are ordered by key (nulls first; ties by checksum and size, then by where they
    lie). Each range of that order reports its bytes and rows; the running sums of these few
    totals start the prefix sums inside the ranges. A document goes to the shard in whose
    equal slice of all bytes its middle byte lies, so a shard is a contiguous run and misses
    its target by less than one document. The size is UTF-8 bytes plus one; a null text has
    size 1 and the checksum of nothing, 0. A shard can be empty when there are fewer
    documents than shards; an empty table gives no rows. Only key and text are read.

    The text is reduced to size and checksum before anything is shuffled.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    slim = docs.select(
        F.col(key).alias("key"),
        (F.octet_length(body).cast("long") + 1).alias("size"),
        F.crc32(body).alias("crc"),
    )
    slim = stored(slim.withColumn("tie", F.monotonically_increasing_id()), "sizes")
    width = tasks_for(spark, slim.count(), ROWS_PER_TASK)
    order = ["key", "crc", "size", "tie"]
    ranges = stored(
        slim.repartitionByRange(width, *order).withColumn("part", F.spark_partition_id()), "ranges")
    totals = ranges.groupBy("part").agg(F.sum("size").alias("part_bytes"), F.count("*").alias("part_rows"))
    # One row per range: the only window without a key.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = totals.select(
        "part",
        F.coalesce(F.sum("part_bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("part_rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("part_bytes").over(whole).alias("all_bytes"),
    )
    inside = Window.partitionBy("part").orderBy(*order)
    placed = (
        ranges.join(F.broadcast(starts), "part")
        .withColumn("end", F.col("bytes_before") + F.sum("size").over(inside))
        .withColumn("row", F.col("rows_before") + F.row_number().over(inside) - 1)
        .withColumn("shard", F.expr(f"cast((2 * end - size) * {shards} div (2 * all_bytes) as int)"))
    )
    placed = stored(placed.select("key", "size", "crc", "shard", "row"), "placed")
    firsts = placed.groupBy("shard").agg(F.min("row").alias("first"))
    return placed.join(F.broadcast(firsts), "shard").select(
        F.col("key").alias(key), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", (F.col("row") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
