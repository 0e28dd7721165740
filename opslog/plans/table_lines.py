"""Log lines and operational rows derived from the given tables, row by row.

The given tables hold no log text. ``events`` becomes one month of lines, ``orders`` becomes
eighty months. Both contain exact copies, garbage, impossible dates, lines of another month,
unknown locations and lower-case levels, so that every rule of the cleaner is used.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opslog.fixed import STEPS
from opslog.functions.periods import landing_name
from opslog.session import pin_utc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _text(value) -> Column:
    return F.col(value).cast("string") if isinstance(value, str) else value.cast("string")


# Months of the orders with a shape of their own: one of garbage, one without any fault, and one
# with all events of one midplane in one hour.
GARBAGE_MONTH, CLEAN_MONTH, BUSY_MONTH = "1997-02", "1998-03", "1999-11"
TROUBLES = (
    "parity error", "TLB miss", "link down", "fan stopped", "voltage low", "cache flush", "bus timeout",
    "disk full", "clock drift", "page fault", "mount lost", "node reset", "lane failed", "queue stuck",
    "frame dropped", "sensor silent", "power cycled", "route changed", "lease expired", "file missing",
    "thread hung", "stack overrun", "job killed", "token lost",
)


def _lines(source: DataFrame) -> DataFrame:
    """(event_id, ts, user_id, event_type, value) -> (line_no, month, value)."""
    number, user = F.col("event_id"), F.col("user_id")
    month = F.substring(F.col("time"), 1, 7)
    sound, busy = month == CLEAN_MONTH, month == BUSY_MONTH
    label = F.when((F.col("event_type") == "error") & (F.col("value") > 50), "KERNDTLB").otherwise("-")
    node = F.when(busy, "R02-M0-N0").when(user % 37 == 0, "UNKNOWN_LOCATION").otherwise(
        F.concat(F.lit("R"), F.lpad(_text(user % 4), 2, "0"), F.lit("-M"), _text(user % 2), F.lit("-N0"))
    )
    time = F.col("time")  # 'yyyy-MM-dd HH:mm:ss' with a fraction unless it is zero
    day_and_hour = F.when(busy, f"{BUSY_MONTH}-05-10").otherwise(
        F.concat(F.substring(time, 1, 10), F.lit("-"), F.substring(time, 12, 2)))
    time_text = (
        F.when((number % 89 == 1) & ~sound, "2024-01-32-00.00.00.000000")
        .when((number % 83 == 1) & ~sound, "2023-12-31-23.59.59.999999")
        .otherwise(F.concat(
            day_and_hour, F.translate(F.substring(time, 14, 6), ":", "."),
            F.lit("."), F.rpad(F.substring(time, 21, 6), 6, "0")))
    )
    component = F.when(user % 3 == 0, "APP").when(user % 7 == 0, "DISCOVERY").otherwise("KERNEL")
    levels = {"error": "FATAL", "view": "info", "click": "WARNING", "signup": "SEVERE"}
    level = F.coalesce(
        *(F.when(F.col("event_type") == k, F.lit(v)) for k, v in levels.items()), F.lit("FAILURE")
    )
    message = F.concat(
        F.lit("core "), _text(number % 5), F.lit(" at 0x"), _text(number % 7),
        F.lit("fA from 10.0.0."), _text("user_id"), F.lit(" by u"), _text("user_id"),
        F.lit("@x.org "),
        F.element_at(F.array(*map(F.lit, TROUBLES)), (number % len(TROUBLES) + 1).cast("int")),
    )
    seconds = _text(F.unix_timestamp(F.col("ts").cast("timestamp")))
    whole = F.concat_ws(
        " ", label, seconds, F.translate(F.substring(time, 1, 10), "-", "."), node, time_text, node,
        F.lit("RAS"), component, level, message,
    )
    garbage = (month == GARBAGE_MONTH) | ((number % 97 == 1) & ~sound)
    value = F.when(garbage, F.concat(F.lit("garbage "), _text("event_id"))).otherwise(whole)
    # Exploding the text itself also keeps later filters on it from being pushed below the
    # generator, where the long expression above would be evaluated once per filter.
    copies = F.array_repeat(value, F.when((number % 50 == 0) & ~sound, 2).otherwise(1))
    return source.withColumn("time", _text("ts")).select(
        "event_id", F.substring(time, 1, 7).alias("month"),
        F.posexplode(copies).alias("copy", "value"),
    ).select((F.col("event_id") * 2 + F.col("copy")).alias("line_no"), "month", "value")


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(table(spark, sf_dir, "events"))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    kinds = {0: "error", 1: "view", 2: "click", 3: "signup"}
    kind = F.coalesce(*(F.when(key % 5 == k, F.lit(v)) for k, v in kinds.items()), F.lit("purchase"))
    after = F.make_dt_interval(secs=(key % 14400).cast("decimal(18,6)"))
    return _lines(table(spark, sf_dir, "orders").select(
        key.alias("event_id"),
        (F.col("o_orderdate") + after).alias("ts"),
        F.col("o_custkey").alias("user_id"),
        kind.alias("event_type"),
        F.when(F.col("o_totalprice") > 100000, 60.0).otherwise(40.0).alias("value"),
    ))


LINES_PER_SPLIT = 4096


def log_file(lines: DataFrame) -> DataFrame:
    """The lines as one unsplit log file in ``line_no`` order, cut into many small splits."""
    return lines.select(
        F.lit("whole.log").alias("file_name"),
        F.floor(F.col("line_no") / LINES_PER_SPLIT).cast("bigint").alias("split"),
        F.col("line_no").alias("line_id"),
        "value",
    )


def landing_files(lines: DataFrame) -> DataFrame:
    """The lines as one landing file per month; in every May each tenth event is not log text."""
    spoilt = F.col("month").endswith("-05") & (F.floor(F.col("line_no") / 2) % 10 == 0)
    return lines.select(
        landing_name(F.col("month")).alias("file_name"),
        F.floor(F.col("line_no") / LINES_PER_SPLIT).cast("bigint").alias("split"),
        F.col("line_no").alias("line_id"),
        F.when(spoilt, F.concat(F.lit("# "), "value")).otherwise(F.col("value")).alias("value"),
    )


def file_checksums(files: DataFrame) -> DataFrame:
    """A stand-in checksum per landing file that both SQL engines can compute."""
    sizes = files.groupBy("file_name").agg(
        F.count("*").alias("lines"),
        F.sum(F.octet_length("value") + F.lit(1)).alias("size_bytes"),
    )
    sha = checksum(F.col("lines"), F.col("size_bytes"))
    return sizes.select("file_name", "lines", "size_bytes", sha.alias("sha256"))


def checksum(lines: Column, size_bytes: Column) -> Column:
    text = F.concat_ws(":", F.col("file_name"), lines.cast("string"), size_bytes.cast("string"))
    return F.sha2(text, 256)


def manifest_rows(files: DataFrame) -> DataFrame:
    return manifest_of(file_checksums(files))


def manifest_of(checksums: DataFrame) -> DataFrame:
    """Files of every third month (and May) as stored before; those of September have changed."""
    month = F.substring("file_name", 5, 7)
    sha = F.when(month.endswith("-09"), F.sha2("sha256", 256)).otherwise(F.col("sha256"))
    return (
        checksums.filter(F.substring(month, 6, 2).isin("03", "05", "06", "09", "12"))
        .select(
            "file_name", month.alias("month"), sha.alias("sha256"),
            F.col("lines").alias("line_count"), "size_bytes",
            F.concat(F.lit("raw/month="), month).alias("hdfs_path"),
            F.to_timestamp_ntz(F.concat(month, F.lit("-28 00:00:00"))).alias("ingested_at"),
        )
    )


def audit_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit rows without rows_dropped, one per order."""
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    priorities = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
    step = F.coalesce(*(
        F.when(F.substring("o_orderpriority", 1, 1) == p[0], F.lit(s))
        for p, s in zip(priorities, STEPS)
    ))
    rows_in = F.floor("o_totalprice").cast("bigint")
    micros = F.make_dt_interval(
        secs=(key.cast("decimal(18,0)") * F.lit(Decimal("0.000001"))).cast("decimal(18,6)")
    )
    failed = F.col("o_orderstatus") == "F"
    return orders.select(
        key.alias("run_id"),
        step.alias("step"),
        F.substring(_text("o_orderdate"), 1, 7).alias("period"),
        rows_in.alias("rows_in"),
        (rows_in - key % 50).alias("rows_out"),
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.when(failed, F.concat(F.lit("order "), F.repeat(_text("o_orderkey"), F.lit(100)))).alias("message"),
        F.col("o_orderdate").alias("started_at"),
        (F.col("o_orderdate") + micros).alias("finished_at"),
    )
