"""Session settings the results depend on."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

BYTES_PER_SHUFFLE_TASK = 256 * 1024**2

#: Defaults of a session; any of them can be given to ``build_session`` or set on the cluster.
#: Split borders must not depend on how many executors are alive, and a scan task should hold
#: one split, so that a line's number in its task is its number in the split. Period folders
#: stay text. A range of input sizes above ``opslog.largeInput`` aims at larger AQE tasks.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.files.minPartitionNum": "200",
    "spark.sql.files.openCostInBytes": "128m",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}
LARGE_INPUT = "opslog.largeInput"
LARGE_TASK = "opslog.largeTask"


def build_session(app_name: str = "opslog", **settings: str) -> SparkSession:
    """A session for the pipeline; everything about size is left to the cluster and AQE."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in (DEFAULTS | settings).items():
        builder = builder.config(key, value)
    return pin_utc(builder.getOrCreate())


def pin_utc(spark: SparkSession) -> SparkSession:
    """Log times carry no zone; UTC keeps every conversion on the way from shifting them."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@contextmanager
def sized_for(spark: SparkSession, input_bytes: int) -> Iterator[None]:
    """Shuffle settings for a job over ``input_bytes`` of text, put back afterwards.

    The number of shuffle tasks only ever goes up from what the session has; AQE joins tasks
    that turn out small. For inputs above the session's ``opslog.largeInput`` (bytes, 100 GiB
    by default) AQE aims at tasks of ``opslog.largeTask``, because they become the files of a
    zone.
    """
    settings = {}
    tasks = -(-input_bytes // BYTES_PER_SHUFFLE_TASK)
    if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")):
        settings["spark.sql.shuffle.partitions"] = str(tasks)
    if input_bytes > int(spark.conf.get(LARGE_INPUT, str(100 * 1024**3))):
        settings["spark.sql.adaptive.advisoryPartitionSizeInBytes"] = spark.conf.get(LARGE_TASK, "512m")
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
