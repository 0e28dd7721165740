"""Which landing files may enter the raw zone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslog.fixed import MIN_VALID_SHARE
from opslog.functions.periods import is_month, landing_name, month_of_landing_name

ACCEPTED = ("ingested", "already_ingested")


def landing_status(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Landing files (``file_name``) with a flag for those in the manifest, sorted by name."""
    known = manifest.select("file_name").distinct().withColumn("known", F.lit(True))
    return (
        files.select("file_name").distinct()
        .join(known, "file_name", "left")
        .select("file_name", F.coalesce("known", F.lit(False)).alias("ingested"))
        .orderBy("file_name")
    )


def ingest_decisions(requests: DataFrame, inspected: DataFrame, manifest: DataFrame) -> DataFrame:
    """Decide every requested ``month`` at once; the first rule that applies wins.

    ``inspected`` has file_name, line_count, size_bytes, valid_share and sha256, one row per
    landing file. ``manifest`` has file_name and sha256 of the files stored before.
    """
    known = manifest.select("file_name", F.col("sha256").alias("known_sha256"))
    joined = (
        requests.select("month").distinct()
        .withColumn("file_name", landing_name(F.col("month")))
        .join(inspected.withColumn("found", F.lit(True)), "file_name", "left")
        .join(known, "file_name", "left")
    )
    doubtful = (F.col("line_count") == 0) | (F.col("valid_share") < MIN_VALID_SHARE)
    status = (
        F.when(~is_month(F.col("month")), "bad_month")
        .when(F.col("found").isNull(), "not_found")
        .when(doubtful, "wrong_format")
        .when(F.col("known_sha256") == F.col("sha256"), "already_ingested")
        .when(F.col("known_sha256").isNotNull(), "conflict")
        .otherwise("ingested")
    )
    codes = {
        "bad_month": 400, "not_found": 404, "wrong_format": 422,
        "already_ingested": 200, "conflict": 409, "ingested": 201,
    }
    code = F.coalesce(*(F.when(F.col("status") == s, F.lit(c)) for s, c in codes.items()))
    return joined.withColumn("status", status).select(
        "month", "file_name", "status", code.alias("code"),
        "line_count", "size_bytes", "valid_share", "sha256",
    )


def requests_for(files: DataFrame) -> DataFrame:
    """One request per landing file, for ingesting everything that is there."""
    return files.select(month_of_landing_name(F.col("file_name")).alias("month"))


def new_manifest_rows(decisions: DataFrame, raw_root: str) -> DataFrame:
    """Manifest rows of the months that were decided as new."""
    return decisions.filter(F.col("status") == "ingested").select(
        "file_name", "month", "sha256", "line_count", "size_bytes",
        F.concat(F.lit(raw_root.rstrip("/") + "/month="), F.col("month")).alias("hdfs_path"),
        F.current_timestamp().alias("ingested_at"),
    )
