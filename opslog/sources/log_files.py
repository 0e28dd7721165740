"""Text log files as frames of (file_name, split, line_id, value), and the files themselves.

A month arrives either as one file ``BGL_<month>.log`` or, as the month split writes it, as a
folder ``month=<month>`` of part files whose names keep the line order. Both have the same
logical ``file_name``. Nothing below other folders of the landing area is looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opslog.fixed import LANDING_NAME, MONTH_PATTERN
from opslog.functions.periods import landing_name

_MONTH_FOLDER = "month="
LANDING_SCHEMA = "file_name string, size_bytes bigint"


def _logical_name(path: Column) -> Column:
    """Evaluated for every line, so it only cuts the path at its last two slashes."""
    tail = F.substring_index(path, "/", -2)
    return F.when(
        tail.startswith(_MONTH_FOLDER), landing_name(F.substring(tail, len(_MONTH_FOLDER) + 1, 7))
    ).otherwise(F.substring_index(tail, "/", -1))


def read_log_lines(spark: SparkSession, *paths: str, landing: bool = False) -> DataFrame:
    """Every line of the given files, or of the files right in the given folders.

    (split, line_id) is the order inside a file. Lines end at a newline only. The id counts
    the lines of a scan task in file order, without gaps. Path and byte position identify a
    split, so the same split has the same key in every scan of the same files. With
    ``landing`` the part files of a month are one file; otherwise each path is a file.
    """
    path = F.col("_metadata.file_path")
    return spark.read.text(list(paths), lineSep="\n").select(
        (_logical_name(path) if landing else path).alias("file_name"),
        F.struct(path.alias("part"), F.col("_metadata.file_block_start").alias("start")).alias("split"),
        F.monotonically_increasing_id().alias("line_id"),
        "value",
    )


@dataclass(frozen=True)
class Landed:
    """What lies in the landing folder for one month."""

    month: str
    paths: tuple[str, ...]
    size_bytes: int

    @property
    def file_name(self) -> str:
        return LANDING_NAME % self.month

    @property
    def ambiguous(self) -> bool:
        """Both a file and a folder: it is not known which of them is meant."""
        return len(self.paths) > 1


def _folder(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def landed_months(spark: SparkSession, folder: str) -> dict[str, Landed]:
    """The months of the landing folder, from its own listing: one entry per month.

    Files are not opened, and part files are only summed up by the file system.
    """
    found: dict[str, list[tuple[str, int]]] = {}
    prefix, suffix = map(re.escape, LANDING_NAME.split("%s"))
    system, place = _folder(spark, folder)
    for entry in system.listStatus(place):
        name = entry.getPath().getName()
        pattern = rf"{_MONTH_FOLDER}({MONTH_PATTERN})" if entry.isDirectory() else rf"{prefix}({MONTH_PATTERN}){suffix}"
        if month := re.fullmatch(pattern, name):
            size = system.getContentSummary(entry.getPath()).getLength()
            found.setdefault(month[1], []).append((entry.getPath().toString(), size))
    return {
        month: Landed(month, tuple(sorted(path for path, _ in parts)), sum(size for _, size in parts))
        for month, parts in found.items()
    }


def landing_files(spark: SparkSession, landed: Iterable[Landed]) -> DataFrame:
    """file_name (logical) and size_bytes, empty files included."""
    rows = sorted((one.file_name, one.size_bytes) for one in landed)
    return spark.createDataFrame(rows, LANDING_SCHEMA)


def text_bytes(spark: SparkSession, *paths: str) -> int:
    """Total size of the files below the paths, from their listing."""
    total = 0
    for path in paths:
        system, place = _folder(spark, path)
        total += system.getContentSummary(place).getLength()
    return total


def write_month_files(lines_by_month: DataFrame, folder: str) -> None:
    """One folder per month; part file names and rows keep the line order of the input.

    Only the folders of the months in the input are replaced; everything else in ``folder``
    stays as it is.
    """
    (
        lines_by_month.select("value", "month")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("month").option("lineSep", "\n").text(folder)
    )


def write_csv(rows: DataFrame, path: str) -> None:
    """Export of a bounded selection (one midplane and quarter) as a single file with a header."""
    shown = [
        F.initcap(F.col(name).cast("string")).alias(name) if kind == "boolean" else F.col(name)
        for name, kind in rows.dtypes
    ]
    (
        rows.select(*shown).coalesce(1).write.mode("overwrite")
        .option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path)
    )
