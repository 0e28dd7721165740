"""The zones and operational tables under one lake folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from opslog.fixed import (
    AUDIT_SCHEMA,
    BUILD_SCHEMA,
    EVENT_SCHEMA,
    FEATURE_COLUMNS,
    FEATURE_SCHEMA,
    MANIFEST_SCHEMA,
    PUBLISH_SCHEMA,
    VERDICT_SCHEMA,
    column_names,
)
from opslog.operators.publish import visible_features
from opslog.operators.reports import latest_quarter
from opslog.sources import files
from opslog.sources.claims import Claims

_FIRST_VERSION = "version=000000"


@dataclass(frozen=True)
class Lake:
    """``measure_type`` is that of the feature counts in all tables: "int", or "bigint" where one
    midplane can have over two billion events an hour.

    A step holds exclusive claims on its months or quarters for at most ``claim_seconds``; it
    waits ``claim_wait`` seconds for one that another run holds, then the period fails.
    """

    spark: SparkSession
    root: str
    measure_type: str = "int"
    claim_seconds: float = 2 * 3600
    claim_wait: float = 0

    @property
    def feature_schema(self) -> str:
        return FEATURE_SCHEMA.replace(" int", f" {self.measure_type}")

    def path(self, *parts: str) -> str:
        return "/".join((self.root.rstrip("/"), *parts))

    @property
    def claims(self) -> Claims:
        return Claims(self.spark, self.path("ops/claims"))

    # ---- reading --------------------------------------------------------

    def _table(self, folder: str, schema: str) -> DataFrame:
        """A Parquet table, empty until something was written."""
        try:
            return self.spark.read.schema(schema).parquet(self.path(folder))
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _version(self, folder: str) -> str:
        """The newest version of an operational table. Versions only come from ``compact``."""
        there = [e.name for e in files.entries(self.spark, self.path(folder)) if e.name.startswith("version=")]
        return max(there, default=_FIRST_VERSION)

    def _log(self, folder: str, schema: str) -> DataFrame:
        """An operational table: rows that were appended, in its newest version."""
        return self._table(f"{folder}/{self._version(folder)}", schema)

    def raw(self, months: Sequence[str]) -> DataFrame:
        """``value`` and ``month`` of the given months; only their folders are read."""
        schema = "value string, month string"
        try:
            lines = self.spark.read.schema(schema).text(self.path("raw"))
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            lines = self.spark.createDataFrame([], schema)
        return lines.filter(F.col("month").isin(list(months)))

    def processed(self, months: Sequence[str]) -> DataFrame:
        events = self._table("processed", f"{EVENT_SCHEMA}, month string")
        return events.filter(F.col("month").isin(list(months)))

    def curated(self, quarters: Sequence[str]) -> DataFrame:
        return self._table("curated", self.feature_schema).filter(F.col("quarter").isin(list(quarters)))

    def manifest(self) -> DataFrame:
        return self._log("ops/ingested_files", MANIFEST_SCHEMA)

    def audit(self) -> DataFrame:
        return self._log("ops/pipeline_runs", AUDIT_SCHEMA)

    def verdicts(self) -> DataFrame:
        """What became of every load of a processed month, oldest first by ``sequence``."""
        return self._log("ops/month_verdicts", VERDICT_SCHEMA)

    def builds(self) -> DataFrame:
        """Which load of which month went into the curated rows of a quarter."""
        return self._log("ops/quarter_builds", BUILD_SCHEMA)

    def first_month(self) -> str | None:
        """The earliest month that was ever stored or cleaned."""
        months = self.manifest().select("month").unionByName(self.verdicts().select("month"))
        return months.agg(F.min("month")).first()[0]

    def published(self) -> DataFrame:
        return self._log("serving/published", PUBLISH_SCHEMA)

    def loads(self) -> DataFrame:
        """All delivered rows, visible or not, with their load_id."""
        return self._table("serving/midplane_hourly", f"{self.feature_schema}, load_id string")

    def features(self) -> DataFrame:
        """What readers see: the newest published load of every quarter."""
        return visible_features(self.loads(), self.published())

    def latest_quarter(self) -> DataFrame:
        """The newest published quarter; the publish log tells which, and only it is read."""
        return latest_quarter(self.features(), self.published())

    def load_folders(self) -> dict[tuple[str, str], files.Entry]:
        """The folder of every (quarter, load_id), from listings alone."""
        found, root = {}, self.path("serving/midplane_hourly")
        for quarter in files.entries(self.spark, root):
            if quarter.name.startswith("quarter="):
                for load in files.entries(self.spark, quarter.path):
                    if load.name.startswith("load_id="):
                        found[quarter.name.removeprefix("quarter="), load.name.removeprefix("load_id=")] = load
        return found

    def create_views(self) -> None:
        """Temporary views for SQL users, under the names of the serving tables.

        They are stored as SQL text over the table folders, so the files are listed anew at
        each read and a later delivery shows up in an older view.
        """
        tables = {
            "ingested_files": ("ops/ingested_files", MANIFEST_SCHEMA),
            "pipeline_runs": ("ops/pipeline_runs", AUDIT_SCHEMA),
            "published_quarters": ("serving/published", PUBLISH_SCHEMA),
            "delivered_hours": ("serving/midplane_hourly", f"{self.feature_schema}, load_id string"),
        }
        for name, (folder, schema) in tables.items():
            if not self.exists(self.path(folder)):
                self._write_empty(folder, schema)
            columns = ", ".join(column_names(schema))
            source = f"parquet.`{self.path(folder)}`"
            newest = "" if name == "delivered_hours" else f" WHERE version = (SELECT max(version) FROM {source})"
            self.spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS SELECT {columns} FROM {source}{newest}")
        columns = ", ".join(f"h.{c}" for c in FEATURE_COLUMNS)
        self.spark.sql(f"""
            CREATE OR REPLACE TEMPORARY VIEW midplane_hourly AS
            SELECT {columns} FROM delivered_hours h JOIN (
                SELECT quarter, max_by(load_id, struct(published_at, load_id)) AS load_id
                FROM published_quarters GROUP BY quarter) p
            ON h.quarter = p.quarter AND h.load_id = p.load_id""")
        self.spark.sql("""
            CREATE OR REPLACE TEMPORARY VIEW latest_quarter AS
            SELECT * FROM midplane_hourly
            WHERE quarter = (SELECT max(quarter) FROM published_quarters WHERE row_count > 0)""")

    def _write_empty(self, folder: str, schema: str) -> None:
        """A table without rows, in the folder layout that later rows get."""
        rows = self.spark.createDataFrame([], schema)
        if folder == "serving/midplane_hourly":
            place = self.path(folder, "quarter=none", "load_id=none")
            rows.drop("quarter", "load_id").write.mode("append").parquet(place)
        else:
            self.append(rows, folder)

    def exists(self, path: str) -> bool:
        return files.exists(self.spark, path)

    def month_bytes(self, months: Sequence[str]) -> dict[str, int]:
        """Size of the stored months according to the manifest."""
        stored = self.manifest().filter(F.col("month").isin(list(months)))
        return {r["month"]: r["size"] for r in stored.groupBy("month").agg(F.sum("size_bytes").alias("size")).collect()}

    def raw_bytes(self, months: Sequence[str]) -> int:
        return sum(self.month_bytes(months).values())

    # ---- writing --------------------------------------------------------

    def replace_partitions(
        self, rows: DataFrame, folder: str, key: str, requested: Sequence[str]
    ) -> None:
        """Overwrite exactly the requested partitions; other partitions stay.

        A dynamic overwrite leaves a partition alone for which there is no row at all, so such
        a requested partition is emptied afterwards. Each period of the requested time is a
        bit, 64 in one observed measure; it is only asked whether a partition got any row, so
        a retried task may be counted twice without harm.
        """
        seen = Observation()
        per_year = 4 if "Q" in requested[0] else 12
        place = {value: int(value[:4]) * per_year + int(value[5:]) for value in requested}
        base = min(place.values())
        number = F.expr(
            f"cast(substr({key}, 1, 4) as int) * {per_year} + cast(substr({key}, 6) as int) - {base}")
        counted = rows.observe(seen, *(
            F.bit_or(F.when(F.floor(number / 64) == word, F.call_function(
                "shiftleft", F.lit(1).cast("bigint"), F.pmod(number, F.lit(64))))).alias(f"w{word}")
            for word in range((max(place.values()) - base) // 64 + 1)
        ))
        (
            counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(key).parquet(self.path(folder))
        )
        empty = self.spark.createDataFrame([], rows.drop(key).schema)
        for value in requested:
            word, bit = divmod(place[value] - base, 64)
            if not (seen.get[f"w{word}"] or 0) >> bit & 1:
                empty.write.mode("overwrite").parquet(self.path(folder, f"{key}={value}"))

    def write_processed(self, events: DataFrame, months: Sequence[str]) -> None:
        self.replace_partitions(events, "processed", "month", months)

    def write_curated(self, features: DataFrame, quarters: Sequence[str]) -> None:
        # A quarter of features is small; one or few files per quarter.
        gathered = features.hint("rebalance", F.col("quarter"))
        self.replace_partitions(gathered, "curated", "quarter", quarters)

    def write_raw(self, lines: DataFrame) -> None:
        """Lines with their month. Overwriting makes a failed copy repeatable: the caller only
        stores months that are not in the manifest."""
        (
            lines.select("value", "month").write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").option("lineSep", "\n")
            .partitionBy("month").text(self.path("raw"))
        )

    def raw_copied(self, months: Sequence[str]) -> DataFrame:
        """The stored lines as they were copied: a line ends at a newline only."""
        lines = self.spark.read.schema("value string, month string").text(
            self.path("raw"), lineSep="\n"
        )
        return lines.filter(F.col("month").isin(list(months)))

    def add_load(self, delivery: DataFrame) -> None:
        """Rows of a new load. A load written again replaces itself, and loads of other runs,
        written at the same time, are not touched."""
        (
            delivery.hint("rebalance", F.col("quarter"), F.col("load_id"))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("quarter", "load_id").parquet(self.path("serving/midplane_hourly"))
        )

    @contextmanager
    def working(self) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
        """A function that writes an intermediate result once and reads it back.

        The results lie under the lake, which all executors share, and are removed at the end.
        """
        target = self.path("work", uuid.uuid4().hex)

        def keep(rows: DataFrame, name: str) -> DataFrame:
            rows.write.parquet(f"{target}/{name}")
            return self.spark.read.schema(rows.schema).parquet(f"{target}/{name}")

        try:
            yield keep
        finally:
            files.remove(self.spark, target)

    def append(self, rows: DataFrame, folder: str) -> None:
        """Add a few operational rows as one file.

        The file is written aside and moved into the table as one step, so runs that append at
        the same time do not meet in a temporary folder of the table.
        """
        with self._aside(rows.coalesce(1)) as written, self._table_claim(folder):
            version = self.path(folder, self._version(folder))
            for entry in written:
                files.move(self.spark, entry.path, f"{version}/{entry.name}")

    def compact(self, folder: str, schema: str, target_bytes: int = 128 * 1024**2) -> int:
        """Rewrite an operational table into few files under a new version; returns the number
        of files it had.

        The new version appears by one rename. Appends wait meanwhile. The version before stays
        for readers that have listed it, until the next compaction.
        """
        with self._table_claim(folder):
            version = self._version(folder)
            there = [e for e in files.entries(self.spark, self.path(folder, version)) if _is_data(e)]
            if len(there) < 2:
                return len(there)
            rows = self._table(f"{folder}/{version}", schema)
            size = files.size(self.spark, self.path(folder, version))
            aside = self.path("work", uuid.uuid4().hex)
            rows.repartition(max(1, -(-size // target_bytes))).write.parquet(aside)
            new = f"version={int(version.split('=')[1]) + 1:06d}"
            files.move(self.spark, aside, self.path(folder, new))
            for entry in files.entries(self.spark, self.path(folder)):
                if entry.name.startswith("version=") and entry.name < version:
                    files.remove(self.spark, entry.path)
            return len(there)

    @contextmanager
    def _aside(self, rows: DataFrame) -> Iterator[list[files.Entry]]:
        aside = self.path("work", uuid.uuid4().hex)
        try:
            rows.write.parquet(aside)
            yield [e for e in files.entries(self.spark, aside) if _is_data(e)]
        finally:
            files.remove(self.spark, aside)

    @contextmanager
    def _table_claim(self, folder: str) -> Iterator[None]:
        """Appends and compactions of a table come one after another; both are short."""
        name = "table-" + folder.replace("/", "-")
        with self.claims.hold([name], seconds=600, wait=900) as held:
            if name not in held:
                raise TimeoutError(f"{folder} is claimed by another run")
            yield


def _is_data(entry: files.Entry) -> bool:
    return not entry.name.startswith(("_", "."))
