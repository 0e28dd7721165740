"""The registered queries: each runs one operator over whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opslog.fixed import EVENT_COLUMNS, FEATURE_COLUMNS
from opslog.functions import periods as P
from opslog.functions import text as T
from opslog.operators import clean as C
from opslog.operators import features as H
from opslog.operators import ingest as I
from opslog.operators import publish as D
from opslog.operators import quality as Q
from opslog.operators import reports as R
from opslog.operators import split as S
from opslog.operators import verdicts as V
from opslog.operators.replicate import replicate_lines
from opslog.plans import table_lines as B

Query = Callable[[SparkSession, str], DataFrame]

# Arguments a user of the pipeline would pass; the data covers 1995-01 to 2001-08. Files are judged
# by their first 100 lines, so that the limit is reached on small tables too.
QUARTER = "1996Q2"
MIDPLANE = "R01-M1"
COPIES = 3
CHECK_LINES = 100


def _order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.clean(B.order_lines(spark, sf_dir))


def _order_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.hourly_features(_order_events(spark, sf_dir))


def _event_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.hourly_measures(C.clean(B.event_lines(spark, sf_dir)))


def _audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.audit_rows(B.audit_runs(spark, sf_dir))


def _landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.landing_files(B.order_lines(spark, sf_dir))


def _order_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months of the orders with the number of orders."""
    orders = B.table(spark, sf_dir, "orders")
    return orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(
        F.count("*").alias("orders")
    )


# ---- lines and events ---------------------------------------------------

def parse_lines(spark, sf_dir):
    return C.parse_lines(B.event_lines(spark, sf_dir))


def clean(spark, sf_dir):
    return C.clean(B.event_lines(spark, sf_dir)).select(*EVENT_COLUMNS)


def clean_months(spark, sf_dir):
    return _order_events(spark, sf_dir)


def location_parts(spark, sf_dir):
    nodes = C.parse_lines(B.order_lines(spark, sf_dir)).groupBy("node").agg(
        F.count("*").alias("lines")
    )
    return nodes.select(
        "node", T.rack(F.col("node")).alias("rack"), T.midplane(F.col("node")).alias("midplane"),
        "lines",
    )


def mask_pii(spark, sf_dir):
    return B.table(spark, sf_dir, "documents").select(
        "doc_id", C.mask_pii(F.col("text")).alias("masked")
    )


def log_template(spark, sf_dir):
    masked = mask_pii(spark, sf_dir)
    return masked.select("doc_id", C.log_template(F.col("masked")).alias("template"))


def message_templates(spark, sf_dir):
    """Templates of the log messages with their number of events."""
    return C.clean(B.event_lines(spark, sf_dir)).groupBy("template").agg(
        F.count("*").alias("events"), F.count_distinct("message").alias("messages")
    )


def rows_per_month(spark, sf_dir):
    return C.rows_per_month(B.order_lines(spark, sf_dir))


def quality_gate(spark, sf_dir):
    return Q.quality_gate(rows_per_month(spark, sf_dir))


def replicate(spark, sf_dir):
    lines = B.event_lines(spark, sf_dir).select("line_no", "value")
    return replicate_lines(lines, COPIES)


# ---- periods ------------------------------------------------------------

def quarter_of(spark, sf_dir):
    month = F.col("month")
    return _order_months(spark, sf_dir).select(
        "month", P.quarter_of(month).alias("quarter"),
        P.is_quarter_end(month).alias("is_quarter_end"), "orders",
    )


def months_of_quarter(spark, sf_dir):
    quarters = _order_months(spark, sf_dir).groupBy(P.quarter_of(F.col("month")).alias("quarter")).agg(
        F.sum("orders").alias("orders")
    )
    return quarters.select(
        "quarter", "orders",
        F.posexplode(P.months_of_quarter(F.col("quarter"))).alias("position", "month"),
    )


def period_checks(spark, sf_dir):
    """Order dates written in good and bad ways, each way tested as month and as quarter."""
    key, date = F.col("o_orderkey"), F.col("o_orderdate")
    year, number = F.date_format(date, "yyyy"), F.month(date)
    ways = [
        F.date_format(date, "yyyy-MM"),
        F.date_format(date, "yyyy/MM"),
        F.date_format(date, "yy-MM"),
        F.concat(year, F.lit("-"), (number + 9).cast("string")),
        F.concat(year, F.lit("Q"), F.quarter(date).cast("string")),
        F.concat(year, F.lit("Q"), number.cast("string")),
        F.concat(F.date_format(date, "yyyy-MM"), F.lit("\n")),
        F.lit(""),
    ]
    text = F.element_at(F.array(*ways), (key % len(ways) + 1).cast("int"))
    return (
        B.table(spark, sf_dir, "orders").groupBy(text.alias("period")).agg(F.count("*").alias("orders"))
        .select("period", P.is_month(F.col("period")).alias("is_month"),
                P.is_quarter(F.col("period")).alias("is_quarter"), "orders")
    )


def quarters_ready(spark, sf_dir):
    """Which clean months complete a quarter; the last month of all completes its quarter too."""
    months = _order_events(spark, sf_dir).select("month").distinct()
    # One row per month; the window has no other rows.
    last = F.max("month").over(Window.partitionBy())
    return months.select("month", P.ready_quarter(F.col("month"), last).alias("quarter"))


def quarter_gaps(spark, sf_dir):
    """What keeps the quarters of the data from being complete, from the gate of every month.

    Each month has load 'a' with the verdict of the gate; no load in the Junes of even years;
    a later unchecked load 'b' in February; and in October a load 'b' that passed, after which
    a late failure of 'a' came in. The data is said to run from 1995-02 to 2001-07.
    """
    gate = quality_gate(spark, sf_dir).select("month", "status", "message")
    month = F.col("month")
    verdict = F.when(F.col("status") == "success", "passed").otherwise("failed")

    def row(load: str, status, message, sequence: int):
        status = F.lit(status) if isinstance(status, str) else status
        return F.struct(F.lit(load).alias("load_id"), status.alias("status"),
                        message.alias("message"), F.lit(sequence).cast("bigint").alias("sequence"))

    nothing = F.lit(None).cast("string")
    first = [row("a", "pending", nothing, 1), row("a", verdict, F.col("message"), 2)]
    rows = (
        F.when(month.endswith("-06") & (F.substring(month, 1, 4).cast("int") % 2 == 0), F.array())
        .when(month.endswith("-02"), F.array(*first, row("b", "pending", nothing, 3)))
        .when(month.endswith("-10"), F.array(*first, row("b", "pending", nothing, 3), row(
            "a", "failed", F.lit("too late"), 4), row("b", "passed", nothing, 5)))
        .otherwise(F.array(*first))
    )
    verdicts = gate.select("month", F.inline(rows))
    quarters = gate.select(P.quarter_of(month).alias("quarter")).distinct()
    return V.quarter_gaps(quarters, V.current_verdicts(verdicts), "1995-02", "2001-07")


def quarter_events(spark, sf_dir):
    months = P.month_names(QUARTER)
    return _order_events(spark, sf_dir).filter(F.col("month").isin(months))


# ---- features -----------------------------------------------------------

def hourly_features(spark, sf_dir):
    return H.hourly_features(C.clean(B.event_lines(spark, sf_dir)))


def quarterly_features(spark, sf_dir):
    return _order_features(spark, sf_dir)


def alert_next_hour(spark, sf_dir):
    labelled = H.alert_next_hour(_event_measures(spark, sf_dir))
    return labelled.select("midplane", "hour_start", "alerts", "alert_next_hour")


def feature_violations(spark, sf_dir):
    """Constraints on the features, after a copy of some rows and some wrong rows were added."""
    features = _order_features(spark, sf_dir)
    alerts = F.col("alerts")
    times = F.when(alerts > 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    seeded = features.withColumn("again", F.explode(times))
    wrong = (F.col("events_total") > 2) & (F.col("again") == 0)
    return Q.feature_violations(
        seeded.withColumn("alerts", F.when(wrong, F.col("events_total") + 1).otherwise(alerts))
        .withColumn("midplane", F.nullif("midplane", F.lit("R03-M1")))
        .select(*FEATURE_COLUMNS)
    )


def deliver(spark, sf_dir):
    """Three loads: 'a' has everything, 'b' replaces second quarters, 'c' was never published."""
    features = _order_features(spark, sf_dir)
    everything = F.array(F.lit("a"), F.lit("c"))
    second = F.col("quarter").endswith("Q2") & F.col("midplane").startswith("R01")
    loads = features.withColumn(
        "load_id", F.explode(F.when(second, F.array(F.lit("a"), F.lit("b"), F.lit("c"))).otherwise(everything))
    )
    quarters = _order_months(spark, sf_dir).select(P.quarter_of(F.col("month")).alias("quarter")).distinct()
    published = quarters.select(
        "quarter", F.explode(F.when(F.col("quarter").endswith("Q2"), F.array(F.lit("a"), F.lit("b")))
                             .otherwise(F.array(F.lit("a")))).alias("load_id"),
    ).withColumn("published_at", F.when(F.col("load_id") == "b", 2).otherwise(1))
    return D.visible_features(loads, published)


# ---- files --------------------------------------------------------------

def split_by_month(spark, sf_dir):
    whole = B.log_file(B.order_lines(spark, sf_dir))
    return S.split_by_month(whole).select("month", F.col("line_id").alias("line_no"), "value")


def split_counts(spark, sf_dir):
    return S.split_counts(split_by_month(spark, sf_dir))


def inspect_files(spark, sf_dir):
    return S.inspect_files(_landing(spark, sf_dir), CHECK_LINES).drop("size_bytes")


def _md5_digest(value, seed: int):
    """A line hash that other SQL engines have too; the pipeline uses a faster one."""
    text = F.concat(F.lit(f"{seed}:"), value) if seed else value
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def file_fingerprints(spark, sf_dir):
    """The content hash of every landing file, over splits as they come."""
    in_split = Window.partitionBy("file_name", "split").orderBy("line_id")
    lines = _landing(spark, sf_dir).withColumn("line_id", F.row_number().over(in_split).cast("bigint") - 1)
    splits = S.place_splits(S.split_sums(lines, CHECK_LINES, _md5_digest))
    return S.files_from_splits(splits, CHECK_LINES).select("file_name", "line_count", "fingerprint")


def landing_status(spark, sf_dir):
    files = _landing(spark, sf_dir)
    return I.landing_status(files, B.manifest_rows(files))


def ingest_decisions(spark, sf_dir):
    """All landing months, each also asked for with a bad name and ten years too late."""
    files = _landing(spark, sf_dir)
    month = F.col("month")
    later = F.concat((F.substring(month, 1, 4).cast("int") + 10).cast("string"), F.substring(month, 5, 3))
    requests = I.requests_for(files.select("file_name").distinct()).select(
        F.explode(F.array(month, F.replace(month, F.lit("-"), F.lit("/")), later)).alias("month")
    )
    inspected = S.inspect_files(files, CHECK_LINES)
    inspected = inspected.withColumn("sha256", B.checksum(F.col("line_count"), F.col("size_bytes")))
    return I.ingest_decisions(requests, inspected, B.manifest_rows(files))


# ---- reports ------------------------------------------------------------

def manifest_kpis(spark, sf_dir):
    return R.manifest_kpis(B.manifest_rows(_landing(spark, sf_dir)))


def manifest_violations(spark, sf_dir):
    """Constraints on a manifest in which the June files were recorded twice."""
    rows = B.manifest_rows(_landing(spark, sf_dir))
    times = F.when(F.col("month").endswith("-06"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return Q.manifest_violations(rows.withColumn("again", F.explode(times)))


def feature_kpis(spark, sf_dir):
    return R.feature_kpis(_order_features(spark, sf_dir))


def pipeline_kpis(spark, sf_dir):
    return R.pipeline_kpis(_audit(spark, sf_dir))


def audit_rows(spark, sf_dir):
    return _audit(spark, sf_dir)


def audit_violations(spark, sf_dir):
    """Constraints on audit rows with a few wrong steps, statuses and repeated ids."""
    key = F.col("run_id")
    seeded = _audit(spark, sf_dir).withColumns({
        "step": F.when(key % 1000 == 3, "copy").otherwise(F.col("step")),
        "status": F.when(key % 1000 == 4, "started").otherwise(F.col("status")),
        "period": F.when(key % 1000 == 5, F.lit(None)).otherwise(F.col("period")),
        "run_id": F.when(key % 1000 == 6, key - 1).otherwise(key),
    })
    return Q.audit_violations(seeded)


def latest_runs(spark, sf_dir):
    return R.latest_runs(_audit(spark, sf_dir))


def status_grid(spark, sf_dir):
    return R.status_grid(_audit(spark, sf_dir))


def lines_per_month(spark, sf_dir):
    return R.lines_per_month(_audit(spark, sf_dir))


def recent_runs(spark, sf_dir):
    return R.recent_runs(_audit(spark, sf_dir))


def quarters(spark, sf_dir):
    return R.quarters(_order_features(spark, sf_dir))


def latest_quarter(spark, sf_dir):
    return R.newest_of(_order_features(spark, sf_dir))


def midplane_ranking(spark, sf_dir):
    """The ranking of every quarter with the place of each midplane."""
    place = F.row_number().over(
        Window.partitionBy("quarter").orderBy(F.desc("alerts"), F.desc("events"), "midplane")
    )
    return R.midplane_sums(_order_features(spark, sf_dir)).withColumn("place", place)


def top_midplanes(spark, sf_dir):
    return R.top_midplanes(_order_features(spark, sf_dir), QUARTER)


def feature_rows(spark, sf_dir):
    return R.feature_rows(_order_features(spark, sf_dir), QUARTER, MIDPLANE)


def midplane_kpis(spark, sf_dir):
    return R.midplane_kpis(_order_features(spark, sf_dir))


_REGISTERED: tuple[Query, ...] = (
    parse_lines, clean, clean_months, location_parts, mask_pii, log_template, message_templates,
    rows_per_month, quality_gate,
    quarter_of, months_of_quarter, period_checks, quarters_ready, quarter_gaps, quarter_events,
    hourly_features, quarterly_features, alert_next_hour, feature_violations,
    deliver, split_by_month, split_counts, inspect_files, file_fingerprints, landing_status, ingest_decisions,
    manifest_kpis, manifest_violations, feature_kpis, pipeline_kpis, audit_rows, audit_violations,
    latest_runs, status_grid, lines_per_month, recent_runs, quarters, latest_quarter,
    midplane_ranking, top_midplanes, feature_rows, midplane_kpis,
)

QUERIES: dict[str, Query] = {q.__name__: q for q in _REGISTERED} | {"replicate_lines": replicate}
