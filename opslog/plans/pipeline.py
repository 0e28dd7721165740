"""The five steps over sets of months or quarters, and the run over a whole history.

Each step is a few Spark jobs however many periods it gets. What reaches the driver is one
small row per requested period: decisions, counts and outcomes.

Every step takes ``strict``: true raises ``StepFailed`` once all periods are done and audited,
false only reports, so that one bad month does not stop the others.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslog.fixed import (
    AUDIT_SCHEMA,
    BUILD_SCHEMA,
    FORMAT_CHECK_LINES,
    MANIFEST_SCHEMA,
    MAX_DROP_RATE,
    PUBLISH_SCHEMA,
    VERDICT_SCHEMA,
)
from opslog.functions import periods as P
from opslog.functions.lines import dated_month
from opslog.operators import clean as C
from opslog.operators import features as H
from opslog.operators import ingest as I
from opslog.operators import publish as D
from opslog.operators import quality as Q
from opslog.operators import split as S
from opslog.operators import verdicts as V
from opslog.operators.replicate import replicate_lines
from opslog.plans.audit import StepRun, audited, raise_failures, succeeded
from opslog.session import BYTES_PER_SHUFFLE_TASK, sized_for
from opslog.sources import files
from opslog.sources import log_files as L
from opslog.sources.claims import Claim
from opslog.sources.lake import Lake

Runs = dict[str, StepRun]

DECISION_SCHEMA = (
    "month string, file_name string, status string, code int, line_count bigint, "
    "size_bytes bigint, valid_share double, sha256 string"
)


def _distinct(periods: Iterable[str], check) -> list[str]:
    return sorted({check(period) for period in periods})


def _counts(rows: DataFrame, key: str) -> dict[str, int]:
    return {row[key]: row["count"] for row in rows.groupBy(key).count().collect()}


def _finish(runs: Runs, strict: bool) -> Runs:
    if strict:
        raise_failures(runs)
    return runs


@contextmanager
def _claimed(
    lake: Lake, runs: Runs, names: Callable[[str], list[str]] = lambda period: [period]
) -> Iterator[dict[str, list[Claim]]]:
    """Claim what every period works on; a period that another run works on fails.

    Yields the claims of the periods that may go on.
    """
    wanted = {period: names(period) for period, run in runs.items() if not run.error}
    flat = {name for some in wanted.values() for name in some}
    with lake.claims.hold(flat, lake.claim_seconds, lake.claim_wait) as held:
        for period, some in wanted.items():
            if taken := [name for name in some if name not in held]:
                holder = lake.claims.holder(taken[0])
                runs[period].error = f"{taken[0]} is claimed by {holder.owner if holder else 'another run'}"
        yield {p: [held[n] for n in some] for p, some in wanted.items() if not runs[p].error}


def _still_held(lake: Lake, claims: dict[str, list[Claim]], runs: Runs, periods: Iterable[str]) -> list[str]:
    """The periods whose claims did not run out; the others fail before anything of them shows."""
    kept = []
    for period in periods:
        if all(lake.claims.is_held(claim) for claim in claims[period]):
            kept.append(period)
        else:
            runs[period].error = f"the claim on {period} ran out, run it again"
    return kept


def _log_verdicts(lake: Lake, rows: list[tuple[str, str, str, str | None]]) -> None:
    """Append (month, load_id, status, message) to the verdicts."""
    if rows:
        first = time.time_ns()
        frame = lake.spark.createDataFrame(
            [(*row, first + i, None) for i, row in enumerate(rows)], VERDICT_SCHEMA)
        lake.append(frame.withColumn("decided_at", F.current_timestamp()), "ops/month_verdicts")


# ---- split ---------------------------------------------------------------

def split_log(lake: Lake, source: str, landing: str, partitions: int | None = None) -> DataFrame:
    """Split unsplit log files into month folders of the landing area; returns lines by month.

    Only the months of the source are replaced. A month that already lies there as a plain
    file is refused before anything is written. The text is read twice: once for the month
    carried into each split, with the set of months, and once for the write, which counts.
    """
    with lake.working() as keep, sized_for(lake.spark, L.text_bytes(lake.spark, source)):
        lines = L.read_log_lines(lake.spark, source)
        dates = S.Tally(dated_month(F.col("value")))
        carried = keep(S.carried_months(dates.watch(lines)), "carried")
        months = dates.counts()
        if months is None:
            counts = keep(S.split_counts(S.split_by_month(lines, carried)), "counts")
            months = {row["month"]: row["line_count"] for row in counts.collect()}
        taken = sorted(
            m for m, one in _landed(lake, landing).items()
            if m in months and any(path.endswith(one.file_name) for path in one.paths))
        if taken:
            raise ValueError(f"already in the landing folder as a file: {', '.join(taken)}")
        width = partitions or int(lake.spark.conf.get("spark.sql.shuffle.partitions"))
        ordered = S.split_in_file_order(lines, width, carried, S.SplitOrder.of(carried))
        written = S.Tally(F.col("month"))
        L.write_month_files(written.watch(ordered), landing)
        counted = written.counts() or months
        return lake.spark.createDataFrame(sorted(counted.items()), "month string, line_count bigint")


def _landed(lake: Lake, landing: str) -> dict[str, L.Landed]:
    return L.landed_months(lake.spark, landing) if lake.exists(landing) else {}


def write_replay(lake: Lake, source: str, target: str, copies: int) -> None:
    """Volume data from a sample log: all copies of a line follow it, in the order of the log."""
    lines = L.read_log_lines(lake.spark, source)
    partitions = max(1, -(-L.text_bytes(lake.spark, source) * copies // BYTES_PER_SHUFFLE_TASK))
    order = ("file_name", "split", "line_id")
    replicas = replicate_lines(lines, copies, partitions, order)
    replicas.select("value").write.option("lineSep", "\n").text(target)


# ---- ingest --------------------------------------------------------------

def _landing_lines(lake: Lake, landed: Iterable[L.Landed]) -> DataFrame:
    """Lines of the given months only; other files of the landing folder are not touched."""
    paths = [path for one in landed for path in one.paths]
    return L.read_log_lines(lake.spark, *paths, landing=True)


def inspect_landing(
    lake: Lake, landed: Sequence[L.Landed], splits: DataFrame, check_lines: int = FORMAT_CHECK_LINES
) -> DataFrame:
    """file_name, line_count, size_bytes, valid_share, sha256 of landing files, from stored splits.

    ``sha256`` is the hash of a fingerprint of line count, line contents and line order: the
    same lines have the same one at any size, as one file or as part files. Lines are read
    again only for files whose first split does not hold the first ``check_lines`` lines.
    """
    inspected = S.files_from_splits(splits, check_lines)
    open_ = {row["file_name"] for row in inspected.filter("starts is null").select("file_name").collect()}
    if open_:
        again = _landing_lines(lake, [one for one in landed if one.file_name in open_])
        numbered = S.head_starts(again, splits.filter(F.col("file_name").isin(sorted(open_))), check_lines)
        inspected = inspected.join(
            numbered.withColumnRenamed("starts", "numbered"), "file_name", "left"
        ).withColumn("starts", F.coalesce("starts", "numbered"))
    return L.landing_files(lake.spark, landed).join(inspected, "file_name", "left").select(
        "file_name",
        F.coalesce("line_count", F.lit(0).cast("bigint")).alias("line_count"),
        "size_bytes",
        F.coalesce(S.valid_share(check_lines), F.lit(0.0)).alias("valid_share"),
        F.sha2(F.coalesce("fingerprint", F.lit("empty")), 256).alias("sha256"),
    )


def ingest(
    lake: Lake, landing: str, months: Iterable[str], *, strict: bool = True,
    check_lines: int = FORMAT_CHECK_LINES, keep_order: bool = True,
) -> Runs:
    """Inspect, decide, copy accepted files to the raw zone, check the copy, record it.

    The months are claimed before the manifest is read, so of two runs that ingest a month at
    the same time one stores it and the other fails, or waits and finds it stored.
    A month that lies in the landing folder both as a file and as a folder is refused. Part
    files of the raw zone and their lines are in the order of the landing lines; this takes
    one exchange of the text, which ``keep_order=False`` saves.
    """
    wanted = _distinct(months, P.require_month)
    with audited(lake, "ingest", wanted) as runs, _claimed(lake, runs) as claims, lake.working() as keep:
        there = {m: one for m, one in _landed(lake, landing).items() if m in claims}
        clear = [one for one in there.values() if not one.ambiguous]
        for month, one in there.items():
            if one.ambiguous:
                runs[month].error = f"{one.file_name} is there as a file and as a folder"
        requests = lake.spark.createDataFrame(
            [(m,) for m in claims if not runs[m].error], "month string")
        splits = keep(_splits(lake, clear, check_lines), "file_splits")
        inspected = inspect_landing(lake, clear, splits, check_lines)
        decisions = I.ingest_decisions(requests, inspected, lake.manifest()).collect()
        new = [d for d in decisions if d["status"] == "ingested"]
        stored = [there[d["month"]] for d in new]
        incomplete = _store(lake, stored, splits, keep_order) if new else set()
        whole = [d["month"] for d in new if d["month"] not in incomplete]
        recorded = set(_still_held(lake, claims, runs, whole))
        if recorded:
            rows = lake.spark.createDataFrame([d for d in new if d["month"] in recorded], DECISION_SCHEMA)
            lake.append(I.new_manifest_rows(rows, lake.path("raw")), "ops/ingested_files")
        for decision in decisions:
            run = runs[decision["month"]]
            if run.error:
                continue
            if decision["status"] not in I.ACCEPTED:
                run.error = f"{decision['code']} {decision['status']}: {decision['file_name']}"
            elif decision["month"] in incomplete:
                run.error = f"copy of {decision['file_name']} is incomplete"
            else:
                run.rows_in = run.rows_out = decision["line_count"]
                run.message = decision["status"]
    return _finish(runs, strict)


def _splits(lake: Lake, landed: Sequence[L.Landed], check_lines: int) -> DataFrame:
    """Counts and sums of every split of the months' files: one row per split, one text scan."""
    if landed:
        lines = _landing_lines(lake, landed)
    else:
        lines = lake.spark.createDataFrame(
            [], "file_name string, split struct<part: string, start: bigint>, line_id bigint, value string")
    return S.place_splits(S.split_sums(lines, check_lines, S.line_digest))


def _store(
    lake: Lake, landed: Sequence[L.Landed], splits: DataFrame, keep_order: bool = True
) -> set[str]:
    """Copy the months' lines to the raw zone; returns the months whose copy differs.

    The copy is read back and compared with the sums of the inspection.
    """
    month = P.month_of_landing_name(F.col("file_name")).alias("month")
    lines = _landing_lines(lake, landed).select("*", month)
    months = [one.month for one in landed]
    placed = splits.filter(F.col("file_name").isin([one.file_name for one in landed]))
    with sized_for(lake.spark, sum(one.size_bytes for one in landed)):
        if keep_order and (order := S.SplitOrder.of(placed)) is not None:
            width = int(lake.spark.conf.get("spark.sql.shuffle.partitions"))
            lines = order.arrange(lines, width).sortWithinPartitions("month", "split", "line_id")
        elif keep_order:
            lines = lines.repartitionByRange("month", "split").sortWithinPartitions("month", "split", "line_id")
        lake.write_raw(lines)
    given = S.content_by_file(splits).select(month, "lines", "low", "high")
    stored = S.content_by_month(lake.raw_copied(months))
    same = {row["month"] for row in given.intersect(stored).collect()}
    return set(months) - same


def landing_status(lake: Lake, landing: str) -> DataFrame:
    landed = _landed(lake, landing).values()
    return I.landing_status(L.landing_files(lake.spark, landed), lake.manifest())


# ---- clean ---------------------------------------------------------------

def clean_months(lake: Lake, months: Iterable[str], *, strict: bool = True) -> Runs:
    """Raw text -> clean events of the processed zone, one job for all months.

    A load that is being written is pending in the verdicts, until the gate has judged it.
    """
    wanted = _distinct(months, P.require_month)
    with audited(lake, "clean", wanted) as runs, _claimed(lake, runs) as claims:
        counted = {row["month"]: row for row in C.count_lines(lake.raw(list(claims))).collect()}
        rows_in = {month: row["count"] for month, row in counted.items()}
        for month in claims:
            runs[month].rows_in = rows_in.get(month)
            if month not in rows_in:
                runs[month].error = f"{month} is not in the raw zone"
        present = [m for m in claims if m in rows_in]
        if present:
            for month in present:
                runs[month].load_id = uuid.uuid4().hex
            _log_verdicts(lake, [(m, runs[m].load_id, V.PENDING, None) for m in present])
            sizes = lake.month_bytes(present)
            tasks = {m: max(1, -(-sizes.get(m, 0) // BYTES_PER_SHUFFLE_TASK)) for m in present}
            hot = tuple(h for m in present for h in counted[m]["hot"] or ())
            events = C.clean(lake.raw(present), C.MonthTasks(tasks, hot) if len(present) > 1 else None)
            with sized_for(lake.spark, lake.raw_bytes(present)):
                lake.write_processed(events, present)
            rows_out = _counts(lake.processed(present), "month")
            for month in _still_held(lake, claims, runs, present):
                runs[month].rows_out = rows_out.get(month, 0)
    return _finish(runs, strict)


def check_quality(
    lake: Lake, cleaned: Runs, *, strict: bool = True, max_drop_rate: float = MAX_DROP_RATE
) -> Runs:
    """Fail months that lost too many lines. Only the small counts of ``clean_months`` are used.

    The verdict on each load is stored: it decides which quarters are complete.
    """
    counted = {m: r for m, r in cleaned.items() if r.rows_out is not None}
    with audited(lake, "quality_check", sorted(counted)) as runs:
        counts = lake.spark.createDataFrame(
            [(m, r.rows_in, r.rows_out) for m, r in counted.items()],
            "month string, raw_lines bigint, clean_rows bigint",
        )
        for verdict in Q.quality_gate(counts, max_drop_rate).collect():
            run = runs[verdict["month"]]
            run.rows_in, run.rows_out = verdict["raw_lines"], verdict["clean_rows"]
            if verdict["status"] == "failed":
                run.error = verdict["message"]
            else:
                run.message = verdict["message"]
        _log_verdicts(lake, [
            (m, counted[m].load_id or uuid.uuid4().hex, V.FAILED if run.error else V.PASSED, run.error or run.message)
            for m, run in runs.items()])
    return _finish(runs, strict)


# ---- aggregate -----------------------------------------------------------

def _gaps(
    lake: Lake, quarters: Sequence[str], first_month: str | None, last_month: str | None,
    built: DataFrame | None = None,
) -> dict[str, str]:
    """For each quarter that is not complete, which months are missing and why."""
    asked = lake.spark.createDataFrame([(q,) for q in quarters], "quarter string")
    current = V.current_verdicts(lake.verdicts())
    missing: dict[str, list[str]] = {}
    for row in V.quarter_gaps(asked, current, first_month or lake.first_month(), last_month, built).orderBy("month").collect():
        missing.setdefault(row["quarter"], []).append(f"{row['month']} {row['reason']}")
    return {quarter: "; ".join(months) for quarter, months in missing.items()}


def aggregate_quarters(
    lake: Lake, quarters: Iterable[str], *, strict: bool = True, first_month: str | None = None,
    last_month: str | None = None, allow_incomplete: bool = False,
) -> Runs:
    """Processed events -> hourly features of the curated zone, one job for all quarters.

    Only months whose newest load passed the gate are used. A quarter with another month is
    refused, unless ``allow_incomplete`` asks for it; the audit says which months are missing
    and why. Months before ``first_month`` (by default the first month of the lake) or after
    ``last_month`` are not asked for.
    """
    wanted = _distinct(quarters, P.require_quarter)
    with audited(lake, "aggregate", wanted) as runs, _claimed(lake, runs, lambda q: [q, *P.month_names(q)]) as claims:
        months = [m for q in claims for m in P.month_names(q)]
        passed = {
            row["month"]: row["load_id"] for row in V.current_verdicts(lake.verdicts())
            .filter(F.col("month").isin(months) & (F.col("status") == V.PASSED)).collect()}
        by_month = _counts(lake.processed(list(passed)), "month")
        gaps = _gaps(lake, list(claims), first_month, last_month)
        for quarter in claims:
            run = runs[quarter]
            run.rows_in = sum(by_month.get(m, 0) for m in P.month_names(quarter))
            if quarter in gaps and not allow_incomplete:
                run.error = f"{quarter} is not complete: {gaps[quarter]}"
            elif run.rows_in == 0:
                run.error = f"no processed data for {quarter}, run its months first"
            elif quarter in gaps:
                run.message = f"without {gaps[quarter]}"
        present = [q for q in claims if not runs[q].error]
        if present:
            used = [m for q in present for m in P.month_names(q) if m in passed]
            features = H.hourly_features(lake.processed(used), lake.measure_type)
            with sized_for(lake.spark, lake.raw_bytes(used)):
                lake.write_curated(features, present)
            rows_out = _counts(lake.curated(present), "quarter")
            kept = _still_held(lake, claims, runs, present)
            build, first = uuid.uuid4().hex, time.time_ns()
            rows = [(q, build, m, passed[m], first) for q in kept for m in P.month_names(q) if m in passed]
            if rows:
                lake.append(lake.spark.createDataFrame(rows, BUILD_SCHEMA), "ops/quarter_builds")
            for quarter in kept:
                runs[quarter].rows_out = rows_out.get(quarter, 0)
    return _finish(runs, strict)


# ---- deliver -------------------------------------------------------------

def deliver_quarters(
    lake: Lake, quarters: Iterable[str], *, strict: bool = True, load_id: str | None = None,
    first_month: str | None = None, last_month: str | None = None, allow_incomplete: bool = False,
) -> Runs:
    """Load curated features for readers; a quarter becomes visible as a whole or not at all.

    The rows are written under a new load id that nobody reads. Only after the counts and the
    constraints hold, one publish row per quarter switches readers over. A quarter is refused
    if its curated rows are not made from the newest, passed load of each of its months; the
    last three arguments are those of ``aggregate_quarters``.
    """
    wanted = _distinct(quarters, P.require_quarter)
    load_id = load_id or uuid.uuid4().hex
    with audited(lake, "deliver", wanted) as runs, _claimed(lake, runs) as claims:
        asked = list(claims)
        curated = lake.curated(asked)
        lake.add_load(D.delivery_rows(curated, load_id))
        loaded = lake.loads().filter(
            F.col("quarter").isin(asked) & (F.col("load_id") == load_id)
        )
        rows_in, rows_out = _counts(curated, "quarter"), _counts(loaded, "quarter")
        broken = {
            row["quarter"]: row["rule"] for row in Q.feature_violations(loaded, by="quarter")
            .filter(F.col("violations") > 0).collect()
        }
        gaps = {} if allow_incomplete else _gaps(
            lake, asked, first_month, last_month, V.newest_builds(lake.builds()))
        for quarter in asked:
            run = runs[quarter]
            run.rows_in, run.rows_out = rows_in.get(quarter, 0), rows_out.get(quarter, 0)
            if not run.rows_in:
                run.error = f"no curated rows for {quarter}, aggregate it first"
            elif run.rows_in != run.rows_out:
                run.error = f"{run.rows_out} rows loaded, {run.rows_in} in the curated zone"
            elif quarter in broken:
                run.error = f"constraint violated: {broken[quarter]}"
            elif quarter in gaps:
                run.error = f"{quarter} is not complete: {gaps[quarter]}"
        kept = _still_held(lake, claims, runs, [q for q in asked if not runs[q].error])
        if kept:
            rows = lake.spark.createDataFrame(
                [(q, load_id, runs[q].rows_out) for q in kept], "quarter string, load_id string, row_count bigint"
            ).withColumn("published_at", F.current_timestamp())
            lake.append(rows, "serving/published")
    return _finish(runs, strict)


# ---- whole runs ----------------------------------------------------------

def ready_quarters(passed: Iterable[str], last_month: str | None = None) -> list[str]:
    """Quarters whose closing month, or the last month of all data, has passed the gate.

    Without ``last_month`` more data may follow, so only closing months count.
    """
    return sorted({
        P.quarter_name(m) for m in passed if P.closes_quarter(m) or m == last_month
    })


def backfill(
    lake: Lake, landing: str, months: Iterable[str], last_month: str | None = None,
    check_lines: int = FORMAT_CHECK_LINES, *, first_month: str | None = None, allow_incomplete: bool = False,
) -> dict[str, Runs]:
    """Ingest, clean and check all months, then aggregate and deliver the complete quarters.

    A month that fails a step is left out of the following steps, the others go on. A quarter
    of these months is tried once its closing month has passed the gate, now or earlier; name
    ``last_month`` where the data ends inside a quarter. It is published only if all its
    months have passed, from ``first_month`` on: the first month of the lake or of the landing
    folder, if none is given. ``allow_incomplete`` publishes it without the missing months.
    The outcome of every step and period is returned and in the audit trail.
    """
    wanted = _distinct(months, P.require_month)
    done: dict[str, Runs] = {}
    done["ingest"] = ingest(lake, landing, wanted, strict=False, check_lines=check_lines)
    done["clean"] = clean_months(lake, succeeded(done["ingest"]), strict=False)
    done["quality_check"] = check_quality(lake, done["clean"], strict=False)
    known = [m for m in (first_month or lake.first_month(), *([] if first_month else _landed(lake, landing))) if m]
    bounds = {"first_month": min(known, default=None), "last_month": last_month, "allow_incomplete": allow_incomplete}
    passed = succeeded(done["quality_check"])
    touched = {P.quarter_name(m) for m in passed}
    ever = [
        row["month"] for row in V.current_verdicts(lake.verdicts()).filter(F.col("status") == V.PASSED)
        .filter(F.col("month").isin([m for q in touched for m in P.month_names(q)])).collect()]
    quarters = [q for q in ready_quarters(ever, last_month) if q in touched]
    done["aggregate"] = aggregate_quarters(lake, quarters, strict=False, **bounds)
    done["deliver"] = deliver_quarters(lake, succeeded(done["aggregate"]), strict=False, **bounds)
    return done


# ---- upkeep --------------------------------------------------------------

def remove_old_loads(lake: Lake, grace_seconds: float = 7 * 24 * 3600) -> list[tuple[str, str]]:
    """Remove the folders of loads that nobody can still be reading; returns (quarter, load_id).

    A load goes when it was superseded longer than the grace time ago, or was never published
    and its folder is that old. No row is read: the publish log and the listing of the folders
    tell everything. Each quarter is claimed, so no delivery is on its way, and the log is
    read again under the claim. Quarters that another run holds are left for the next time.
    """
    removed = []
    quarters = sorted({quarter for quarter, _ in lake.load_folders()} - {"none"})
    with lake.claims.hold(quarters, lake.claim_seconds) as held:
        published = lake.published()
        current = {(r["quarter"], r["load_id"]) for r in D.current_loads(published).collect()}
        ended = {
            (r["quarter"], r["load_id"]): r["superseded_at"].timestamp()
            for r in D.superseded_loads(published).collect() if r["superseded_at"] is not None}
        for load, folder in sorted(lake.load_folders().items()):
            if load[0] not in held or load in current:
                continue
            since = max(ended.get(load, 0.0), folder.modified)
            if time.time() - since >= grace_seconds and lake.claims.is_held(held[load[0]]):
                files.remove(lake.spark, folder.path)
                removed.append(load)
    return removed


#: Tables that grow by one file with every step.
LOGS = {
    "ops/ingested_files": MANIFEST_SCHEMA, "ops/pipeline_runs": AUDIT_SCHEMA,
    "ops/month_verdicts": VERDICT_SCHEMA, "ops/quarter_builds": BUILD_SCHEMA,
    "serving/published": PUBLISH_SCHEMA,
}


def compact_logs(lake: Lake) -> dict[str, int]:
    """Rewrite the operational tables into few files; returns how many files each one had."""
    return {folder: lake.compact(folder, schema) for folder, schema in LOGS.items()}
