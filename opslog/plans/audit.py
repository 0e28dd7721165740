"""One audit row per step and period, whether the step succeeds or fails."""

from __future__ import annotations

import os
import time
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone

from opslog.fixed import AUDIT_SCHEMA, column_names
from opslog.operators.reports import audit_rows
from opslog.sources.lake import Lake

RUN_ID_VARIABLE = "OPSLOG_RUN_ID"


class StepFailed(RuntimeError):
    """At least one period of a step failed; ``runs`` has the outcome of all of them."""

    def __init__(self, runs: Sequence[StepRun]):
        self.runs = list(runs)
        super().__init__("; ".join(f"{r.step} {r.period}: {r.error}" for r in runs if r.error))


@dataclass
class StepRun:
    step: str
    period: str
    rows_in: int | None = None
    rows_out: int | None = None
    message: str | None = None
    error: str | None = None
    load_id: str | None = None

    @property
    def status(self) -> str:
        return "failed" if self.error else "success"


@contextmanager
def audited(lake: Lake, step: str, periods: Sequence[str]) -> Iterator[dict[str, StepRun]]:
    """Yield one open run per period and append all of them to the audit trail at the end.

    A single period fails by setting ``error``; an exception fails all periods that have not
    failed on their own, and is raised again. Counts set before a failure are kept.
    """
    runs = {period: StepRun(step, period) for period in periods}
    started = datetime.now(timezone.utc)
    try:
        yield runs
    except Exception as cause:
        for run in runs.values():
            run.error = run.error or str(cause) or type(cause).__name__
        raise
    finally:
        _append(lake, list(runs.values()), started)


def _append(lake: Lake, runs: list[StepRun], started: datetime) -> None:
    if not runs:
        return
    finished = datetime.now(timezone.utc)
    first_id = time.time_ns()  # grows from run to run and is the last sort key of the reports
    rows = [
        (first_id + i, run.step, run.period, os.environ.get(RUN_ID_VARIABLE), run.rows_in,
         run.rows_out, None, run.status, run.error or run.message, started, finished)
        for i, run in enumerate(runs)
    ]
    frame = audit_rows(lake.spark.createDataFrame(rows, AUDIT_SCHEMA))
    lake.append(frame.select(*column_names(AUDIT_SCHEMA)), "ops/pipeline_runs")


def succeeded(runs: dict[str, StepRun]) -> list[str]:
    return [period for period, run in runs.items() if not run.error]


def raise_failures(runs: dict[str, StepRun]) -> None:
    if len(succeeded(runs)) < len(runs):
        raise StepFailed(list(runs.values()))
