"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query is run to the end with a no-op writer. The time of a query is the smaller of two
runs, so that compiling generated code is not measured. ``replay`` runs cleaning and hourly
features over about 4.8 million replicated lines (at sf0.1).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from opslog.operators.clean import clean  # noqa: E402
from opslog.operators.features import hourly_features  # noqa: E402
from opslog.operators.replicate import replicate_lines  # noqa: E402
from opslog.plans.registry import QUERIES  # noqa: E402
from opslog.plans.table_lines import event_lines  # noqa: E402
from opslog.session import build_session  # noqa: E402

HEADLINE = (
    "parse_lines", "clean", "clean_months", "mask_pii", "log_template", "hourly_features",
    "quarterly_features", "alert_next_hour", "quality_gate",
    "split_by_month", "inspect_files", "ingest_decisions", "deliver", "replicate_lines",
    "latest_runs", "status_grid", "lines_per_month", "midplane_ranking", "latest_quarter",
)
COPIES = 47


def replay(spark, sf_dir):
    source = event_lines(spark, sf_dir).select("month", "value")
    lines = replicate_lines(source, COPIES, partitions=4 * spark.sparkContext.defaultParallelism)
    return hourly_features(clean(lines))


def timed(query, spark, sf_dir: str) -> float:
    started = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "opslog-bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": "12g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        seconds[name] = round(min(timed(QUERIES[name], spark, sf_dir) for _ in range(2)), 3)
    seconds["replay"] = round(timed(replay, spark, sf_dir), 3)
    spark.stop()
    print(json.dumps({
        "metric": "opslog_headline_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
