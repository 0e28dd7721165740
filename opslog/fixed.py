"""Patterns, formats, word lists and limits that decide the results.

They are data, not design. Changing one changes what the pipeline returns.
"""

# ---- raw log line -------------------------------------------------------
LINE_PATTERN = (
    r"^(\S+) (\d+) (\d{4}\.\d{2}\.\d{2}) (\S+) "
    r"(\d{4}-\d{2}-\d{2}-\d{2}\.\d{2}\.\d{2}\.\d{6}) (\S+) (\S+) (\S+) (\S+) ?(.*)$"
)
LINE_FIELDS = (
    "alert_label", "unix_ts", "log_date", "node", "event_ts_raw",
    "node_repeat", "event_type", "component", "level", "message",
)
# Weaker test of the first three fields, used before a file is accepted and when it is split.
LINE_START_PATTERN = r"^\S+ \d+ (\d{4})\.(\d{2})\.\d{2} "
EVENT_TS_PATTERN = r"\d{4}-\d{2}-\d{2}-\d{2}\.\d{2}\.\d{2}\.\d{6}"
EVENT_TS_LENGTH = 26
NO_ALERT = "-"

# ---- locations and message text ----------------------------------------
RACK_PATTERN = r"^(R\d\d)"
MIDPLANE_PATTERN = r"^(R\d\d-M\d)"
UNKNOWN_LOCATION = "UNKNOWN"
EMAIL_PATTERN, EMAIL_MASK = r"[\w.+-]+@[\w-]+\.[\w.]+", "<EMAIL>"
IP_PATTERN, IP_MASK = r"\b\d{1,3}(\.\d{1,3}){3}\b", "<IP>"
HEX_PATTERN, HEX_MASK = r"0x[0-9a-fA-F]+", "<HEX>"
NUMBER_PATTERN, NUMBER_MASK = r"\d+", "<NUM>"

# ---- hourly measures ----------------------------------------------------
LEVEL_GROUPS = {
    "events_info": ("INFO",),
    "events_warning": ("WARNING",),
    "events_error": ("ERROR", "SEVERE"),
    "events_fatal": ("FATAL", "FAILURE"),
}
COMPONENT_MEASURES = {"kernel_events": "KERNEL", "app_events": "APP"}

# ---- periods and files --------------------------------------------------
MONTH_PATTERN = r"\d{4}-(0[1-9]|1[0-2])"
QUARTER_PATTERN = r"\d{4}Q[1-4]"
LANDING_NAME = "BGL_%s.log"

# ---- limits -------------------------------------------------------------
FORMAT_CHECK_LINES = 10_000
MIN_VALID_SHARE = 0.95
MAX_DROP_RATE = 0.01
MESSAGE_LENGTH = 500
RECENT_RUNS = 25
TOP_MIDPLANES = 15

# ---- texts of the gate --------------------------------------------------
NO_VALID_LINES = "%s: no valid lines after cleaning"
TOO_MANY_DROPPED = "%s: %s of lines dropped (limit %s)"
DROP_RATE = "drop rate %s"

# ---- audit vocabulary ---------------------------------------------------
STEPS = ("ingest", "clean", "quality_check", "aggregate", "deliver")
STATUSES = ("success", "failed")
STATUS_LABELS = {"success": "✅ success", "failed": "❌ failed"}
NO_STATUS_LABEL = "–"

# ---- table schemas ------------------------------------------------------
EVENT_SCHEMA = (
    "event_time timestamp_ntz, node string, rack string, midplane string, event_type string, "
    "component string, level string, is_alert boolean, alert_category string, message string, "
    "template string"
)
FEATURE_SCHEMA = (
    "quarter string, midplane string, hour_start timestamp_ntz, events_total int, events_info int, "
    "events_warning int, events_error int, events_fatal int, kernel_events int, app_events int, "
    "distinct_templates int, alerts int, alert_next_hour boolean"
)
MANIFEST_SCHEMA = (
    "file_name string, month string, sha256 string, line_count bigint, size_bytes bigint, "
    "hdfs_path string, ingested_at timestamp"
)
AUDIT_SCHEMA = (
    "run_id bigint, step string, period string, airflow_run_id string, rows_in bigint, "
    "rows_out bigint, rows_dropped bigint, status string, message string, started_at timestamp, "
    "finished_at timestamp"
)
PUBLISH_SCHEMA = "quarter string, load_id string, row_count bigint, published_at timestamp"
# Own tables: what became of each load of a processed month, and what curated quarters are made of.
VERDICT_SCHEMA = (
    "month string, load_id string, status string, message string, sequence bigint, decided_at timestamp"
)
BUILD_SCHEMA = "quarter string, build_id string, month string, load_id string, sequence bigint"
VERDICTS = ("pending", "passed", "failed")


def column_names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(",")]


EVENT_COLUMNS = column_names(EVENT_SCHEMA)
FEATURE_COLUMNS = column_names(FEATURE_SCHEMA)
