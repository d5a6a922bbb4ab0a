"""Reading, loading and unloading of files."""

from .files import (
    add_columns,
    create_from_schema,
    file_inventory,
    scan_csv,
    scan_json_payload_csv,
    scan_parquet,
    table,
    typed,
    write_table,
)
from .inference import diff_reports, inferred_schema, merged_report, payload_shape, schema_by_file, schema_report
from .loading import evolve_append, load_by_name, load_positional
from .unload import (
    load_calendar,
    mark_done,
    next_day,
    pending_days,
    reset_days,
    unload_by_date,
    unload_status,
)

__all__ = [
    "add_columns",
    "create_from_schema",
    "diff_reports",
    "evolve_append",
    "file_inventory",
    "inferred_schema",
    "load_by_name",
    "load_calendar",
    "load_positional",
    "mark_done",
    "merged_report",
    "next_day",
    "payload_shape",
    "pending_days",
    "reset_days",
    "scan_csv",
    "scan_json_payload_csv",
    "scan_parquet",
    "schema_by_file",
    "schema_report",
    "table",
    "typed",
    "unload_by_date",
    "unload_status",
    "write_table",
]
