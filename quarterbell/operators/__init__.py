from quarterbell.operators.decode import all_records, all_table_records, quarantine, readings, table_quarantine, table_rows
from quarterbell.operators.lateness import late_readings, on_time_readings
from quarterbell.operators.project import table_columns, with_day, with_hour, with_run_date
from quarterbell.operators.windows import (
    in_windows,
    newest_per_window,
    snap_to_window,
    time_neat,
    with_event_time,
    with_watermark,
)

__all__ = [
    "all_records",
    "all_table_records",
    "in_windows",
    "late_readings",
    "newest_per_window",
    "on_time_readings",
    "quarantine",
    "readings",
    "snap_to_window",
    "table_columns",
    "table_quarantine",
    "table_rows",
    "time_neat",
    "with_day",
    "with_event_time",
    "with_hour",
    "with_run_date",
    "with_watermark",
]
