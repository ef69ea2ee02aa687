from quarterbell.streaming.late import collect_late, finished_batches, late_rows
from quarterbell.streaming.run import (
    LateRows,
    append_stream,
    both_kinds,
    commit_while_running,
    dropped_late,
    preview_stream,
    start_job,
    start_one_pass,
    watermark_of,
)

__all__ = [
    "LateRows",
    "append_stream",
    "both_kinds",
    "collect_late",
    "commit_while_running",
    "dropped_late",
    "finished_batches",
    "late_rows",
    "preview_stream",
    "start_job",
    "start_one_pass",
    "watermark_of",
]
