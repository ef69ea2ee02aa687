from quarterbell.sinks.commit import (
    DAILY_COMMIT,
    HOURLY_COMMIT,
    CommitRule,
    carry_out,
    commit_pages,
    commit_pending,
    committable_partitions,
    partition_time,
    pending_partitions,
    seen_partitions,
    written_partitions,
)
from quarterbell.sinks.publish import drop_superseded, publish_pages, publish_pending, published
from quarterbell.sinks.runs import attempt_folder, attempts_that_count, new_attempt, point_run, read_runs, register_attempt
from quarterbell.sinks.tables import (
    append_files,
    append_table,
    create_table,
    has_stream_log,
    list_tables,
    read_files,
    spread,
    use_database,
)

__all__ = [
    "CommitRule",
    "DAILY_COMMIT",
    "HOURLY_COMMIT",
    "append_files",
    "append_table",
    "attempt_folder",
    "attempts_that_count",
    "carry_out",
    "commit_pages",
    "commit_pending",
    "committable_partitions",
    "create_table",
    "drop_superseded",
    "has_stream_log",
    "list_tables",
    "new_attempt",
    "partition_time",
    "pending_partitions",
    "point_run",
    "publish_pages",
    "publish_pending",
    "published",
    "read_files",
    "read_runs",
    "register_attempt",
    "seen_partitions",
    "spread",
    "use_database",
    "written_partitions",
]
