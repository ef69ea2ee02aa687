from quarterbell.plans.jobs import (
    JOBS,
    KIND,
    Job,
    Messages,
    commit_replay,
    flat_one_pass,
    flat_quarantine,
    flat_rows,
    groups_of,
    hourly_one_pass,
    hourly_quarantine,
    hourly_rows,
    hourly_rows_sql,
    quarter_hour_quarantine,
    quarter_hour_rows,
    register_source,
    replay_job,
)

__all__ = [
    "JOBS",
    "KIND",
    "Job",
    "Messages",
    "commit_replay",
    "flat_one_pass",
    "flat_quarantine",
    "flat_rows",
    "groups_of",
    "hourly_one_pass",
    "hourly_quarantine",
    "hourly_rows",
    "hourly_rows_sql",
    "quarter_hour_quarantine",
    "quarter_hour_rows",
    "register_source",
    "replay_job",
]
