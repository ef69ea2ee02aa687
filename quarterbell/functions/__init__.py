from quarterbell.functions.sampletime import (
    SAMPLE_TIME_PATTERN,
    SENTINEL_MILLIS,
    day_of,
    event_time,
    hour_of,
    is_present,
    is_valid_sample_time,
    run_date,
    table_time,
    time_text,
)

__all__ = [
    "SAMPLE_TIME_PATTERN",
    "SENTINEL_MILLIS",
    "day_of",
    "event_time",
    "hour_of",
    "is_present",
    "is_valid_sample_time",
    "run_date",
    "table_time",
    "time_text",
]
