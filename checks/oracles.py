"""The same queries in SQL, written against the given tables alone."""

from __future__ import annotations

from quarterbell.functions import SAMPLE_TIME_PATTERN, SENTINEL_MILLIS

# One common table expression after the other; each query takes what it needs.
_READINGS = """
ruled AS (
    SELECT *, CASE
        WHEN event_id % 97 = 0 THEN 97
        WHEN event_id % 101 = 0 THEN 101
        WHEN event_id % 103 = 0 THEN 103
        WHEN event_id % 107 = 0 THEN 107
        WHEN event_id % 109 = 0 THEN 109
        WHEN event_id % 113 = 0 THEN 113
        ELSE 0 END AS rule
    FROM events
),
named AS (
    SELECT event_id AS seq,
           CAST(user_id % 4 AS INTEGER) AS source_partition,
           CAST(user_id % 10 AS VARCHAR) AS measurepointid,
           event_type AS measuretag,
           value, rule,
           substring(CAST(ts AS VARCHAR), 1, 19) AS clean_time,
           CASE rule
               WHEN 97 THEN ''
               WHEN 101 THEN '2023-02-29 00:00:00'
               WHEN 113 THEN substring(CAST(ts - INTERVAL 40 MINUTE AS VARCHAR), 1, 19)
               ELSE substring(CAST(ts AS VARCHAR), 1, 19) END AS dirty_time
    FROM ruled
)"""


def _stamped(time: str, where: str = "TRUE") -> str:
    """Readings with their event time, window start and window end."""
    return f"""{_READINGS},
stamped AS (
    SELECT seq, source_partition, measurepointid, measuretag, value, {time} AS sampletime,
           CASE WHEN regexp_full_match({time}, '{SAMPLE_TIME_PATTERN}')
                THEN epoch_ms(TRY_CAST({time} AS TIMESTAMP)) ELSE {SENTINEL_MILLIS} END AS ms
    FROM named WHERE {where}
),
windowed AS (
    SELECT *, ms - ms % 900000 AS w, ms - ms % 900000 + 900000 AS w_end FROM stamped
)"""


def _text(ms: str) -> str:
    return f"strftime(make_timestamp_ms({ms}), '%Y-%m-%d %H:%M:%S')"


_NEWEST = """
newest AS (
    SELECT * FROM (
        SELECT *, row_number() OVER (
            PARTITION BY measurepointid, measuretag, w ORDER BY ms DESC, seq) AS place
        FROM {source}
    ) WHERE place = 1
)"""

_NEAT = f"""
    SELECT measurepointid, measuretag, CAST(value AS DECIMAL(30, 8)) AS value1,
           CASE WHEN ms - w <= 450000 THEN {_text('w')} ELSE {_text('w_end')} END AS sampletime
    FROM newest"""


def _neat(stamped: str, source: str = "windowed", extra: str = "") -> str:
    return f"WITH {stamped}{extra}, {_NEWEST.format(source=source)} {_NEAT}"


# The running maximum, row by row, that the engine itself never computes.
_LATE = """,
audited AS (
    SELECT *, coalesce(max(ms) OVER (
        PARTITION BY source_partition ORDER BY seq
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 120000 >= w_end, FALSE) AS late
    FROM windowed
),
on_time AS (SELECT * FROM audited WHERE NOT late)"""

# Four micro-batches; a row is dropped if the batches before the previous one had closed its window.
_IN_BATCHES = """,
placed AS (
    SELECT *, seq * 4 // (SELECT count(*) FROM events) AS batch FROM windowed
),
batches AS (
    SELECT batch, max(max(ms)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) - 120000 AS closed
    FROM placed GROUP BY batch
),
judged AS (SELECT placed.*, closed FROM placed JOIN batches USING (batch))"""

_HOURLY = """
    SELECT measurepointid, measuretag, CAST(value AS DECIMAL(30, 8)) AS value1, {time} AS sampletime,
           strftime(CAST({time} AS TIMESTAMP), '%Y-%m-%d') AS dt,
           strftime(CAST({time} AS TIMESTAMP), '%H') AS hr
    FROM named"""

_HOURLY_CLEAN = f"WITH {_READINGS} {_HOURLY.format(time='clean_time')}"
_HOURLY_DIRTY = f"""
WITH {_READINGS}, kept AS (
    SELECT * REPLACE (CASE WHEN rule = 103 THEN NULL ELSE value END AS value)
    FROM named WHERE rule NOT IN (97, 101, 107)
) {_HOURLY.format(time='dirty_time').replace('FROM named', 'FROM kept')}"""

_FLAT = """
    SELECT measurepointid, measuretag, CAST(value AS DECIMAL(30, 8)) AS value1, {time} AS sampletime
    FROM named WHERE {where}"""

_REASON = "CASE rule WHEN 103 THEN 'null_value' WHEN 107 THEN 'malformed' ELSE '{other}' END AS reason"

_COMMITTABLE = f"""
WITH {_READINGS}, span AS (
    SELECT epoch_ms(min(CAST(clean_time AS TIMESTAMP))) AS lo,
           epoch_ms(max(CAST(clean_time AS TIMESTAMP))) AS hi
    FROM named
), parts AS (
    SELECT DISTINCT strftime(CAST(clean_time AS TIMESTAMP), '%Y-%m-%d') AS dt,
           strftime(CAST(clean_time AS TIMESTAMP), '%H') AS hr
    FROM named
)
SELECT dt, hr FROM parts
WHERE (SELECT lo + (hi - lo) // 2 - 180000 FROM span)
      > epoch_ms(strptime(dt || ' ' || hr || ':00:00', '%Y-%m-%d %H:%M:%S')) + 900000"""


def oracle_sql() -> dict[str, str]:
    clean = _stamped("clean_time")
    dirty = _stamped("dirty_time")
    decoded = _stamped("dirty_time", "rule NOT IN (103, 107)")
    timed = _stamped("dirty_time", "rule NOT IN (97, 101, 103, 107)")
    decode = f"""
        WITH {_READINGS}
        SELECT source_partition, seq, measurepointid, measuretag, value, dirty_time AS sampletime
        FROM named WHERE rule NOT IN (103, 107)"""
    rejects = f"""
        WITH {_READINGS}
        SELECT source_partition, seq, {_REASON.format(other='')}
        FROM named WHERE rule IN (103, 107)"""
    return {
        "decode_messages": decode,
        "decode_quarantine": rejects,
        "quarantine_bad_time": f"""
            WITH {_READINGS}
            SELECT source_partition, seq, {_REASON.format(other='bad_time')}
            FROM named WHERE rule IN (97, 101, 103, 107)""",
        "sample_time_valid": f"""
            WITH {_READINGS}
            SELECT seq, coalesce(dirty_time, '') <> '' AS present,
                   regexp_full_match(dirty_time, '{SAMPLE_TIME_PATTERN}') AS valid
            FROM named""",
        "event_time_sentinel": f"WITH {dirty} SELECT seq, ms AS event_millis FROM stamped",
        "table_decode_nulls": f"""
            WITH {_READINGS}
            SELECT source_partition, seq, measurepointid, measuretag,
                   CASE WHEN rule = 103 THEN NULL ELSE value END AS value,
                   dirty_time AS sampletime,
                   strftime(TRY_CAST(dirty_time AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS ts
            FROM named WHERE rule <> 107""",
        "table_quarantine": f"""
            WITH {_READINGS}
            SELECT source_partition, seq, {_REASON.format(other='null_time')}
            FROM named WHERE rule IN (97, 101, 107)""",
        "project_decimal": f"""
            WITH {_READINGS}
            SELECT measurepointid, measuretag, CAST(value AS DECIMAL(30, 8)) AS value1,
                   clean_time AS sampletime, seq
            FROM named""",
        "hourly_columns": f"""
            WITH {_READINGS}
            SELECT seq, strftime(CAST(clean_time AS TIMESTAMP), '%Y-%m-%d') AS dt,
                   strftime(CAST(clean_time AS TIMESTAMP), '%H') AS hr
            FROM named""",
        "window_assign": f"""
            WITH {dirty}
            SELECT seq, {_text('w')} AS window_start, {_text('w_end')} AS window_end FROM windowed""",
        "latest_per_window": f"""
            WITH {clean}, {_NEWEST.format(source='windowed')}
            SELECT measurepointid, measuretag, {_text('w')} AS window_start, value,
                   {_text('ms')} AS event_time
            FROM newest""",
        "time_neat": _neat(clean),
        "time_neat_dirty": _neat(dirty),
        "time_neat_messages": f"SELECT *, substring(sampletime, 1, 10) AS daytime FROM ({_neat(decoded)})",
        "time_neat_ties": f"""
            WITH {_READINGS}, tied AS (
                SELECT measurepointid, measuretag, value, seq // 4 AS seq, seq % 4 AS source_partition,
                       epoch_ms(CAST(substring(clean_time, 1, 14) || '00:00' AS TIMESTAMP)) AS ms
                FROM named
            ), windowed AS (SELECT *, ms AS w, ms + 900000 AS w_end FROM tied),
            {_NEWEST.format(source='windowed').replace("ms DESC, seq)", "ms DESC, seq, source_partition)")}
            SELECT *, '2024-01-01' AS daytime FROM ({_NEAT})""",
        "time_neat_wild_stamps": f"""
            WITH {_READINGS}, tied AS (
                SELECT measurepointid, measuretag, value, seq // 4 AS seq, seq % 4 AS source_partition,
                       epoch_ms(CAST(substring(clean_time, 1, 14) || '00:00' AS TIMESTAMP)) AS ms,
                       CASE WHEN (seq // 4) % 6 = 0 THEN -1 WHEN (seq // 4) % 6 = 3 THEN (1704067200000 - seq // 4) * 1000
                            ELSE 1704067200000 - seq // 4 END AS arrived
                FROM named
            ), windowed AS (
                SELECT *, ms AS w, ms + 900000 AS w_end, CASE WHEN arrived < 9999999999998 THEN arrived ELSE 9999999999998 END AS stamp FROM tied),
            {_NEWEST.format(source='windowed').replace("ms DESC, seq)", "ms DESC, stamp, seq, source_partition)")}
            SELECT *, '2024-01-01' AS daytime FROM ({_NEAT})""",
        "time_neat_bounded": f"SELECT *, '2024-01-01' AS daytime FROM ({_neat(timed)})",
        "time_neat_on_time": _neat(dirty, "on_time", _LATE),
        "time_neat_replay": f"""
            SELECT *, substring(sampletime, 1, 10) AS daytime FROM ({_neat(decoded, "on_time", _LATE)})""",
        "late_audit": f"""
            WITH {dirty}{_LATE}
            SELECT seq, source_partition, {_text('ms')} AS event_time FROM audited WHERE late""",
        "late_audit_files": f"""
            WITH {decoded}{_LATE}
            SELECT source_partition, measurepointid, measuretag, value, {_text('ms')} AS event_time
            FROM audited WHERE late""",
        "hourly_sql": _HOURLY_DIRTY,
        "append_hourly": _HOURLY_CLEAN,
        "append_daily": f"SELECT *, '2024-01-01' AS daytime FROM ({_neat(clean)})",
        "append_flat": f"WITH {_READINGS} {_FLAT.format(time='clean_time', where='TRUE')}",
        "committable_partitions": _COMMITTABLE,
        "committed_partitions": _COMMITTABLE,
        "committed_daily": f"""
            WITH span AS (
                SELECT epoch_ms(min(CAST(ts AS TIMESTAMP))) // 1000 * 1000 AS lo, epoch_ms(max(CAST(ts AS TIMESTAMP))) // 1000 * 1000 AS hi FROM events
            )
            SELECT DISTINCT daytime FROM (SELECT substring(sampletime, 1, 10) AS daytime FROM ({_neat(clean)}))
            WHERE (SELECT lo + (hi - lo) // 2 - 180000 FROM span) > epoch_ms(strptime(daytime, '%Y-%m-%d'))""",
        "replay_committed": f"SELECT dt, hr, count(*) AS n FROM ({_HOURLY_CLEAN}) GROUP BY dt, hr",
        "list_tables": "SELECT DISTINCT 'readings_' || event_type AS table_name FROM events",
        "preview_stream": "SELECT least(2, count(*)) AS n FROM events",
        "preview": f"""
            WITH {_READINGS}
            SELECT source_partition, seq, measurepointid, measuretag, value, clean_time AS sampletime
            FROM named ORDER BY seq LIMIT 2""",
        "source_text": f"""
            WITH {_READINGS}
            SELECT measurepointid, measuretag, value, dirty_time AS sampletime
            FROM named WHERE rule NOT IN (103, 107)""",
        "source_archive": decode,
        "stream_quarantine": rejects,
        "stream_one_pass_quarantine": rejects,
        "stream_time_neat": f"""
            SELECT *, '2024-01-01' AS daytime FROM (
                {_neat(clean)} WHERE w_end <= (SELECT max(ms) FROM stamped) - 120000)""",
        "stream_time_neat_groups": f"""
            SELECT *, '2024-01-01' AS daytime FROM (
                {_neat(clean)} WHERE w_end <= (
                    SELECT least(max(ms) FILTER (seq % 2 = 0), max(ms) FILTER (seq % 2 = 1)) FROM stamped) - 120000)""",
        "stream_time_neat_batches": f"""
            SELECT *, '2024-01-01' AS daytime FROM (
                WITH {decoded}{_IN_BATCHES}, accepted AS (
                    SELECT * FROM judged WHERE closed IS NULL OR w_end > closed
                ), {_NEWEST.format(source='accepted')} {_NEAT}
                WHERE w_end <= (SELECT max(ms) FROM stamped) - 120000)""",
        "stream_late_rows": f"""
            WITH {decoded}{_IN_BATCHES}
            SELECT measurepointid, measuretag, value, sampletime, CAST(source_partition AS VARCHAR) AS source_partition, seq, batch
            FROM judged WHERE w_end <= closed""",
        "stream_append_hourly": _HOURLY_DIRTY,
        "stream_hourly_sql": _HOURLY_DIRTY,
        "stream_append_flat": f"""
            WITH {_READINGS} {_FLAT.format(time='dirty_time', where='rule NOT IN (103, 107)')}""",
        "published_hours": _HOURLY_DIRTY,
        "replay_runs_hourly": _HOURLY_DIRTY,
        "replay_runs_quarantine": rejects,
        "replay_runs_flat": f"""
            WITH {_READINGS} {_FLAT.format(time='dirty_time', where='rule NOT IN (103, 107)')}""",
        "stream_one_pass_rows": f"""
            WITH {_READINGS} {_FLAT.format(time='dirty_time', where='rule NOT IN (103, 107)')}""",
    }
