"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores. Each query runs
once to warm up and then ``RUNS`` times; the median counts. Results go to a
sink that discards them, so that only the work of the query is timed; the
append queries write their files and are timed with them. The ``large`` figures
read messages that were written before the clock starts: ``COPIES`` copies of
all events, each a year after the one before.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.bindings import as_messages, events
from checks.queries import queries
from quarterbell import JobOptions
from quarterbell.operators import late_readings, readings, with_event_time
from quarterbell.plans import hourly_rows, quarter_hour_rows
from quarterbell.session import configure, new_folder
from quarterbell.streaming import append_stream

RUNS = 3
COPIES = 10
HEADLINE = (
    "decode_messages",
    "time_neat",
    "time_neat_messages",
    "time_neat_bounded",
    "time_neat_on_time",
    "late_audit",
    "committable_partitions",
    "stream_time_neat",
    "stream_append_flat",
    "append_flat",
    "append_daily",
    "append_hourly",
)


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("quarterbell-bench")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # The tables are small and their hours many: let small partitions keep all cores busy.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "16KB")
    return configure(spark, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)


def drain(result: DataFrame) -> None:
    result.write.format("noop").mode("overwrite").save()


def stream_details(spark: SparkSession, sf_dir: str) -> dict[str, int]:
    """Micro-batches and peak state of one run of the quarter-hour job as a stream."""
    folder = new_folder(spark, "bench-stream")
    rows = quarter_hour_rows(as_messages(events(spark, sf_dir, streaming=True)))
    query = append_stream(rows, f"{folder}/rows", f"{folder}/checkpoint", ("daytime",), available_now=True)
    query.awaitTermination()
    progress = query.recentProgress
    return {
        "micro_batches": len(progress),
        "peak_state_rows": max(op.numRowsTotal for p in progress for op in p.stateOperators),
    }


def median_of_runs(run: Callable[[], None]) -> float:
    spent = []
    for _ in range(RUNS + 1):
        began = time.perf_counter()
        run()
        spent.append(time.perf_counter() - began)
    return round(statistics.median(spent[1:]), 3)


def large(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    """Seconds of the jobs over messages that are there as text already."""
    table = events(spark, sf_dir)
    rows = table.count()
    copies = spark.range(COPIES).select(F.col("id").alias("copy"))
    shifted = table.join(copies, F.lit(True)).withColumns({
        "event_id": F.col("event_id") + F.col("copy") * rows,
        "ts": F.col("ts") + F.make_dt_interval((F.col("copy") * 365).cast("int")),
    })
    path = new_folder(spark, "bench-messages")
    # as many files as cores, so that all of them read
    as_messages(shifted, dirty=True).repartition(spark.sparkContext.defaultParallelism).write.parquet(path)
    messages = spark.read.parquet(path)
    options = JobOptions(daytime="event_date")
    jobs = {
        "decode": lambda: readings(messages),
        "quarter_hour": lambda: quarter_hour_rows(messages, options),
        "hourly": lambda: hourly_rows(messages),
        "late_audit": lambda: late_readings(with_event_time(readings(messages))),
    }
    tasks = messages.select(F.spark_partition_id()).distinct().count()
    return {"rows": rows * COPIES, "reading_tasks": tasks} | {name: median_of_runs(lambda: drain(job())) for name, job in jobs.items()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(cpus)
    registered = queries()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        seconds[name] = median_of_runs(lambda: drain(registered[name](spark, sf_dir)))
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    shuffle_partitions = spark.conf.get("spark.sql.shuffle.partitions")
    much = large(spark, sf_dir)
    streamed = stream_details(spark, sf_dir)
    written = registered["append_hourly"](spark, sf_dir).select("_metadata.file_path").distinct().count()
    spark.stop()
    print(json.dumps({
        "metric": "total of the medians of all headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "rows_per_sec": {name: round(rows / spent) for name, spent in seconds.items()},
        "sf": os.path.basename(os.path.normpath(sf_dir)),
        "cpus": cpus,
        "shuffle_partitions": shuffle_partitions,
        "large": much,
        "stream_time_neat": streamed,
        "append_hourly_files": written,
        "input_rows": rows,
    }))


if __name__ == "__main__":
    main()
