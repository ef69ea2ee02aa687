"""What a stream has written, from the log of its file sink.

The log has a small file for each micro-batch, and now and then a compact one
with everything up to its batch, after which the small ones before it may go.
Reading the batches since a known one costs what they wrote, whatever the
table already holds; no data file is listed or opened.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOG = "_spark_metadata"
_COMPACT = ".compact"


def log_files(spark: SparkSession, path: str) -> dict[int, tuple[bool, str]]:
    """For each batch with a file in the log: whether it is compact, and its path."""
    return numbered_files(spark, f"{path}/{_LOG}")


def numbered_files(spark: SparkSession, log: str) -> dict[int, tuple[bool, str]]:
    """The same of any folder whose files are named by numbers, as all logs of a stream are."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(log)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return {}
    found: dict[int, tuple[bool, str]] = {}
    for status in system.listStatus(folder):
        name = status.getPath().getName()
        batch = name.removesuffix(_COMPACT)
        if batch.isdigit():
            found[int(batch)] = name.endswith(_COMPACT), status.getPath().toString()
    return found


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines of files as rows. Spark's own readers skip the folder of a log, so its files are read as Hadoop text."""
    text = spark.sparkContext._jsc.textFile(",".join(paths)).rdd()
    lines = spark._jsparkSession.createDataset(text, spark._jvm.org.apache.spark.sql.Encoders.STRING())
    return DataFrame(lines.toDF(), spark)


def newest_batch(spark: SparkSession, path: str) -> int:
    """The newest finished batch of the stream that writes to a folder; -1 before the first."""
    return max(log_files(spark, path), default=-1)


def files_since(spark: SparkSession, path: str, batch: int) -> tuple[DataFrame | None, int]:
    """path and written_at (milliseconds) of the files of later batches, and the newest batch; None if there is no later one.

    A small file goes only once a later compact file has its entries; that one is read in place of all
    before it, so older files may be given again, never fewer.
    """
    log = log_files(spark, path)
    newest = max(log, default=-1)
    if newest <= batch:
        return None, newest
    later = {n: log[n] for n in log if n > batch}
    compact = max((n for n, (whole, _) in later.items() if whole), default=-1)
    wanted = [name for n, (_, name) in log.items() if n == compact or n > max(batch, compact)]
    line = F.col("value")
    entries = _lines(spark, wanted).where(line.startswith("{"))
    get = lambda key: F.get_json_object(line, f"$.{key}")
    files = entries.where((get("action") == "add") & (get("isDir") == "false")).select(
        get("path").alias("path"), get("modificationTime").cast("long").alias("written_at"))
    return files, newest
