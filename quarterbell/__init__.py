"""quarterbell: sensor-reading pipelines expressed as Spark DataFrames.

Readings arrive as JSON text, are decoded, stamped with an event time, reduced
to the newest one per quarter hour and appended to partitioned parquet tables.
Every operator takes and returns a DataFrame or a Column, works on batch and
streaming inputs alike, and starts no Spark job by itself.
"""

from quarterbell.schema import JobOptions

__all__ = ["JobOptions"]
