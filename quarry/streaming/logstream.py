"""Web-log counts over a folder of arriving log files.

The batch operators are reused unchanged on a ``readStream.text`` source:
parse -> domain group -> running count per group (or per organisation).
State is one row per key; the checkpoint lives in the shared checkpoint
folder so a restarted query resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import weblog as wl
from quarry.session import scratch_path
from quarry.sources.files import ACCESS_LOG_SCHEMA


def _lines(spark: SparkSession, path: str, max_files: int | None) -> DataFrame:
    reader = spark.readStream.schema(ACCESS_LOG_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)


def stream_group_counts(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Streaming (grp, requests) over the log files landing in ``path``."""
    parsed = wl.parse_log(_lines(spark, path, max_files))
    return wl.with_group(parsed).groupBy("grp").agg(F.count(F.lit(1)).alias("requests"))


def stream_org_counts(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Streaming (grp, org, requests)."""
    return wl.org_requests(wl.parse_log(_lines(spark, path, max_files)))


def start_group_counts(spark: SparkSession, path: str, name: str = "log_group_counts",
                       checkpoint: str | None = None, sink: str = "memory"):
    """Start the running group counts (complete mode) and return the query."""
    counts = stream_group_counts(spark, path)
    return (counts.writeStream.outputMode("complete").format(sink).queryName(name)
            .option("checkpointLocation", checkpoint or scratch_path(spark, f"stream_{name}"))
            .start())
