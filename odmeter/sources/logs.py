"""Run-log text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Place of a line in its file: start of the input split, then the order inside that split.
SPLIT_ORDER = ["block_start", "line_id"]


def read_run_logs(spark: SparkSession, path: str) -> DataFrame:
    """One row per line with its file name and place.

    Files are read by splits, so one very long log is spread over tasks as well.  ``line_id`` grows
    inside a split; with ``block_start`` it orders the lines of a file (not dense).
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("line_id"),
        F.col("value").alias("line"),
    )
