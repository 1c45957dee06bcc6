"""Append to the landing table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: rows per output file of a run.
BLOCK_ROWS = 1_500_000
# With a bound below this, a write's time is that of making its files.
SMALL_FILE_ROWS = 10_000


def landing_layout(df: DataFrame) -> DataFrame:
    """Rows of a month together, in shuffle partitions of the advisory size.

    REBALANCE lets AQE split a month that is too large for one task and merge small ones, so a run
    writes neither one file per task and month nor one huge file.
    """
    return df.hint("rebalance", F.col("year"), F.col("month"))


def small_file_options(spark: SparkSession) -> dict[str, str]:
    """Options for a write of many small files: on a local file system no ``.crc`` file beside each.

    Hadoop's local file system starts a program for the permissions of every file it makes, sidecars included.  The
    checksums of Parquet pages stay; readers of landed files compare them (``sources.files.VERIFY``).  Other
    stores, and a local file system that the session has chosen itself, are as before.
    """
    pages = {"parquet.page.write-checksum.enabled": "true"}
    if spark._jsparkSession.sessionState().newHadoopConf().get("fs.file.impl"):
        return pages
    # An instance of the other kind is cached for this scheme by now.
    return {**pages, "fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def write_landing(
    df: DataFrame, path: str, max_records: int | None = BLOCK_ROWS, mode: str = "append", layout: bool = True
) -> None:
    """Parquet below ``year=/month=``, at most ``max_records`` rows per file.

    ``append`` never touches existing files: part names carry the id of the write job.  For a table that
    must not exist yet use ``mode="errorifexists"``.
    """
    if mode not in ("append", "errorifexists"):
        raise ValueError("landing is appended to or newly made; use sinks.swap to replace a month")
    writer = (landing_layout(df) if layout else df).write.partitionBy("year", "month").mode(mode)
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
        if max_records < SMALL_FILE_ROWS:
            writer = writer.options(**small_file_options(df.sparkSession))
    writer.parquet(path)


def write_new(df: DataFrame, path: str, max_records: int | None = BLOCK_ROWS) -> None:
    """Write without clobbering anything that is there."""
    write_landing(df, path, max_records, mode="append")
