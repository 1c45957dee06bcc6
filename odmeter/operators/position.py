"""Positions, blocks, even parts and running totals without a one-task window.

A position inside a whole file or month would need that whole group in one task.  Instead the group is
cut into order-preserving buckets of bounded size: rows are numbered inside their bucket, and the
number of rows in earlier buckets is added.  The offsets are one row per bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odmeter.schemas import MONTH

BUCKET_ROWS = 1_000_000


def row_index_bucket(row_index: str = "row_index", width: int = BUCKET_ROWS) -> Column:
    """Bucket of at most ``width`` rows, in order of a unique non-negative row index."""
    return F.floor(F.col(row_index) / F.lit(width))


def with_position(
    df: DataFrame, group: list[str], order: list[str | Column], buckets: list[Column]
) -> DataFrame:
    """Adds ``position`` (from 0, in ``order``) and ``group_rows``, both per group.

    ``buckets`` must follow ``order``: a row in an earlier bucket comes before a row in a later one.
    Group and bucket columns must not be NULL.
    """
    names = [f"_bucket_{i}" for i in range(len(buckets))]
    bucketed = df.withColumns(dict(zip(names, buckets, strict=True)))

    sizes = bucketed.groupBy(*group, *names).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *group,
        *names,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
        F.sum("_n").over(Window.partitionBy(*group)).alias("group_rows"),
    )
    inside = Window.partitionBy(*group, *names).orderBy(*order)
    numbered = bucketed.withColumn("_row", F.row_number().over(inside) - 1)
    return (
        numbered.join(offsets, [*group, *names])
        .withColumn("position", F.col("_offset") + F.col("_row"))
        .select(*df.columns, "position", "group_rows")
    )


def with_block_id(df: DataFrame, size: int, group: list[str], order: list, buckets: list[Column]) -> DataFrame:
    """Adds ``block_id``: consecutive blocks of ``size`` rows per group, the last one shorter."""
    return (
        with_position(df, group, order, buckets)
        .withColumn("block_id", F.floor(F.col("position") / F.lit(size)))
        .drop("position", "group_rows")
    )


def split_even(df: DataFrame, parts: int, group: list[str], order: list, buckets: list[Column]) -> DataFrame:
    """Adds ``part`` (from 0): ``parts`` contiguous runs per group, the first ``rows % parts`` one longer."""
    short = F.floor(F.col("group_rows") / F.lit(parts))
    longer = F.col("group_rows") % F.lit(parts)
    in_longer = longer * (short + 1)
    part = F.when(
        F.col("position") < in_longer, F.floor(F.col("position") / (short + 1))
    ).otherwise(longer + F.floor((F.col("position") - in_longer) / short))
    return with_position(df, group, order, buckets).withColumn("part", part).drop("position", "group_rows")


def files_in_time_order(files: DataFrame) -> DataFrame:
    """Listing sorted by file time, ties by path."""
    return files.orderBy("file_time", "file_path")


def file_seq(files: DataFrame) -> DataFrame:
    """Adds ``file_seq`` (from 0): place of each file of a month in time order, ties by path.

    ``files`` is a listing, one row per file.
    """
    window = Window.partitionBy(MONTH).orderBy("file_time", "file_path")
    return files.withColumn("file_seq", (F.row_number().over(window) - 1).cast("bigint"))


def running_total(df: DataFrame, within: list[str], group: str = MONTH) -> DataFrame:
    """Rows per block and the running total after each block, over the whole run.

    ``within`` orders the blocks of a group, e.g. file and block number.  Rows are counted per block
    first.  The running sum is taken inside each group, and the totals of earlier groups are added; the
    group table has one row per month.
    """
    blocks = df.groupBy(group, *within).agg(F.count(F.lit(1)).alias("rows"))
    months = blocks.groupBy(group).agg(F.sum("rows").alias("_month_rows"))
    earlier = Window.orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    offsets = months.select(group, F.coalesce(F.sum("_month_rows").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(group).orderBy(*within).rowsBetween(Window.unboundedPreceding, 0)
    return (
        blocks.withColumn("_running", F.sum("rows").over(inside))
        .join(offsets, group)
        .select(group, *within, "rows", (F.col("_offset") + F.col("_running")).alias("running_rows"))
    )
