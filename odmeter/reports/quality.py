"""Data counts: distances, rows, files, routes, runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odmeter.functions import columns as C
from odmeter.schemas import MONTH

# Fixed value: the run status that is no failure (the others are in ``reports.runlog``).
SUCCESS = "success"


def quality_measures() -> list[Column]:
    """Rows, missing distances and zero distances, for an aggregate or for ``observe``."""
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(C.missing(F.col("distance"))).alias("nan_distances"),
        F.count_if(F.col("distance") == 0).alias("zero_distances"),
    ]


def quality_counts(df: DataFrame, by: list[str] = ()) -> DataFrame:
    """Rows, missing distances and zero distances."""
    return df.groupBy(*by).agg(*quality_measures())


def volume_by_month(df: DataFrame, file_col: str = "source_file") -> DataFrame:
    """Rows and files per month; rows are counted per file first."""
    per_file = df.groupBy(MONTH, file_col).agg(F.count(F.lit(1)).alias("n"))
    return per_file.groupBy(MONTH).agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("files"))


def rows_processed(df: DataFrame) -> DataFrame:
    """Rows per month and, with a NULL month, in total."""
    return df.rollup(MONTH).agg(F.count(F.lit(1)).alias("rows"))


def max_file_time(df: DataFrame, file_time: str = "file_time") -> DataFrame:
    """Latest file time per month: the next checkpoint."""
    return df.groupBy(MONTH).agg(F.max(file_time).alias("max_file_time"))


def first_last_file(files: DataFrame) -> DataFrame:
    """First and last file of each month in time order, ties by path."""
    place = F.struct("file_time", "file_path")
    return files.groupBy(MONTH).agg(
        F.min_by("file_path", place).alias("first_file"), F.max_by("file_path", place).alias("last_file")
    )


def file_stats(files: DataFrame) -> DataFrame:
    """Files and megabytes per month of a listing (one row per file)."""
    return files.groupBy(MONTH).agg(
        F.count(F.lit(1)).alias("files"),
        F.round(F.sum("file_size") / F.lit(1024.0 * 1024.0), 2).alias("mb"),
    )


def file_stats_change(before: DataFrame, after: DataFrame) -> DataFrame:
    """Files and megabytes per month before and after a rewrite."""

    def named(files: DataFrame, suffix: str) -> DataFrame:
        return file_stats(files).withColumnsRenamed({"files": f"files_{suffix}", "mb": f"mb_{suffix}"})

    return named(before, "before").join(named(after, "after"), MONTH, "full")


def throughput(rows: int, seconds: float) -> float | None:
    """Rows per second of a run or a block, from the observed row count and the run clock."""
    return round(rows / seconds, 2) if seconds > 0 else None


def throughput_column(rows: Column, seconds: Column) -> Column:
    """The same for a table of runs; NULL where no time has passed."""
    return F.when(seconds > 0, F.round(rows / seconds, 2))


def backfill_counts(files: DataFrame) -> DataFrame:
    """Files per ``status`` (success, skipped, error)."""
    return files.groupBy("status").agg(F.count(F.lit(1)).alias("files"))


def unrouted_rate(enriched: DataFrame, by: list[str] = ()) -> DataFrame:
    """Requests (rows with complete coordinates), lost ones, and the success share in percent."""
    asked = enriched.where("route_match <> 'missing_coords'")
    return asked.groupBy(*by).agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(F.col("distance").isNull()).alias("lost"),
        C.percent(F.count("distance"), F.count(F.lit(1))).alias("success_pct"),
    )


def availability_report(runs: DataFrame, by: list[str] = ()) -> DataFrame:
    """Runs, successes, failures, success share, days between failures, hours to recovery.

    ``runs`` has ``run_date``, ``status`` and, for failures, ``recovery_hours``.
    """
    failed = F.col("status") != SUCCESS
    return runs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(~failed).alias("successes"),
        F.count_if(failed).alias("failures"),
        C.percent(F.count_if(~failed), F.count(F.lit(1))).alias("success_pct"),
        F.round(F.try_divide(F.count_distinct("run_date"), F.count_if(failed)), 2).alias("mtbf_days"),
        F.round(F.avg(F.when(failed, F.col("recovery_hours"))), 2).alias("mttr_hours"),
    )


def failures_by_type(runs: DataFrame) -> DataFrame:
    return runs.where(F.col("status") != SUCCESS).groupBy("status").agg(F.count(F.lit(1)).alias("failures"))
