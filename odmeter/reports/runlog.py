"""Statistics of run logs: one row per line in, one row per file out.

Lines are counted and the first and last of them chosen by aggregates that combine before the shuffle.
Lists of lines are collected only where a fixed number per file is wanted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odmeter.functions import columns as C

# Texts in log lines, run statuses in log file names, and how much a message shows.
TOTAL_PATTERN = r"Total processado:\s*([\d,]+)"
MONTH_PATTERN = r"Partição ([0-9\-]+) concluída"
ERROR_MARKS = ["❌", "ERROR", "FALHA"]
WARNING_MARKS = ["⚠️", "WARNING"]
STATUSES = ["success", "osrm_timeout", "container_restart", "dedupe_failed", "pipeline_failed"]
SHOWN = {"month": 5, "warning": 3, "error": 5}
SHOWN_CHARS = {"month": 100, "warning": 100, "error": 150}

LINE_ORDER = ["line_no"]


def _contains_any(marks: list[str]) -> Column:
    found = F.lit(False)
    for mark in marks:
        found = found | F.col("line").contains(mark)
    return found


def _match(pattern: str) -> Column:
    text = F.regexp_extract("line", pattern, 1)
    return F.when(text != "", text)


def run_status(file_name: Column) -> Column:
    """Status at the end of ``<date>_<time>_<status>.log``, whatever the form of the time."""
    known = F.regexp_extract(file_name, "_(" + "|".join(STATUSES) + r")\.log$", 1)
    return F.when(known != "", known).otherwise("unknown")


def clean_lines(logs: DataFrame) -> DataFrame:
    """Removes a Python logger prefix from each line."""
    return logs.withColumn("line", C.strip_logger_prefix(F.col("line")))


def run_log_stats(logs: DataFrame, order: list[str] = LINE_ORDER) -> DataFrame:
    """Per log file: date, status, total, finished months, errors, warnings, first and last time.

    The total is the last one logged, 0 when there is none.  The last time comes from the last line
    that is not empty.  ``order`` gives the place of a line in its file.
    """
    place = F.struct(*order)
    total = F.replace(_match(TOTAL_PATTERN), F.lit(","), F.lit("")).try_cast("bigint")
    stamp = F.trim(F.substring_index("line", " - ", 1))
    month = _match(MONTH_PATTERN)
    return (
        logs.select("file_name", *order, "line", total.alias("_total"), stamp.alias("_stamp"), month.alias("_month"))
        .groupBy("file_name")
        .agg(
            F.coalesce(F.max_by("_total", F.when(F.col("_total").isNotNull(), place)), F.lit(0)).alias(
                "total_processed"
            ),
            F.count("_month").alias("n_months"),
            F.count_if(_contains_any(ERROR_MARKS)).alias("n_errors"),
            F.count_if(_contains_any(WARNING_MARKS)).alias("n_warnings"),
            F.min_by("_stamp", place).alias("start_time"),
            F.max_by("_stamp", F.when(F.trim("line") != "", place)).alias("end_time"),
        )
        .withColumn("run_date", F.substring_index("file_name", "_", 1))
        .withColumn("status", run_status(F.col("file_name")))
    )


def run_log_months(logs: DataFrame, order: list[str] = LINE_ORDER) -> DataFrame:
    """Every "month finished" line: file, place, month."""
    return logs.select("file_name", *order, _match(MONTH_PATTERN).alias("month")).where("month IS NOT NULL")


def top_messages(logs: DataFrame, order: list[str] = LINE_ORDER) -> DataFrame:
    """What a run message shows per file: the first months, warnings and errors, and how many more.

    This is a top-k report: the limits are what a message holds, the ``more_*`` columns count the rest.  A
    file without any of them has empty lists.
    """
    kinds = F.filter(
        F.array(
            F.when(_match(MONTH_PATTERN).isNotNull(), F.struct(F.lit("month").alias("kind"), _match(MONTH_PATTERN).alias("text"))),
            F.when(_contains_any(WARNING_MARKS), F.struct(F.lit("warning").alias("kind"), F.trim("line").alias("text"))),
            F.when(_contains_any(ERROR_MARKS), F.struct(F.lit("error").alias("kind"), F.trim("line").alias("text"))),
        ),
        lambda entry: entry.isNotNull(),
    )
    entries = logs.select("file_name", *order, F.explode(kinds).alias("e")).select("file_name", *order, "e.*")

    counts = entries.groupBy("file_name").agg(
        *[F.count_if(F.col("kind") == k).alias(f"_all_{k}") for k in SHOWN]
    )
    window = Window.partitionBy("file_name", "kind").orderBy(*order)
    limit = F.create_map(*[F.lit(x) for pair in SHOWN.items() for x in pair])
    first = (
        entries.withColumn("_rank", F.row_number().over(window))
        .where(F.col("_rank") <= max(SHOWN.values()))
        .where(F.col("_rank") <= limit[F.col("kind")])
    )

    def texts(kind: str) -> Column:
        shown = F.when(
            F.col("kind") == kind, F.struct("_rank", F.substring("text", 1, SHOWN_CHARS[kind]).alias("text"))
        )
        return F.transform(F.array_sort(F.collect_list(shown)), lambda e: e["text"]).alias(f"{kind}s")

    shown = first.groupBy("file_name").agg(*[texts(k) for k in SHOWN])
    none = F.array().cast("array<string>")
    lists = [F.coalesce(f"{k}s", none).alias(f"{k}s") for k in SHOWN]
    more = [F.greatest(F.coalesce(f"_all_{k}", F.lit(0)) - n, F.lit(0)).alias(f"more_{k}s") for k, n in SHOWN.items()]
    every = logs.select("file_name").distinct()
    found = every.join(shown, "file_name", "left").join(counts, "file_name", "left")
    return found.select("file_name", *lists, *more)


def runs_of(stats: DataFrame) -> DataFrame:
    """Run table for ``availability_report`` out of ``run_log_stats``."""
    return stats.select("run_date", "status", F.lit(None).cast("double").alias("recovery_hours"))
