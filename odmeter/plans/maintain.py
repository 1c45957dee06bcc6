"""Month maintenance: global keep-first, compaction, column backfill."""

from __future__ import annotations

import math
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from odmeter.operators.dedupe import dedupe_month, dedupe_report
from odmeter.reports.quality import backfill_counts
from odmeter.schemas import KEY, MONTH
from odmeter.session import cut_lineage
from odmeter.sinks.swap import file_snapshot, repair, replace_months
from odmeter.sources.files import VERIFY, landed_schema, list_landing, month_folder, read_landing

# Fixed value: rows per file after daily de-duplication.
DEDUPE_BLOCK_ROWS = 1_000_000
TARGET_FILE_BYTES = 1 << 30
#: files below this share of the target are merged
SMALL_SHARE = 0.75


@dataclass(frozen=True)
class MonthChange:
    """What maintenance found in a month, what it left, and whether it was rewritten."""

    month: str
    rows_before: int
    rows_after: int
    files_before: int
    bytes_before: int
    files_after: int
    bytes_after: int
    rewritten: bool


def _files_wanted(size: int, target_bytes: int) -> int:
    return max(1, math.ceil(size / target_bytes))


def _spread(rows: DataFrame, files: dict[str, int], by: list[str] = (KEY,)) -> DataFrame:
    """Shuffles so that month ``m`` ends in at most ``files[m]`` tasks, hence files.

    A month below the target size goes to one task; a large one is split by a hash of ``by`` (the key, which is
    unique after de-duplication), so that no task takes a whole large month.  The number of tasks follows the number of files (twice that, so that
    few files share a task), not the session default.
    """
    wanted: Column = F.lit(1)
    for month, n in files.items():
        if n > 1:
            here = (F.col("year") == month[:4]) & (F.col("month") == month[5:])
            wanted = F.when(here, n).otherwise(wanted)
    split = rows.withColumn("_part", F.pmod(F.xxhash64(*by), wanted))
    return split.repartition(2 * sum(files.values()), "year", "month", "_part").drop("_part")


def _rewrite(
    spark: SparkSession,
    landing: str,
    months: list[str],
    needs: str,
    scope_key: str,
    target_bytes: int,
    max_records: int | None,
    dry_run: bool,
) -> list[MonthChange]:
    repair(spark, landing)
    before = file_snapshot(spark, landing, months)
    months = [m for m in months if m in before]
    if not months:
        return []
    rows = read_landing(spark, landing, months, landed_schema(spark, landing, months))
    counts = {
        f"{r['year']}-{r['month']}": (r["rows_before"], r["rows_after"])
        for r in dedupe_report(rows, ["year", "month"], scope_key).collect()
    }
    files = {m: _files_wanted(before[m].size, target_bytes) for m in months}
    twice = [m for m in months if counts.get(m, (0, 0))[0] != counts.get(m, (0, 0))[1]]
    small = {}
    if needs == "compact":
        unique = [m for m in months if m not in twice and before[m].files > 1 and counts.get(m, (0, 0))[1]]
        small = small_files(spark, landing, unique, target_bytes)
    todo = [m for m in months if m in twice or m in small]
    if twice and not dry_run:
        chosen = read_landing(spark, landing, twice, rows.schema)
        unique = _spread(dedupe_month(chosen, scope_key), {m: files[m] for m in twice})
        replace_months(unique, landing, {m: counts[m][1] for m in twice}, before, max_records)
    if small and not dry_run:
        _merge_files(spark, landing, small, before, rows.schema, target_bytes)
    after = file_snapshot(spark, landing, months) if todo and not dry_run else before
    return [
        MonthChange(
            m, *counts.get(m, (0, 0)), before[m].files, before[m].size, after[m].files, after[m].size,
            m in todo and not dry_run,
        )
        for m in months
    ]


def small_files(spark: SparkSession, landing: str, months: list[str], target_bytes: int = TARGET_FILE_BYTES) -> dict[str, dict[str, int]]:
    """Names and sizes, by month, of the files below ``SMALL_SHARE`` of the target that fit together into fewer files.

    Files that are large enough, and months where merging would leave as many files, are left out.
    """
    if not months:
        return {}
    listed = list_landing(spark, landing, months).where(F.col("file_size") < SMALL_SHARE * target_bytes)
    per_month = listed.groupBy(MONTH).agg(F.count(F.lit(1)).alias("files"), F.sum("file_size").alias("size"))
    due = per_month.where(F.col("files") > F.greatest(F.ceil(F.col("size") / target_bytes), F.lit(1)))
    out: dict[str, dict[str, int]] = {}
    for r in listed.join(F.broadcast(due.select(MONTH)), MONTH).select(MONTH, "file_name", "file_size").collect():
        out.setdefault(r[MONTH], {})[r["file_name"]] = r["file_size"]
    return out


def _merge_files(
    spark: SparkSession, landing: str, small: dict[str, dict[str, int]], before: dict, schema: StructType, target_bytes: int
) -> None:
    """Rewrites just the small files of each month; all others keep their names and times."""
    paths = [f"{month_folder(landing, m)}/{name}" for m, names in small.items() for name in names]
    rows = spark.read.schema(schema).option("basePath", landing).option(VERIFY, True).parquet(*paths)
    counted = {f"{r['year']}-{r['month']}": r["count"] for r in rows.groupBy("year", "month").count().collect()}
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    files = {m: _files_wanted(sum(names.values()), target_bytes) for m, names in small.items()}
    spread = _spread(rows.select("*", *place), files, ["_file", "_row"]).drop("_file", "_row")
    replace_months(spread, landing, counted, before, retire={m: sorted(names) for m, names in small.items()})


def dedupe_months(
    spark: SparkSession,
    landing: str,
    months: list[str],
    key: str = KEY,
    target_bytes: int = TARGET_FILE_BYTES,
    max_records: int | None = DEDUPE_BLOCK_ROWS,
    dry_run: bool = False,
) -> list[MonthChange]:
    """Global keep-first over landed months; months without duplicates are left alone.

    Give every month that a run touched, not only the current one.
    """
    return _rewrite(spark, landing, months, "dedupe", key, target_bytes, max_records, dry_run)


def compact_months(
    spark: SparkSession,
    landing: str,
    months: list[str],
    key: str = KEY,
    target_bytes: int = TARGET_FILE_BYTES,
    dry_run: bool = False,
) -> list[MonthChange]:
    """Closed months: keep-first and one file per month, or one per ``target_bytes`` of a larger month.

    A month with duplicates is rewritten whole.  Of one without, only small files are, and only if that leaves fewer files: large ones
    keep their names and times.  A month that is compact and free of duplicates is not touched, so a second run does nothing.
    """
    return _rewrite(spark, landing, months, "compact", key, target_bytes, None, dry_run)


# A text no real value has: stands for "this file has no such column" while reading.
_ABSENT = "\u0000absent"


def read_with_absent_mark(
    spark: SparkSession, landing: str, months: list[str], column: str, paths: list[str] | None = None
) -> DataFrame:
    """Landed rows (of the files ``paths`` only, where given), in which a file that lacks ``column`` shows a mark instead of NULL.

    The mark is the default value of the column in the read schema: Spark fills it in for files written
    before the column existed, and leaves a NULL that a file really holds as it is.
    """
    schema = landed_schema(spark, landing, months)
    default = {"CURRENT_DEFAULT": f"'{_ABSENT}'", "EXISTS_DEFAULT": f"'{_ABSENT}'"}
    others = [f for f in schema if f.name != column]
    marked = StructType([*others[:-2], StructField(column, StringType(), True, default), *others[-2:]])
    if paths is not None:
        return spark.read.schema(marked).option("basePath", landing).option(VERIFY, True).parquet(*paths)
    return read_landing(spark, landing, months, marked)


def backfill_status(spark: SparkSession, landing: str, months: list[str], column: str = "ingestion_date") -> DataFrame:
    """One row per landed file with rows: month, path, ``success`` (to be filled) or ``skipped``."""
    rows = read_with_absent_mark(spark, landing, months, column)
    status = F.when(F.bool_or(F.col(column) == _ABSENT), "success").otherwise("skipped")
    return rows.groupBy(
        F.concat_ws("-", "year", "month").alias(MONTH), F.col("_metadata.file_path").alias("file_path")
    ).agg(status.alias("status"), F.count(F.lit(1)).alias("rows"))


def backfill_column(
    spark: SparkSession,
    landing: str,
    months: list[str],
    value: str,
    column: str = "ingestion_date",
    target_bytes: int = TARGET_FILE_BYTES,
    dry_run: bool = False,
) -> dict[str, int]:
    """Adds the text ``column`` with a constant to rows of files that lack it; returns files per status.

    A NULL in a file that has the column stays NULL.  Only the files that lack the column are read and replaced; the others
    keep their names and times.  Months go one after the other, and only the paths of a month's old files come to the
    driver.  An unreadable file raises before anything of its month is replaced.
    """
    repair(spark, landing)
    before = file_snapshot(spark, landing, months)
    months = [m for m in months if m in before]
    if not months:
        return {}
    status = cut_lineage(backfill_status(spark, landing, months, column))
    result = {r["status"]: r["files"] for r in backfill_counts(status).collect()}
    old = status.where(F.col("status") == "success")
    per_month = {r[MONTH]: r["rows"] for r in old.groupBy(MONTH).agg(F.sum("rows").alias("rows")).collect()}
    for month in [] if dry_run else sorted(per_month):
        paths = [r["file_path"] for r in old.where(F.col(MONTH) == month).select("file_path").collect()]
        names = [unquote(p.rsplit("/", 1)[1]) for p in paths]
        rows = read_with_absent_mark(spark, landing, [month], column, paths)
        place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]
        filled = F.when(F.col(column) == _ABSENT, value).otherwise(F.col(column)).alias(column)
        rows = rows.select(*[filled if c == column else F.col(c) for c in rows.columns], *place)
        files = {month: _files_wanted(before[month].size, target_bytes)}
        spread = _spread(rows, files, ["_file", "_row"]).drop("_file", "_row")
        replace_months(spread, landing, {month: per_month[month]}, before, retire={month: names})
    return result
