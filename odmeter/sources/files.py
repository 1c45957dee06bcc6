"""Source files in ``YYYY-MM`` directories and the landing table ``year=/month=``.

Row order inside a run is (file time, path, row index); all three come from Spark's ``_metadata``.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from odmeter.functions import columns as C
from odmeter.plans.work import FileUnit, MonthTask
from odmeter.schemas import KEY, LANDING, MONTH, OD, PAIR, require_columns
from odmeter.sinks.views import current_views, hide
from odmeter.session import new_folder
from odmeter.sources.paths import Folder, existing, footer_rows

MONTH_NAME = re.compile(r"\d{4}-\d{2}")
MONTH_GLOB = "[0-9][0-9][0-9][0-9]-[0-9][0-9]"
PARQUET_ONLY = "*.parquet"
FILE_COLUMNS = [MONTH, "source_file", "file_path", "file_time", "row_index"]
# Option of readers of landed files: a page whose bytes differ from its checksum raises.
VERIFY = "parquet.page.verify-checksum.enabled"
_FILE_FACTS = ["_metadata.file_path", "_metadata.file_name", "_metadata.file_size"]


def month_glob(root: str, years: list[str] | None = None) -> str:
    """Glob of the month directories, limited to years so that others are not even listed."""
    if years is None:
        return f"{root}/{MONTH_GLOB}"
    return f"{root}/{{{','.join(years)}}}-[0-9][0-9]"


def list_files(
    spark: SparkSession,
    paths: str | list[str],
    suffix: str | None = None,
    recursive: bool = False,
    only: Column | None = None,
) -> DataFrame:
    """One row per file: path, name, size, time, month.  Contents are not read.

    ``only`` is a predicate on ``_metadata``.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if suffix:
        reader = reader.option("pathGlobFilter", suffix)
    found = reader.load(paths) if only is None else reader.load(paths).where(only)
    return found.select(
        *_FILE_FACTS,
        F.col("_metadata.file_modification_time").alias("file_time"),
        C.month_of_path(F.col("_metadata.file_path")).alias(MONTH),
    )


def list_partitions(spark: SparkSession, root: str, years: list[str] | None = None) -> DataFrame:
    """Months that have a directory, ascending.  A missing root raises.

    Only the directory names of the root are listed, one per calendar month, not the files below them.
    """
    folder = Folder(spark, root)
    if not folder.exists(root):
        raise FileNotFoundError(root)
    names = [n for n in folder.names(root) if MONTH_NAME.fullmatch(n)]
    months = spark.createDataFrame([(n,) for n in names], f"{MONTH} string")
    return months if years is None else months.where(F.substring(MONTH, 1, 4).isin(years))


def with_file_columns(df: DataFrame) -> DataFrame:
    """Adds month, file name, path, time and row index of each row.

    A row of a file that lacks a required column raises, with the name of the file; see ``marked_schema``.
    """
    path = F.col("_metadata.file_path")

    def present(field: StructField) -> Column:
        mark = _MARKS.get(field.dataType.typeName())
        if field.name not in REQUIRED or mark is None:
            return F.col(field.name)
        problem = F.raise_error(F.concat(F.lit(f"no column {field.name} in file "), path)).cast(field.dataType)
        return F.when(F.col(field.name).eqNullSafe(F.lit(mark).cast(field.dataType)), problem).otherwise(F.col(field.name)).alias(field.name)

    return df.select(
        *[present(f) for f in df.schema],
        C.month_of_path(F.col("_metadata.file_path")).alias(MONTH),
        F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_modification_time").alias("file_time"),
        F.col("_metadata.row_index").alias("row_index"),
    )


REQUIRED = [KEY, *PAIR]

# Values no real column has: each stands for "this file has no such column" while reading.
_MARKS = {"string": "\u0000absent", "double": -1.7976931348623157e308, "float": -3.0e38, "long": -(2**63) + 1, "integer": -(2**31) + 1}


def marked_schema(schema: StructType) -> StructType:
    """The schema with a mark as the default of each required column.

    Spark fills the default in for files that lack the column, and leaves a NULL that a file really holds as
    it is.  So every file that is read is checked, in the same scan, and not only the one that the schema came from.
    """

    def marked(field: StructField) -> StructField:
        mark = _MARKS.get(field.dataType.typeName())
        if field.name not in REQUIRED or mark is None:
            return field
        text = f"'{mark}'" if isinstance(mark, str) else f"CAST('{mark!r}' AS {field.dataType.simpleString()})"
        return StructField(field.name, field.dataType, True, {**field.metadata, "CURRENT_DEFAULT": text, "EXISTS_DEFAULT": text})

    return StructType([marked(f) for f in schema])


def _parquet(spark: SparkSession, tolerant: bool) -> DataFrameReader:
    """Reader of the Parquet files in month directories and in folders below them."""
    reader = spark.read.option("pathGlobFilter", PARQUET_ONLY).option("recursiveFileLookup", True)
    return reader.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True) if tolerant else reader


def _found_schema(spark: SparkSession, paths: list[str], tolerant: bool) -> StructType:
    """Columns of all files, from their footers, read by a job; types that don't go together raise.

    A tolerant read of nothing but damaged files has the types of ``OD``.
    """
    try:
        return _parquet(spark, tolerant).option("mergeSchema", True).parquet(*paths).schema
    except AnalysisException as problem:
        if tolerant and problem.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return OD
        raise


def _od_reader(spark: SparkSession, paths: list[str], schema: StructType | None, tolerant: bool) -> DataFrame:
    schema = schema or _found_schema(spark, paths, tolerant)
    require_columns(spark.createDataFrame([], schema), REQUIRED, "source files")
    return _parquet(spark, tolerant).schema(marked_schema(schema)).parquet(*paths)


def read_od_months(
    spark: SparkSession,
    root: str,
    months: list[str] | None = None,
    years: list[str] | None = None,
    schema: StructType | None = None,
    tolerant: bool = False,
) -> DataFrame:
    """Source rows of the months, with file columns.

    Without ``schema`` the types are those of the files (``select_od`` casts them); a required column that
    any of them lacks raises.  ``tolerant`` leaves out files that cannot be read; see ``unread_files``.
    Files in folders below a month directory belong to the month.
    """
    paths = [month_glob(root, years)] if months is None else [f"{root}/{m}" for m in months]
    return with_file_columns(_od_reader(spark, paths, schema, tolerant))


def delta_filter(tasks: list[MonthTask]) -> Column:
    """Predicate on file metadata only, so that Spark drops files before scanning them.

    Only months with a checkpoint need a term, in practice the current and the previous one.
    """
    path, time = F.col("_metadata.file_path"), F.col("_metadata.file_modification_time")
    wanted = F.lit(True)
    for task in tasks:
        if task.incremental and task.checkpoint_us is not None:
            read_before = time <= F.timestamp_micros(F.lit(task.checkpoint_us))
            wanted = wanted & ~((C.month_of_path(path) == task.month) & read_before)
    return wanted


def unit_filter(unit: FileUnit) -> Column:
    """Predicate on file metadata: the files of a month from the unit's first to its last, in order of time and path."""
    path, time = F.col("_metadata.file_path"), F.col("_metadata.file_modification_time")
    place = F.struct(F.unix_micros(time).alias("t"), path.alias("p"))
    first, last = (F.struct(F.lit(t).cast("bigint").alias("t"), F.lit(p).alias("p")) for t, p in (unit.first, unit.last))
    return (C.month_of_path(path) == unit.month) & (place >= first) & (place <= last)


def list_delta(spark: SparkSession, root: str, tasks: list[MonthTask]) -> DataFrame:
    """Listing of the Parquet files that the queue has to read."""
    paths = [f"{root}/{t.month}" for t in tasks]
    return list_files(spark, paths, PARQUET_ONLY, recursive=True, only=delta_filter(tasks))


def read_delta(
    spark: SparkSession,
    root: str,
    tasks: list[MonthTask],
    schema: StructType | None = None,
    tolerant: bool = False,
    unit: FileUnit | None = None,
) -> DataFrame:
    """Rows of the files newer than each month's checkpoint (strictly); all files of historical months.

    With ``unit`` only those of its files.
    """
    rows = _od_reader(spark, [f"{root}/{t.month}" for t in tasks], schema, tolerant).where(delta_filter(tasks))
    return with_file_columns(rows if unit is None else rows.where(unit_filter(unit)))


def stage_scan(scanned: DataFrame) -> DataFrame:
    """A tolerant scan written once to the shared folder and read back from there.

    Damaged files are decoded once, as far as they go: rows and what ``rows_read`` counts of each file then always
    belong together, whatever a second read of the source would have given.
    """
    spark = scanned.sparkSession
    path = new_folder(spark, "scan")
    scanned.write.parquet(path)
    return spark.read.schema(scanned.schema).parquet(path)


def with_rows_read(files: DataFrame, staged: DataFrame) -> DataFrame:
    """A listing with ``rows_read``: how many rows of each file a scan that was staged has."""
    read = staged.groupBy("file_path").agg(F.count(F.lit(1)).alias("rows_read"))
    return files.join(read, "file_path", "left").withColumn("rows_read", F.coalesce("rows_read", F.lit(0)))


def promised_rows(spark: SparkSession, paths: list[str], only: Column | None = None) -> DataFrame:
    """Rows by file as the footers say; no page is read.  Files without rows and damaged ones have no row here."""
    rows = _parquet(spark, tolerant=True).schema(OD).parquet(*paths)
    rows = rows if only is None else rows.where(only)
    return rows.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(F.count(F.lit(1)).alias("promised"))


def unread_files(spark: SparkSession, files: DataFrame, paths: list[str], only: Column | None = None) -> DataFrame:
    """Files of a listing that a tolerant read left out, in whole or in part.

    A file counts as read when the tolerant scan has as many rows of it as its footer promises: those of a listing
    ``with_rows_read``, or of a scan of the needed columns made here.  Files that have no rows come out too; ``empty_files`` tells them
    from damaged ones.  ``only`` is the predicate on file metadata that the listing was made with, so that no other file is read.
    """
    promised = promised_rows(spark, paths, only)
    if "rows_read" in files.columns:
        whole = files.join(promised, "file_path").where("promised = rows_read")
        return files.join(whole.select("file_path"), "file_path", "left_anti")
    rows = _parquet(spark, tolerant=True).schema(_found_schema(spark, paths, tolerant=True)).parquet(*paths)
    rows = rows if only is None else rows.where(only)
    read = rows.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(
        F.count(F.lit(1)).alias("read"), F.bit_xor(F.xxhash64(KEY, *PAIR)).alias("_contents")
    )
    whole = promised.join(read, "file_path").where("promised = read AND _contents IS NOT NULL")
    return files.join(whole.select("file_path"), "file_path", "left_anti")


def read_month_landing(
    spark: SparkSession, landing: str, months: list[str], exclude: list[str] = ("consolidated",)
) -> DataFrame:
    """Landed rows of the months, without files whose name contains one of ``exclude``."""
    name = F.col("_metadata.file_name")
    kept = F.lit(True)
    for part in exclude:
        kept = kept & ~name.contains(part)
    return read_landing(spark, landing, months).where(kept)


def month_folder(landing: str, month: str) -> str:
    return f"{landing}/year={month[:4]}/month={month[5:]}"


def read_landing(
    spark: SparkSession, landing: str, months: list[str] | None = None, schema: StructType = LANDING
) -> DataFrame:
    """The landing table, or some of its months; only those directories are listed.

    The schema is explicit: ``month=01`` stays text, and a column that old files lack is NULL.  Of a month that is being
    replaced by ``sinks.views`` all old or all new rows are there.
    """

    def listed() -> DataFrame:
        paths = [landing] if months is None else [month_folder(landing, m) for m in months]
        found = existing(spark, paths)
        if not found:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("basePath", landing).option(VERIFY, True).parquet(*found)

    return seen(spark, landing, months, listed)


def seen(
    spark: SparkSession, landing: str, months: list[str] | None, listed: Callable[[], DataFrame], file_path: str = "_metadata.file_path"
) -> DataFrame:
    """What ``listed`` makes of the landed files, without hidden ones.

    Files are listed when the DataFrame is made.  If a view has changed meanwhile they are listed again.
    """
    views = current_views(spark, landing, months)
    while True:
        rows = listed()
        now = current_views(spark, landing, months)
        if now == views:
            return hide(rows, views, file_path)
        views = now


def landed_schema(spark: SparkSession, landing: str, months: list[str]) -> StructType:
    """All columns that any landed file of the months has; partition columns as text."""
    found = existing(spark, [month_folder(landing, m) for m in months])
    merged = spark.read.option("mergeSchema", True).option("basePath", landing).parquet(*found).schema
    texts = [StructField(p, StringType()) for p in ("year", "month")]
    return StructType([f for f in merged if f.name not in ("year", "month")] + texts)


def read_existing_keys(spark: SparkSession, landing: str, months: list[str] | None = None) -> DataFrame:
    """Landed keys with their month; no other column is read.  An unreadable file raises."""
    rows = read_landing(spark, landing, months)
    return rows.select(F.concat_ws("-", "year", "month").alias(MONTH), KEY)


def list_landing(spark: SparkSession, landing: str, months: list[str]) -> DataFrame:
    """Listing of the landed Parquet files of the months."""
    found = existing(spark, [month_folder(landing, m) for m in months])
    path = F.col("file_path")
    month = F.concat_ws("-", F.regexp_extract(path, r"year=(\d{4})/", 1), F.regexp_extract(path, r"month=(\d{2})/", 1))
    listed = seen(spark, landing, months, lambda: list_files(spark, found, PARQUET_ONLY), "file_path")
    return listed.withColumn(MONTH, month)


def empty_files(spark: SparkSession, paths: list[str], only: Column | None = None) -> DataFrame:
    """Paths of the files whose Parquet footer says that they have no rows, each decided by its footer alone.

    Only files of which no row is promised are opened, one after the other, and only their ends are read.  Contents
    that are no Parquet are not empty; an error of the store fails the job, as in any read.
    """
    listing = list_files(spark, paths, PARQUET_ONLY, recursive=True, only=only)
    doubtful = listing.join(promised_rows(spark, paths, only), "file_path", "left_anti")
    empty = [(path,) for path in (r[0] for r in doubtful.select("file_path").toLocalIterator()) if footer_rows(spark, unquote(path)) == 0]
    return spark.createDataFrame(empty, "file_path string")
