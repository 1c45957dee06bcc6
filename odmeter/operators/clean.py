"""Projection, lineage and row filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odmeter.context import RunContext
from odmeter.functions import columns as C
from odmeter.schemas import END, KEY, MONTH, PAIR, START, require_columns

# The country box, degrees.
BBOX = {"lat": (-34.0, 5.0), "lon": (-74.0, -34.0)}


def select_od(df: DataFrame, keep: list[str] = (), key: str = KEY, on_bad_number: str = "raise") -> DataFrame:
    """Key, four coordinates as doubles, and the columns named in ``keep``.

    A text that is no number raises; with ``on_bad_number="reject"`` it becomes NULL, so that
    ``drop_missing_coords`` removes the row.
    """
    require_columns(df, [key, *PAIR, *keep], "origin-destination table")
    if on_bad_number not in ("raise", "reject"):
        raise ValueError("on_bad_number is 'raise' or 'reject'")

    def number(name: str) -> Column:
        c = F.col(name)
        return (c.cast("double") if on_bad_number == "raise" else c.try_cast("double")).alias(name)

    return df.select(F.col(key).cast("string").alias(key), *[number(c) for c in PAIR], *keep)


def drop_missing_coords(df: DataFrame) -> DataFrame:
    """Drop rows in which any coordinate is NULL or NaN."""
    return df.na.drop(subset=PAIR)


def within_bbox(df: DataFrame, box: dict = BBOX, both_points: bool = False) -> DataFrame:
    """Keep start points inside the box, edges included; with ``both_points`` end points too."""

    def inside(point: list[str]) -> Column:
        lon, lat = point
        return F.col(lat).between(*box["lat"]) & F.col(lon).between(*box["lon"])

    return df.where(inside(START) & inside(END) if both_points else inside(START))


def with_lineage(df: DataFrame, ctx: RunContext, source_file: Column | None = None) -> DataFrame:
    """Run date, run time and, when given, the source file name."""
    stamps = {"ingestion_date": F.lit(ctx.run_date), "processing_timestamp": F.lit(ctx.run_ts)}
    if source_file is not None:
        stamps["source_file"] = source_file
    return df.withColumns(stamps)


def with_file_hash(df: DataFrame, file_name: str = "source_file") -> DataFrame:
    return df.withColumn("file_hash", C.file_hash(F.col(file_name)))


def with_year_month(df: DataFrame, month: str = MONTH) -> DataFrame:
    return df.withColumns({"year": C.year_of(F.col(month)), "month": C.month_digits(F.col(month))})


def with_rounded_coords(df: DataFrame) -> DataFrame:
    return df.withColumns({c: C.rounded(F.col(c)) for c in PAIR})


def output_file_label(df: DataFrame, file_hash="file_hash", file_seq="file_seq", block="block_id") -> DataFrame:
    """``part-<hash>-<file, 3 digits>-<block, 5 digits>`` as a column."""
    return df.withColumn("output_file", F.format_string("part-%s-%03d-%05d", file_hash, file_seq, block))


def months_with_prefix(df: DataFrame, prefixes: list[str], month: str = MONTH) -> DataFrame:
    kept = F.lit(False)
    for prefix in prefixes:
        kept = kept | F.col(month).startswith(prefix)
    return df.where(kept)


def drop_unrouted(df: DataFrame) -> DataFrame:
    return df.where(F.col("distance").isNotNull())


def union_files(*tables: DataFrame) -> DataFrame:
    """Bag union by column name; a column that a table lacks is NULL there."""
    first, *rest = tables
    for table in rest:
        first = first.unionByName(table, allowMissingColumns=True)
    return first
