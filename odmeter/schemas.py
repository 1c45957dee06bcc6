"""Column names and explicit schemas."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Column names of the source and landing tables.
KEY = "order_number"
START = ["poc_longitude", "poc_latitude"]
END = ["order_longitude", "order_latitude"]
PAIR = START + END

MONTH = "partition_month"


def _struct(**columns) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns.items()])


OD = _struct(**{KEY: StringType()}, **{c: DoubleType() for c in PAIR})

LANDING = _struct(
    order_number=StringType(),
    distance=DoubleType(),
    duration=DoubleType(),
    ingestion_date=StringType(),
    processing_timestamp=StringType(),
    source_file=StringType(),
    year=StringType(),
    month=StringType(),
)

MANIFEST = _struct(
    partition_month=StringType(),
    file_path=StringType(),
    file_time=TimestampType(),
    mode=StringType(),
    rows=LongType(),
    run_ts=StringType(),
    batch=StringType(),
)

BOOKMARK = _struct(
    completed_partitions=ArrayType(StringType()),
    delta_timestamps=MapType(StringType(), StringType()),
    last_updated=StringType(),
)


def require_columns(df: DataFrame, names: Iterable[str], what: str = "input") -> DataFrame:
    """Fail early, naming every missing column."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks required columns {missing}; it has {df.columns}")
    return df
