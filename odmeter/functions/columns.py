"""Scalar derivations: file names, months, clock texts, coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean Earth radius in metres, and the 4-decimal grid of the retry rule.
EARTH_RADIUS_M = 6371008.8
GRID = 10000.0

# Fixed value: prefix that Python loggers put before a message.
LOGGER_PREFIX = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2},\d{3} - (INFO|WARNING|ERROR|DEBUG) - "


def file_hash(file_name: Column, length: int = 8) -> Column:
    """First characters of the MD5 of a file name without any ``.parquet``."""
    return F.substring(F.md5(F.replace(file_name, F.lit(".parquet"), F.lit(""))), 1, length)


def month_of_path(path: Column) -> Column:
    """The innermost ``YYYY-MM`` directory that holds the file, directly or in folders below it, else NULL."""
    found = F.regexp_extract(path, r"^.*/(\d{4}-\d{2})/", 1)
    return F.when(found != "", found)


def year_of(month: Column) -> Column:
    return F.substring(month, 1, 4)


def month_digits(month: Column) -> Column:
    return F.substring(month, 6, 2)


def iso_utc(ts: Column) -> Column:
    """Instant as ``YYYY-MM-DDTHH:MM:SS.ffffff+00:00`` whatever the session zone."""
    utc = F.to_utc_timestamp(ts, F.current_timezone())
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def rounded(coordinate: Column) -> Column:
    """Four decimals, ties to even: scale, round to the nearest integer, scale back."""
    return F.rint(coordinate * GRID) / GRID


def grid_cell(coordinate: Column) -> Column:
    """The same rounding as an integer, which is a safe join key; NULL for NaN and for infinity."""
    scaled = F.rint(coordinate * GRID)
    return F.when(F.abs(scaled) < 1e18, scaled).cast("bigint")


def missing(coordinate: Column) -> Column:
    return coordinate.isNull() | F.isnan(coordinate)


def any_missing(names: list[str]) -> Column:
    found = F.lit(False)
    for name in names:
        found = found | missing(F.col(name))
    return found


def great_circle_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Haversine distance in metres."""
    half_dlat = F.radians(lat2 - lat1) / 2
    half_dlon = F.radians(lon2 - lon1) / 2
    a = F.sin(half_dlat) * F.sin(half_dlat) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(
        half_dlon
    ) * F.sin(half_dlon)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def percent(part: Column, whole: Column) -> Column:
    """Share in percent, two decimals; NULL when there is nothing to divide by."""
    return F.round(F.try_divide(part * 100.0, whole), 2)


def strip_logger_prefix(line: Column) -> Column:
    return F.regexp_replace(line, LOGGER_PREFIX, "")
