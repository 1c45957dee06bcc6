"""Left join to a table that is unique on the join key, safe for hot and for missing keys.

A key that holds a third of the left rows would put a third of the table into one join task.  Such keys
are found exactly, from row counts that pre-aggregate before their shuffle, and get one salt for every
``SLICE_ROWS`` of their rows, or for every ``1 / SLICES`` of all rows where that is more.  The right side is
copied once per salt of a hot key.  Shares add up to one, so there are at most ``SLICES`` hot keys and ``2 * SLICES``
copies, whatever the table size; that bound is what makes the broadcast of the hot keys safe.  Rows with
a missing key match nothing and are spread by a hash of the row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICES = 65_536
SLICE_ROWS = 2_000_000

_SALT = "_salt"
_SALTS = "_salts"


def key_counts(df: DataFrame, on: list[str]) -> DataFrame:
    """Rows per key, as ``n``."""
    return df.groupBy(*on).agg(F.count(F.lit(1)).alias("n"))


def hot_keys(counts: DataFrame, on: list[str], slices: int = SLICES, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Keys with at least ``slice_rows`` rows and ``1 / slices`` of all, and into how many salts to split each.

    At most ``slices`` rows, because their counts add up to no more than the total.
    """
    least = F.greatest(counts.agg(F.sum("n")).scalar() / F.lit(slices), F.lit(float(slice_rows)))
    hot = counts.where(F.col("n") >= least)
    return hot.select(*on, F.ceil(F.col("n") / least).cast("int").alias(_SALTS))


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    values: list[str],
    counts: DataFrame | None = None,
    spread_by: list[str | Column] | None = None,
    slices: int = SLICES,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """``left`` plus the columns ``values`` of ``right``; rows are never multiplied or lost.

    right       unique on ``on``
    counts      rows per key of the left side (key columns and ``n``), when already at hand
    spread_by   columns that tell left rows apart; all left columns by default
    """
    columns = left.columns
    if counts is None:
        counts = key_counts(left, on)
    no_key = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
    hot = F.broadcast(hot_keys(counts.where(~no_key), on, slices, slice_rows))

    row_hash = F.xxhash64(*(spread_by or columns))
    # Every row of a missing key may go anywhere; every row of a cold key goes to salt 0.
    salt = F.when(no_key, row_hash).otherwise(F.coalesce(F.pmod(row_hash, F.col(_SALTS)), F.lit(0)))
    rows = left.join(hot, on, "left").withColumn(_SALT, salt).drop(_SALTS)

    salts = F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col(_SALTS), F.lit(1)).cast("bigint") - 1)
    answers = (
        right.select(*on, *values)
        .join(hot, on, "left")
        .withColumn(_SALT, F.explode(salts))
        .drop(_SALTS)
    )
    return rows.join(answers, [*on, _SALT], "left").select(*columns, *values)
