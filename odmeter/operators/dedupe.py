"""Keep-first de-duplication, its report, and the anti-join with landed keys.

``keep_first`` is ``row_number() = 1``.  Spark turns that into a group limit that runs *before* the
shuffle too: every map task sends at most one row per key, so a key that holds a third of the table
costs one row per task in the exchange and its final group is as small as the number of tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odmeter.functions import columns as C
from odmeter.schemas import KEY, MONTH, PAIR

SOURCE_ORDER = ["file_time", "file_path", "row_index"]
_RANK = "_keep_first_rank"


def keep_first(df: DataFrame, keys: list[str | Column], order: list[str | Column]) -> DataFrame:
    """First row per key.  ``order`` must be total, so that the survivor is always the same row.

    NULL keys count as equal to each other.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def _valid_first(order: list[str | Column], prefer_valid: bool) -> list[str | Column]:
    return [C.any_missing(PAIR), *order] if prefer_valid else list(order)


def dedupe_within_file(
    df: DataFrame,
    order: list[str | Column],
    file_cols: list[str] = (MONTH, "source_file"),
    key: str = KEY,
    prefer_valid: bool = False,
) -> DataFrame:
    """One row per key inside each source file.

    It runs before rows without coordinates are dropped: a first copy without coordinates removes a
    later good one.  ``prefer_valid`` ranks complete copies first instead.
    """
    return keep_first(df, [*file_cols, key], _valid_first(order, prefer_valid))


def dedupe_batch(df: DataFrame, order: list[str | Column], key: str = KEY, scope: str = "month") -> DataFrame:
    """One row per key over all files of a run: per month, or with ``scope="table"`` overall."""
    return keep_first(df, _scope_keys(key, scope), order)


def dedupe_month(df: DataFrame, key: str = KEY, scope: str = "month", order: list[str] | None = None) -> DataFrame:
    """One row per key over a landed month.

    The default order is the landing lineage and then every remaining column, which makes it total up
    to identical rows.
    """
    keys = _scope_keys(key, scope, df)
    if order is None:
        lineage = [c for c in ("ingestion_date", "processing_timestamp", "source_file") if c in df.columns]
        order = lineage + [c for c in df.columns if c not in lineage and c not in keys]
    return keep_first(df, keys, order)


def _scope_keys(key: str, scope: str, df: DataFrame | None = None) -> list[str]:
    if scope == "table":
        return [key]
    if scope != "month":
        raise ValueError("scope is 'month' or 'table'")
    if df is not None and MONTH not in df.columns:
        return ["year", "month", key]
    return [MONTH, key]


def dedupe_report(df: DataFrame, by: list[str] = (MONTH,), key: str = KEY) -> DataFrame:
    """Rows before and after keep-first, removed rows and their share, per group.

    Counting pre-aggregates by (group, key), so a hot key is one row per map task in the shuffle.  The
    NULL key counts as one key.
    """
    per_key = df.groupBy(*by, key).agg(F.count(F.lit(1)).alias("n"))
    counted = per_key.groupBy(*by).agg(
        F.sum("n").alias("rows_before"), F.count(F.lit(1)).alias("rows_after")
    )
    removed = F.col("rows_before") - F.col("rows_after")
    return counted.withColumns({"rows_removed": removed, "removed_pct": C.percent(removed, F.col("rows_before"))})


def duplicates_removed_total(report: DataFrame) -> DataFrame:
    return report.agg(F.coalesce(F.sum("rows_removed"), F.lit(0)).alias("rows_removed"))


def with_key_parts(df: DataFrame, key: str = KEY) -> DataFrame:
    """Key as two non-null columns, so that NULL equals NULL in a plain equi-join.

    Grouping and joining on the same two columns lets one shuffle serve both.
    """
    return df.withColumns({"_key": F.coalesce(F.col(key), F.lit("")), "_key_is_null": F.col(key).isNull()})


def anti_join_existing(
    new: DataFrame, existing: DataFrame, key: str = KEY, within: list[str] = (MONTH,)
) -> DataFrame:
    """Rows of ``new`` whose key has not landed in the same month; a NULL key matches a NULL key.

    ``new`` may be raw rows with hot keys.  Both sides are shuffled once and joined as they are, without a
    distinct of the landed keys, so that adaptive execution can split a skewed partition of ``new``.
    """
    return _not_landed(with_key_parts(new, key), existing, key, within).select(*new.columns)


def _not_landed(keyed: DataFrame, existing: DataFrame, key: str, within: list[str]) -> DataFrame:
    on = [*within, "_key", "_key_is_null"]
    return keyed.join(with_key_parts(existing, key).select(*on), on, "left_anti")


def dedupe_batch_against(
    new: DataFrame,
    existing: DataFrame,
    order: list[str | Column],
    key: str = KEY,
    within: list[str] = (MONTH,),
    between: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """``anti_join_existing``, then ``between``, then ``dedupe_batch``.

    Landed keys go first, so that nothing is done for rows that cannot land.  Where ``between`` does not
    shuffle, the anti-join and the keep-first share one shuffle of the new rows.
    """
    fresh = between(_not_landed(with_key_parts(new, key), existing, key, within))
    first = keep_first(fresh, [*within, "_key", "_key_is_null"], order)
    return first.drop("_key", "_key_is_null")
