"""Set operations on month lists and on the bookmark state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odmeter.context import RunContext
from odmeter.schemas import MONTH


def not_completed(months: DataFrame, state: DataFrame) -> DataFrame:
    """Months that the bookmark does not hold as completed."""
    return months.join(state.where("completed").select(MONTH), MONTH, "left_anti")


def months_except(months: DataFrame, state: DataFrame, ctx: RunContext) -> DataFrame:
    """Available, minus completed, minus the current month."""
    return not_completed(months, state).where(F.col(MONTH) != ctx.current_month)


def months_semi(months: DataFrame, state: DataFrame) -> DataFrame:
    """Available months that have a checkpoint."""
    return months.join(state.where(F.col("checkpoint").isNotNull()).select(MONTH), MONTH, "left_semi")
