"""Work queue: which months to run, in which order and mode."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from odmeter.context import RunContext
from odmeter.plans.bookmark import CURRENT, HISTORICAL, PREVIOUS, SKIP
from odmeter.schemas import MONTH


@dataclass(frozen=True)
class MonthTask:
    """One month of the queue."""

    month: str
    mode: str
    checkpoint_us: int | None

    @property
    def incremental(self) -> bool:
        return self.mode in (CURRENT, PREVIOUS)


@dataclass(frozen=True)
class FileUnit:
    """A run of a month's files in order of (file time in microseconds, path), both ends included."""

    month: str
    first: tuple[int, str]
    last: tuple[int, str]
    closes: bool


def file_units(files: DataFrame, unit_bytes: int) -> list[FileUnit]:
    """The files of a listing in units of about ``unit_bytes``, month by month, in order of time and path.

    Files of one time stay together, because a checkpoint is a time.  A month's listing is numbered in a window; only the ends of the units
    come to the driver.
    """
    order = Window.partitionBy(MONTH).orderBy("file_time")
    before = F.sum("file_size").over(order.rangeBetween(Window.unboundedPreceding, Window.currentRow)) - F.sum("file_size").over(
        Window.partitionBy(MONTH, "file_time")
    )
    placed = files.withColumn("unit", F.floor(before / F.lit(unit_bytes)))
    place = F.struct(F.unix_micros("file_time").alias("t"), F.col("file_path").alias("p"))
    ends = placed.groupBy(MONTH, "unit").agg(F.min(place).alias("first"), F.max(place).alias("last")).orderBy(MONTH, "unit").collect()
    return [
        FileUnit(r[MONTH], tuple(r["first"]), tuple(r["last"]), after is None or after[MONTH] != r[MONTH])
        for r, after in zip(ends, [*ends[1:], None])
    ]


def with_mode(
    months: DataFrame,
    state: DataFrame,
    ctx: RunContext,
    previous_month_rule: bool = True,
    skip_completed: bool = False,
) -> DataFrame:
    """Adds ``mode`` and ``checkpoint`` to each available month.

    The current month, and the previous one while it has a checkpoint, run incrementally even when they
    are completed; with ``skip_completed`` a completed month is always skipped.
    """
    known = months.select(MONTH).distinct().join(state.select(MONTH, "completed", "checkpoint"), MONTH, "left")
    completed = F.coalesce("completed", F.lit(False))
    mode = F.when(completed & F.lit(skip_completed), SKIP).when(F.col(MONTH) == ctx.current_month, CURRENT)
    if previous_month_rule:
        follows = (F.col(MONTH) == ctx.previous_month) & F.col("checkpoint").isNotNull()
        mode = mode.when(follows, PREVIOUS)
    mode = mode.when(completed, SKIP).otherwise(HISTORICAL)
    return known.select(MONTH, mode.alias("mode"), "checkpoint")


def plan_work(
    months: DataFrame,
    state: DataFrame,
    ctx: RunContext,
    previous_month_rule: bool = True,
    skip_completed: bool = False,
) -> DataFrame:
    """Ordered queue: historical months ascending, then the previous month, then the current one.

    ``seq`` starts at 0.  The queue has one row per calendar month, so one window over it is small.
    """
    labelled = with_mode(months, state, ctx, previous_month_rule, skip_completed).where(F.col("mode") != SKIP)
    rank = F.when(F.col("mode") == HISTORICAL, 0).when(F.col("mode") == PREVIOUS, 1).otherwise(2)
    seq = F.row_number().over(Window.orderBy(rank, MONTH)) - 1
    return labelled.withColumn("seq", seq.cast("bigint"))


def collect_tasks(plan: DataFrame) -> list[MonthTask]:
    """The queue on the driver: at most one row per calendar month."""
    rows = plan.orderBy("seq").select(MONTH, "mode", F.unix_micros("checkpoint").alias("us")).collect()
    return [MonthTask(r[MONTH], r["mode"], r["us"]) for r in rows]


def after_checkpoint(df: DataFrame, plan: DataFrame, file_time: str = "file_time") -> DataFrame:
    """Rows of planned months: all for a historical month, else only those newer than the checkpoint.

    This form joins rows (or a listing) to the plan, which has one row per calendar month.  Reading
    files, use ``sources.files.read_delta``, which skips whole files.
    """
    wanted = plan.select(MONTH, "mode", "checkpoint")
    fresh = (
        (F.col("mode") == HISTORICAL) | F.col("checkpoint").isNull() | (F.col(file_time) > F.col("checkpoint"))
    )
    return df.join(F.broadcast(wanted), MONTH).where(fresh).drop("mode", "checkpoint")
