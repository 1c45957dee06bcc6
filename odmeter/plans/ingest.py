"""One ingest run: plan, read new files, de-duplicate, enrich, anti-join, append, commit."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from odmeter.context import RunContext
from odmeter.operators import clean
from odmeter.operators.dedupe import SOURCE_ORDER, anti_join_existing, dedupe_batch_against, dedupe_within_file
from odmeter.operators.enrich import Route, enrich_geodesic, enrich_routes, enrich_with
from odmeter.operators.route_index import RouteIndex
from odmeter.plans.bookmark import HISTORICAL, PART, append_manifest, read_manifest, read_state
from odmeter.plans.work import FileUnit, MonthTask, collect_tasks, file_units, plan_work
from odmeter.reports.quality import quality_measures, throughput
from odmeter.schemas import LANDING, MONTH
from odmeter.session import cut_lineage
from odmeter.sinks.landing import BLOCK_ROWS, write_landing
from odmeter.sources.files import (
    FILE_COLUMNS,
    delta_filter,
    empty_files,
    list_delta,
    list_partitions,
    read_delta,
    read_existing_keys,
    read_landing,
    stage_scan,
    unread_files,
    with_rows_read,
)

# (rows to enrich, scanned rows that hold at least their pairs and no landed key) -> rows with distance and duration
Enrich = Callable[[DataFrame, DataFrame], DataFrame]


def by_routes(routes: DataFrame | RouteIndex) -> Enrich:
    """Enrichment from a route table; its pair branch reads the scan less landed keys, not the de-duplicated rows."""
    return lambda rows, scanned: enrich_routes(rows, routes, pairs_of=scanned)


def by_estimate(**options: float) -> Enrich:
    return lambda rows, scanned: enrich_geodesic(rows, **options)


def by_provider(connect: Callable[[], Route], callers: int, **options) -> Enrich:
    """Enrichment by a caller's routing function; only pairs that are left after cleaning are asked."""
    return lambda rows, scanned: enrich_with(rows, connect, callers, **options)


# Source bytes after which a run commits what it has landed; a larger month is read in units of its files.
COMMIT_BYTES = 256 << 30


@dataclass
class IngestOptions:
    """What may differ between runs; the defaults follow the production rule.

    schema         types of the source columns; by default those of the files
    commit_bytes   months are landed and committed in steps of about so many source bytes, so that a run that is
                   cut off goes on after its last step
    unit_bytes     a month above so many source bytes is read in units of its files, each committed by itself
    """

    years: list[str] | None = None
    previous_month_rule: bool = True
    skip_completed: bool = False
    prefer_valid: bool = False
    bbox: dict | None = None
    on_bad_number: str = "raise"
    tolerant: bool = False
    schema: StructType | None = None
    commit_bytes: int = COMMIT_BYTES
    unit_bytes: int = COMMIT_BYTES
    max_records: int | None = BLOCK_ROWS


@dataclass
class IngestReport:
    """Outcome of a run, for logs and for month maintenance.

    ``held_back`` are months with unreadable files; those of them that are committed up to the first such file are in
    ``partly`` too.
    """

    tasks: list[MonthTask]
    rows: int = 0
    quality: dict = field(default_factory=dict)
    seconds: float = 0.0
    committed: list[str] = field(default_factory=list)
    held_back: list[str] = field(default_factory=list)
    partly: list[str] = field(default_factory=list)

    @property
    def months(self) -> list[str]:
        return [t.month for t in self.tasks]

    @property
    def rows_per_second(self) -> float | None:
        return throughput(self.rows, self.seconds)


def prepare(scanned: DataFrame, options: IngestOptions, order: list[str] = SOURCE_ORDER) -> DataFrame:
    """Keep-first inside each file, then complete coordinates; the order of the two matters."""
    first = dedupe_within_file(scanned, order, prefer_valid=options.prefer_valid)
    rows = clean.drop_missing_coords(first)
    return rows if options.bbox is None else clean.within_bbox(rows, options.bbox)


def ingest_rows(
    scanned: DataFrame,
    existing: DataFrame,
    enrich: Enrich,
    ctx: RunContext,
    options: IngestOptions | None = None,
    order: list[str] = SOURCE_ORDER,
) -> DataFrame:
    """The whole row pipeline, for batches and for micro-batches: routed rows that are new in their month, with
    lineage and partition columns.

    Rows whose key has landed go before enrichment: nothing is looked up or asked for them.
    """
    options = options or IngestOptions()
    od = clean.select_od(scanned, FILE_COLUMNS, on_bad_number=options.on_bad_number)
    new = dedupe_batch_against(
        prepare(od, options, order), existing, order, between=lambda rows: clean.drop_unrouted(enrich(rows, anti_join_existing(od, existing)))
    )
    return clean.with_year_month(clean.with_lineage(new, ctx)).select(*LANDING.fieldNames())


def ingest_batch(
    spark: SparkSession,
    source: str,
    landing: str,
    manifest: str,
    ctx: RunContext,
    enrich: Enrich,
    options: IngestOptions | None = None,
) -> IngestReport:
    """Runs the planned months in order, in steps of ``commit_bytes``, and commits each step.

    The commit follows the write.  A crash between the two makes the next run read the same files again,
    and the anti-join keeps that from adding rows.
    """
    options = options or IngestOptions()
    started = time.monotonic()
    state = read_state(spark, manifest)
    months = list_partitions(spark, source, options.years)
    plan = plan_work(months, state, ctx, options.previous_month_rule, options.skip_completed)
    tasks = collect_tasks(plan)
    report = IngestReport(tasks)
    if not tasks:
        return report

    delta = list_delta(spark, source, tasks)
    sizes = {r[MONTH]: r["size"] for r in delta.groupBy(MONTH).agg(F.sum("file_size").alias("size")).collect()}
    counts = RunCounts()
    for step in commit_steps(tasks, sizes, options.commit_bytes):
        with_files = [t for t in step if t.month in sizes]
        if len(with_files) == 1 == len(step) and sizes[step[0].month] > options.unit_bytes:
            _ingest_units(spark, source, landing, manifest, step[0], ctx, enrich, options, report, counts)
            continue
        files = delta.where(F.col(MONTH).isin([t.month for t in with_files]))
        if with_files:
            files = _land(spark, source, landing, with_files, files, ctx, enrich, options, counts)
        commit_months(spark, source, landing, manifest, step, files, set(sizes), ctx, report, options.tolerant)
    if sizes:
        report.quality, report.rows = counts.totals, counts.totals["rows"]
    report.seconds = time.monotonic() - started
    return report


class RunCounts:
    """Rows, missing and zero distances of a run, seen as they are written."""

    def __init__(self):
        self.totals = {"rows": 0, "nan_distances": 0, "zero_distances": 0}

    def write(self, rows: DataFrame, landing: str, max_records: int | None) -> None:
        seen = Observation()
        write_landing(rows.observe(seen, *quality_measures()), landing, max_records)
        for name, value in _observed(seen).items():
            self.totals[name] += value or 0


def _observed(seen: Observation) -> dict:
    """What was observed; nothing where Spark has found at run time that there is no row and has dropped the plan with its measures."""
    try:
        return seen.get
    except Py4JJavaError as problem:
        if "toPyRow" not in str(problem):
            raise
        return {}


def _land(
    spark: SparkSession,
    source: str,
    landing: str,
    tasks: list[MonthTask],
    files: DataFrame,
    ctx: RunContext,
    enrich: Enrich,
    options: IngestOptions,
    counts: RunCounts,
    unit: FileUnit | None = None,
) -> DataFrame:
    """Reads, prepares and appends the rows of some months, or of a unit; returns the listing, after a tolerant read with ``rows_read``."""
    scanned = read_delta(spark, source, tasks, options.schema, options.tolerant, unit)
    if options.tolerant:
        scanned = stage_scan(scanned)
        files = with_rows_read(files, scanned)
    existing = read_existing_keys(spark, landing, [t.month for t in tasks])
    counts.write(ingest_rows(scanned, existing, enrich, ctx, options), landing, options.max_records)
    return files


def _ingest_units(
    spark: SparkSession,
    source: str,
    landing: str,
    manifest: str,
    task: MonthTask,
    ctx: RunContext,
    enrich: Enrich,
    options: IngestOptions,
    report: IngestReport,
    counts: RunCounts,
) -> None:
    """One large month in units of its files, in order; each is committed before the next is read.

    Files that an earlier run has committed as parts, unchanged, are left out.  A historical month is closed when all of its files are
    in; an incremental one moves its checkpoint with each unit.  A unit with an unreadable file ends the month's turn.
    """
    done = read_manifest(spark, manifest).where((F.col(MONTH) == task.month) & (F.col("mode") == PART))
    files = list_delta(spark, source, [task])
    todo = cut_lineage(files.join(done.select("file_path", "file_time").distinct(), ["file_path", "file_time"], "left_anti"))
    part = MonthTask(task.month, PART if task.mode == HISTORICAL else task.mode, task.checkpoint_us)
    for unit in file_units(todo, options.unit_bytes):
        place = F.struct(F.unix_micros("file_time").alias("t"), F.col("file_path").alias("p"))
        first, last = (F.struct(F.lit(t).cast("bigint").alias("t"), F.lit(p).alias("p")) for t, p in (unit.first, unit.last))
        own = todo.where((place >= first) & (place <= last))
        own = _land(spark, source, landing, [task], own, ctx, enrich, options, counts, unit)
        commit_months(spark, source, landing, manifest, [part], own, {task.month}, ctx, report, options.tolerant)
        if task.month in report.held_back:
            break
    else:
        if task.mode == HISTORICAL:
            close_months(spark, manifest, [task], ctx)


def close_months(spark: SparkSession, manifest: str, tasks: list[MonthTask], ctx: RunContext) -> None:
    """Marks historical months as complete whose files are all committed as parts."""
    markers = spark.createDataFrame([(t.month, HISTORICAL, ctx.run_ts) for t in tasks], f"{MONTH} string, mode string, run_ts string")
    append_manifest(markers, manifest)


def commit_steps(tasks: list[MonthTask], sizes: dict[str, int], commit_bytes: int) -> list[list[MonthTask]]:
    """The queue cut, in order, where a step has reached ``commit_bytes``; at least one month each."""
    steps: list[list[MonthTask]] = [[]]
    held = 0
    for task in tasks:
        size = sizes.get(task.month, 0)
        if steps[-1] and held + size > commit_bytes:
            steps.append([])
            held = 0
        steps[-1].append(task)
        held += size
    return steps


def landed_by(spark: SparkSession, landing: str, tasks: list[MonthTask], ctx: RunContext) -> DataFrame:
    """Rows that this run has landed.  A file holds one run time, so older files are skipped by their statistics."""
    rows = read_landing(spark, landing, [t.month for t in tasks])
    return rows.where(F.col("processing_timestamp") == ctx.run_ts)


def commit_months(
    spark: SparkSession,
    source: str,
    landing: str,
    manifest: str,
    tasks: list[MonthTask],
    delta: DataFrame,
    has_files: set[str],
    ctx: RunContext,
    report: IngestReport,
    tolerant: bool,
) -> None:
    """Appends one manifest row per processed file, and a marker for historical months without files.

    Where files were left out by a tolerant read, an incremental month is committed only up to the first
    of them and a historical month not at all.  An incremental month without new files gets no row.
    """
    has_files = {t.month for t in tasks} & has_files
    modes = F.create_map(*[F.lit(text) for t in tasks for text in (t.month, t.mode)])
    files = delta.withColumn("mode", modes[F.col(MONTH)])

    if tolerant:
        with_files = [t for t in tasks if t.month in has_files]
        paths, only = [f"{source}/{t.month}" for t in with_files], delta_filter(with_files)
        if with_files:
            unread = unread_files(spark, delta, paths, only).join(empty_files(spark, paths, only), "file_path", "left_anti")
            first_bad = cut_lineage(unread.groupBy(MONTH).agg(F.min("file_time").alias("_first_bad")))
            held = [r[MONTH] for r in first_bad.select(MONTH).collect()]  # one row per month
            files = files.join(F.broadcast(first_bad), MONTH, "left").where(
                F.col("_first_bad").isNull() | ((F.col("mode") != HISTORICAL) & (F.col("file_time") < F.col("_first_bad")))
            )
            report.held_back = sorted({*report.held_back, *held})
            report.partly = sorted({*report.partly, *(r[MONTH] for r in files.where(F.col(MONTH).isin(held)).select(MONTH).distinct().collect())})

    landed = (
        landed_by(spark, landing, tasks, ctx)
        .groupBy(F.concat_ws("-", "year", "month").alias(MONTH), F.col("source_file").alias("file_name"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    commits = files.join(landed, [MONTH, "file_name"], "left").select(
        MONTH, "file_path", "file_time", "mode", F.coalesce("rows", F.lit(0)).alias("rows")
    )

    closed = [(t.month, HISTORICAL) for t in tasks if t.mode == HISTORICAL and t.month not in has_files]
    if closed:
        markers = spark.createDataFrame(closed, f"{MONTH} string, mode string")
        commits = commits.unionByName(markers, allowMissingColumns=True)
    append_manifest(commits.withColumn("run_ts", F.lit(ctx.run_ts)), manifest)
    done = (has_files | {m for m, _ in closed}) - set(report.held_back)
    report.committed = sorted({*report.committed, *done})

