"""The bookmark: what is completed, and up to which file time the other months are read.

State is an aggregate over an append-only manifest with one row per processed file.  Nothing is read,
changed and written back, so the state cannot go backwards and a repeated run does no harm.

``compact_manifest`` takes what has been appended (the tail, small files) into a history of large files and a snapshot of few rows;
``read_state`` reads the snapshot and the tail alone.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from odmeter.functions import columns as C
from odmeter.schemas import BOOKMARK, MANIFEST, MONTH
from odmeter.sinks.views import latest_version, put_version
from odmeter.sources.paths import Folder, existing

# Job types of a month.
HISTORICAL = "HISTORICAL"
CURRENT = "INCREMENTAL_CURRENT"
PREVIOUS = "INCREMENTAL_PREVIOUS"
SKIP = "SKIP"
STREAM = "STREAM"
#: a file of a month that is read in units and not yet complete; it neither closes the month nor moves its checkpoint
PART = "PART"


def bookmark_state(manifest: DataFrame) -> DataFrame:
    """One row per month: ``completed``, ``checkpoint``, ``last_updated``.

    A HISTORICAL commit completes the month and removes its checkpoint.  The checkpoint is the latest
    file time of the other commits from then on, so a lower time changes nothing.
    """
    historical = F.col("mode") == HISTORICAL
    per_run = manifest.where(F.col("mode") != PART).groupBy(MONTH, "mode", "run_ts").agg(F.max("file_time").alias("file_time"))
    closed = F.max(F.when(historical, F.col("run_ts"))).over(Window.partitionBy(MONTH))
    open_since = ~historical & (F.col("_closed").isNull() | (F.col("run_ts") >= F.col("_closed")))
    return (
        per_run.withColumn("_closed", closed)
        .groupBy(MONTH)
        .agg(
            F.bool_or(historical).alias("completed"),
            F.max(F.when(open_since, F.col("file_time"))).alias("checkpoint"),
            F.max("run_ts").alias("last_updated"),
        )
    )


def bookmark_document(state: DataFrame) -> DataFrame:
    """The state as one row: sorted completed months, map of checkpoints, time of the last change.

    The state has one row per calendar month.
    """
    open_month = F.when(
        F.col("checkpoint").isNotNull(), F.struct(F.col(MONTH), C.iso_utc(F.col("checkpoint")).alias("ts"))
    )
    return state.agg(
        F.array_sort(F.collect_list(F.when(F.col("completed"), F.col(MONTH)))).alias("completed_partitions"),
        F.map_from_entries(F.array_sort(F.collect_list(open_month))).alias("delta_timestamps"),
        F.max("last_updated").alias("last_updated"),
    )


def read_bookmark(spark: SparkSession, path: str) -> DataFrame:
    """A bookmark document as state rows, to take over old state.

    No file means no rows; a file that cannot be parsed raises.
    """
    if existing(spark, [path]):
        document = spark.read.schema(BOOKMARK).option("multiLine", True).option("mode", "FAILFAST").json(path)
    else:
        document = spark.createDataFrame([], BOOKMARK)
    done = document.select(F.explode("completed_partitions").alias(MONTH), "last_updated").withColumns(
        {"completed": F.lit(True), "checkpoint": F.lit(None).cast("timestamp")}
    )
    started = document.select(F.explode("delta_timestamps").alias(MONTH, "ts"), "last_updated").select(
        MONTH, "last_updated", F.lit(False).alias("completed"), F.to_timestamp("ts").alias("checkpoint")
    )
    return (
        done.unionByName(started)
        .groupBy(MONTH)
        .agg(
            F.bool_or("completed").alias("completed"),
            F.max("checkpoint").alias("checkpoint"),
            F.max("last_updated").alias("last_updated"),
        )
    )


def manifest_of(state: DataFrame) -> DataFrame:
    """State rows as manifest rows without files, for ``append_manifest``."""
    done = state.where("completed").select(MONTH, F.lit(HISTORICAL).alias("mode"), "last_updated")
    started = state.where(F.col("checkpoint").isNotNull()).select(
        MONTH, F.lit(CURRENT).alias("mode"), "last_updated", F.col("checkpoint").alias("file_time")
    )
    return done.unionByName(started, allowMissingColumns=True).select(
        MONTH,
        F.lit(None).cast("string").alias("file_path"),
        "file_time",
        "mode",
        F.lit(None).cast("bigint").alias("rows"),
        F.col("last_updated").alias("run_ts"),
    )


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest table, every row of it; a missing one is the empty, reset state."""
    return _with_tail(spark, path, lambda snapshot: snapshot.history)


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """``bookmark_state`` of a manifest, from its latest snapshot and what has been appended since: history is not read."""
    return bookmark_state(_with_tail(spark, path, lambda snapshot: [snapshot.rows] if snapshot.rows else []))


def append_manifest(rows: DataFrame, path: str) -> None:
    """Appends commit rows; call it only after the data of the same files has been written.

    Columns of the manifest that ``rows`` lacks are NULL.
    """
    absent = {f.name: F.lit(None).cast(f.dataType) for f in MANIFEST if f.name not in rows.columns}
    rows.withColumns(absent).select(*MANIFEST.fieldNames()).hint("rebalance").write.mode("append").parquet(path)


@dataclass(frozen=True)
class Snapshot:
    """What has been taken out of the tail: ``rows`` is the folder of the state, ``history`` those of all commit rows.

    ``covered`` are the tail files that both hold; those still there are passed over.
    """

    version: int = 0
    rows: str | None = None
    history: list[str] = field(default_factory=list)
    covered: list[str] = field(default_factory=list)


def state_rows(manifest: DataFrame) -> DataFrame:
    """The fewest rows with the same ``bookmark_state``, now and after any later commits: of each month the last closing, and one row for
    each run since with its latest file time.
    """
    per_run = manifest.where(F.col("mode") != PART).groupBy(MONTH, "mode", "run_ts").agg(
        F.max("file_time").alias("file_time"), F.sum("rows").alias("rows")
    )
    historical = F.col("mode") == HISTORICAL
    closed = F.max(F.when(historical, F.col("run_ts"))).over(Window.partitionBy(MONTH))
    kept = per_run.withColumn("_closed", closed).where(F.col("_closed").isNull() | (F.col("run_ts") >= F.col("_closed")))
    absent = {f.name: F.lit(None).cast(f.dataType) for f in MANIFEST if f.name not in kept.columns}
    return kept.withColumns(absent).select(*MANIFEST.fieldNames())


def compact_manifest(spark: SparkSession, path: str) -> int:
    """Takes the tail into history and a new snapshot; returns how many files it had.

    Files that are appended meanwhile stay in the tail.  The snapshot is put in one step; a crash before leaves all as it was, and one
    after it only files that readers pass over.  One compaction at a time; a second one raises ``ViewTaken``.
    """
    folder = Folder(spark, path)
    was = _snapshot(folder, path)
    tail = [n for n in folder.sizes(path) if n not in was.covered]
    if not tail:
        return 0
    root, number = _snapshots(path), was.version + 1
    unique = uuid.uuid4().hex
    rows, history = f"{root}/rows-{unique}", f"{root}/history-{unique}"
    commits = spark.read.schema(MANIFEST).parquet(*(f"{path}/{n}" for n in tail))
    commits.hint("rebalance").write.parquet(history)
    old = [spark.read.schema(MANIFEST).parquet(was.rows)] if was.rows else []
    everything = reduce(DataFrame.unionByName, [spark.read.schema(MANIFEST).parquet(history), *old])
    state_rows(everything).hint("rebalance").write.parquet(rows)
    now = Snapshot(number, rows, [*was.history, history], tail)
    put_version(folder, f"{root}/versions", number, json.dumps(asdict(now)))
    for name in [*tail, *was.covered]:
        folder.delete(f"{path}/{name}")
    return len(tail)


def _snapshots(path: str) -> str:
    return f"{path.rstrip('/')}__snapshot"


def _snapshot(folder: Folder, path: str) -> Snapshot:
    text = latest_version(folder, f"{_snapshots(path)}/versions")[1]
    return Snapshot(**json.loads(text)) if text else Snapshot()


def _with_tail(spark: SparkSession, path: str, parts: Callable[[Snapshot], list[str]]) -> DataFrame:
    """Some folders of the snapshot and the tail.  If a compaction came between the look at it and the listing, both are done again."""
    folder = Folder(spark, path)
    while True:
        snapshot = _snapshot(folder, path)
        tail = [f"{path}/{n}" for n in folder.sizes(path) if n not in snapshot.covered]
        found = [*parts(snapshot), *tail]
        rows = spark.read.schema(MANIFEST).parquet(*found) if found else spark.createDataFrame([], MANIFEST)
        if _snapshot(folder, path) == snapshot:
            return rows
