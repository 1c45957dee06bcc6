"""Daily pick-up of new files as a file-source stream.

The stream checkpoint remembers which files were read, also late ones in older month directories.  Spark would
pass over files that are older, by modification time, than the newest one seen less ``maxFileAge`` (a week by
default); here that age is ``MAX_FILE_AGE``, longer than any history.  Keys
already landed live in the landing table, not in stream state: each micro-batch is anti-joined with the
months it touches, so state does not grow and a replayed batch adds nothing.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from odmeter.context import RunContext
from odmeter.plans.bookmark import STREAM, append_manifest, read_manifest
from odmeter.plans.ingest import Enrich, IngestOptions, ingest_rows
from odmeter.schemas import MONTH, OD
from odmeter.session import cut_lineage
from odmeter.sinks.landing import write_landing
from odmeter.sources.paths import Folder
from odmeter.sources.files import (
    PARQUET_ONLY,
    marked_schema,
    month_glob,
    read_existing_keys,
    read_landing,
    with_file_columns,
)


#: Files older than the newest one by more than this are passed over by the stream.
MAX_FILE_AGE = "36500d"


def read_od_stream(
    spark: SparkSession,
    source: str,
    schema: StructType = OD,
    max_files: int | None = None,
    max_file_age: str = MAX_FILE_AGE,
) -> DataFrame:
    """New source files with file columns, from month directories and folders below them; ``max_files`` bounds
    a micro-batch.  A file that lacks a required column raises."""
    reader = spark.readStream.schema(marked_schema(schema)).option("pathGlobFilter", PARQUET_ONLY)
    reader = reader.option("recursiveFileLookup", True).option("maxFileAge", max_file_age)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return with_file_columns(reader.parquet(month_glob(source)))


def land_batch(
    batch: DataFrame,
    landing: str,
    manifest: str | None,
    ctx: RunContext,
    enrich: Enrich,
    options: IngestOptions,
    batch_key: str | None = None,
) -> None:
    """De-duplicates a micro-batch, keeps what has not landed, appends, then commits its files.

    ``batch_key`` names the batch over restarts.  Its clock is kept under that name before anything is written, so that a replay lands
    what is missing under the first attempt's time and counts both; a batch that the manifest has is not committed again.
    """
    spark = batch.sparkSession
    if manifest and batch_key:
        ctx = batch_clock(spark, manifest, batch_key, ctx)
    # File facts come from file metadata: this scan decodes no column.
    files = cut_lineage(batch.select(MONTH, "source_file", "file_path", "file_time").distinct())
    months = [r[MONTH] for r in files.select(MONTH).distinct().collect()]
    if not months:
        return
    existing = read_existing_keys(spark, landing, months)
    write_landing(ingest_rows(batch, existing, enrich, ctx, options), landing, options.max_records)
    known = bool(manifest and batch_key) and not read_manifest(spark, manifest).where(F.col("batch") == batch_key).isEmpty()
    if manifest and not known:
        landed = read_landing(spark, landing, months).where(F.col("processing_timestamp") == ctx.run_ts)
        landed = landed.groupBy(F.concat_ws("-", "year", "month").alias(MONTH), "source_file").agg(F.count(F.lit(1)).alias("rows"))
        commits = files.join(landed, [MONTH, "source_file"], "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
        facts = {"mode": F.lit(STREAM), "run_ts": F.lit(ctx.run_ts), "batch": F.lit(batch_key).cast("string")}
        append_manifest(commits.withColumns(facts), manifest)


def batch_clock(spark: SparkSession, manifest: str, batch_key: str, ctx: RunContext) -> RunContext:
    """The clock of the batch's first attempt; ``ctx``, which is kept, if this is it."""
    place = f"{manifest.rstrip('/')}__batches/{batch_key}"
    folder = Folder(spark, place)
    if folder.exists(place):
        return RunContext.at(folder.read(place).strip())
    folder.write(f"{place}.new", ctx.now.isoformat())
    folder.move(f"{place}.new", place)
    return ctx


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps in its checkpoint over restarts."""
    return json.loads(Folder(spark, checkpoint).read(f"{checkpoint}/metadata"))["id"]


def stream_ingest(
    spark: SparkSession,
    source: str,
    landing: str,
    checkpoint: str,
    enrich: Enrich,
    manifest: str | None = None,
    clock: Callable[[], RunContext] = RunContext.system,
    options: IngestOptions | None = None,
    schema: StructType = OD,
    max_files: int | None = None,
    max_file_age: str = MAX_FILE_AGE,
) -> StreamingQuery:
    """Starts the stream over everything that is there now, then stops (``availableNow``)."""
    options = options or IngestOptions()
    return (
        read_od_stream(spark, source, schema, max_files, max_file_age)
        .writeStream.foreachBatch(
            lambda batch, number: land_batch(
                batch, landing, manifest, clock(), enrich, options, f"{query_id(batch.sparkSession, checkpoint)}/{number}" if manifest else None
            )
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
