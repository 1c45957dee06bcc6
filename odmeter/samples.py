"""Sample tables derived from an ``orders`` table, for checks and the bench.

The orders hold no coordinates, so positions are computed from the keys.  Edge cases are built in: copies
in the same file, in another file of the month, in the next month; missing start points; equal start and
end; NULL keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from odmeter.context import RunContext
from odmeter.schemas import KEY, MONTH, PAIR
from odmeter.sources.paths import Folder

CLOCK = RunContext.at("2001-08-15T04:00:00+00:00")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet")


def od(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Origin-destination rows with file columns; one scan, copies by ``explode``."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    still = k % 101 == 0
    start_lat = F.lit(-34.0) + ((c * 37) % 3900) / F.lit(100.0)
    start_lon = F.lit(-74.0) + ((c * 53) % 4000) / F.lit(100.0)

    def shift(step: int) -> Column:
        return F.when(still, 0).otherwise((k * step) % 200 - 100) / F.lit(1000.0)

    copies = F.filter(
        F.array(F.lit(0), F.when(k % 50 == 0, 1), F.when(k % 70 == 0, 2), F.when(k % 90 == 0, 3)),
        lambda n: n.isNotNull(),
    )
    rows = orders(spark, sf_dir).select(
        k, c, F.col("o_orderdate").cast("date").alias("day"), F.explode(copies).alias("copy_no")
    )
    copy_no = F.col("copy_no")
    end_lat = start_lat + shift(17)
    day = F.when(copy_no == 3, F.add_months("day", 1)).otherwise(F.col("day"))
    month = F.date_format(day, "yyyy-MM")
    idx = (k % 4).cast("int")
    idx = F.when(copy_no == 2, (idx + 1) % 4).otherwise(idx)
    return rows.select(
        F.when(k % 499 != 0, k.cast("string")).alias(KEY),
        month.alias(MONTH),
        F.concat(F.lit("part-0000"), idx.cast("string"), F.lit(".snappy.parquet")).alias("source_file"),
        idx.alias("file_idx"),
        copy_no,
        (k * 4 + copy_no).alias("row_index"),
        F.concat(month, F.lit("-0"), (idx + 1).cast("string"), F.lit("T03:10:00+00:00")).alias("last_modified"),
        F.when(k % 97 != 0, start_lat).alias("poc_latitude"),
        start_lon.alias("poc_longitude"),
        F.when(copy_no == 2, end_lat + F.lit(0.001)).otherwise(end_lat).alias("order_latitude"),
        (start_lon + shift(29)).alias("order_longitude"),
    ).withColumns({"file_path": F.concat_ws("/", MONTH, "source_file"), "file_time": F.to_timestamp("last_modified")})


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing of the sample's files: one row per month and file."""
    return od(spark, sf_dir).groupBy(MONTH, "source_file", "file_idx", "file_path", "file_time").agg(
        F.count(F.lit(1)).alias("rows")
    )


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Route table: a tenth of the orders has none, another tenth is found only on the 4-decimal grid."""
    number = F.col(KEY).cast("bigint")
    lat = F.col("order_latitude") - F.col("poc_latitude")
    lon = F.col("order_longitude") - F.col("poc_longitude")
    end_lat = F.when(number % 10 == 3, F.col("order_latitude") + F.lit(0.00001)).otherwise(F.col("order_latitude"))
    metres = F.lit(111000.0) * (F.abs("dlat") + F.abs("dlon"))
    return (
        od(spark, sf_dir)
        .where(F.col("poc_latitude").isNotNull() & (number % 10 != 0))
        .select("poc_longitude", "poc_latitude", "order_longitude", end_lat.alias("order_latitude"),
                lat.alias("dlat"), lon.alias("dlon"))
        .distinct()
        .select(*PAIR, F.round(metres, 1).alias("distance"), F.round(metres / F.lit(8.0), 1).alias("duration"))
    )


def landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return od(spark, sf_dir).where((F.col("file_idx") == 0) & (F.col(MONTH) < "1998-01")).select(KEY, MONTH)


def landing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample in the form of the landing table, duplicates included."""
    return od(spark, sf_dir).select(
        KEY,
        F.col("row_index").cast("double").alias("distance"),
        F.col("file_idx").cast("double").alias("duration"),
        F.substring("last_modified", 1, 10).alias("ingestion_date"),
        F.col("last_modified").alias("processing_timestamp"),
        "source_file",
        F.substring(MONTH, 1, 4).alias("year"),
        F.substring(MONTH, 6, 2).alias("month"),
    )


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commits of earlier runs: old months closed, some months read up to a file."""
    month, idx = F.col(MONTH), F.col("file_idx")
    mode = F.when(month < "2000-01", "HISTORICAL").when(month == "2001-05", "INCREMENTAL_PREVIOUS")
    mode = mode.when((month == "2001-07") & (idx < 2), "INCREMENTAL_CURRENT")
    mode = mode.when((month == "2001-08") & (idx < 1), "INCREMENTAL_CURRENT")
    return files(spark, sf_dir).withColumn("mode", mode).where("mode IS NOT NULL").select(
        MONTH, "file_path", "file_time", "mode", "rows", F.concat(month, F.lit("-28T04:00:00.000000")).alias("run_ts")
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log file per order date, one line per order."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    day = F.col("day").cast("string")
    dated = orders(spark, sf_dir).select(k, c, F.col("o_orderdate").cast("date").alias("day"))
    first = dated.groupBy("day").agg((F.min("o_orderkey") % 10).alias("kind"))
    status = F.when(F.col("kind") == 0, "osrm_timeout").when(F.col("kind") == 1, "pipeline_failed").otherwise("success")
    commas = F.concat(
        (F.floor(c / 1000) + 1).cast("string"), F.lit(","), F.lpad((c % 1000).cast("string"), 3, "0")
    )
    text = (
        F.when(k % 7 == 0, F.concat(F.lit("⚠️  Removidas "), commas, F.lit(" duplicatas do arquivo fonte!")))
        .when(k % 7 == 1, F.concat(F.lit("✅ Partição "), F.substring(day, 1, 7), F.lit(" concluída. Total: "), commas))
        .when(k % 7 == 2, F.concat(F.lit("📊 Total processado: "), commas, F.lit(" registros")))
        .when(k % 7 == 3, F.lit("❌ FALHA: Pipeline principal falhou. WARNING"))
        .otherwise("⚙️  Processando bloco")
    )
    stamp = F.concat(day, F.lit(" 04:"), F.lpad((k % 60).cast("string"), 2, "0"), F.lit(":05 - "))
    return dated.join(first, "day").select(
        F.concat(day, F.lit("_"), F.replace(day, F.lit("-"), F.lit("")), F.lit("_040000_"), status, F.lit(".log")).alias("file_name"),
        k.alias("line_no"),
        F.when(k % 11 == 0, "").otherwise(F.concat(stamp, text)).alias("line"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per order date, with hours to recovery for failed runs."""
    dated = orders(spark, sf_dir).groupBy(F.col("o_orderdate").cast("date").cast("string").alias("run_date")).agg(
        F.min("o_orderkey").alias("k")
    )
    status = F.when(F.col("k") % 10 == 0, "osrm_timeout").when(F.col("k") % 10 == 1, "container_restart").otherwise("success")
    hours = F.when(F.col("k") % 10 < 2, (F.col("k") % 7 + 1).cast("double"))
    return dated.select("run_date", status.alias("status"), hours.alias("recovery_hours"))


def router():
    """Routing function for checks: metres on a grid, and no route where start and end are the same."""

    def route(lon1: float, lat1: float, lon2: float, lat2: float) -> tuple[float, float]:
        if lon1 == lon2 and lat1 == lat2:
            raise ValueError("No route found")
        metres = 111000.0 * (abs(lat2 - lat1) + abs(lon2 - lon1))
        return metres, metres / 8.0

    return route


def write_month_dirs(rows: DataFrame, root: str, files_per_month: int | None = None) -> str:
    """Writes rows as ``root/YYYY-MM/*.parquet``; returns the root.

    Spark writes ``partition_month=YYYY-MM`` directories, which are then moved, one per calendar month.
    """
    spread = [MONTH] if files_per_month is None else [MONTH, F.pmod(F.xxhash64(KEY), F.lit(files_per_month))]
    rows.repartition(*spread).write.partitionBy(MONTH).parquet(f"{root}/_new")
    folder = Folder(rows.sparkSession, root)
    for name in folder.names(f"{root}/_new"):
        if name.startswith(f"{MONTH}="):
            folder.move(f"{root}/_new/{name}", f"{root}/{name.split('=')[1]}")
    folder.delete(f"{root}/_new")
    return root
