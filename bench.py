"""Times the headline operators and prints one JSON line.

    BENCH_SF_DIR  folder of the tables   (default /root/testdata/sf0.1)
    BENCH_CPUS    local threads          (default 8)
    BENCH_COPIES  the sample is repeated this many times under new keys (default 1)

The origin-destination sample is written once and then read by every operator, so that its derivation is
not part of the figures.  So is the route index, which a deployment prepares once: ``enrich_routes`` and ``ingest_batch_routes`` read it;
``enrich_routes_plain`` has the plain route table, as ``enrich_routes`` had before there was an index.  Each operator runs once to warm up and is then timed once; results are consumed
whole by the ``noop`` sink, or written as files where writing is the point.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from odmeter import samples
from odmeter.operators import dedupe, enrich, route_index
from odmeter.plans import ingest, maintain
from odmeter.reports import quality
from odmeter.schemas import KEY, MONTH, PAIR
from odmeter.session import build_session, new_folder
from odmeter.sinks.landing import write_landing
from odmeter.sources import files
from odmeter.streaming.ingest import stream_ingest

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
COPIES = int(os.environ.get("BENCH_COPIES", "1"))
ORDER = ["file_time", "file_path", "row_index"]


def consume(df):
    df.write.format("noop").mode("overwrite").save()


def prepare(spark):
    """The sample tables as files; ``COPIES`` of it with keys and end points of their own."""
    copy = F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1)))
    od = samples.od(spark, SF_DIR).withColumn("copy", copy).withColumns({
        KEY: F.concat_ws("-", KEY, F.when(F.col("copy") > 0, F.col("copy"))) if COPIES > 1 else F.col(KEY),
        "order_longitude": F.col("order_longitude") + F.col("copy") / 100000,
    })
    paths = {name: new_folder(spark, name) for name in ("od", "routes", "source")}
    od.drop("copy").write.parquet(paths["od"])
    routes = samples.routes(spark, SF_DIR).withColumn("copy", copy)
    routes.withColumn("order_longitude", F.col("order_longitude") + F.col("copy") / 100000).drop("copy").write.parquet(paths["routes"])
    samples.write_month_dirs(spark.read.parquet(paths["od"]).select(KEY, *PAIR, MONTH), paths["source"])
    return paths


def operators(spark, paths):
    od = spark.read.parquet(paths["od"])
    routes = spark.read.parquet(paths["routes"])
    prepared = route_index.write_routes(routes, new_folder(spark, "route-index"), CPUS)
    landed = od.where((F.col("file_idx") == 0) & (F.col(MONTH) < "1998-01")).select(KEY, MONTH)

    def dedupe_file_then_month():
        rows = dedupe.dedupe_within_file(od, ["row_index"])
        consume(dedupe.dedupe_batch(rows, ORDER))

    def anti_join_existing():
        consume(dedupe.anti_join_existing(od, landed))

    def dedupe_report():
        consume(dedupe.dedupe_report(od))

    def enrich_geodesic():
        consume(enrich.enrich_geodesic(od))

    def enrich_routes():
        consume(enrich.enrich_routes(od, prepared))

    def enrich_routes_plain():
        consume(enrich.enrich_routes(od, routes))

    def quality_counts():
        consume(quality.quality_counts(enrich.enrich_geodesic(od), [MONTH]))

    def ingest_batch():
        ingest.ingest_batch(
            spark, paths["source"], new_folder(spark, "landing"), new_folder(spark, "manifest"),
            samples.CLOCK, ingest.by_estimate(),
        )

    def ingest_batch_routes():
        ingest.ingest_batch(
            spark, paths["source"], new_folder(spark, "landing"), new_folder(spark, "manifest"),
            samples.CLOCK, ingest.by_routes(prepared),
        )

    def ingest_stream():
        stream_ingest(
            spark, paths["source"], new_folder(spark, "landing"), new_folder(spark, "stream"),
            ingest.by_estimate(), clock=lambda: samples.CLOCK,
        ).awaitTermination()

    def compact_months():
        landing = new_folder(spark, "landing")
        rows = samples.landing_rows(spark, SF_DIR)
        write_landing(rows, landing)
        write_landing(rows, landing)
        months = [f"{r['year']}-{r['month']}" for r in files.read_landing(spark, landing).select("year", "month").distinct().collect()]
        started = time.perf_counter()
        maintain.compact_months(spark, landing, months)
        return time.perf_counter() - started

    return od.count(), [
        dedupe_file_then_month, dedupe_report, anti_join_existing, enrich_geodesic, enrich_routes, enrich_routes_plain, quality_counts,
        ingest_batch, ingest_batch_routes, ingest_stream, compact_months,
    ]


def timed(run):
    run()
    started = time.perf_counter()
    own = run()
    return round(own if own is not None else time.perf_counter() - started, 3)


def main():
    spark = build_session(
        "odmeter-bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": str(CPUS),
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    rows, runs = operators(spark, prepare(spark))
    only = os.environ.get("BENCH_ONLY")
    seconds = {run.__name__: timed(run) for run in runs if not only or run.__name__ in only.split(",")}
    print(json.dumps({
        "metric": "total seconds of the headline operators",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).replace("sf", ""),
        "rows": rows,
        "rows_per_sec": {name: round(rows / s) for name, s in seconds.items()},
    }))


if __name__ == "__main__":
    main()
