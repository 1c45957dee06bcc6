"""Distance (m) and duration (s) for origin-destination pairs.

``enrich_routes``    from a route table: exact coordinates first, then coordinates on a 4-decimal grid
``enrich_with``      from a caller's routing function, with the retry rule, for distinct pairs only
``enrich_geodesic``  great-circle estimate in column expressions; it is not road distance
"""

from __future__ import annotations

import time
from datetime import datetime, timezone
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odmeter.functions import columns as C
from odmeter.operators.lookup import key_counts, lookup_join
from odmeter.operators.route_index import GRID, RouteIndex, index_of, with_grid
from odmeter.schemas import PAIR
from odmeter.session import cut_lineage, new_folder, ship_package, stage
from odmeter.sources.paths import existing

ANSWERS = ["distance", "duration", "route_match"]

# Attempts per pair, first waiting time in seconds, and the texts that decide.
MAX_RETRIES = 5
FIRST_WAIT_S = 0.1
NO_ROUTE_TEXT = "no route"
DISCONNECTED_TEXT = "disconnected"

PAIRS_PER_COMMIT = 1_000_000


def enrich_geodesic(df: DataFrame, speed_mps: float = 8.0, detour: float = 1.3) -> DataFrame:
    """Great-circle metres times a detour factor, and seconds at a constant speed."""
    straight = C.great_circle_m(*[F.col(c) for c in PAIR])
    return df.withColumn("distance", straight * F.lit(detour)).withColumn(
        "duration", F.col("distance") / F.lit(speed_mps)
    )


def pair_counts(df: DataFrame) -> DataFrame:
    """Distinct complete pairs and how many rows hold each of them (``n``)."""
    return df.where(~C.any_missing(PAIR)).groupBy(*PAIR).agg(F.count(F.lit(1)).alias("n"))


def od_pairs(df: DataFrame) -> DataFrame:
    """``pair_counts``, written once, so that later uses don't aggregate the rows again."""
    return stage(pair_counts(df), "pairs")


def _looked_up(pairs: DataFrame, index: RouteIndex) -> DataFrame:
    """Pairs with their exact route, written once: what follows reads it several times."""
    return stage(index.join_exact(pairs), "pairs")


def _answers(looked_up: DataFrame, index: RouteIndex, columns: list[str]) -> DataFrame:
    """Distance, duration and match of looked-up pairs; those without an exact route go on to the grid.

    They are looked up by cell, each cell once, and cells that many pairs share are split where the answers go back to the pairs.
    """
    found = looked_up.where(F.col("_distance").isNotNull())
    rest = with_grid(looked_up.where(F.col("_distance").isNull()).select(*columns))
    cells = key_counts(rest, GRID)
    on_grid = lookup_join(rest, cells.join(index.near, GRID), GRID, ["_distance", "_duration"], counts=cells, spread_by=PAIR)

    def answered(some: DataFrame, match: str) -> DataFrame:
        known = F.when(F.col("_distance").isNotNull(), match).otherwise("no_route")
        return some.select(*columns, F.col("_distance").alias("distance"), F.col("_duration").alias("duration"), known.alias("route_match"))

    return answered(found, "exact").unionByName(answered(on_grid, "rounded"))


def _index(routes: DataFrame | RouteIndex) -> RouteIndex:
    return routes if isinstance(routes, RouteIndex) else index_of(routes)


def resolve_pairs(pairs: DataFrame, routes: DataFrame | RouteIndex) -> DataFrame:
    """Adds ``distance``, ``duration`` and ``route_match`` (exact, rounded, no_route) to distinct pairs.

    ``routes`` is a route table, or one that ``route_index`` has prepared.
    """
    index = _index(routes)
    return _answers(_looked_up(pairs, index), index, pairs.columns)


def _attach(df: DataFrame, resolved: DataFrame, counts: DataFrame, answers: list[str] = ANSWERS) -> DataFrame:
    found = lookup_join(df, resolved, PAIR, answers, counts=counts)
    reason = F.when(C.any_missing(PAIR), "missing_coords").otherwise(
        F.coalesce("route_match", F.lit("no_route"))
    )
    return found.withColumn("route_match", reason)


def enrich_routes(df: DataFrame, routes: DataFrame | RouteIndex, pairs_of: DataFrame | None = None) -> DataFrame:
    """Adds ``distance``, ``duration`` and ``route_match``; every input row comes out once.

    Routes are looked up per distinct pair, and the rows are joined to the answers once.
    ``pairs_of`` may name any table that holds at least the pairs of ``df``, such as the scan before
    de-duplication: the pair branch then does not repeat the window over ``df``.
    """
    index = _index(routes)
    looked_up = _looked_up(pair_counts(df if pairs_of is None else pairs_of), index)
    return _attach(df, _answers(looked_up, index, PAIR), looked_up.select(*PAIR, "n"))


def distinct_od_pairs(df: DataFrame, routes: DataFrame | RouteIndex | None = None) -> DataFrame:
    """Distinct complete pairs without a route: the work list for whoever fills the route table."""
    pairs = pair_counts(df).select(*PAIR)
    if routes is None:
        return pairs
    return resolve_pairs(pairs, routes).where("route_match = 'no_route'").select(*PAIR)


def route_rejects(enriched: DataFrame) -> DataFrame:
    """Rows without a distance, with the ``reason``."""
    return enriched.where(F.col("distance").isNull()).withColumnRenamed("route_match", "reason")


Route = Callable[[float, float, float, float], tuple[float, float]]


def request_route(
    connect: Callable[[], Route],
    route: Route,
    pair: tuple[float, float, float, float],
    max_retries: int = MAX_RETRIES,
    wait: Callable[[float], None] = time.sleep,
) -> tuple[float | None, float | None, int, str]:
    """One pair under the retry rule: (distance, duration, attempts, outcome).

    After a failure the coordinates are rounded to 4 decimals.  While attempts remain the wait doubles;
    a lost connection is opened again, and "no route" ends the pair at once.
    """
    for attempt in range(1, max_retries + 1):
        try:
            distance, duration = route(*pair)
            return float(distance), float(duration), attempt, "exact" if attempt == 1 else "rounded"
        except Exception as failure:
            message = str(failure).lower()
        if NO_ROUTE_TEXT in message:
            return None, None, attempt, "no_route"
        if attempt < max_retries:
            pair = tuple(float(np.round(c, 4)) for c in pair)
            wait(FIRST_WAIT_S * 2**attempt)
            if DISCONNECTED_TEXT in message:
                route = connect()
    return None, None, max_retries, "retries_exhausted"


_ANSWER = ", ".join(f"{c} double" for c in PAIR) + (
    ", distance double, duration double, attempts int, route_match string"
)


def ask_routes(
    pairs: DataFrame,
    connect: Callable[[], Route],
    callers: int,
    in_flight: int = 30,
    max_retries: int = MAX_RETRIES,
    store: str | None = None,
    pairs_per_commit: int = PAIRS_PER_COMMIT,
) -> DataFrame:
    """Calls the routing function for each distinct pair and stores the answers reliably.

    ``connect`` is called in the tasks and returns a function (lon, lat, lon, lat) -> (metres, seconds)
    that raises on failure and may be called from several threads.  ``callers`` tasks ask at the same time, each with ``in_flight`` requests.
    The answers are checkpointed, so that no pair is asked again by later use of the result.  With
    ``store``, a folder, they are appended there instead, ``pairs_per_commit`` pairs at a time, and pairs that it holds
    are not asked: a run that was cut off goes on where it stopped.  Pairs that failed for want of retries are asked again; answers carry
    the time of asking, and the latest good one counts.
    """

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        route = connect()
        with ThreadPoolExecutor(in_flight) as pool:
            for batch in batches:
                found = pool.map(
                    lambda pair: request_route(connect, route, pair, max_retries),
                    batch.itertuples(index=False, name=None),
                )
                answers = pd.DataFrame(
                    list(found), columns=["distance", "duration", "attempts", "route_match"], index=batch.index
                )
                yield pd.concat([batch, answers.astype({"distance": float, "duration": float})], axis=1)

    spark = pairs.sparkSession
    ship_package(spark)

    def answers(some: DataFrame) -> DataFrame:
        return some.repartition(callers, *PAIR).mapInPandas(ask, _ANSWER)

    wanted = pairs.select(*PAIR)
    if store is None:
        return cut_lineage(answers(wanted))
    wanted = stage(wanted, "wanted")
    todo = stage(wanted.join(stored_answers(spark, store), PAIR, "left_anti"), "todo")
    steps = -(-todo.count() // pairs_per_commit)
    if steps:
        # the work list lies on disk by step, so that a step reads its own part and no other
        work = new_folder(spark, "work")
        step = F.pmod(F.xxhash64(*PAIR), F.lit(steps)).alias("step")
        todo.select(*PAIR, step).repartition("step").write.partitionBy("step").parquet(work)
        # a step that no pair has fallen to has no folder
        for part in existing(spark, [f"{work}/step={k}" for k in range(steps)]):
            asked_at = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%f")
            some = spark.read.schema(todo.schema).parquet(part)
            answers(some).withColumn("asked_at", F.lit(asked_at)).write.mode("append").parquet(store)
    kept = _kept_answers(spark, store)
    # of several answers to a pair the latest good one; without a good one the latest
    good = F.col("route_match") != "retries_exhausted"
    answer = F.struct("distance", "duration", "attempts", "route_match")
    best = kept.groupBy(*PAIR).agg(F.max_by(answer, F.struct(good, F.coalesce("asked_at", F.lit("")))).alias("a"))
    return wanted.join(best, PAIR).select(*PAIR, "a.distance", "a.duration", "a.attempts", "a.route_match")


def _kept_answers(spark: SparkSession, store: str) -> DataFrame:
    """All answers of a store; ``asked_at`` is NULL in stores that are older than it."""
    schema = f"{_ANSWER}, asked_at string"
    return spark.read.schema(schema).parquet(store) if existing(spark, [store]) else spark.createDataFrame([], schema)


def stored_answers(spark: SparkSession, store: str) -> DataFrame:
    """Pairs that a store of answers need not be asked for again."""
    return _kept_answers(spark, store).where("route_match <> 'retries_exhausted'").select(*PAIR).distinct()


def enrich_with(
    df: DataFrame,
    connect: Callable[[], Route],
    callers: int,
    in_flight: int = 30,
    max_retries: int = MAX_RETRIES,
    routes: DataFrame | RouteIndex | None = None,
    store: str | None = None,
    pairs_per_commit: int = PAIRS_PER_COMMIT,
) -> DataFrame:
    """``enrich_routes`` with a caller's routing function; pairs found in ``routes`` are not asked.

    Adds ``attempts`` too, NULL where nobody was asked.  ``store`` keeps answers for later runs, see ``ask_routes``.
    """
    answers = ["distance", "duration", "attempts", "route_match"]
    pairs = od_pairs(df)
    known = None if routes is None else resolve_pairs(pairs.drop("n"), routes)
    unknown = pairs if known is None else known.where("route_match = 'no_route'")
    resolved = ask_routes(unknown, connect, callers, in_flight, max_retries, store, pairs_per_commit).select(*PAIR, *answers)
    if known is not None:
        found = known.where("route_match <> 'no_route'").withColumn("attempts", F.lit(None).cast("int"))
        resolved = found.select(*PAIR, *answers).unionByName(resolved)
    return _attach(df, resolved, pairs, answers)
