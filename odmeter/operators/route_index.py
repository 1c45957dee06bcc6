"""A route table prepared once for many look-ups: best route per pair and per 4-decimal cell, in buckets of their keys.

A look-up joins pairs to the buckets where they lie; of the route table nothing is aggregated, shuffled or sorted by a run.  The two
tables are plain Parquet files; ``open_routes`` tells a session's catalog where they are and how they are bucketed.

Spark normalises doubles in join keys, so buckets of coordinates would be shuffled again; pairs are bucketed and joined by a hash of their
coordinates, and the coordinates themselves decide inside the join.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odmeter.functions import columns as C
from odmeter.schemas import PAIR
from odmeter.sources.paths import Folder

GRID = [f"_grid_{c}" for c in PAIR]
FACTS = "_index.json"
PAIR_KEY = "_pair_key"


@dataclass(frozen=True)
class RouteIndex:
    """``exact`` by pair, with its key, and ``near`` by grid cell, each with ``_distance`` (not missing) and ``_duration``."""

    exact: DataFrame
    near: DataFrame

    def join_exact(self, pairs: DataFrame) -> DataFrame:
        """Distinct pairs with ``_distance`` and ``_duration`` of their exact route, NULL where there is none."""
        theirs = self.exact.withColumnsRenamed({PAIR_KEY: "_their_key", **{c: f"_their_{c}" for c in PAIR}})
        # two comparisons, because an equality would become a key of the join
        same = [(F.col(c) >= F.col(f"_their_{c}")) & (F.col(c) <= F.col(f"_their_{c}")) for c in PAIR]
        keyed = pairs.withColumn(PAIR_KEY, F.xxhash64(*PAIR))
        found = keyed.join(theirs, (F.col(PAIR_KEY) == F.col("_their_key")) & reduce(and_, same), "left")
        return found.select(*pairs.columns, "_distance", "_duration")


def with_grid(df: DataFrame) -> DataFrame:
    return df.withColumns({g: C.grid_cell(F.col(c)) for g, c in zip(GRID, PAIR, strict=True)})


def best_route(routes: DataFrame, on: list[str]) -> DataFrame:
    """One route per key: lowest distance, then lowest duration."""
    best = F.min(F.struct("distance", "duration")).alias("best")
    found = routes.where(~C.missing(F.col("distance"))).groupBy(*on).agg(best)
    return found.select(*on, F.col("best.distance").alias("_distance"), F.col("best.duration").alias("_duration"))


def index_of(routes: DataFrame) -> RouteIndex:
    """The same from a plain route table, for a single look-up: it is aggregated by that run."""
    near = best_route(with_grid(routes), GRID)
    return RouteIndex(best_route(routes, PAIR).withColumn(PAIR_KEY, F.xxhash64(*PAIR)), near.where(reduce(and_, [F.col(g).isNotNull() for g in GRID])))


def write_routes(routes: DataFrame, path: str, buckets: int) -> RouteIndex:
    """Prepares a route table at ``path``, which must not exist, and opens it.

    One bucket should hold some 100 MB; give at least as many as ``spark.sql.shuffle.partitions``.
    """
    spark, index = routes.sparkSession, index_of(routes)
    tables = {"exact": (index.exact, [PAIR_KEY]), "near": (index.near, GRID)}
    for name, (table, on) in tables.items():
        table.repartition(buckets, *on).write.bucketBy(buckets, *on).sortBy(*on).option("path", f"{path}/{name}").saveAsTable(_table(path, name))
    facts = {"buckets": buckets, "schemas": {n: _ddl(t) for n, (t, _) in tables.items()}}
    Folder(spark, path).write(f"{path}/{FACTS}", json.dumps(facts))
    return open_routes(spark, path)


def open_routes(spark: SparkSession, path: str) -> RouteIndex:
    """A prepared route table, in this or a later session."""
    facts = json.loads(Folder(spark, path).read(f"{path}/{FACTS}"))
    for name, on in (("exact", [PAIR_KEY]), ("near", GRID)):
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {_table(path, name)} ({facts['schemas'][name]}) USING parquet"
            f" CLUSTERED BY ({', '.join(on)}) SORTED BY ({', '.join(on)}) INTO {facts['buckets']} BUCKETS LOCATION '{path}/{name}'"
        )
    return RouteIndex(*(spark.table(_table(path, name)) for name in ("exact", "near")))


def _table(path: str, name: str) -> str:
    return f"route_index_{name}_{hashlib.md5(path.encode()).hexdigest()[:16]}"


def _ddl(table: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema)
