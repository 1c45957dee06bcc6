"""Work on groups of rows inside tasks, and connected components over edges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odmeter.session import cut_lineage


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups and the bounds of each, from batches sorted by ``key`` (bigint, no NULL).

    Only the group that a batch ends in waits for the next batch.
    """
    held: list[pa.RecordBatch] = []

    def cut(parts):
        table = pa.Table.from_batches(parts).combine_chunks()
        values = table.column(key).to_numpy()
        starts = np.flatnonzero(values[1:] != values[:-1]) + 1
        return table, np.concatenate([[0], starts, [len(values)]])

    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(batch.schema.get_field_index(key)).to_numpy()
        last = np.flatnonzero(values != values[-1])
        split = int(last[-1]) + 1 if len(last) else 0
        if held and split == 0 and held[-1].column(held[-1].schema.get_field_index(key))[-1].as_py() != values[0]:
            yield cut(held)
            held = []
        if split:
            yield cut([*held, batch.slice(0, split)])
            held = []
        held.append(batch.slice(split))
    if held:
        yield cut(held)


class Forest:
    """Union of the numbers 0 to n - 1; the smallest of a set stands for it."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def root(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return int(x)

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        if x == y:
            return False
        self.parent[max(x, y)] = min(x, y)
        return True


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node of ``edges`` (columns a and b, no NULL).

    Large and small stars in turn (each node's larger neighbours move to its smallest one, then its smaller
    ones) until the edges are stars.  Minima are combined before the shuffle and written before they are joined, so that
    both sides of a join are plain shuffles and adaptive execution can split the edges of a hub; every round is
    written, so lost executors cost one round at most.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges, seen = cut_lineage(edges), None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen or not now[0]:
            break
        seen = now
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = cut_lineage(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = cut_lineage(large.distinct())
        least = cut_lineage(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(least, "a").select(F.explode(F.array(
            F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))
        )).alias("e")).select("e.a", "e.b")
        edges = cut_lineage(small.where("a <> b").distinct())
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
