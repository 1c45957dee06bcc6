"""Near-duplicate vectors: random-hyperplane sign hashing, exact cosines, connected components.

Vectors of one label are compared by cosine in double precision.  Tables of hyperplanes each give a code; two
vectors at cosine 0.93 agree in a bit with chance 0.88, in a table of ten bits with 0.28, and miss 36 tables with 7e-6.  A label with more
vectors gets more bits (``settings``), so that a bucket holds some ``FILL`` vectors that are no neighbours whatever the number of all, and
as many more tables as keep that chance.
Equal vectors of a label are one node from the start, with their number.  Vectors that share a bucket (table, label, code) are compared by
one matrix product; a pair counts in the first table in which its codes agree, so no pair is counted twice
and none has to leave the task: out come link counts per vector and a forest of links.

Buckets above ``BLOCK`` vectors are cut into blocks, each pair of blocks a group of its own; none is capped.

Defined results: vectors that are NULL, empty, zero or hold NULL or non-finite components link with nothing, nor do those without
a label; vectors of different lengths don't link; rows that repeat are vectors of their own, linked with each other; a
NULL vec_id counts as a link of others but never names a component unless it has no other; an empty table gives an
empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odmeter.llm.groups import Forest, connected_components, whole_groups
from odmeter.session import cut_lineage, ship_package

COSINE = 0.93
TABLES, BITS = 36, 10
#: vectors of a label in a bucket by chance, and the chance to miss a pair at COSINE that more bits must keep
FILL, MISS = 64, 7.7e-6
BLOCK = 2048
SEED = 20011


def hyperplanes(dimensions: int, tables: int = TABLES, bits: int = BITS) -> np.ndarray:
    """Normal vectors of the planes, the same in every task."""
    return np.random.default_rng([SEED, dimensions]).standard_normal((dimensions, tables * bits))


def settings(most: int) -> tuple[int, int]:
    """Tables and bits for labels of at most ``most`` vectors."""
    bits = max(BITS, math.ceil(math.log2(max(1, most) / FILL)))
    agree = (1 - math.acos(COSINE) / math.pi) ** bits
    return max(TABLES, math.ceil(math.log(MISS) / math.log1p(-agree))), bits


def codes(vectors: np.ndarray, tables: int = TABLES, bits: int = BITS) -> np.ndarray:
    """A code per vector and table (int32)."""
    signs = (vectors @ hyperplanes(vectors.shape[1], tables, bits) > 0).reshape(len(vectors), tables, bits)
    return (signs << np.arange(bits)).sum(2).astype(np.int32)


def _coded(tables: int, bits: int):
    schema = pa.schema([("node", pa.binary()), ("label", pa.int64()), ("copies", pa.int64()), ("unit", pa.binary()), ("codes", pa.list_(pa.int32()))])
    rows = 1024  # at once: their signs take 8 bytes each
    return lambda batches: (
        coded for batch in batches for at in range(0, batch.num_rows, rows) for coded in _coded_batch(batch.slice(at, rows), schema, tables, bits)
    )


def _coded_batch(batch, schema, tables, bits):
    if batch.num_rows:
        node, label, copies, vectors = batch.columns
        sizes = np.array([len(v) for v in vectors], np.int64)
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            taken = vectors.take(pa.array(at))
            x = np.asarray(taken.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(at), size)
            x = x / np.abs(x).max(1, keepdims=True)
            x = x / np.sqrt((x * x).sum(1, keepdims=True))
            code = codes(x, tables, bits)
            yield pa.RecordBatch.from_arrays([
                node.take(pa.array(at)), label.take(pa.array(at)), copies.take(pa.array(at)),
                pa.array([v.tobytes() for v in x], pa.binary()), pa.array(list(code), pa.list_(pa.int32())),
            ], schema=schema)


def _compare(cosine: float, tables: int):
    def compare(batches):
        schema = pa.schema([("node", pa.binary()), ("links", pa.int64()), ("other", pa.binary())])
        for table, bounds in whole_groups(batches, "g"):
            columns = {c: table.column(c) for c in table.column_names}
            out: tuple[list, list, list] = ([], [], [])
            copies, sides, turns = (columns[c].to_numpy() for c in ("copies", "side", "turn"))
            across = columns["across"].to_pylist()
            units = columns["unit"].to_pylist()
            coded = np.asarray(columns["codes"].combine_chunks().flatten().to_numpy(zero_copy_only=False)).reshape(len(units), tables)
            for first, last in zip(bounds[:-1], bounds[1:]):
                if last - first < 2:
                    continue
                n, turn = last - first, int(turns[first])
                x = np.stack([np.frombuffer(u, np.float64) for u in units[first:last]])
                side, code, count = sides[first:last], coded[first:last], copies[first:last]
                near = np.triu(x @ x.T >= cosine, 1)
                if across[first]:
                    near &= side[:, None] != side[None, :]
                i, j = np.nonzero(near)
                if turn:
                    fresh = ~(code[i, :turn] == code[j, :turn]).any(1)
                    i, j = i[fresh], j[fresh]
                if not len(i):
                    continue
                links = np.bincount(i, count[j], n) + np.bincount(j, count[i], n)
                forest, other = Forest(n), {}
                for a, b in zip(i.tolist(), j.tolist()):
                    if forest.join(a, b):
                        other.setdefault(b, []).append(a)
                names = columns["node"].slice(first, n).to_pylist()
                for k in np.flatnonzero(links):
                    out[0].append(names[k]), out[1].append(int(links[k])), out[2].append(None)
                for b, tied in other.items():
                    for a in tied:
                        out[0].append(names[b]), out[1].append(0), out[2].append(names[a])
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

    return compare


def near_vector_components(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of ``vectors`` (vec_id, embedding, label).

    ``cosine`` below 0.93 needs more tables for the same recall.
    """
    ship_package(vectors.sparkSession)
    whole = F.coalesce(F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))), F.lit(False))
    usable = whole & F.coalesce(F.exists("embedding", lambda v: v != 0), F.lit(False)) & F.col("label").isNotNull()
    node = F.unhex(F.md5(F.concat_ws("|", F.col("label").cast("string"), F.col("embedding").cast("string"))))
    rows = cut_lineage(vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.when(usable, node).alias("node"), F.col("label").cast("bigint").alias("label"), F.col("embedding").cast("array<double>").alias("embedding")))
    known = rows.where(F.col("node").isNotNull())
    nodes = known.groupBy("node").agg(
        F.first("label").alias("label"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first_id"), F.first("embedding").alias("embedding")
    )
    nodes = cut_lineage(nodes)
    tables, bits = settings(nodes.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0)
    coded = nodes.select("node", "label", "copies", "embedding").mapInArrow(
        _coded(tables, bits), "node binary, label bigint, copies bigint, unit binary, codes array<int>"
    )
    coded = cut_lineage(coded)
    slots = coded.select("node", "label", F.posexplode("codes").alias("turn", "code"))
    slots = slots.withColumn("bucket", F.xxhash64("turn", "label", "code"))
    full = slots.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    hits = slots.join(full, "bucket").withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    hits = hits.withColumn("side", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    hits = hits.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    group = F.xxhash64("bucket", F.least("side", "other"), F.greatest("side", "other"))
    dealt = coded.join(hits.select("node", "turn", "side", (F.col("side") != F.col("other")).alias("across"), group.alias("g")), "node")
    dealt = dealt.select("g", "node", "turn", "side", "across", "copies", "unit", "codes").repartition("g").sortWithinPartitions("g")
    found = cut_lineage(dealt.mapInArrow(_compare(cosine, tables), "node binary, links bigint, other binary"))

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    components = connected_components(found.where(F.col("other").isNotNull()).select(F.col("node").alias("a"), F.col("other").alias("b")))
    placed = nodes.select("node", "copies", "first_id").join(components, "node", "left").join(links, "node", "left")
    placed = placed.withColumn("component", F.coalesce("component", "node"))
    placed = cut_lineage(placed)
    names = cut_lineage(placed.groupBy("component").agg(F.min("first_id").alias("component_id")))
    placed = placed.join(names, "component").select(
        F.col("node").alias("_node"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("_links"), "component_id"
    )
    out = rows.select("vec_id", "node").join(placed, F.col("node") == F.col("_node"), "left")
    out = out.select("vec_id", F.coalesce("_links", F.lit(0)).cast("bigint").alias("n_links"), F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
   AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reached AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) c ON vec_id = c.a
 JOIN (SELECT a, min(b) AS component_id FROM reached GROUP BY a) r ON vec_id = r.a
"""


def op5_near_vectors(spark, sf_dir: str) -> DataFrame:
    return near_vector_components(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
