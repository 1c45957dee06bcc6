"""Near-duplicate texts by DartMinHash.

A text is a bag of shingles (five words), weighted by how often each occurs.  Darts are thrown at every element's
weight axis, cut into regions [0, 1), [1, 2), [2, 4) ...: in each region they come as a Poisson process over rank, hashed from element,
region and number, so that two texts see the same darts wherever both weights reach.  A text keeps, for each of ``COORDINATES``
coordinates, its dart of the lowest rank: about ``ln k`` darts a coordinate are thrown, whatever the
number of shingles, and the chance that two texts agree in a coordinate is their weighted Jaccard similarity.

Texts that agree in a whole band of ``ROWS`` coordinates share a bucket.  At the similarity 0.8 a pair shares none of
the 25 bands with a chance of 5e-5.  Inside a bucket pairs whose signatures agree well enough (a chance of 1e-5 to lose a pair of 0.8)
are compared exactly (over 32-bit hashes of their shingles); links are kept as a forest, not as pairs, and give connected components.

Equal texts (md5 of the bytes) are one node from the start.  Buckets of more than ``BLOCK`` texts or ``BLOCK_SHINGLES``
shingles are cut into blocks, and each pair of blocks is a group of its own: no task holds an unbounded bucket, and none is capped.

Defined results: a text with one to four words has one shingle of them all; texts without words (NULL too) are
copies of nothing; NULL doc_ids never name a class unless it has no other; repeated rows are in one class; an empty table
gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odmeter.llm.groups import Forest, connected_components, whole_groups
from odmeter.llm.hashing import Words, chunks, mix64, shingles
from odmeter.session import cut_lineage, ship_package

SIZE = 5
SIMILARITY = 0.8
BANDS, ROWS = 25, 5
COORDINATES = BANDS * ROWS
#: Share of agreeing coordinates from which a pair is compared exactly: 4 deviations below 0.8.
LIKELY = 0.65
BLOCK = 4096
BLOCK_SHINGLES = 8_000_000
CHUNK = 1 << 20
_UNIT = 2.0**-53


def bags(texts: list[bytes], size: int = SIZE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, element (44 bits) and weight of every distinct shingle of each text, ordered."""
    hashes, doc = shingles(Words(texts), size)
    if len(texts) >> 20:
        raise ValueError("too many texts at once")
    keys = np.sort((doc.astype(np.uint64) << np.uint64(44)) | (hashes >> np.uint64(20)))
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    weight = np.diff(np.append(first, len(keys)))
    return (keys[first] >> np.uint64(44)).astype(np.int64), keys[first] & np.uint64((1 << 44) - 1), weight


def _uniform(x: np.ndarray, salt: int) -> np.ndarray:
    return (mix64(x, salt) >> np.uint64(11)).astype(np.float64) * _UNIT


def dart_signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, texts: int, k: int = COORDINATES) -> np.ndarray:
    """``texts`` x ``k`` dart identities (uint64); texts without elements have zeros."""
    weight = weight.astype(np.float64)
    norm = np.bincount(doc, weight, texts)
    out = np.zeros((texts, k), np.uint64)
    todo, factor = norm > 0, 1.0
    while todo.any():
        at = np.flatnonzero(todo[doc])
        of, e, w = doc[at], element[at], weight[at]
        # regions of the weight axis that reach below w
        regions = 1 + np.ceil(np.log2(np.maximum(w, 1))).astype(np.int64)
        region = np.arange(regions.sum()) - np.repeat(np.cumsum(regions) - regions, regions)
        of, e, w = np.repeat(of, regions), np.repeat(e, regions), np.repeat(w, regions)
        low = np.where(region == 0, 0.0, 2.0 ** (region - 1))
        width = np.where(region == 0, 1.0, low)
        seed = mix64(e, 7) + mix64(region.astype(np.uint64), 8)
        rank, most = np.zeros(len(of)), factor * k * (math.log(k) + 3) / np.maximum(norm, 1)
        cells, ranks, names = [], [], []
        dart = 0
        while len(of):
            name = mix64(seed, 16 + dart)
            rank = rank - np.log1p(-_uniform(name, 1)) / width
            live = rank <= most[of]
            of, w, low, width, seed, rank, name = (x[live] for x in (of, w, low, width, seed, rank, name))
            hit = low + _uniform(name, 2) * width < w
            cells.append(of[hit] * k + (mix64(name[hit], 3) % np.uint64(k)).astype(np.int64))
            ranks.append(rank[hit])
            names.append(name[hit])
            dart += 1
        cell, order = np.concatenate(cells), np.argsort(-np.concatenate(ranks), kind="stable")
        best, filled = out.reshape(-1), np.zeros(texts * k, bool)
        best[cell[order]] = np.concatenate(names)[order]  # of several for a cell the last one stays: the lowest rank
        filled[cell] = True
        todo = todo & ~filled.reshape(texts, k).all(1)
        factor *= 2
    return out


def band_keys(signatures: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per text and band."""
    parts = signatures.reshape(len(signatures), bands, rows)
    keys = np.zeros(parts.shape[:2], np.uint64)
    for r in range(rows):
        keys += mix64(parts[:, :, r], 40 + r)
    return mix64(keys + np.arange(bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), 50)


def with_occurrence(element: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """A bag as a set: the n-th occurrence of an element is a member of its own (32 bits)."""
    number = np.arange(weight.sum()) - np.repeat(np.cumsum(weight) - weight, weight)
    return np.unique((mix64(np.repeat(element, weight) + (number.astype(np.uint64) << np.uint64(44)), 60) >> np.uint64(32)).astype(np.uint32))


def _sketch(batches):
    for batch, texts in chunks(batches, 1, CHUNK):
        doc, element, weight = bags(texts)
        keys = band_keys(dart_signatures(doc, element, weight, len(texts)))
        size = np.bincount(doc, weight, len(texts)).astype(np.int64)
        yield pa.RecordBatch.from_pydict({
            "key": batch.column(0), "doc_id": batch.column(2), "n": size,
            "bands": pa.ListArray.from_arrays(np.arange(0, keys.size + 1, BANDS, dtype=np.int32), pa.array(keys.reshape(-1).view(np.int64))),
        })


def _payload(batches):
    for batch, texts in chunks(batches, 1, CHUNK):
        doc, element, weight = bags(texts)
        signatures = (mix64(dart_signatures(doc, element, weight, len(texts)), 61) >> np.uint64(56)).astype(np.uint8)
        bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
        members = [with_occurrence(element[a:b], weight[a:b]).tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
        yield pa.RecordBatch.from_pydict({"key": batch.column(0), "signature": [s.tobytes() for s in signatures], "members": members})


def link_group(keys: list[bytes], signatures: np.ndarray, members: list[np.ndarray], similarity: float = SIMILARITY, likely: float = LIKELY, side=None):
    """Links of a forest over a group of texts; with ``side`` only pairs of different sides are compared."""
    n = len(keys)
    sizes = np.array([len(m) for m in members])
    forest, links = Forest(n), []
    for i in range(n - 1):
        close = np.minimum(sizes[i], sizes[i + 1 :]) >= similarity * np.maximum(sizes[i], sizes[i + 1 :])
        if side is not None:
            close &= side[i + 1 :] != side[i]
        at = np.flatnonzero(close) + i + 1
        if not len(at):
            continue
        agree = (signatures[at] == signatures[i]).mean(1)
        at = at[(agree - 1 / 256) / (1 - 1 / 256) >= likely]
        root = forest.root(i)
        at = np.array([j for j in at if forest.root(j) != root], np.int64)
        if not len(at):
            continue
        whole = np.concatenate([members[j] for j in at])
        place = np.minimum(np.searchsorted(members[i], whole), sizes[i] - 1)
        found = np.add.reduceat((members[i][place] == whole).astype(np.int64), np.cumsum(sizes[at]) - sizes[at])
        for j, both in zip(at, found):
            if both >= similarity * (sizes[i] + sizes[j] - both) and forest.join(i, int(j)):
                links.append((keys[i], keys[int(j)]))
    return links


def _links(batches):
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])
    for table, bounds in whole_groups(batches, "g"):
        key, signature, member, side, across = (table.column(c) for c in ("key", "signature", "members", "side", "across"))
        for first, last in zip(bounds[:-1], bounds[1:]):
            if last - first < 2:
                continue
            rows = {}
            for r in range(first, last):
                rows.setdefault(key[r].as_py(), r)
            if len(rows) < 2:
                continue
            at = list(rows.values())
            sides = np.array([side[r].as_py() for r in at])
            first = int(first)
            links = link_group(
                list(rows),
                np.stack([np.frombuffer(signature[r].as_py(), np.uint8) for r in at]),
                [np.frombuffer(member[r].as_py(), np.uint32) for r in at],
                side=sides if across[first].as_py() else None,
            )
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.binary()) for k in (0, 1)], schema=schema)


def near_copy_classes(docs: DataFrame) -> DataFrame:
    """doc_id, key (md5 of the text), cluster_id, ``cluster_rows`` and component (NULL for texts without words) for every row of ``docs``
    (doc_id bigint, text)."""
    ship_package(docs.sparkSession)
    keyed = docs.select(
        F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("key"), F.col("text"), F.col("doc_id").cast("bigint").alias("doc_id")
    )
    sketches = cut_lineage(keyed.mapInArrow(_sketch, "key binary, doc_id bigint, n bigint, bands array<bigint>"))
    nodes = cut_lineage(sketches.groupBy("key").agg(
        F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("bands").alias("bands")
    ))

    buckets = nodes.where("n > 0").select("key", "n", F.explode("bands").alias("bucket"))
    full = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("shingles")).where("texts > 1")
    blocks = F.greatest(F.ceil(F.col("texts") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    hits = buckets.join(full.select("bucket", blocks.alias("blocks")), "bucket").select("key", "bucket", "blocks")
    hits = cut_lineage(hits)

    wanted = hits.select("key").distinct().join(nodes.select("key", "first_id"), "key")
    wanted = wanted.select(F.col("key").alias("_key"), "first_id")
    texts = keyed.join(wanted, (F.col("key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("first_id")))
    payload = texts.select("key", "text").mapInArrow(_payload, "key binary, signature binary, members binary")

    own = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    dealt = hits.withColumn("side", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    group = F.xxhash64("bucket", F.least("side", "other"), F.greatest("side", "other"))
    dealt = payload.join(dealt.select("key", "side", (F.col("side") != F.col("other")).alias("across"), group.alias("g")), "key")
    links = dealt.select("g", "key", "side", "across", "signature", "members").repartition("g").sortWithinPartitions("g").mapInArrow(_links, "a binary, b binary")

    components = connected_components(links)
    placed = nodes.join(components, nodes["key"] == components["node"], "left").select(
        "key", "first_id", "copies", "n", F.coalesce("component", "key").alias("component")
    )
    placed = cut_lineage(placed)
    classes = cut_lineage(placed.where("n > 0").groupBy("component").agg(F.min("first_id").alias("cluster_id"), F.sum("copies").alias("cluster_rows")))
    placed = placed.where("n > 0").join(classes, "component").select(F.col("key").alias("_key"), "cluster_id", "cluster_rows", "component")
    rows = sketches.select("doc_id", "key").join(placed, F.col("key") == F.col("_key"), "left")
    alone = F.col("_key").isNull()
    return rows.select(
        "doc_id", "key",
        F.when(alone, F.col("doc_id")).otherwise(F.col("cluster_id")).alias("cluster_id"),
        F.when(alone, F.lit(1).cast("bigint")).otherwise(F.col("cluster_rows")).alias("cluster_rows"),
        "component",
    )


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each class: that of the smallest doc_id, once where its row repeats or its id has several texts."""
    classes = near_copy_classes(docs).where(F.col("doc_id").eqNullSafe(F.col("cluster_id")))
    # One column tells a row by doc_id and text, so that the join and the removal of repeated rows share a shuffle.
    def identity(key: Column) -> Column:
        return F.unhex(F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.hex(key))))

    own = identity(F.col("key"))
    kept = classes.groupBy(F.coalesce("component", own).alias("class")).agg(F.min(own).alias("identity")).select("identity")
    key = F.unhex(F.md5(F.coalesce("text", F.lit(""))))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), identity(key).alias("identity"))
    rows = rows.join(kept, "identity").dropDuplicates(["identity"])
    return rows.select([F.col("row")[c].alias(c) for c in docs.columns])


def op4_near_copies(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_copy_classes(docs).select(
        "doc_id", "cluster_id", "cluster_rows", F.col("doc_id").eqNullSafe(F.col("cluster_id")).alias("kept")
    )
