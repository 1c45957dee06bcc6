"""Harmonic packing: classes of reciprocal length, and as many pieces in each sequence of a class as its number says.

A piece of at most ``capacity / k`` and more than ``capacity / (k + 1)`` ids is of class k, and k of them fill a sequence, whichever they are.  So a
piece's sequence follows from its number inside its class alone, and workers fill sequences without knowing of each other.

What a class wastes is what its pieces lack of ``capacity // k``.  Documents may be cut, so only pieces that lack
at most a ``SLACK``-th of that go into their class as they are.  From all others a head of ``capacity // (k + 1)`` ids is
cut, which lacks nothing in class k + 1, and the rest is looked at again; a document ends in at most four pieces beside its
whole sequences.

The last sequence of a class is not full: at most k - 1 pieces, some thousands over all classes whatever the table's size.  They
are brought to the driver and put, longest first, where they first fit.

Defined results: NULL and empty texts have the end id alone; repeated rows are packed each; an empty table gives an empty
result.  Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from odmeter.llm import byte_tokens
from odmeter.llm.tokens import crc
from odmeter.operators.position import with_position
from odmeter.session import cut_lineage, ship_package

CAPACITY = 2048
END_ID = 1
SLACK = 32
BUCKETS = 1024


def cuts(total: int, capacity: int = CAPACITY, slack: int = SLACK) -> list[tuple[int, int]]:
    """Lengths and classes of the pieces of a document of ``total`` ids, in order."""
    out, left = [(capacity, 1)] * (total // capacity), total % capacity
    while left:
        k = capacity // left
        longest = capacity // k
        if (longest - left) * slack <= longest:
            out.append((left, k))
            break
        head = capacity // (k + 1)
        out.append((head, k + 1))
        left -= head
    return out


def cut_pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens and class of every document's pieces."""
    ship_package(docs.sparkSession)
    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")] + [("class", pa.int32())])

    def cut(batches):
        encoder = byte_tokens.encoder(tokenizer)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encoder.encode(text.as_py()), np.uint32(end_id))
                start = 0
                for length, k in cuts(len(ids), capacity):
                    rows.append((doc_id, start, length, crc(ids[start : start + length]), len(ids), k))
                    start += length
            columns = list(zip(*rows)) or [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    return rows.mapInArrow(cut, "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, class int")


def first_fit(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """Sequence and offset of each length; ``lengths`` falls.  Of sequences, the first with room takes it."""
    used: list[int] = []
    out = []
    for length in lengths:
        at = next((k for k, u in enumerate(used) if u + length <= capacity), len(used))
        if at == len(used):
            used.append(0)
        out.append((at, used[at]))
        used[at] += length
    return out


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset instead of class."""
    spark, names = pieces.sparkSession, [c for c in pieces.columns if c != "class"]
    bucket = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(BUCKETS))
    placed = cut_lineage(with_position(pieces, ["class"], ["doc_id", "start", "ids_crc32", "length"], [bucket]))

    # one row per class
    counts = sorted((r["class"], r["n"]) for r in placed.groupBy("class").agg(F.count(F.lit(1)).alias("n")).collect())
    first, table = 0, []
    for k, n in counts:
        table.append((k, n // k * k, first))
        first += n // k
    classes = F.broadcast(spark.createDataFrame(table, "class int, _full bigint, _first bigint"))
    rows = placed.join(classes, "class")

    whole = rows.where(F.col("position") < F.col("_full"))
    whole = whole.withColumn("sequence_id", F.expr("_first + position div class"))
    before = Window.partitionBy("sequence_id").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    whole = whole.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))

    # fewer than k pieces of class k
    over = rows.where(F.col("position") >= F.col("_full"))
    left = sorted(((-r["length"], r["class"], r["position"]) for r in over.select("class", "position", "length").collect()))
    fitted = first_fit([-n for n, _, _ in left], capacity)
    seats = [(k, p, first + s, at) for (_, k, p), (s, at) in zip(left, fitted)]
    seats = F.broadcast(spark.createDataFrame(seats, "class int, position bigint, sequence_id bigint, offset bigint"))
    return whole.select(*names, "sequence_id", "offset").unionByName(
        over.join(seats, ["class", "position"]).select(*names, "sequence_id", "offset")
    )


def pack_documents(docs: DataFrame) -> DataFrame:
    return pack(cut_lineage(cut_pieces(docs)))


def op12_harmonic_packing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack_documents(docs).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
