"""Best-fit packing by minimum bin slack.

A sequence is filled by the longest piece left and the fullest combination of the lengths that are still there: reachable sums are
a bitset, one shift per length (and power of two of its count), and the combination is read back from the stages.  Pieces of
a length are alike, so the whole plan needs only the number of pieces of each length, a table of at most ``CAPACITY`` rows
counted by Spark; a combination is used as many times at once as its lengths allow.  The plan is a list of
runs: pieces number a to b of a length go to these sequences at this offset.

Pieces are numbered inside their length by Spark, in hashed buckets, so that a length that most pieces have
(whole sequences of a cut document) is not one task's work.

Defined results: NULL and empty texts have the end id alone; rows that repeat are packed each; an empty table gives
an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odmeter.llm import tokens
from odmeter.operators.position import with_position
from odmeter.session import cut_lineage, ship_package

CAPACITY = 2048
END_ID = 0
BUCKETS = 1024


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """Lengths, with how many of each, whose sum is the largest that doesn't exceed ``room``."""
    mask, reach, stages = (1 << (room + 1)) - 1, 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, share = min(counts[length], room // length), 1
        while left and not reach >> room & 1:
            share = min(share, left)
            stages.append((length, share, reach))
            reach |= reach << (length * share) & mask
            left, share = left - share, share * 2
        if reach >> room & 1:
            break
    total, taken = reach.bit_length() - 1, defaultdict(int)
    for length, share, before in reversed(stages):
        if not before >> total & 1:
            taken[length] += share
            total -= length * share
    return dict(taken)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Combinations of lengths and how many sequences are filled with each."""
    left, filled = {n: c for n, c in counts.items() if c}, []
    while left:
        longest = max(left)
        left[longest] -= 1
        combination = fullest({n: c for n, c in left.items() if c}, capacity - longest)
        left[longest] += 1
        combination[longest] = combination.get(longest, 0) + 1
        times = min(left[n] // k for n, k in combination.items())
        for n, k in combination.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
        filled.append((combination, times))
    return filled


def runs(filled: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """By length: rows of (first piece number, pieces per sequence, first sequence, offset), in order."""
    used, rows, sequence = defaultdict(int), defaultdict(list), 0
    for combination, times in filled:
        offset = 0
        for length, k in sorted(combination.items(), reverse=True):
            rows[length].append((used[length], k, sequence, offset))
            used[length] += k * times
            offset += length * k
        sequence += times
    return {n: np.array(r, np.int64) for n, r in rows.items()}


def cut_pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every document's pieces."""
    ship_package(docs.sparkSession)
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    schema = pa.schema(fields + ([("ids", pa.list_(pa.int32()))] if with_ids else []))

    def cut(batches):
        encoder = tokens.encoder(tokenizer)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encoder.encode(text.as_py()), np.uint32(end_id))
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    rows.append((doc_id, piece, start, len(part), tokens.crc(part)) + ((part.astype(np.int32),) if with_ids else ()))
            columns = list(zip(*rows)) or [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    text = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids array<int>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text")).mapInArrow(cut, text)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset; ``length`` is from 1 to ``capacity``."""
    ship_package(pieces.sparkSession)
    pieces = cut_lineage(pieces)
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    by_length = runs(plan(counts, capacity))

    def place(batches):
        for batch in batches:
            length, number = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "position"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length):
                at, table = np.flatnonzero(length == n), by_length[int(n)]
                run = table[np.searchsorted(table[:, 0], number[at], "right") - 1]
                inside = number[at] - run[:, 0]
                sequence[at] = run[:, 2] + inside // run[:, 1]
                offset[at] = run[:, 3] + inside % run[:, 1] * n
            kept = batch.drop_columns(["position", "group_rows"])
            yield kept.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    bucket = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(BUCKETS))
    numbered = with_position(pieces, ["length"], ["doc_id", "piece", "ids_crc32"], [bucket])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return numbered.mapInArrow(place, f"{fields}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, with_ids: bool = False) -> DataFrame:
    return pack(cut_pieces(docs, with_ids=with_ids))


def op10_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack_documents(docs).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
