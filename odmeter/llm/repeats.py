"""Repeated passages: bytes covered by a 400-byte string that starts anywhere else too.

All 400-byte strings of a text are dealt to *anchors*: of the 64-byte grams inside a string the one with the lowest hash
(rightmost of equals), which depends on the string alone, so equal strings have equal anchors wherever they stand.
Neighbouring strings of one anchor form a *run*.  Most anchors occur once, and their strings with them; the rest:

* Runs equal in all bytes are counted by Spark; two or more make every string in them repeated.
* Different runs with one anchor gram are compared: the texts after the anchor and those before it (backwards) are
  suffix-sorted (``suffix_sort``), and for each place of a string around its anchor two strings are equal if no smaller common prefix
  lies between them in either order.  Only one copy of equal runs takes part.
* A gram with more than ``HOT`` different runs is not one task's work: its strings are counted by their BLAKE2 digests,
  with partial sums before the shuffle.  Equal runs are told by such digests too, equal texts by SHA-256: sums of powers
  modulo 2^64 agree on different bytes (Thue-Morse words do so for any base), so they only find anchors.

Everything is judged on the input.  Texts longer than a chunk are cut into segments that overlap by 399 bytes.

Defined results: NULL texts are empty; texts below 400 bytes keep all bytes; repeated rows are texts of their own, so both
lose what is long enough; an empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odmeter.llm.groups import whole_groups
from odmeter.llm.hashing import _BASE, _BASE_INVERSE, mix64, powers
from odmeter.llm.suffix_sort import deep_shallow_sort
from odmeter.session import cut_lineage, ship_package

LENGTH = 400
GRAM = 64
HOT = 4096
SEGMENT = 1 << 20
_PLACE = np.uint64((1 << 26) - 1)
DIGEST = 16


def _hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums and inverse powers, from which the hash of any slice follows."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data + np.uint64(1)) * powers(_BASE, len(data)), out=sums[1:])
    return sums, powers(_BASE_INVERSE, len(data) + 1)


def _digests(data: bytes, start: np.ndarray, end: np.ndarray) -> list[bytes]:
    """A digest of each slice; those of different bytes differ."""
    view = memoryview(data)
    return [hashlib.blake2b(view[a:b], digest_size=DIGEST).digest() for a, b in zip(start.tolist(), end.tolist())]


def _slice_hash(sums, inverse, start, end):
    return (sums[end] - sums[start]) * inverse[start]


def lowest_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    n = len(values) - width + 1
    padded = np.concatenate([values, np.full(-len(values) % width, np.iinfo(values.dtype).max, values.dtype)]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, 1).reshape(-1)
    behind = np.minimum.accumulate(padded[:, ::-1], 1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def runs_of(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> dict[str, np.ndarray]:
    """Runs of all texts: text number, start of the first string, number of strings, anchor's place after the start, hash of
    the anchor gram and digest of the run's bytes."""
    parts = []
    sizes = np.array([len(t) for t in texts], np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    if bounds[-1] >= length:
        joined = b"".join(texts)
        data = np.frombuffer(joined, np.uint8)
        sums, inverse = _hashes(data)
        grams = mix64(_slice_hash(sums, inverse, np.arange(len(data) - gram + 1), np.arange(gram, len(data) + 1)))
        ranked = (grams & ~_PLACE) | (_PLACE - np.arange(len(grams), dtype=np.uint64))
        anchor = (_PLACE - (lowest_in_windows(ranked, length - gram + 1) & _PLACE)).astype(np.int64)
        starts = np.arange(len(anchor))
        owner = np.repeat(np.arange(len(texts)), sizes)[: len(starts)]
        whole = starts + length <= bounds[owner + 1]
        starts, anchor, owner = starts[whole], anchor[whole], owner[whole]
        if len(starts):
            new = np.ones(len(starts), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
            first = np.flatnonzero(new)
            count = np.diff(np.append(first, len(starts)))
            start, owner, anchor = starts[first], owner[first], anchor[first]
            content = np.array(_digests(joined, start, start + count + length - 1), object)
            parts = [owner, start - bounds[owner], count, anchor - start, grams[anchor].view(np.int64), content]
    names = ("text", "start", "strings", "place", "gram", "content")
    return dict(zip(names, parts or [*[np.zeros(0, np.int64)] * 5, np.zeros(0, object)]))


def _segments(batch: pa.RecordBatch, column: int, length: int):
    """Groups of (row, offset, bytes) of about ``SEGMENT`` bytes; long texts in overlapping segments."""
    held, size = [], 0
    for row, text in enumerate(batch.column(column).cast(pa.binary()).to_pylist()):
        text = text or b""
        for offset in range(0, max(1, len(text) - length + 1), SEGMENT):
            piece = text[offset : offset + SEGMENT + length - 1]
            held.append((row, offset, piece))
            size += len(piece)
            if size >= SEGMENT:
                yield held
                held, size = [], 0
    if held:
        yield held


def _find_runs(length: int, gram: int):
    def find(batches):
        for batch in batches:
            keys, ids = batch.column(0), batch.column(2)
            for held in _segments(batch, 1, length):
                found = runs_of([h[2] for h in held], length, gram)
                row = np.array([h[0] for h in held])[found["text"]]
                offset = np.array([h[1] for h in held], np.int64)[found["text"]]
                yield pa.RecordBatch.from_pydict({
                    "key": keys.take(pa.array(row)), "doc_id": ids.take(pa.array(row)),
                    "start": pa.array((found["start"] + offset).astype(np.int32)), "strings": pa.array(found["strings"].astype(np.int32)),
                    "place": pa.array(found["place"].astype(np.int32)), "gram": found["gram"], "content": pa.array(found["content"], pa.binary()),
                })

    return find


def _cut_contents(length: int):
    """Per run: the bytes before its anchor backwards, and from the anchor on; and whether its gram is hot."""

    def cut(batches):
        for batch in batches:
            out = []
            for text, wanted in zip(batch.column(0).cast(pa.binary()), batch.column(1)):
                text = text.as_py()
                for w in wanted.as_py():
                    anchor, end = w["start"] + w["place"], w["start"] + w["strings"] + length - 1
                    out.append((w["gram"], w["content"], w["strings"], text[w["start"] : anchor][::-1], text[anchor:end], w["hot"]))
                if len(out) > 2000:
                    yield batch_of(out)
                    out = []
            if out:
                yield batch_of(out)

    def batch_of(rows):
        kinds = (pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=["gram", "content", "strings", "before", "after", "hot"])

    return cut


def equal_strings(group: np.ndarray, before: list[bytes], after: list[bytes], strings: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """For runs with anchors of ``group``: which of their strings another of the runs has too (a boolean array each).

    A string that begins d bytes before the anchor is known by its class in the order of ``before`` cut at d and its
    class in the order of ``after`` cut at ``length - d``.
    """
    n = len(group)
    tag = [int(g).to_bytes(8, "big") for g in group]
    orders = []
    for texts in (before, after):
        order, shared = deep_shallow_sort([t + x for t, x in zip(tag, texts)], 24)
        orders.append((order, shared - 8))
    place = np.array([len(b) for b in before])
    out = [np.zeros(s, bool) for s in strings]
    if not n:
        return out
    low, high = place - strings + 1, place
    for d in range(max(0, int(low.min())), int(high.max()) + 1):
        at = np.flatnonzero((low <= d) & (d <= high))
        if len(at) < 2:
            continue
        classes = []
        for (order, shared), depth in zip(orders, (d, length - d)):
            number = np.empty(n, np.int64)
            number[order] = np.cumsum(shared < depth)
            classes.append(number[at])
        _, which, count = np.unique(classes[0] * (n + 1) + classes[1], return_inverse=True, return_counts=True)
        for k in at[count[which] > 1]:
            out[k][place[k] - d] = True
    return out


def _compare(length: int):
    def compare(batches):
        for table, bounds in whole_groups(batches, "gram"):
            groups = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
            gram, strings, content = table.column("gram").to_numpy(), table.column("strings").to_numpy(), np.array(table.column("content").to_pylist(), object)
            fresh = np.ones(len(gram), bool)  # a text whose row repeats brings its runs again
            fresh[1:] = (gram[1:] != gram[:-1]) | (content[1:] != content[:-1])
            at = np.flatnonzero(fresh)
            before, after = (table.column(c).take(pa.array(at)).to_pylist() for c in ("before", "after"))
            found = equal_strings(groups[at], before, after, strings[at], length)
            keep = [k for k, f in enumerate(found) if f.any()]
            yield pa.RecordBatch.from_pydict({
                "gram": pa.array(gram[at[keep]], pa.int64()), "content": pa.array(content[at[keep]], pa.binary()),
                "bits": pa.array([np.packbits(found[k]).tobytes() for k in keep], pa.binary()),
            })

    return compare


def _hash_strings(length: int):
    def strings(batches):
        for batch in batches:
            for gram, content, count, before, after in zip(*(c.to_pylist() for c in batch.columns)):
                start = np.arange(count)
                yield pa.RecordBatch.from_pydict({
                    "gram": np.full(count, gram), "content": pa.array([content] * count, pa.binary()), "n": start.astype(np.int32),
                    "digest": pa.array(_digests(before[::-1] + after, start, start + length), pa.binary()),
                })

    return strings


def _gather(batches):
    for batch in batches:
        bits = []
        for places in batch.column(2).to_pylist():
            marks = np.zeros(max(places) + 1, bool)
            marks[places] = True
            bits.append(np.packbits(marks).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bits, pa.binary())], names=["gram", "content", "bits"])


def covered(n: int, pieces: list[tuple[int, int, bytes | None]], length: int = LENGTH) -> np.ndarray:
    """Which bytes of a text of ``n`` are covered; pieces are (start, strings, bits or None for all)."""
    begins = np.zeros(n + 1, np.int64)
    for start, strings, bits in pieces:
        if bits is None:
            begins[start : start + strings] = 1
        else:
            begins[start + np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8))[:strings])] = 1
    so_far = np.cumsum(begins[:n])
    earlier = np.concatenate([np.zeros(min(length, n), np.int64), so_far[: max(0, n - length)]])
    return so_far > earlier


def _remove(length: int, with_text: bool):
    def remove(batches):
        for batch in batches:
            rows = []
            for text, pieces in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist()):
                text = text or b""
                if not pieces:
                    rows.append((len(text), 0, 0, text))
                    continue
                gone = covered(len(text), [(p["start"], p["strings"], p["bits"]) for p in pieces], length)
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                rows.append((len(text), int(gone.sum()), spans, np.frombuffer(text, np.uint8)[~gone].tobytes()))
            columns = [batch.column(0), *(pa.array([r[k] for r in rows], pa.int64()) for k in range(3)), pa.array([hashlib.sha256(r[3]).hexdigest() for r in rows], pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                columns, names = columns + [pa.array([r[3] for r in rows], pa.binary())], names + ["kept_bytes"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return remove


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept_bytes) for every row of ``docs`` (doc_id bigint, text)."""
    ship_package(docs.sparkSession)
    docs = docs.select(F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)).alias("key"), "text", F.col("doc_id").cast("bigint").alias("doc_id"))
    fields = "key binary, doc_id bigint, start int, strings int, place int, gram bigint, content binary"
    long = docs.where(F.octet_length("text") >= length)
    every = cut_lineage(long.mapInArrow(_find_runs(length, gram), fields))
    # Tables of keys are written before they are joined: adaptive execution splits a hot gram of plain shuffles only.
    again = cut_lineage(every.groupBy("gram").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("gram"))
    runs = cut_lineage(every.join(again, "gram"))

    kinds = cut_lineage(runs.groupBy("gram", "content").agg(
        F.count(F.lit(1)).alias("times"), F.min(F.struct("doc_id", "key", "start", "strings", "place")).alias("at")
    ))
    several = cut_lineage(kinds.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1"))
    compared = kinds.join(several, "gram")
    wanted = compared.select("at.key", "at.doc_id", F.struct("gram", "content", "at.start", "at.strings", "at.place", (F.col("kinds") > hot).alias("hot")).alias("w"))
    wanted = wanted.groupBy("key", "doc_id").agg(F.collect_list("w").alias("wanted")).select(
        F.col("key").alias("_key"), F.col("doc_id").alias("_doc_id"), "wanted"
    )
    sources = docs.join(wanted, (F.col("key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_doc_id")))
    contents = cut_lineage(sources.select("text", "wanted").mapInArrow(
        _cut_contents(length), "gram bigint, content binary, strings int, before binary, after binary, hot boolean"
    ))
    # No join by gram stands before this shuffle: it would take its place, and adaptive execution may then read a gram in several tasks.
    few = contents.where("not hot").drop("hot").repartition("gram").sortWithinPartitions("gram", "content")
    sorted_bits = few.mapInArrow(_compare(length), "gram bigint, content binary, bits binary")

    hot_runs = contents.where("hot").drop("hot").dropDuplicates(["gram", "content"])
    strings = cut_lineage(hot_runs.mapInArrow(_hash_strings(length), "gram bigint, content binary, n int, digest binary"))
    equal = strings.groupBy("digest").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("digest")
    places = strings.join(equal, "digest").groupBy("gram", "content").agg(F.collect_list("n").alias("places"))
    hot_bits = places.mapInArrow(_gather, "gram bigint, content binary, bits binary")

    whole = kinds.where("times > 1").select("gram", "content", F.lit(None).cast("binary").alias("bits"))
    partly = sorted_bits.unionByName(hot_bits).join(kinds.where("times = 1").select("gram", "content"), ["gram", "content"], "left_semi")
    verdicts = cut_lineage(whole.unionByName(partly))
    pieces = runs.join(verdicts, ["gram", "content"]).groupBy("key", "start").agg(
        F.first("strings").alias("strings"), F.first("bits").alias("bits")
    )
    pieces = pieces.groupBy("key").agg(F.collect_list(F.struct("start", "strings", "bits")).alias("pieces"))
    judged = docs.join(pieces.withColumnRenamed("key", "_key"), F.col("key") == F.col("_key"), "left")
    text = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + (", kept_bytes binary" if with_text else "")
    return judged.select("doc_id", "text", "pieces").mapInArrow(_remove(length, with_text), text)


def op8_remove_repeats(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs).withColumn("has_repeat", F.col("n_removed") > 0)
