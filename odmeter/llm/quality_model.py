"""Quality classifier: hashed word n-grams, logistic regression, follow-the-regularised-leader updates.

Features of a text are n-grams of its words and of its words' forms (how a word begins and ends, whether it repeats the word before),
hashed into ``SLOTS`` slots; counts of either family are scaled to length 1.  The score is
the logistic function of a sparse dot product.  Nothing but the text enters a score.

Training takes at most ``TRAINING_ROWS`` labelled documents, picked by a hash of doc_id, so that the model fits the driver;
their features are made in the tasks.  Labels are only taken from documents outside the held-out fold.

Defined results: NULL and empty texts score by the bias alone; rows of ``labels`` without doc_id or quality are ignored, of several for
one document the lowest counts, and of several texts of one doc_id one is learned from; without usable labels every score is 0.5; repeated
documents score alike; an empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odmeter.llm.hashing import Words, chunks, mix64
from odmeter.session import ship_package

SLOTS = 1 << 18
TRAINING_ROWS = 6000
EPOCHS = 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-3
THRESHOLD = 0.7
CHUNK = 1 << 18  # bytes of text whose features a worker holds at once

_KIND = np.zeros(256, np.uint64)  # of a byte: letter, digit, upper case, stop, symbol, other
_KIND[[*range(ord("a"), ord("z") + 1)]] = 1
_KIND[[*range(ord("A"), ord("Z") + 1)]] = 2
_KIND[[*range(ord("0"), ord("9") + 1)]] = 3
_KIND[[ord(c) for c in ".,;:!?"]] = 4
_KIND[[ord(c) for c in "#*$%&|<>"]] = 5
_KIND[128:] = 6


def held_out(doc_id: Column) -> Column:
    """Whether a document is in the fold that nothing is learned from; a NULL doc_id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def features(texts: list[bytes], slots: int = SLOTS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, slot and value of every feature, ordered by text."""
    words = Words(texts)
    n, doc, h = len(words.hashes), words.doc, words.hashes
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)
    same_text = np.zeros(n, bool)
    same_text[1:] = doc[1:] == doc[:-1]
    repeats = same_text.copy()
    repeats[1:] &= h[1:] == h[:-1]
    long = np.minimum(words.ends - words.starts, 24).astype(np.uint64) // np.uint64(8)
    form = _KIND[words.data[words.starts]] + np.uint64(8) * _KIND[words.data[words.ends - 1]] + np.uint64(64) * repeats.astype(np.uint64) + np.uint64(128) * long

    def grams(values: np.ndarray, size: int, family: int) -> tuple[np.ndarray, np.ndarray]:
        mixed, whole = mix64(values, family), np.ones(n, bool)
        for k in range(1, size):
            whole[k:] &= doc[k:] == doc[:-k]
            whole[:k] = False
            mixed[k:] = mixed[k:] + mix64(values[:-k], family + 16 * k) if k < n else mixed[k:]
        return doc[whole], mix64(mixed[whole], family)

    out, half = [], slots // 2  # either family has half of the slots
    for first, (values, sizes, family) in zip((0, half), ((h, (1, 2), 101), (form, (1, 2, 3), 201))):
        parts = [grams(values, size, family + size) for size in sizes]
        of, key = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        cell, count = np.unique(of.astype(np.int64) * half + (key % np.uint64(half)).astype(np.int64), return_counts=True)
        of, value = cell // half, np.log1p(count)
        length = np.sqrt(np.bincount(of, value * value, len(texts)))
        out.append((of, first + cell % half, (value / length[of]).astype(np.float32)))
    of, slot, value = (np.concatenate(x) for x in zip(*out))
    order = np.argsort(of, kind="stable")
    return of[order], slot[order], value[order]


class Ftrl:
    """Per-coordinate follow-the-regularised-leader with a logistic loss; slot ``slots`` is the bias.

    The slots of one example are distinct.
    """

    def __init__(self, slots: int = SLOTS):
        self.z, self.n = np.zeros(slots + 1), np.zeros(slots + 1)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, slot: np.ndarray, value: np.ndarray, label: int) -> None:
        slot, value = np.append(slot, len(self.z) - 1), np.append(value, 1.0)
        weight = self.weights(slot)
        gradient = (1 / (1 + np.exp(-np.clip(weight @ value, -35, 35))) - label) * value
        before = self.n[slot]
        self.n[slot] = after = before + gradient * gradient
        self.z[slot] += gradient - (np.sqrt(after) - np.sqrt(before)) / ALPHA * weight


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS, epochs: int = EPOCHS) -> np.ndarray:
    """Weights (float32, the bias last) learned from at most ``rows`` labelled documents outside the held-out fold."""
    ship_package(docs.sparkSession)
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)  # so many rows at most are sent to all tasks
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def extract(batches):
        for batch, texts in chunks(batches, 1, CHUNK):
            of, slot, value = features(texts)
            bounds = np.searchsorted(of, np.arange(len(texts) + 1))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "quality": batch.column(2),
                "slots": [slot[bounds[k] : bounds[k + 1]].astype("<i4").tobytes() for k in range(len(texts))],
                "vals": [value[bounds[k] : bounds[k + 1]].astype("<f4").tobytes() for k in range(len(texts))],
            })

    # one row for each document, however often its id is there: no more than ``rows`` come to the driver
    one = F.min_by(F.struct("text", "quality"), F.md5(F.coalesce("text", F.lit("")))).alias("one")
    sample = sample.groupBy("doc_id").agg(one).select("doc_id", "one.text", F.col("one.quality").cast("int").alias("quality"))
    made = sample.mapInArrow(extract, "doc_id bigint, quality int, slots binary, vals binary").collect()
    examples = sorted(made, key=lambda r: (r["doc_id"] * 0x9E3779B1 % 4294967291, r["doc_id"], bytes(r["slots"])))[:rows]
    model = Ftrl()
    for _ in range(epochs):
        for r in examples:
            model.learn(np.frombuffer(r["slots"], "<i4"), np.frombuffer(r["vals"], "<f4"), int(r["quality"] == 1))
    return model.weights().astype(np.float32)


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``docs`` with ``score``, 0 to 1; a column of that name is replaced."""
    spark = docs.sparkSession
    ship_package(spark)
    sent = spark.sparkContext.broadcast(weights)
    docs = docs.select([F.col(f"`{c}`") for c in docs.columns if c != "score"])
    text = docs.columns.index("text")

    def rate(batches):
        w = sent.value
        for batch, texts in chunks(batches, text, CHUNK):
            of, slot, value = features(texts)
            total = np.bincount(of, w[slot].astype(np.float64) * value, len(texts)) + float(w[-1])
            yield batch.append_column("score", pa.array(1 / (1 + np.exp(-np.clip(total, -35, 35)))))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(rate, f"{fields}, score double")


def op3_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    weights = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score(docs, weights).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
