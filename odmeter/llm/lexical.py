"""Ranked lexical search with length buckets: a document is a sparse vector of integer impacts, and a search goes from long vectors to short ones.

Of a document only the terms that an item asks for are kept: the entry of term t is ``w(t) * ((10^9 tf) div (1000 tf + 8 m))``, and the score
of an item is the sum of the entries of its terms, an inner product with a vector of ones.

* **Index.** One scan of the texts writes tf of the asked terms and n of each document; Spark sums give N, L and df.
  The impact vectors are written ordered by length (Euclidean norm), with a level (eighths of a power of two) as a column.
* **First round.** The longest levels that hold ``FIRST`` documents are searched; they give each item a score that its
  tenth best document reaches at least.
* **Second round.** The scan skips all vectors too short for any item (a filter on the norm, pushed to the file's statistics).
  A task cuts the rest, longest first, into buckets.  Cauchy-Schwarz (``sqrt(terms) * longest norm``) drops a bucket for an item.
  Inside, the item's rarer coordinates are added up from the postings; what the commoner ones can add is bounded by the
  largest entry of each coordinate in the bucket and by Cauchy-Schwarz over the rest of the vector.  Survivors are scored
  in 64-bit integers.
* At most ten documents of each item leave a task, and only those that the threshold lets through.

Items come in blocks of ``BLOCK_BYTES`` of text, so what is sent to the tasks is bounded; each block is a search of its own.

Defined results: NULL texts have no term, and are no documents to N; items without a known term have no rows; repeated
items and documents count each, equal scores and ids in any order; a NULL doc_id comes after the others; empty tables give
an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from odmeter.llm.hashing import chunks
from odmeter.session import new_folder, ship_package

TOP = 10
FIRST = 8192
BUCKET = 4096
BLOCK_BYTES = 4 << 20
LAST_ID = 2**63 - 1
#: every ASCII byte that is no letter or digit becomes a space; A-Z become a-z
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
#: allowance for rounding of the bounds, which are in doubles
_SLACK = 1 + 1e-9


def terms(text: bytes) -> list[bytes]:
    """Terms of a UTF-8 text in order."""
    return text.translate(_TERM_BYTES).split()


def item_blocks(items: DataFrame, size: int = BLOCK_BYTES) -> Iterator[list[tuple[int, list[bytes]]]]:
    """Items with their distinct terms, in blocks of about ``size`` bytes; rows are brought down a partition at a time."""
    block, held = [], 0
    for row in items.select(F.col("item_id").cast("bigint"), F.col("text").cast("binary")).toLocalIterator():
        asked = sorted(set(terms(bytes(row[1] or b""))))
        if asked:
            block.append((row[0], asked))
            held += len(row[1])
        if held >= size:
            yield block
            block, held = [], 0
    if block:
        yield block


def weight(total: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * total + 2) / (2 * df + 1)))


def count_terms(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n, ids and tfs (unsigned 32-bit integers) of the terms of ``vocabulary``; documents without terms are left out."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches):
        known = sent.value
        for batch, texts in chunks(batches, 1):
            lengths, ids, tfs = [], [], []
            for text in texts:
                words = terms(text)
                lengths.append(len(words))
                found = np.array([known[w] for w in words if w in known], np.uint32)
                each, times = np.unique(found, return_counts=True)
                ids.append(each.astype("<u4").tobytes())
                tfs.append(times.astype("<u4").tobytes())
            kept = np.flatnonzero(np.array(lengths, np.int64))
            rows = pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lengths, pa.int64()), pa.array(ids, pa.binary()), pa.array(tfs, pa.binary())], names=["doc_id", "n", "ids", "tfs"]
            )
            yield rows.take(pa.array(kept))

    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return slim.mapInArrow(count, "doc_id bigint, n bigint, ids binary, tfs binary")


def document_counts(counted: DataFrame, size: int) -> np.ndarray:
    """df of every term of a vocabulary of ``size`` terms; tasks add up their documents first."""

    def add(batches):
        held = np.zeros(size, np.int64)
        for batch in batches:
            data = b"".join(batch.column(0).to_pylist())
            held += np.bincount(np.frombuffer(data, "<u4"), minlength=size)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(held[at], pa.int64())], names=["id", "df"])

    df = np.zeros(size, np.int64)
    for row in counted.select("ids").mapInArrow(add, "id bigint, df bigint").groupBy("id").agg(F.sum("df").alias("df")).collect():
        df[row["id"]] = row["df"]
    return df


def impact_vectors(counted: DataFrame, weights: np.ndarray, total: int, length: int) -> DataFrame:
    """doc_id, norm, level, ids and impacts (64-bit integers) of the documents with an entry above 0."""

    def weigh(batches):
        for batch in batches:
            out_norms, out_ids, out_impacts = [], [], []
            for n, ids, tfs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                ids, tfs = np.frombuffer(ids, "<u4"), np.frombuffer(tfs, "<u4").astype(np.int64)
                m = 100 - 90 + (90 * n * total) // length
                impacts = weights[ids] * ((1_000_000_000 * tfs) // (1000 * tfs + 8 * m))
                out_ids.append(ids[impacts > 0].tobytes())
                impacts = impacts[impacts > 0]
                out_impacts.append(impacts.astype("<i8").tobytes())
                out_norms.append(math.sqrt(float(np.square(impacts.astype(np.float64)).sum())))
            norms = np.array(out_norms)
            levels = np.floor(8 * np.log2(np.maximum(norms, 1))).astype(np.int32)
            rows = pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(norms), pa.array(levels), pa.array(out_ids, pa.binary()), pa.array(out_impacts, pa.binary())],
                names=["doc_id", "norm", "level", "ids", "impacts"],
            )
            yield rows.take(pa.array(np.flatnonzero(norms > 0)))

    return counted.mapInArrow(weigh, "doc_id bigint, norm double, level int, ids binary, impacts binary")


class Best:
    """The best documents of each item so far, and the score below which none can enter."""

    def __init__(self, floors: np.ndarray, top: int):
        self.floors, self.top = floors.copy(), top
        self.found: list[list[tuple[int, int]]] = [[] for _ in floors]

    def offer(self, item: int, ids: np.ndarray, scores: np.ndarray) -> None:
        keep = scores >= max(1, self.floors[item])
        ids, scores = ids[keep], scores[keep]
        if not len(ids):
            return
        first = np.lexsort((ids, -scores))[: self.top]
        both = self.found[item] + list(zip((-scores[first]).tolist(), ids[first].tolist()))
        self.found[item] = sorted(both)[: self.top]
        if len(self.found[item]) == self.top:
            self.floors[item] = max(self.floors[item], -self.found[item][-1][0])


class Bucket:
    """Some vectors of similar length, as postings by term."""

    def __init__(self, doc_ids: np.ndarray, norms: np.ndarray, ids: list[bytes], impacts: list[bytes], size: int):
        sizes = np.array([len(x) // 4 for x in ids])
        owners = np.repeat(np.arange(len(ids)), sizes)
        entries = np.frombuffer(b"".join(ids), "<u4").astype(np.int64)
        values = np.frombuffer(b"".join(impacts), "<i8")
        order = np.argsort(entries, kind="stable")
        self.doc_ids, self.norms = doc_ids, norms
        self.owners, self.values = owners[order], values[order]
        self.bounds = np.searchsorted(entries[order], np.arange(size + 1))
        self.longest = float(norms.max())

    def search(self, item: int, asked: np.ndarray, best: Best) -> None:
        """Offers the item's documents in this bucket that can be among its best."""
        floor = float(max(1, best.floors[item]))
        if math.sqrt(len(asked)) * self.longest * _SLACK < floor:
            return
        starts, ends = self.bounds[asked], self.bounds[asked + 1]
        held = np.flatnonzero(ends > starts)
        if not len(held):
            return
        lists = sorted(zip((ends - starts)[held].tolist(), starts[held].tolist(), ends[held].tolist()))
        most = np.array([float(self.values[s:e].max()) for _, s, e in lists])
        # from the rarest term on, until what is left can't reach the floor on its own
        rest = np.append(np.cumsum(most[::-1])[::-1], 0.0)
        cut = int(np.flatnonzero(rest * _SLACK < floor)[0])
        sums, squares = np.zeros(len(self.norms), np.int64), np.zeros(len(self.norms))
        for _, s, e in lists[:cut]:
            at, value = self.owners[s:e], self.values[s:e]
            sums[at] += value
            squares[at] += np.square(value.astype(np.float64))
        alive = np.flatnonzero(sums)
        open_norm = np.sqrt(np.maximum(np.square(self.norms[alive]) * _SLACK - squares[alive], 0))
        bound = sums[alive] + np.minimum(rest[cut], math.sqrt(len(lists) - cut) * open_norm)
        alive = alive[bound * _SLACK >= floor]
        if not len(alive):
            return
        for k in range(cut, len(lists)):
            _, s, e = lists[k]
            place = np.searchsorted(self.owners[s:e], alive)
            inside = np.flatnonzero(place < e - s)
            inside = inside[self.owners[s + place[inside]] == alive[inside]]
            sums[alive[inside]] += self.values[s + place[inside]]
            keep = (sums[alive] + rest[k + 1]) * _SLACK >= floor
            alive = alive[keep]
        best.offer(item, self.doc_ids[alive], sums[alive])


def searched(vectors: DataFrame, asked: list[np.ndarray], floors: np.ndarray, size: int, top: int) -> DataFrame:
    """item (its number), doc_id and score: at most ``top`` rows of each item and task."""
    sent = vectors.sparkSession.sparkContext.broadcast((asked, floors))

    def search(batches):
        items, starts = sent.value
        best = Best(starts, top)
        for batch in batches:
            ids = batch.column(0).fill_null(LAST_ID).to_numpy()
            norms = batch.column(1).to_numpy()
            order = np.argsort(-norms, kind="stable")
            for at in range(0, len(order), BUCKET):
                some = order[at : at + BUCKET]
                part = batch.take(pa.array(some))
                bucket = Bucket(ids[some], norms[some], part.column(2).to_pylist(), part.column(3).to_pylist(), size)
                for item, each in enumerate(items):
                    bucket.search(item, each, best)
        rows = [(item, None if d == LAST_ID else d, -s) for item, found in enumerate(best.found) for s, d in found]
        columns = list(zip(*rows)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())], names=["item", "doc_id", "score"])

    columns = vectors.select("doc_id", "norm", "ids", "impacts")
    return columns.mapInArrow(search, "item int, doc_id bigint, score bigint")


def ranked(found: DataFrame, top: int) -> DataFrame:
    window = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= top)


def _search_block(docs: DataFrame, items: list[tuple[int, list[bytes]]], top: int, first: int) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = {w: k for k, w in enumerate(sorted({w for _, asked in items for w in asked}))}
    size = len(vocabulary)
    path = new_folder(spark, "terms")
    count_terms(docs, vocabulary).write.parquet(path)
    counted = spark.read.parquet(path)
    total, length = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = document_counts(counted, size)
    weights = np.array([weight(total, int(x)) for x in df], np.int64)

    path = new_folder(spark, "impacts")
    made = impact_vectors(counted, weights, total, max(1, length))
    made.repartitionByRange(F.desc("norm"), F.col("doc_id")).sortWithinPartitions(F.desc("norm")).write.parquet(path)
    vectors = spark.read.parquet(path)

    asked = [np.array(sorted(vocabulary[w] for w in each), np.int64) for _, each in items]
    levels = sorted(((r["level"], r["count"]) for r in vectors.groupBy("level").count().collect()), reverse=True)
    held, lowest = 0, 0
    for lowest, count in levels:
        held += count
        if held >= first:
            break
    floors = np.zeros(len(items), np.int64)
    if held >= first:
        begun = ranked(searched(vectors.where(F.col("level") >= lowest), asked, floors, size, top), top)
        for row in begun.where(F.col("rank") == top).select("item", "score").collect():
            floors[row["item"]] = row["score"]
    shortest = min((max(1, f) / math.sqrt(len(a)) for f, a in zip(floors.tolist(), asked)), default=0) / _SLACK
    best = ranked(searched(vectors.where(F.col("norm") >= shortest), asked, floors, size, top), top)
    names = spark.createDataFrame([(k, item_id) for k, (item_id, _) in enumerate(items)], "item int, item_id bigint")
    return best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, first: int = FIRST, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the ``top`` best documents of every row of ``items`` (item_id, text)."""
    spark = docs.sparkSession
    ship_package(spark)
    found = spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    path = new_folder(spark, "ranked")
    for block in item_blocks(items, block_bytes):
        _search_block(docs, block, top, first).write.mode("append").parquet(path)
        found = spark.read.parquet(path)
    return found


ORACLE = r"""
WITH words AS (
  SELECT row_number() OVER () AS doc, doc_id,
   regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), docs AS (SELECT doc, doc_id, terms, len(terms)::BIGINT AS n FROM words WHERE len(terms) > 0
), totals AS (SELECT count(*)::BIGINT AS total, sum(n)::BIGINT AS length FROM docs
), tfs AS (
  SELECT doc, term, count(*)::BIGINT AS tf FROM (SELECT doc, unnest(terms) AS term FROM docs) GROUP BY doc, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * total + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tfs, totals GROUP BY term, total
), asked AS (
  SELECT DISTINCT item, item_id, term FROM (
   SELECT row_number() OVER () AS item, item_id,
    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
), scored AS (
  SELECT item, item_id, d.doc, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * total) // length)))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN tfs USING (term) JOIN docs d ON d.doc = tfs.doc, totals GROUP BY ALL
), ranks AS (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranks WHERE rank <= 10
"""


def op11_ranked_search(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return search(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
