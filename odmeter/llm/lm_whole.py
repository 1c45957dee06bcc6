"""Cross-entropy difference: how much likelier a target's language model finds a text than the background's.

Two bigram models share one vocabulary: every word of target and background, without a limit and without an entry for other words.  The
background is all documents, every one of them; its counts are scaled to the target's number of tokens, so that both are
smoothed alike.  A bigram's chance is ``(c(h, w) + MASS * p(w)) / (c(h) + MASS)`` with add-one word chances ``p(w)``.  A document's
score is the mean over its words of (background loss - target loss): higher is nearer to the target.  Of a word ``w`` after ``h`` it is

``x(h, w) = ln(t(h,w) + MASS * pt(w)) - ln(t(h) + MASS) - ln(f(h,w) * s + MASS * pf(w)) + ln(f(h) * s + MASS)``

with target counts t, counts f of all documents, and s the target's words by those of all documents.

* **Words** are counted first (one row per word and task).  Heavy words, of which at most 65,536 exist, are broadcast with
  their counts; then pairs of two heavy words are counted, and heavy pairs among them are scored where the text is read.
* **All other words** of the texts are dealt once, to the bucket of the word or, for a heavy word, of the pair.  A bucket
  holds all of a pair, so the pair's count and that of a word that is not heavy are exact there; what depends on ``h`` alone is
  added in the bucket of ``h``, for each time that it does not end its text.  No key of a bucket is heavy.
* Sums per text and task, at most one for each of its words, go back to the text's row; nothing but totals and heavy entries
  reaches the driver.

Words are told apart by 64-bit hashes.

Defined results: NULL and empty texts have no word and score 0; without target words every score is 0; repeated documents count and
score each; an empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odmeter.llm.groups import whole_groups
from odmeter.llm.hashing import Words, chunks, mix64
from odmeter.session import new_folder, ship_package

MASS = 5.0
BEGIN = np.uint64(0)
FLUSH = 1 << 20
BUCKET = 1 << 20
GROUP = 10
_DOCS, _TEXTS, _TARGET, _SUMS = 0, 1, 2, 3
_COUNTS = ("f", "t", "fh", "th")


def heavy_at(total: int) -> int:
    """Count from which words and pairs are heavy: at most 65,536 words reach it."""
    return max(total // 65_536 + 1, min(total // 4_096 + 1, 500_000))


def sequences(texts: list[bytes]) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words of texts, the hash before each, and whether it ends its text."""
    words = Words(texts)
    before, last = np.concatenate([[BEGIN], words.hashes[:-1]])[: len(words.hashes)], np.zeros(len(words.hashes), bool)
    some = words.counts > 0
    before[words.bounds[:-1][some]] = BEGIN
    last[words.bounds[1:][some] - 1] = True
    return words, before, last


def word_counts(texts: DataFrame, target: bool) -> DataFrame:
    """word, its count and how often it does not end its text; the beginning of a text is word 0 with a count of 0."""

    def count(batches):
        for found, ends, begins in gathered(batches):
            word, at = np.unique(found, return_inverse=True)
            n = np.bincount(at, minlength=len(word))
            held = n - np.bincount(at, ends, len(word)).astype(np.int64)
            word, n, held = np.append(word, BEGIN), np.append(n, 0), np.append(held, begins)
            none = np.zeros(len(n), np.int64)
            columns = (none, n, none, held) if target else (n, none, held, none)
            yield pa.RecordBatch.from_pydict({"word": word.view(np.int64), **dict(zip(_COUNTS, columns))})

    def gathered(batches):
        hashes, ends, begins, held = [], [], 0, 0
        for _, some in chunks(batches, 0):
            words, _, last = sequences(some)
            hashes.append(words.hashes), ends.append(last)
            begins, held = begins + int((words.counts > 0).sum()), held + len(last)
            if held >= FLUSH:
                yield np.concatenate(hashes), np.concatenate(ends), begins
                hashes, ends, begins, held = [], [], 0, 0
        if hashes:
            yield np.concatenate(hashes), np.concatenate(ends), begins

    return texts.select("text").mapInArrow(count, "word bigint, f bigint, t bigint, fh bigint, th bigint")


class Model:
    """Totals, heavy words with their counts, and heavy pairs with their differences."""

    def __init__(self, heavy: pa.Table, f: int, t: int, entries: int):
        words = heavy.column("word").to_numpy().view(np.uint64)
        order = np.argsort(words)
        self.words = words[order]
        self.counts = {c: heavy.column(c).to_numpy()[order] for c in _COUNTS}
        self.scale, self.spread = t / max(1, f), max(1, t + entries)
        self.pairs, self.pair_x = np.zeros(0, np.int64), np.zeros(0)
        self.begins = self.held(self.counts["fh"], self.counts["th"])

    def place(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each heavy word, -1 for others."""
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, at, -1)

    def held(self, f, t):
        """What depends on the word before."""
        return np.log(f * self.scale + MASS) - np.log(t + MASS)

    def met(self, f, t, fw, tw):
        """What depends on the pair and its second word."""
        return np.log(t + MASS * (tw + 1) / self.spread) - np.log(f * self.scale + MASS * (fw * self.scale + 1) / self.spread)

    def take(self, pairs: pa.Table) -> None:
        """Heavy pairs: (number before) * words + (number)."""
        pair = pairs.column("pair").to_numpy()
        order = np.argsort(pair)
        self.pairs, w = pair[order], pair[order] % len(self.words)
        f, t = (pairs.column(c).to_numpy()[order] for c in "ft")
        self.pair_x = self.met(f, t, self.counts["f"][w], self.counts["t"][w])


def pair_counts(texts: DataFrame, sent, target: bool) -> DataFrame:
    """pair and count, of two heavy words or the beginning and a heavy word."""

    def count(batches):
        model, found, held = sent.value, [], 0

        def out():
            pair, n = np.unique(np.concatenate(found), return_counts=True)
            none = np.zeros(len(n), np.int64)
            f, t = (none, n) if target else (n, none)
            return pa.RecordBatch.from_pydict({"pair": pair, "f": f, "t": t})

        for _, some in chunks(batches, 0):
            words, before, _ = sequences(some)
            w, h = model.place(words.hashes), model.place(before)
            both = (w >= 0) & (h >= 0)
            found.append(h[both] * len(model.words) + w[both])
            held += len(found[-1])
            if held >= FLUSH:
                yield out()
                found, held = [], 0
        if held:
            yield out()

    return texts.select("text").mapInArrow(count, "pair bigint, f bigint, t bigint")


def packed(kind: int, base: int, *arrays: np.ndarray) -> bytes:
    return b"".join([np.array([kind, base, *[a.nbytes for a in arrays]], np.int64).tobytes(), *[a.tobytes() for a in arrays]])


def unpacked(block: bytes, *kinds) -> list[np.ndarray]:
    sizes, at, out = np.frombuffer(block, np.int64, len(kinds), 16), 16 + 8 * len(kinds), []
    for size, kind in zip(sizes.tolist(), kinds):
        out.append(np.frombuffer(block, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out


def deal(texts: DataFrame, sent, buckets: int, target: bool) -> DataFrame:
    """Blocks of words by bucket, and for documents (ref, doc_id, text) a block of rows with what is known where they are read."""

    def flushed(base, parts):
        model = sent.value
        w, h, last, ref = (np.concatenate([p[k] for p in parts]) for k in range(4))
        heavy, before = model.place(w), model.place(h)
        x = np.where(before >= 0, model.begins[before], 0.0)
        rest = np.ones(len(w), bool)
        if len(model.pairs):
            pair = np.where((heavy >= 0) & (before >= 0), before * len(model.words) + heavy, -1)
            at = np.minimum(np.searchsorted(model.pairs, pair), len(model.pairs) - 1)
            known = model.pairs[at] == pair
            x[known] += model.pair_x[at[known]]
            rest = ~known
        if not target:
            doc_id, null, n = (np.concatenate([p[k] for p in parts]) for k in (4, 5, 6))
            total = np.bincount(ref, x, len(n)) if len(ref) else np.zeros(len(n))
            yield base % buckets, packed(_DOCS, base, doc_id, null, n, total)
        w, h, last, ref = w[rest], h[rest], last[rest], ref[rest]
        bucket = (mix64(np.where(heavy[rest] >= 0, mix64(w, 1) + h, w), 2) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((w, bucket))
        w, h, last, ref, bucket = w[order], h[order], last[order], ref[order].astype(np.uint16), bucket[order]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a < b:
                first = np.concatenate([[0], np.flatnonzero(np.diff(w[a:b])) + 1])
                many = np.diff(np.append(first, b - a)).astype(np.uint32)
                of = ref[:0] if target else ref[a:b]
                yield int(bucket[a]), packed(_TARGET if target else _TEXTS, base, w[a:b][first], many, h[a:b], np.packbits(last[a:b]), of)

    def go(batches):
        base, parts, held, rows = None, [], 0, 0
        for batch, some in chunks(batches, batch_text):
            for a in range(0, len(some), 1 << 15):
                few = some[a : a + (1 << 15)]
                refs = np.zeros(len(few), np.int64) if target else batch.column(0).to_numpy()[a : a + len(few)]
                if parts and (held >= FLUSH or rows + len(few) > 1 << 16 or not target and refs[0] != base + rows):
                    yield from blocks(base, parts)
                    parts, held, rows = [], 0, 0
                base = int(refs[0]) if not parts else base
                words, before, last = sequences(few)
                part = [words.hashes, before, last, words.doc + rows]
                if not target:
                    ids = batch.column(1).slice(a, len(few))
                    part += [ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), words.counts.astype(np.int64)]
                parts.append(part)
                held, rows = held + len(last), rows + len(few)
        if parts:
            yield from blocks(base, parts)

    def blocks(base, parts):
        keys, values, size = [], [], 0
        for key, value in flushed(base, parts):
            keys.append(key), values.append(value)
            size += len(value)
            if size >= 1 << 23:
                yield pa.RecordBatch.from_pydict({"bucket": pa.array(keys, pa.int64()), "block": pa.array(values, pa.binary())})
                keys, values, size = [], [], 0
        if keys:
            yield pa.RecordBatch.from_pydict({"bucket": pa.array(keys, pa.int64()), "block": pa.array(values, pa.binary())})

    batch_text = 0 if target else 2
    return texts.mapInArrow(go, "bucket bigint, block binary")


def rated(blocks: DataFrame, sent) -> DataFrame:
    """Rows of documents as they were read, and sums of their words in each task, in blocks by group of 1,024 neighbouring rows."""

    def bucket(found: list[bytes]):
        model, w, h, last, ref, of_target = sent.value, [], [], [], [], []
        for block in found:
            kind, base = np.frombuffer(block, np.int64, 2).tolist()
            word, many, before, ends, refs = unpacked(block, np.uint64, np.uint32, np.uint64, np.uint8, np.uint16)
            w.append(np.repeat(word, many)), h.append(before)
            last.append(np.unpackbits(ends, count=len(before)).astype(bool))
            ref.append(base + refs.astype(np.int64) if kind == _TEXTS else np.full(len(before), -1))
            of_target.append(np.full(len(before), kind == _TARGET))
        w, h, last, ref, of_target = map(np.concatenate, (w, h, last, ref, of_target))
        order = np.lexsort((h, w))
        w, h, last, ref, of_target = w[order], h[order], last[order], ref[order], of_target[order]
        new_word = np.concatenate([[True], w[1:] != w[:-1]])
        new_pair = new_word | np.concatenate([[True], h[1:] != h[:-1]])
        word, pair = np.cumsum(new_word) - 1, np.cumsum(new_pair) - 1
        first = np.flatnonzero(new_word)
        sums = lambda at, which: np.bincount(at[which], minlength=at[-1] + 1)
        place = model.place(w[first])
        counts = {"f": sums(word, ~of_target), "t": sums(word, of_target), "fh": sums(word, ~of_target & ~last), "th": sums(word, of_target & ~last)}
        counts = {c: np.where(place >= 0, model.counts[c][place], counts[c]) for c in _COUNTS}
        x = model.met(sums(pair, ~of_target)[pair], sums(pair, of_target)[pair], counts["f"][word], counts["t"][word])
        held = np.where(place >= 0, 0.0, model.held(counts["fh"], counts["th"]))
        x += np.where(last, 0.0, held[word])
        refs, at = np.unique(ref[~of_target], return_inverse=True)
        return refs, np.bincount(at, x[~of_target], len(refs))

    def pieces(refs):
        group = refs >> GROUP
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(refs)]])
        return [(int(group[a]), a, b) for a, b in zip(cuts[:-1], cuts[1:]) if a < b]

    def summed(parts):
        refs, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        return refs, np.bincount(at, np.concatenate([p[1] for p in parts]), len(refs))

    def batch(keys, values):
        return pa.RecordBatch.from_pydict({"part": pa.array(keys, pa.int64()), "block": pa.array(values, pa.binary())})

    def sums(refs, x):
        for k in range(0, len(refs), FLUSH):
            found = pieces(refs[k : k + FLUSH])
            blocks = [packed(_SUMS, 0, (refs[k + a : k + b] & (1 << GROUP) - 1).astype(np.uint16), x[k + a : k + b]) for _, a, b in found]
            yield batch([g for g, _, _ in found], blocks)

    def go(batches):
        parts, held = [], 0
        for table, bounds in whole_groups(batches, "bucket"):
            for a, b in zip(bounds[:-1], bounds[1:]):
                words = []
                for block in table.column("block").slice(a, b - a).to_pylist():
                    kind, base = np.frombuffer(block, np.int64, 2).tolist()
                    if kind == _DOCS:
                        rows = unpacked(block, np.int64, bool, np.int64, np.float64)
                        found = pieces(base + np.arange(len(rows[0])))
                        yield batch([g for g, _, _ in found], [packed(_DOCS, base + a, *[r[a:b] for r in rows]) for _, a, b in found])
                    else:
                        words.append(block)
                if words:
                    parts.append(bucket(words))
                    held += len(parts[-1][0])
                if held >= 2 * FLUSH:
                    refs, x = summed(parts)
                    parts, held = [(refs, x)], len(refs)
                    if held >= FLUSH:
                        yield from sums(refs, x)
                        parts, held = [], 0
        if parts:
            yield from sums(*summed(parts))

    return blocks.mapInArrow(go, "part bigint, block binary")


def joined(sums: DataFrame) -> DataFrame:
    """doc_id, n_words and score of every row, from the blocks of its group."""

    def go(batches):
        for table, bounds in whole_groups(batches, "part"):
            for a, b in zip(bounds[:-1], bounds[1:]):
                total, docs = np.zeros(1 << GROUP), []
                for block in table.column("block").slice(a, b - a).to_pylist():
                    kind, base = np.frombuffer(block, np.int64, 2).tolist()
                    if kind == _DOCS:
                        docs.append((base & (1 << GROUP) - 1, *unpacked(block, np.int64, bool, np.int64, np.float64)))
                    else:
                        at, x = unpacked(block, np.uint16, np.float64)
                        total[at] += x
                for first, doc_id, null, n, x in docs:
                    score = (x + total[first : first + len(n)]) / np.maximum(n, 1)
                    yield pa.RecordBatch.from_pydict({"doc_id": pa.array(doc_id, mask=null), "n_words": n, "score": score})

    return sums.mapInArrow(go, "doc_id bigint, n_words bigint, score double")


def score(docs: DataFrame, target: DataFrame, heavy: int | None = None) -> DataFrame:
    """doc_id, n_words and score of every row of ``docs`` (doc_id bigint, text), which are the background too.  ``heavy`` is the
    count from which words and pairs are broadcast; it changes no result."""
    spark = docs.sparkSession
    ship_package(spark)
    path = new_folder(spark, "words")
    counted = word_counts(docs, False).unionByName(word_counts(target, True))
    counted.groupBy("word").agg(*[F.sum(c).alias(c) for c in _COUNTS]).write.parquet(path)
    counted = spark.read.parquet(path)
    f, t, entries = counted.where("word <> 0").agg(F.sum("f"), F.sum("t"), F.count(F.lit(1))).first()
    f, t = f or 0, t or 0
    least = heavy or heavy_at(f + t)
    model = Model(counted.where(f"f + t >= {least} or word = 0").toArrow().combine_chunks(), f, t, entries)
    if not len(model.words):
        model = Model(pa.table({"word": [0], **{c: [0] for c in _COUNTS}}), f, t, entries)
    sent = spark.sparkContext.broadcast(model)
    pairs = pair_counts(docs, sent, False).unionByName(pair_counts(target, sent, True))
    pairs = pairs.groupBy("pair").agg(F.sum("f").alias("f"), F.sum("t").alias("t"))
    model.take(pairs.where(f"f + t >= {least}").toArrow().combine_chunks())
    sent = spark.sparkContext.broadcast(model)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (f + t) // (4 * BUCKET) + 1)
    rows = docs.select(F.monotonically_increasing_id().alias("ref"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    blocks = deal(rows, sent, 4 * parts, False).unionByName(deal(target.select("text"), sent, 4 * parts, True))
    sums = rated(blocks.repartition(parts, "bucket").sortWithinPartitions("bucket"), sent)
    return joined(sums.repartition(parts, "part").sortWithinPartitions("part"))


ORACLE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS k, doc_id,
   list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), target AS (
  SELECT row_number() OVER () AS k,
   list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM benchmark
), far_pairs AS (
  SELECT k, e, coalesce(lag(e) OVER (PARTITION BY k ORDER BY pos), '') AS h FROM (SELECT k, unnest(w) AS e, unnest(range(len(w))) AS pos FROM docs)
), near_pairs AS (
  SELECT k, e, coalesce(lag(e) OVER (PARTITION BY k ORDER BY pos), '') AS h FROM (SELECT k, unnest(w) AS e, unnest(range(len(w))) AS pos FROM target)
), size AS (SELECT count(*) AS entries FROM (SELECT e FROM far_pairs UNION SELECT e FROM near_pairs)
), sums AS (SELECT (SELECT count(*) FROM near_pairs)::DOUBLE AS tokens, (SELECT count(*) FROM near_pairs) / (SELECT count(*) FROM far_pairs) AS scale
), far AS (SELECT h, e, count(*) AS n FROM far_pairs GROUP BY h, e
), near AS (SELECT h, e, count(*) AS n FROM near_pairs GROUP BY h, e
), far_word AS (SELECT e, sum(n) AS n FROM far GROUP BY e), near_word AS (SELECT e, sum(n) AS n FROM near GROUP BY e
), far_held AS (SELECT h, sum(n) AS n FROM far GROUP BY h), near_held AS (SELECT h, sum(n) AS n FROM near GROUP BY h
), differences AS (
  SELECT f.h, f.e,
   ln((coalesce(t.n, 0) + 5.0e0 * (coalesce(tw.n, 0) + 1) / (tokens + entries)) / (coalesce(th.n, 0) + 5.0e0))
   - ln((f.n * scale + 5.0e0 * (fw.n * scale + 1) / (tokens + entries)) / (fh.n * scale + 5.0e0)) AS x
  FROM far f JOIN far_word fw ON f.e = fw.e JOIN far_held fh ON f.h = fh.h
   LEFT JOIN near t ON f.h = t.h AND f.e = t.e LEFT JOIN near_word tw ON f.e = tw.e LEFT JOIN near_held th ON f.h = th.h, sums, size
), scores AS (SELECT k, sum(x) AS x FROM far_pairs p JOIN differences d ON p.h = d.h AND p.e = d.e GROUP BY k)
SELECT doc_id, len(w)::BIGINT AS n_words, round(coalesce(x, 0) / greatest(len(w), 1), 6) AS score FROM docs LEFT JOIN scores USING (k)
"""


def op1_cross_entropy_difference(spark, sf_dir: str) -> DataFrame:
    """All documents against the benchmark's texts as the target, over all words of both; scores to six decimals."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text")
    return score(docs, target).withColumn("score", F.round("score", 6))
