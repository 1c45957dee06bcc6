"""Quality rules by host, in DataFrame operations only.

Each text is measured inside its row.  Rule failures are then summed by host (``source`` of the documents),
rates are shrunk towards an empirical beta prior, and verdicts are joined back: a document is kept if it passes
itself and its host's shrunk rate of failures is at most ``MOST``.

The prior has the mean and the variance of the hosts' rates; where these allow no beta distribution (fewer
than two hosts, or no spread) it weighs as two documents of the mean rate.  Hosts are summed map side first, so a host with
most rows sends one row per task; the host table has one row per host, and Spark broadcasts it only where it measures it to be small.

Defined results: NULL text measures like an empty one and fails; NULL is a host like others; repeated rows
count each; an empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odmeter.llm.words import SPACES, word_list
from odmeter.session import cut_lineage

SYMBOLS = "#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
REPEATED_PERCENT = 30
MOST = 0.5


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also inside nested lambdas."""
    return F.transform(F.array(value), body).getItem(0)


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Number of words inside windows of ``window`` words that occur twice or more in the array.

    Windows are compared by a 64-bit hash inside one text.  Most texts have no repeated window and end at the distinct count;
    for the others (hash, place) pairs are sorted and neighbours compared: n log n for any text.
    """

    def places(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        repeated = _let(pairs, lambda s: F.filter(
            s, lambda x, k: x["h"].eqNullSafe(F.get(s, k - 1)["h"]) | x["h"].eqNullSafe(F.get(s, k + 1)["h"])
        ))
        return F.array_sort(F.transform(repeated, lambda x: x["i"]))

    def covered(starts: Column) -> Column:
        widths = F.transform(starts, lambda at, k: F.coalesce(F.least(F.get(starts, k + 1) - at, F.lit(window)), F.lit(window)))
        return F.aggregate(widths, F.lit(0), lambda total, width: total + width)

    def count(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(_let(places(hashes), covered))

    starts = F.sequence(F.lit(1), F.size(words) - (window - 1))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, window)))
    return F.when(F.size(words) <= window, F.lit(0)).otherwise(_let(hashes, count))


def measures(text: Column) -> Column:
    """Struct of the base measures of a text."""
    text = F.coalesce(text, F.lit(""))
    symbols = F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    return F.struct(
        _let(word_list(text), lambda w: F.struct(F.size(w).cast("bigint").alias("n"), repeated_words(w).cast("bigint").alias("r"))).alias("w"),
        F.char_length(F.translate(text, SPACES, "")).cast("bigint").alias("word_chars"),
        symbols.cast("bigint").alias("n_symbols"),
        _let(lines, lambda each: F.size(each) - F.size(F.array_distinct(each))).cast("bigint").alias("n_dup_lines"),
    )


def measured(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host, the base measures and ``base_failed``, one slim row per document."""
    rows = docs.select("doc_id", F.col(host).alias("host"), measures(F.col("text")).alias("m"))
    rows = rows.select(
        "doc_id", "host", F.col("m.w.n").alias("n_words"), "m.word_chars", "m.n_symbols", "m.n_dup_lines",
        F.col("m.w.r").alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def host_rates(rows: DataFrame) -> DataFrame:
    """One row per host: documents, failures and the shrunk rate of failures."""
    hosts = cut_lineage(rows.groupBy("host").agg(
        F.count(F.lit(1)).alias("documents"), F.count_if("base_failed").alias("failures")
    ))
    rate = F.col("failures") / F.col("documents")
    mean, spread = hosts.agg(F.avg(rate), F.var_pop(rate)).first()
    mean = mean or 0.0
    weight = mean * (1 - mean) / spread - 1 if spread else 0.0
    weight = weight if weight > 0 else 2.0
    return hosts.withColumn("rate", (F.col("failures") + mean * weight) / (F.col("documents") + weight))


def apply_host_rules(docs: DataFrame, host: str = "source", most: float = MOST) -> DataFrame:
    """The measures with ``host_failed`` and ``kept``."""
    rows = cut_lineage(measured(docs, host))
    verdicts = host_rates(rows).select(F.col("host").alias("_host"), (F.col("rate") > most).alias("host_failed"))
    judged = rows.join(verdicts, rows["host"].eqNullSafe(verdicts["_host"])).drop("_host")
    return judged.withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed"))


ORACLE = r"""
WITH split AS (
  SELECT doc_id, source, coalesce(text, '') AS text, row_number() OVER () AS k,
   list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
   list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), windows AS (
  SELECT k, i, array_to_string(w[i:i + 7], ' ') AS win FROM (SELECT k, w, unnest(range(1, len(w) - 6)) AS i FROM split WHERE len(w) >= 9)
), repeated AS (
  SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, win) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT k, count(DISTINCT p) AS r FROM (SELECT k, unnest(range(i, i + 8)) AS p FROM repeated) GROUP BY k
), base AS (
  SELECT doc_id, source, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
   (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
   (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(r, 0)::BIGINT AS n_repeat_words
  FROM split LEFT JOIN covered USING (k)
), failed AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base
), hosts AS (SELECT source, count(*) AS n, count(*) FILTER (base_failed) AS f FROM failed GROUP BY source
), moments AS (SELECT avg(f / n) AS m, var_pop(f / n) AS v FROM hosts
), prior AS (SELECT m, CASE WHEN v > 0 AND m * (1 - m) / v - 1 > 0 THEN m * (1 - m) / v - 1 ELSE 2.0 END AS weight FROM moments
), rates AS (SELECT source, (f + m * weight) / (n + weight) AS rate FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND rate <= 0.5 AS kept
FROM failed d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source
"""


def op6_host_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return apply_host_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
