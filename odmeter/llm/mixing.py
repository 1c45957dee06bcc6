"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only.

A source of size S (words) with target T gives every document ``floor(T / S)`` certain copies.  What is
left, ``R = T - floor(T / S) * S`` words, is a sample without replacement: with inclusion probability
``p = R / S`` and a uniform ``u`` hashed from the document, documents are ranked by random odds over inclusion odds,
``Q = u / (1 - u) / (p / (1 - p))``, and taken in this order while the words taken come nearer to R.
Probabilities differ between sources, and between the documents of a source where ``preference`` is given.

No source passes through one task: ranks are cut into ``BUCKETS`` buckets, words are summed per bucket
first, and only the one bucket of a source in which R is reached is ordered row by row.  Texts are in no shuffle: what is
decided on slim rows comes down to one cut per source.

Defined results: a NULL text has size 0 and takes 0 words; a NULL source is a source, the last one; rows that
repeat are documents of their own and tie, so that it doesn't matter which is taken; an empty table gives
an empty result.  Extra columns stay, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odmeter.llm.words import word_count
from odmeter.session import cut_lineage

WEIGHTS = (5, 2, 1)
CAP = 3
BUCKETS = 4096
SEED = "mix-1"
SENT_SOURCES = 65_536
ADDED = ["size", "source_size", "target", "copies", "taken"]


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """One row per source with ``source_size`` and ``target``; ``sizes`` has source and size.

    Sources in code point order, NULL last, weigh ``weights``, repeating, and share the sum of all sizes.  A
    target stops at ``cap`` times its source's size; what that leaves is shared again by weight.  Sources by
    rising cap over weight stop one after the other, so running sums replace the rounds.  The windows see
    one row per source.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (place % len(weights)) + 1)
    exact = "decimal(38,0)"
    rows = by_source.withColumn("_weight", weight).withColumn("_cap", (F.col("source_size") * cap).cast(exact))

    scale = F.lit(_common_multiple(weights))
    rising = [(F.col("_cap") * (scale / F.col("_weight")).cast("int")).asc(), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*rising).rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.orderBy(*rising).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy(*rising).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumns({
        "_total": F.sum("source_size").over(everything).cast(exact),
        "_capped_before": F.coalesce(F.sum("_cap").over(before), F.lit(0)).cast(exact),
        "_weights_on": F.sum("_weight").over(onward),
    })
    room = (F.col("_total") - F.col("_capped_before")).cast(exact)
    stops = (F.col("_cap") * F.col("_weights_on")).cast(exact) <= (room * F.col("_weight")).cast(exact)
    rows = rows.withColumn("_stops", stops)
    rows = rows.withColumns({
        "_left": F.col("_total") - F.sum(F.when(F.col("_stops"), F.col("_cap")).otherwise(0)).over(everything),
        "_open": F.sum(F.when(F.col("_stops"), 0).otherwise(F.col("_weight"))).over(everything),
    })
    shared = (F.col("_left") * F.col("_weight")).cast("double") / F.col("_open")
    return rows.select(
        "source", "source_size", F.when(F.col("_stops"), F.col("_cap").cast("double")).otherwise(shared).alias("target")
    )


def _common_multiple(values: tuple[int, ...]) -> int:
    return math.lcm(*values)


def uniform(*parts: Column, seed: str = SEED) -> Column:
    """A number strictly between 0 and 1, hashed from the parts; the same in every run."""
    digits = F.substring(F.md5(F.concat_ws("|", F.lit(seed), *parts)), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(2**52))


def mix(docs: DataFrame, preference: Column | None = None, seed: str = SEED) -> DataFrame:
    """``docs`` with size, source_size, target, copies (bigint) and taken (``copies * size``).

    ``docs`` has doc_id, text and source; its columns named like an added one are replaced.  ``preference``
    (positive) makes some documents of a source likelier than others to get the copy beyond the certain ones; by
    default all are equal.
    """
    placed = _place(_sized(docs, F.struct(*(F.col(f"`{c}`") for c in docs.columns)), preference, seed))
    kept = [F.col("_row")[c].alias(c) for c in docs.columns if c not in ADDED]
    return placed.select(*kept, *ADDED)


def mix_sizes(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """The decisions without the texts: doc_id, size, source_size, target, copies, taken.

    Texts are read once; the slim rows are written and used from then on.
    """
    slim = cut_lineage(_sized(docs, F.struct("doc_id"), None, seed))
    return _place(slim).select("_row.doc_id", *ADDED)


def _sized(docs: DataFrame, row: Column, preference: Column | None, seed: str) -> DataFrame:
    identity = [F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(F.coalesce("text", F.lit("")))]
    return docs.select(
        row.alias("_row"),
        F.col("source"),
        word_count(F.col("text")).alias("size"),
        uniform(*identity, seed=seed).alias("_u"),
        (preference if preference is not None else F.lit(1.0)).cast("double").alias("_preference"),
    )


def _source_facts(slim: DataFrame) -> DataFrame:
    """source, source_size, target, _whole (certain copies), _rest (words left to sample) and _liked (preference times size)."""
    targets = source_targets(slim.select("source", "size")).join(
        slim.groupBy("source").agg(F.sum(F.col("size") * F.col("_preference")).alias("_liked"))
        .withColumnRenamed("source", "_liked_source"),
        F.col("source").eqNullSafe(F.col("_liked_source")),
    ).drop("_liked_source")
    whole = F.when(F.col("source_size") == 0, 0).otherwise(F.floor(F.col("target") / F.col("source_size")))
    targets = targets.withColumn("_whole", F.least(whole, F.lit(CAP)).cast("bigint"))
    return cut_lineage(targets.withColumn("_rest", F.col("target") - F.col("_whole") * F.col("source_size")))


def _ranked(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """``rows`` with the facts of their source, _rank (odds over inclusion odds) and its bucket."""
    facts = facts.withColumnRenamed("source", "_source")
    rows = rows.join(facts, rows["source"].eqNullSafe(facts["_source"])).drop("_source")
    chance = F.col("_rest") * F.col("_preference") / F.col("_liked")
    chance = F.greatest(F.least(chance, F.lit(1 - 1e-9)), F.lit(1e-12))
    rows = rows.withColumn("_rank", F.col("_u") / (1 - F.col("_u")) * ((1 - chance) / chance))
    return rows.withColumn("_bucket", F.floor(F.col("_rank") / (1 + F.col("_rank")) * BUCKETS))


def _edges(slim: DataFrame, facts: DataFrame) -> DataFrame:
    """The bucket in which each source's rest is reached (_edge) and the words _before it; one row per source at most."""
    words = _ranked(slim, facts).where(F.col("size") > 0).groupBy("source", "_bucket").agg(
        F.sum("size").alias("_words"), F.first("_rest").alias("_rest")
    )
    running = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    words = words.withColumn("_before", F.coalesce(F.sum("_words").over(running), F.lit(0)))
    edge = words.where((F.col("_before") <= F.col("_rest")) & (F.col("_before") + F.col("_words") > F.col("_rest")))
    return edge.select(F.col("source").alias("_edge_source"), F.col("_bucket").alias("_edge"), "_before")


def _place(slim: DataFrame) -> DataFrame:
    """Sizes, targets and copies of slim rows."""
    facts, drawn = _source_facts(slim), F.col("size") > 0
    edge = _edges(slim, facts)
    rows = _ranked(slim, facts)
    rows = rows.join(edge, rows["source"].eqNullSafe(edge["_edge_source"]), "left").drop("_edge_source")
    at_edge = drawn & (F.col("_bucket") == F.col("_edge"))
    below = drawn & F.coalesce(F.col("_bucket") < F.col("_edge"), F.col("_rest") > 0)
    cut = _reached(rows.where(at_edge)).withColumn("_extra", F.col("_taken").cast("bigint"))
    plain = rows.where(F.coalesce(~at_edge, F.lit(True))).withColumn("_extra", F.coalesce(below, F.lit(False)).cast("bigint"))
    copies = F.when(drawn, F.col("_whole") + F.col("_extra")).otherwise(0).cast("bigint")
    return cut.drop("_taken").unionByName(plain).select(
        "_row", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )


def _reached(rows: DataFrame) -> DataFrame:
    """Rows of the edge buckets with _taken: whether the rest is not passed by their middle."""
    inside = Window.partitionBy("source").orderBy("_rank", "size").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.col("_before") + F.coalesce(F.sum("size").over(inside), F.lit(0)) + F.col("size") / 2
    return rows.withColumn("_taken", reached <= F.col("_rest"))


def source_cuts(slim: DataFrame) -> DataFrame:
    """The decisions as one row per source: its facts, and where the extra copies end.

    Places are (rank, size).  Rows before (_cut_rank, _cut_size) have an extra copy; of the _cut_total rows just there, which are
    one row repeated, _cut_rows have.  A source without such a place (NULL) gives an extra copy to every row or to none (_all).
    """
    facts = _source_facts(slim)
    edge = _edges(slim, facts)
    rows = _ranked(slim, facts)
    rows = rows.join(edge, rows["source"].eqNullSafe(edge["_edge_source"])).drop("_edge_source")
    rows = rows.where((F.col("size") > 0) & (F.col("_bucket") == F.col("_edge")))
    places = _reached(rows).groupBy("source", "_rank", "size").agg(F.count_if("_taken").alias("taken"), F.count(F.lit(1)).alias("total"))
    place = F.struct("_rank", "size", "taken", "total")
    # the last place with a taken row, or where an edge bucket has none its first place
    last = places.groupBy(F.col("source").alias("_cut_source")).agg(
        F.coalesce(F.max(F.when(F.col("taken") > 0, place)), F.min(place)).alias("_cut")
    )
    out = facts.join(last, facts["source"].eqNullSafe(last["_cut_source"]), "left").drop("_cut_source")
    return out.select(
        "source", "source_size", "target", "_whole", "_rest", "_liked", (F.col("_rest") > 0).alias("_all"), F.col("_cut._rank").alias("_cut_rank"),
        F.col("_cut.size").alias("_cut_size"), F.col("_cut.taken").alias("_cut_rows"), F.col("_cut.total").alias("_cut_total"),
    )


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: columns of ``docs``, each document as often as it is taken; documents without words
    are not part of a mix.

    The decisions are made on slim rows.  Texts are read a second time and kept or left where they are read: a row looks up
    its source's cut.  Only rows that repeat just at a cut, and of which some are taken, are numbered.  Cuts are sent to the tasks if
    there are at most ``SENT_SOURCES`` of them, and joined otherwise.
    """
    slim = cut_lineage(_sized(docs, F.struct("doc_id"), None, SEED))
    cuts = cut_lineage(source_cuts(slim))
    parted = (F.col("_cut_rows") > 0) & (F.col("_cut_rows") < F.col("_cut_total"))
    sources, partings = cuts.agg(F.count(F.lit(1)), F.count_if(parted)).first()
    sized = _sized(docs, F.struct(*(F.col(f"`{c}`") for c in docs.columns)), None, SEED)
    rows = _ranked(sized, F.broadcast(cuts) if sources <= SENT_SOURCES else cuts).where(F.col("size") > 0)

    def known(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False))

    before = known((F.col("_rank") < F.col("_cut_rank")) | ((F.col("_rank") == F.col("_cut_rank")) & (F.col("size") < F.col("_cut_size"))))
    there = known((F.col("_rank") == F.col("_cut_rank")) & (F.col("size") == F.col("_cut_size")))
    extra = F.when(F.col("_cut_rank").isNull(), F.col("_all")).otherwise(before | (there & (F.col("_cut_rows") > 0)))
    taken = rows.withColumn("_copies", F.col("_whole") + extra.cast("int"))
    if partings:
        number = F.row_number().over(Window.partitionBy("source").orderBy("_rank"))
        some = rows.where(there & known(parted)).withColumn("_copies", F.col("_whole") + (number <= F.col("_cut_rows")).cast("int"))
        taken = taken.where(~(there & known(parted))).unionByName(some)
    repeated = taken.where(F.col("_copies") > 0).select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias("_copy"))
    return repeated.select([F.col("_row")[c].alias(c) for c in docs.columns])


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
   (('0x' || substr(md5(concat_ws('|', 'mix-1', coalesce(doc_id::VARCHAR, 'null'), md5(coalesce(text, '')))), 1, 13))::UBIGINT::DOUBLE
    + 0.5) / 4503599627370496.0 AS u
  FROM documents
), by_source AS (
  SELECT source, sum(size)::HUGEINT AS s, 3 * sum(size)::HUGEINT AS cap,
   [5, 2, 1][((row_number() OVER (ORDER BY source ASC NULLS LAST)) - 1) % 3 + 1] AS w
  FROM sized GROUP BY source
), summed AS (
  SELECT *, sum(s) OVER ()::HUGEINT AS total,
   coalesce(sum(cap) OVER (ORDER BY cap * 10 // w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS before,
   (sum(w) OVER (ORDER BY cap * 10 // w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::HUGEINT AS onward
  FROM by_source
), stopping AS (SELECT *, cap * onward <= (total - before) * w AS stops FROM summed
), targets AS (
  SELECT source, s, CASE WHEN stops THEN cap::DOUBLE ELSE
   ((total - (sum(CASE WHEN stops THEN cap ELSE 0 END) OVER ())::HUGEINT) * w)::DOUBLE
    / (sum(CASE WHEN stops THEN 0 ELSE w END) OVER ())::DOUBLE END AS target
  FROM stopping
), shares AS (
  SELECT *, CASE WHEN s = 0 THEN 0 ELSE least(floor(target / s::DOUBLE)::BIGINT, 3) END AS whole FROM targets
), ranked AS (
  SELECT d.*, s, target, whole, target - whole * s::DOUBLE AS rest,
   greatest(least((target - whole * s::DOUBLE) / s::DOUBLE, 1 - 1e-9), 1e-12) AS p
  FROM sized d JOIN shares t ON d.source IS NOT DISTINCT FROM t.source
), ordered AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY u / (1 - u) * ((1 - p) / p), size
   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM ranked WHERE size > 0
)
SELECT doc_id, size, s::BIGINT AS source_size, target,
 ((whole + CASE WHEN rest > 0 AND before + size / 2 <= rest THEN 1 ELSE 0 END) * size)::BIGINT AS taken FROM ordered
UNION ALL SELECT doc_id, size, s::BIGINT, target, 0 FROM ranked WHERE size = 0
"""


def op9_mix_sources(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix_sizes(docs).select("doc_id", "size", "source_size", "target", "taken")
