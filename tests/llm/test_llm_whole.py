"""Language models over all words: a count by hand, heavy entries, odd rows, and the SQL twin."""

import math
import re
from collections import Counter

import duckdb
import pytest

from llm_helpers import clashing, empty_documents, odd_documents, odd_rows
from odmeter.llm import lm_whole


def brute(docs, target):
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    pairs = lambda t: list(zip(["", *words(t)], words(t)))
    far, near = (Counter(p for t in texts for p in pairs(t)) for texts in (docs, target))
    entries, tokens = len({w for _, w in [*far, *near]}), sum(near.values())
    scale = tokens / max(1, sum(far.values()))

    def loss(counts, by):
        single, held = Counter(), Counter()
        for (h, w), n in counts.items():
            single[w] += n * by
            held[h] += n * by
        return lambda h, w: -math.log((counts[h, w] * by + 5 * (single[w] + 1) / (tokens + entries)) / (held[h] + 5))

    f, t = loss(far, scale), loss(near, 1)
    return [(len(words(d)), sum(f(*p) - t(*p) for p in pairs(d)) / max(1, len(words(d)))) for d in docs]


@pytest.mark.parametrize("heavy", [None, 1, 5, 10**9])
def test_all_words_against_brute_force(spark, heavy):
    texts = [r[1] for r in odd_rows()]
    target = ["an be ti an be ti one two", None, "", "stoan x"]
    docs = clashing(odd_documents(spark).repartition(3), "score", "n_words", "ref", "x")
    got = lm_whole.score(docs, spark.createDataFrame([(t,) for t in target], "text string"), heavy).collect()
    want = sorted(((r[0] is None, r[0] or 0, *x) for r, x in zip(odd_rows(), brute(texts, target))))
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_words"], r["score"]) for r in got)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:3] == w[:3] and g[3] == pytest.approx(w[3], abs=1e-9)


def test_words_outside_the_target_tell_documents_apart(spark):
    """Three words that the target lacks, one of them common in the background: with one entry for other words all are alike."""
    docs = spark.createDataFrame([(1, "red red red red"), (2, "red blue"), (3, "green blue")], "doc_id bigint, text string")
    target = spark.createDataFrame([("yes no yes no",)], "text string")
    whole = {r["doc_id"]: r["score"] for r in lm_whole.score(docs, target).collect()}
    assert len({round(x, 9) for x in whole.values()}) == 3


def test_no_target_and_no_documents(spark):
    none = spark.createDataFrame([], "text string")
    assert {r["score"] for r in lm_whole.score(odd_documents(spark), none).collect()} == {0.0}
    assert lm_whole.score(empty_documents(spark), none).count() == 0


def test_twin(spark, sf):
    duck = duckdb.connect()
    for name in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    want = sorted(duck.execute(lm_whole.ORACLE).fetchall())
    got = sorted(tuple(r) for r in lm_whole.op1_cross_entropy_difference(spark, sf).collect())
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want], abs=2e-6)
