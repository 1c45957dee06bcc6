"""Source mixing and host rules: SQL on the given tables, odd cases, and properties."""

import os

import duckdb
import pytest

from helpers import comparable, plan_of
from llm_helpers import clashing, empty_documents, odd_documents, odd_rows, rows_of
from odmeter.llm import host_rules, mixing
from odmeter.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(sf):
    connection = duckdb.connect()
    for name in os.listdir(sf):
        connection.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{sf}/{name}'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, sf, duck, name):
    got = QUERIES[name](spark, sf)
    want = duck.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    assert comparable(got.columns, [tuple(r) for r in got.collect()]) == comparable(columns, want.fetchall())


def odd_duck(tmp_path):
    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    connection.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", odd_rows())
    return connection


def test_odd_documents_against_sql(spark, tmp_path):
    duck = odd_duck(tmp_path)
    docs = clashing(odd_documents(spark), "size", "host", "_row", "m")
    for got, sql in (
        (mixing.mix_sizes(docs).select("doc_id", "size", "source_size", "target", "taken"), mixing.ORACLE),
        (host_rules.apply_host_rules(docs).drop("host", "host_failed"), host_rules.ORACLE),
    ):
        want = duck.execute(sql)
        columns = [c[0] for c in want.description]
        assert comparable(got.columns, [tuple(r) for r in got.collect()]) == comparable(columns, want.fetchall())


def test_empty_tables(spark):
    docs = empty_documents(spark)
    assert mixing.mix_sizes(docs).count() == 0
    assert mixing.mixed(docs).count() == 0
    assert host_rules.apply_host_rules(docs).count() == 0


def test_targets_share_everything_under_the_cap(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 500), ("c", 70), (None, 3)], "source string, size bigint")
    rows = {r["source"]: r for r in mixing.source_targets(sizes).collect()}
    assert sum(r["target"] for r in rows.values()) == pytest.approx(583)
    assert all(r["target"] <= 3 * r["source_size"] + 1e-9 for r in rows.values())
    assert rows["a"]["target"] == 30 and rows[None]["target"] == 9  # weights 5 and 5 ask for more than three times
    assert rows["b"]["target"] / 2 == pytest.approx(rows["c"]["target"] / 1) or rows["c"]["target"] == 210


def test_taken_words_come_near_targets_and_repeat(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    first, again = (rows_of(mixing.mix_sizes(docs)) for _ in range(2))
    assert first == again
    sources = {r["doc_id"]: r["source"] for r in docs.select("doc_id", "source").collect()}
    taken, facts, most = {}, {}, {}
    for doc_id, size, source_size, target, copies, words in first:
        source = sources[doc_id]
        taken[source] = taken.get(source, 0) + words
        facts[source] = (source_size, target)
        most[source] = max(most.get(source, 0), size)
        assert words == copies * size <= 3 * size
    for source, (_, target) in facts.items():
        assert abs(taken[source] - target) <= most[source]


def test_preference_makes_documents_likelier(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "'w w w w' AS text", "IF(id % 2 = 0, 'x', 'y') AS source")
    from pyspark.sql import functions as F

    liked = F.when(F.col("doc_id") % 4 < 2, 4.0).otherwise(1.0)
    rows = mixing.mix(docs, liked).where("source = 'y'").selectExpr("doc_id % 4 < 2 AS liked", "copies").collect()
    by = {flag: sum(r["copies"] for r in rows if r["liked"] is flag) for flag in (True, False)}
    assert by[True] > 2 * by[False] > 0


def test_mixed_keeps_rows_and_clashing_columns(spark):
    docs = clashing(odd_documents(spark), "size", "copies", "_row")
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    copies = mixing.mix(docs.drop("size", "copies", "_row")).agg({"copies": "sum"}).first()[0]
    assert mixed.count() == copies


@pytest.mark.parametrize("sent", [0, 10**6])
def test_mixed_takes_what_the_sizes_say(spark, sf, sent, monkeypatch):
    """Cuts against the decisions per row, with few sources and many, and with a row that repeats at the cut."""
    monkeypatch.setattr(mixing, "SENT_SOURCES", sent)
    one = [(1, "w " * 7, "big")] * 30 + [(2, "v " * 3, "small")] * 11 + [(3, "u", None)] * 2
    some = [(k, "a b c " * (k % 9), f"s{k % 13}") for k in range(300)]
    for rows in (spark.createDataFrame(one, "doc_id bigint, text string, source string"), spark.createDataFrame(one + some, "doc_id bigint, text string, source string").repartition(4)):
        want = {}
        for r in mixing.mix_sizes(rows).collect():
            want[r["doc_id"]] = want.get(r["doc_id"], 0) + r["copies"]
        got = {r["doc_id"]: r["count"] for r in mixing.mixed(rows).groupBy("doc_id").count().collect()}
        assert got == {k: n for k, n in want.items() if n}


def test_texts_are_in_no_shuffle_of_a_mix(spark, sf):
    plan = plan_of(mixing.mixed(spark.read.parquet(f"{sf}/documents.parquet")))
    assert "Exchange hashpartitioning" not in plan and "Window" not in plan and plan.count("FileScan") == 1


def test_one_host_of_failures_is_turned_away(spark):
    rows = [(k, "word " * 3, "bad") for k in range(50)] + [(100, " ".join(f"w{i}" for i in range(40)), "bad")]
    rows += [(200 + k, " ".join(f"w{i}" for i in range(40)), "good") for k in range(50)]
    rows += [(300, "word " * 3, "new")]
    got = {r["doc_id"]: r for r in host_rules.apply_host_rules(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()}
    assert not got[100]["base_failed"] and not got[100]["kept"]
    assert all(got[200 + k]["kept"] for k in range(50))


def test_no_python_in_native_plans(spark, sf):
    for name in ("op6_host_rules", "op9_mix_sources"):
        assert "Python" not in plan_of(QUERIES[name](spark, sf)) and "Arrow" not in plan_of(QUERIES[name](spark, sf))
