"""Copies dropped inside a stream: with no horizon every row counts, with one what lies behind it is late."""

from datetime import datetime

import pytest

import __spark_entry__ as entry
from helpers import values
from odmeter.streaming.dedupe import keep_state_on_disk, stream_dedupe, write_deduped

FIELDS = "order_number string, day timestamp, row_index bigint"


@pytest.fixture
def arrive(spark, tmp_path):
    """Runs the stream once for each wave of rows (key, year, row index) and gives what it has kept."""
    source, target, checkpoint = (str(tmp_path / n) for n in ("arrivals", "deduped", "stream"))

    def run(*waves, lateness):
        keep_state_on_disk(spark)
        for wave in waves:
            rows = [(key, year and datetime(year, 1, 1), row) for key, year, row in wave]
            spark.createDataFrame(rows, FIELDS).coalesce(1).write.mode("append").parquet(source)
            arrived = spark.readStream.schema(FIELDS).parquet(source)
            write_deduped(stream_dedupe(arrived, "day", lateness, row_id=["row_index"]), target, checkpoint).awaitTermination()
        return values(spark.read.parquet(target).selectExpr("order_number", "year(day) AS year", "row_index"))

    return run


def test_without_a_horizon_no_row_is_late_and_no_key_is_forgotten(arrive):
    first = [("a", 1960, 1), ("b", 1995, 2), ("c", 2001, 3), (None, 1995, 4), ("d", None, 5)]
    second = [("a", 2001, 6), ("b", 1995, 7), ("e", 1950, 8), (None, 1950, 9), ("d", 2001, 10)]
    third = [("a", 1960, 11), ("e", 2002, 12), ("f", 1995, 13), (None, None, 14), ("d", None, 15)]
    kept = [*first, *second[2:4], *third[2:4]]
    assert arrive(first, second, third, lateness=None) == sorted(kept, key=repr)


def test_behind_a_horizon_rows_are_late_and_keys_forgotten(arrive):
    first = [("a", 1995, 1), ("b", 1995, 2), ("c", 2001, 3), (None, 1995, 4)]
    second = [("a", 2001, 5), ("b", 1995, 6), ("c", 2001, 7), ("e", 1995, 8), (None, 2001, 9)]
    kept = [*first, second[0], second[4]]
    assert arrive(first, second, lateness="10 days") == sorted(kept, key=repr)


def test_copies_of_every_year_are_held_against_their_keys(spark, tmp_path):
    """Copies come on the same day (multiples of 50 and 70) and a month later (of 90); multiples of 499 have no key and all stay."""
    keys = [1, 6300, 12600, 34930, 44910, 3143700]
    rows = [(k, k, datetime(1995 + i, 3, 31)) for i, k in enumerate(keys)] + [(6390, 1, datetime(2001, 7, 31))]
    spark.createDataFrame(rows, "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp").write.parquet(str(tmp_path / "orders.parquet"))
    got = [(r[0], str(r[1])) for r in entry.stream_dedupe(spark, str(tmp_path)).collect()]
    keyed = [("1", "1995-03-31"), ("6300", "1996-03-31"), ("12600", "1997-03-31"), ("6390", "2001-07-31")]
    nameless = [*["1998-03-31"] * 2, "1999-03-31", "1999-04-30", *["2000-03-31"] * 3, "2000-04-30"]
    assert sorted(got, key=repr) == sorted([*keyed, *((None, day) for day in nameless)], key=repr)
