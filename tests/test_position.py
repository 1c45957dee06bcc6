from collections import Counter

import pytest
from pyspark.sql import functions as F

from helpers import values
from odmeter.operators import position


def rows(spark, n):
    return spark.range(n).select(F.lit("m").alias("partition_month"), (F.col("id") * 3).alias("row_index"))


@pytest.mark.parametrize("n, parts, sizes", [(10, 3, [4, 3, 3]), (9, 3, [3, 3, 3]), (2, 5, [1, 1]), (7, 1, [7])])
def test_even_parts(spark, n, parts, sizes):
    buckets = [position.row_index_bucket(width=8)]
    got = position.split_even(rows(spark, n), parts, ["partition_month"], ["row_index"], buckets)
    ordered = [r["part"] for r in got.orderBy("row_index").collect()]
    assert ordered == sorted(ordered)
    assert [size for _, size in sorted(Counter(ordered).items())] == sizes


def test_blocks(spark):
    """2,500,001 rows in blocks of 1,000,000: the last block holds 500,001."""
    got = position.with_block_id(
        rows(spark, 2_500_001), 1_000_000, ["partition_month"], ["row_index"], [position.row_index_bucket()]
    )
    assert values(got.groupBy("block_id").count()) == [(0, 1_000_000), (1, 1_000_000), (2, 500_001)]


def test_exact_multiple_leaves_no_empty_block(spark):
    got = position.with_block_id(rows(spark, 20), 10, ["partition_month"], ["row_index"], [position.row_index_bucket()])
    assert values(got.groupBy("block_id").count()) == [(0, 10), (1, 10)]


def test_files_in_time_order_with_ties_by_path(spark):
    listing = spark.createDataFrame(
        [("m", "b", 1), ("m", "a", 1), ("m", "c", 0), ("n", "z", 9)], "partition_month string, file_path string, t int"
    ).withColumn("file_time", F.timestamp_seconds("t"))
    assert values(position.file_seq(listing), "partition_month", "file_path", "file_seq") == [
        ("m", "a", 1), ("m", "b", 2), ("m", "c", 0), ("n", "z", 0),
    ]


def test_running_total_goes_on_over_months(spark):
    table = spark.createDataFrame([("m1", 0)] * 3 + [("m1", 1)] * 2 + [("m2", 0)] * 4, "partition_month string, block_id int")
    assert values(position.running_total(table, ["block_id"])) == [
        ("m1", 0, 3, 3), ("m1", 1, 2, 5), ("m2", 0, 4, 9),
    ]
