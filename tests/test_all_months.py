"""Queries over whole months have every month of the sample, not a subset."""

import pytest

import __spark_entry__ as entry
from odmeter import samples


@pytest.mark.parametrize("name", ["read_delta", "month_ageing"])
def test_every_month_is_there(spark, sf, name):
    months = {r[0] for r in samples.od(spark, sf).select("partition_month").distinct().collect()}
    got = {r[0] for r in entry.queries()[name](spark, sf).select("partition_month").distinct().collect()}
    assert len(months) > 2 and got == months
