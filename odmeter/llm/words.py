"""Words: runs of anything but ASCII white space, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def word_list(text: Column) -> Column:
    """Words in order; an empty array for NULL and for white space only."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_RUN))


def word_count(text: Column) -> Column:
    """Number of words as a bigint, 0 for NULL."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, SPACE_RUN))).cast("bigint")
