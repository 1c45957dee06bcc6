"""Copies of a key dropped inside a stream, by state of its own.

``streaming.ingest`` asks the landing table what has landed and keeps no state.  Where there is no such table, this form keeps one row of
state for each key for as long as copies may follow: ``lateness`` after the event time of its first row, or for good where ``lateness`` is
None.  State lives in RocksDB on the executors' disks, with its changes in the checkpoint, so its size is bounded by the keys of that time
(for good: all keys) and not by memory.

Defined results: of the copies of a key inside the horizon one row is kept, and no more is promised about which; a row at or before the
watermark (the latest event time seen, less ``lateness``) is dropped; a copy that comes when its key's state has expired, but is
itself not that late, is a new row.  Without a horizon no row is too late: each is held against all keys that came before it.  Rows without
a key can't be told to be copies, and all of them stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from odmeter.schemas import KEY

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LATENESS = "31 days"


def keep_state_on_disk(spark: SparkSession) -> None:
    """RocksDB, with a log of changes, as the state store of streams that are started from now on."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def stream_dedupe(rows: DataFrame, event_time: str, lateness: str | None = LATENESS, key: str = KEY, row_id: list[str] = ()) -> DataFrame:
    """A stream of rows less the copies of their keys; ``row_id`` tells rows without a key apart."""
    nameless = F.when(F.col(key).isNull(), F.xxhash64(*row_id) if row_id else F.xxhash64(*rows.columns))
    names = [key, "_nameless"]
    if lateness is None:
        return rows.withColumn("_nameless", nameless).dropDuplicates(names).drop("_nameless")
    known = rows.withWatermark(event_time, lateness).withColumn("_nameless", nameless)
    return known.dropDuplicatesWithinWatermark(names).drop("_nameless")


def write_deduped(rows: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Appends a deduplicated stream to Parquet files, each batch exactly once, over what is there now."""
    return rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
