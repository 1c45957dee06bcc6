"""Session settings and the shared folder used for checkpoints and staging."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "odmeter", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    AQE splits skewed join partitions, coalesces small ones and picks broadcast joins from measured
    sizes; the clock is UTC.  Cluster sizing (executors, memory, shuffle partitions) stays with the
    submitter.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


_SHIPPED: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor reaches: ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting gets a fresh temporary folder; on a cluster a
    machine-local folder would be lost with its machine, so there the setting is required.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    active = context.getCheckpointDir()
    if active:
        return active
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="odmeter-"))
    return context.getCheckpointDir()


def new_folder(spark: SparkSession, label: str) -> str:
    """A not yet existing folder name below the shared folder."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives lost executors and is computed exactly once."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Written once as Parquet in the shared folder and read back: computed exactly once, and read by column."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Hands this package to the Python workers, as ``--py-files`` would; once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    name = os.path.join(tempfile.mkdtemp(prefix="odmeter-"), f"odmeter-{uuid.uuid4().hex}")
    archive = shutil.make_archive(name, "zip", os.path.dirname(package), os.path.basename(package))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)
