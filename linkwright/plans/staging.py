"""Cutting a plan at a table that several steps read."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, from ``spark.checkpoint.dir`` where none is set on the context.

    A folder of our own is made in local mode only: on a cluster it would lie on
    each machine's own disk, so a session without the setting is refused there.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


def settled(df: DataFrame) -> DataFrame:
    """The rows as written to the shared checkpoint folder: read again they cost no work, and lost executors no rows."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
