"""Cutting lineage through the shared checkpoint folder of the cluster."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.

    A folder of our own is used only where the setting is absent and Spark runs
    on this one machine.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="tabledger-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir().rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows of ``df``, computed once and kept in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
