"""Intermediates that survive lost executors.

They go to the folder that the cluster names. Spark removes them when nothing refers to them any more, if the
session has ``spark.cleaner.referenceTracking.cleanCheckpoints``.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A machine-local temporary folder is used only in local mode, as in tests.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="fareweather-"))
    return spark.sparkContext.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder, so that nothing below is computed again."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
