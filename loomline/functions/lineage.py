"""Cutting lineage through storage that all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A folder that all executors share: the session's checkpoint folder.

    It is that of ``spark.checkpoint.dir``.  Where none is set, a temporary one
    serves a session in one process, as in tests; on a cluster that is an
    error, as executors would not share it.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if folder is None:
            if not context.master.split("[")[0] == "local":
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="loomline")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """The table read back from a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
