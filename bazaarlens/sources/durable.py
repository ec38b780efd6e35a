"""Intermediate results that must survive the loss of executors.

Frames that several branches of a report read are written once to the
checkpoint folder of the cluster instead of being recomputed per branch.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A local session without the setting (tests, benchmark) gets a folder of its
    own; a cluster without it is refused, because a machine-local folder would
    be lost with its machine.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="bazaarlens-"))
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and continue from the written rows."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


_made: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; ``release`` removes what was written there."""
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def release(spark: SparkSession) -> None:
    """Remove all scratch paths of this process; results that still read them end here."""
    conf = spark._jsc.hadoopConfiguration()
    while _made:
        path = spark._jvm.org.apache.hadoop.fs.Path(_made.pop())
        path.getFileSystem(conf).delete(path, True)
