"""Folders all executors can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def job_folder(spark: SparkSession, job: str) -> str:
    """The same folder at every start of a job, so that a restart finds the job's checkpoint."""
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        raise ValueError(f"set CHECKPOINT_ROOT or {CHECKPOINT_DIR}: a job's progress needs a lasting folder")
    return f"{root.rstrip('/')}/jobs/{job}"


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the session's ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder; a cluster must name
    one, since a folder of one machine would be lost with it.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{CHECKPOINT_DIR} must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tallyguard-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder of scratch data wherever Spark can write."""
    jvm, settings = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(settings).delete(path, True)
