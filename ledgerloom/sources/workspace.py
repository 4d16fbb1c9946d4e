"""Folders the jobs may write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: ``spark.checkpoint.dir``.

    Only a session that runs inside one process (tests, benchmarks) may go without it; it gets one
    temporary folder of its own.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_dirs.setdefault(context.applicationId, tempfile.mkdtemp(prefix="ledgerloom-"))


def new_dir(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nobody else writes to."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
