"""Session helpers: a session for tests and scripts, and cutting lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """One-JVM session, for tests, benchmarks and small data."""
    builder = SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", str(partitions)).config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


_made: list[str] = []


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new path below the folder that spark.checkpoint.dir names; a folder of its own only where Spark runs in one JVM without it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or "cluster" in master:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _made:
            _made.append(tempfile.mkdtemp(prefix="written-"))
        root = _made[0]
    return f"{root.rstrip('/')}/written/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the folder that spark.checkpoint.dir names.

    A folder of its own is made only where none is set and Spark runs in one JVM.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local") or "cluster" in sc.master:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoints-"))
    return df.checkpoint()
