"""Intermediate tables in the shared folder that ``spark.checkpoint.dir`` names."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder.  A local one is made only where the session names none and runs in
    one process (tests); on a cluster that is an error, as executors wouldn't see it."""
    sc = spark.sparkContext
    jdir = sc._jsc.sc().getCheckpointDir()
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if jdir.isEmpty():
        if not named:
            if not (sc.master or "").startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            named = "file://" + tempfile.mkdtemp(prefix="turnweave-checkpoint-")
        sc.setCheckpointDir(named)
        return named
    return named or jdir.get()


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    return os.path.join(checkpoint_dir(spark), f"{label}-{uuid.uuid4().hex}")


def spilled(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Writes ``df`` as Parquet to the shared folder and reads it back.  Also gives the path."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop_path(spark: SparkSession, path: str) -> None:
    """Removes an intermediate table that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def small_batches(spark: SparkSession, most: int = 4 << 20) -> None:
    """Ends Arrow batches at ``most`` bytes, so that large values don't add up in a Python worker.  A
    smaller limit of the session stays; results don't depend on it."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    try:
        have = int(spark.conf.get(name))
    except (ValueError, TypeError):
        have = 0
    if not 0 < have <= most:
        spark.conf.set(name, str(most))
