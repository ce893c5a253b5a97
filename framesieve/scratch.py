"""Scratch tables in the folder that the driver and all executors share: lineage ends there, any executor can read them."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: list[tuple] = []


def scratch_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; in local mode, where none is set, a folder of this process."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = os.path.join(tempfile.gettempdir(), f"framesieve-checkpoints-{os.getpid()}")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder; it is removed when the process ends."""
    path = f"{scratch_root(spark)}/framesieve/{label}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


def filesystem(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path) of a path."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def remove(spark: SparkSession, path: str) -> None:
    fs, hadoop = filesystem(spark, path)
    fs.delete(hadoop, True)


def cut(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.option("compression", "snappy").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def made() -> int:
    """How many scratch paths there are so far; for ``free``."""
    return len(_made)


def free(since: int) -> None:
    """Removes the scratch tables made after the first ``since``, but for the newest, which no longer needs them."""
    for spark, path in _made[since:-1]:
        remove(spark, path)
    del _made[since:-1]


@atexit.register
def _clean() -> None:
    for spark, path in _made:
        try:
            remove(spark, path)
        except Exception:  # the JVM may be gone by now
            return
