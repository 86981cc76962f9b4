"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Only where a local session names no checkpoint folder, as in tests.
FALLBACK_FOLDER = "file:///tmp/checkpoints"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. A cluster must name it, as each of its machines has a disk of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return (folder or FALLBACK_FOLDER).rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the session's file systems close."""
    path = f"{shared_folder(spark)}/sievestone/{name}-{uuid.uuid4().hex}"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def save(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    made = df.sparkSession.read.schema(df.schema).parquet(path)
    made._saved_in = path
    return made


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def drop(saved: DataFrame) -> None:
    """Remove a table that save() has made and that no plan will read again; the end of the session does it otherwise."""
    remove(saved.sparkSession, saved._saved_in)


class Tables:
    """Tables of the shared folder that go together, as soon as nothing reads any of them."""

    def __init__(self) -> None:
        self.saved: list[DataFrame] = []

    def save(self, df: DataFrame, name: str) -> DataFrame:
        self.saved.append(save(df, name))
        return self.saved[-1]

    def drop(self) -> None:
        while self.saved:
            drop(self.saved.pop())
