"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder where it is unset and everything runs in one process, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        given = spark.sparkContext._jsc.sc().getCheckpointDir()
        if given.isDefined():
            found = given.get()
        elif spark.sparkContext.master.split("[")[0] == "local":
            found = tempfile.mkdtemp(prefix="tidemark-")
        else:
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
