"""Tables that a job writes on its way, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder name in spark.checkpoint.dir; in a temporary folder where none is set and all is on one machine."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="spark-scratch-")
    return f"{base.rstrip('/')}/blocks-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The rows, written as Parquet and read again: cuts the lineage, and a lost executor takes nothing with it."""
    path = scratch_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
