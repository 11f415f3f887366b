"""Tables that an operator stores on its way, in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared place that ``spark.checkpoint.dir`` names, or under /tmp in a local session."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file:///tmp/checkpoints"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, path: str) -> DataFrame:
    """Write a frame once, and a frame that reads it; so later plans start there, and a lost executor costs its tasks alone."""
    frame.write.mode("overwrite").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
