"""Intermediate results on shared storage."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _temporary_root() -> str:
    return tempfile.mkdtemp(prefix="clickmart-")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names, or a temporary one when running on one machine."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return _temporary_root()


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet and read it back.

    For a result that several later steps read: it survives lost executors, the plan starts anew
    with known sizes, and each reader still reads only the columns it needs. The folder lives as
    long as the checkpoint folder's own clean-up rule says.
    """
    path = f"{checkpoint_root(df.sparkSession)}/clickmart-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
