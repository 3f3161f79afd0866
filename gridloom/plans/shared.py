"""Tables in the folder that the driver and all executors share: they cut lineage and outlive executors."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where it is unset and the master local, as in tests, a folder of our own.

    On a cluster it must be set: executors would else write to disks that no one else sees.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if master.startswith("local-cluster") or not master.startswith("local"):
            raise ValueError(f"spark.checkpoint.dir is not set: master {master} needs a folder that all executors share")
        found = os.path.join(tempfile.gettempdir(), "gridloom-checkpoints")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def write(df: DataFrame, name: str) -> str:
    """Path of a new table with the rows of ``df``."""
    path = f"{folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path
