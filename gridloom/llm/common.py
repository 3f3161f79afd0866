"""Shared helpers of the corpus operators: tables in the shared folder, sizes, cleanup."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and every executor see.

    It is ``spark.checkpoint.dir`` of the session.  Where that is unset and the master is local, as in
    tests, a folder of our own is chosen and the session told of it; on a cluster it is an error,
    as executors would write to disks that no one else sees.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if master.startswith("local-cluster") or not master.startswith("local"):
            raise ValueError(f"spark.checkpoint.dir is not set: master {master} needs a folder that all executors share")
        found = os.path.join(tempfile.gettempdir(), "gridloom-checkpoints")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it again.

    This cuts the lineage: later jobs read replicated files, so a lost executor costs at most
    the tasks it was running.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    found.written_at = path
    return found


def forget(*tables: DataFrame) -> None:
    """Delete the files of tables made by :func:`written` that nothing reads any more."""
    for df in tables:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(df.written_at)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def sorted_join(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that Spark must sort, never broadcast.

    Spark broadcasts by an estimate of bytes: that of a table is its compressed files', and rows that
    are generated from a row count as that one.  For tables that grow with the input that
    estimate can be far too small, and the driver would have to hold the whole side.
    """
    return df.hint("merge")


#: Bytes of a column in one of :func:`slices`, about.
SLICE = 4 << 20


def slices(batch, column: int) -> Iterator:
    """An Arrow batch in runs of rows; the texts of ``column`` in a run have ``SLICE`` bytes besides the first's.

    What Python makes of a run is freed before the next, so a worker's memory does not follow the
    size of its batches.
    """
    import numpy as np
    import pyarrow.compute as pc

    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    cuts = [0, *(np.flatnonzero(np.diff(ends // SLICE)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def unused(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` has not, whatever the letters' case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
