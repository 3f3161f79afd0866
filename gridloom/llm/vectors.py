"""Vectors as byte strings of doubles, checked and put in one form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(id, v array<double>)`` of the rows with an id and a vector that is neither null, empty, zero nor holds null or non-finite components."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    fine = F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0), F.lit(False))
    return rows.where(F.col("id").isNotNull() & fine)


def matrix(column):
    """The rows of an Arrow list column as an array of doubles."""
    import numpy as np

    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return values.reshape(len(column), -1)
