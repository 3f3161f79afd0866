"""Scenarios that arrive as a stream.  This is an extension: a model row depends on no other, so the
batch plan runs on a stream as it is, and edits are counted in event-time windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import model


def evaluated(scenarios: DataFrame) -> DataFrame:
    """Output cells of a stream of scenarios, stateless."""
    return model.long(model.evaluate(scenarios))


def edits(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """``(start, event_type, n)``: events in windows; what comes later than the watermark is dropped."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")
