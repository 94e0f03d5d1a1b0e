"""Late rows: dropped by the watermark, and counted."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

LATE_COUNTS = "batch long, input_rows long, late_rows long"


def accept_in_time(rows: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """Rows that are newer than the watermark, each ``key`` once. What it drops as late the engine
    counts row by row (a windowed aggregate would count groups of them)."""
    return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def late_counts(spark: SparkSession, queries: Iterable[StreamingQuery]) -> DataFrame:
    """Of each batch with input: how many rows came in and how many were dropped as late, from the
    progress that the running or finished queries report. A query keeps the progress of its last
    ``spark.sql.streaming.numRecentProgressUpdates`` batches; poll more often than that."""
    found = []
    for query in queries:
        for progress in query.recentProgress:
            if progress["numInputRows"]:
                dropped = sum(op["numRowsDroppedByWatermark"] for op in progress["stateOperators"])
                found.append((progress["batchId"], progress["numInputRows"], dropped))
    return spark.createDataFrame(found, LATE_COUNTS)
