"""Running totals whose idle keys expire."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..schemas import record
from .versions import VersionedTable

TOTALS = record(
    team_id="string",
    team_name="string",
    total_score="long",
    touched="double",
)


class ExpiringTotals:
    """``foreachBatch`` sink: totals per team; a team without input for ``ttl_seconds`` starts anew.

    A watermark cannot express this (it removes by event time), and a keyed state function would
    take every row of a hot team in one task. Here a batch is summed map-side first and then merged
    with the stored totals, which hold one row per live team.
    """

    def __init__(
        self, path: str, ttl_seconds: float = 3600, clock: Callable[[], float] = time.time
    ) -> None:
        self.ttl, self.clock, self.path = ttl_seconds, clock, path
        self.totals = VersionedTable(f"{path}/totals", TOTALS)

    def __call__(self, scores: DataFrame, batch_id: int) -> None:
        spark = scores.sparkSession
        now = self.clock()
        live = self.totals.read(spark, batch_id - 1).where(F.col("touched") > now - self.ttl)
        added = (
            scores.groupBy("team_id", "team_name")
            .agg(F.sum("score").cast("bigint").alias("total_score"))
            .withColumn("touched", F.lit(now))
        )
        merged = (
            live.unionByName(added)
            .groupBy("team_id")
            .agg(
                F.max("team_name").alias("team_name"),
                F.sum("total_score").alias("total_score"),
                F.max("touched").alias("touched"),
            )
        )
        self.totals.write(merged, batch_id)

    def writer(self, scores: DataFrame, checkpoint: str) -> DataStreamWriter:
        return scores.writeStream.option("checkpointLocation", checkpoint).foreachBatch(self)

    def current(self, spark: SparkSession) -> DataFrame:
        return self.totals.read(spark, self.totals.newest(spark)).drop("touched")
