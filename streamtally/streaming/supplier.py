"""Supplier statistics as streams."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions import price_lenient, price_strict
from ..operators.supplier_stats import UNKNOWN, WINDOW, windowed

DELAY = "5 seconds"
DELAY_WITH_LATENESS = "10 seconds"


def closed_windows(
    orders: DataFrame,
    size: str = WINDOW,
    delay: str = DELAY,
    price: Column | None = None,
    supplier: Column | None = None,
) -> DataFrame:
    """Append mode: each window once, when the watermark has passed its end; later rows are dropped."""
    marked = orders.where(F.col("bid_time").isNotNull()).withWatermark("bid_time", delay)
    return windowed(
        marked,
        price_strict(F.col("price")) if price is None else price,
        F.col("supplier") if supplier is None else supplier,
        size,
    )


def refired_windows(
    orders: DataFrame, size: str = WINDOW, delay: str = DELAY_WITH_LATENESS
) -> DataFrame:
    """For update mode: a window is sent again for every row up to the delay late.

    The delay is out-of-orderness plus allowed lateness. Bad prices count as 0.0.
    """
    return closed_windows(orders, size, delay, price_lenient(F.col("price")))


def updated_windows(orders: DataFrame, size: str = WINDOW, grace: str = DELAY) -> DataFrame:
    """For update mode: every change within the grace period. Bad prices count as 0.0, orders
    without a supplier as ``UNKNOWN``."""
    supplier = F.coalesce(F.col("supplier"), F.lit(UNKNOWN))
    return closed_windows(orders, size, grace, price_lenient(F.col("price")), supplier)


def merged_windows(
    sources: Sequence[DataFrame], size: str = WINDOW, delay: str = DELAY
) -> DataFrame:
    """Append mode over several order streams, each with a watermark of its own.

    When a window closes is up to the session's ``spark.sql.streaming.multipleWatermarkPolicy`` at the
    first start: ``min`` waits for the slowest source, also for one that fell silent; ``max`` goes by
    the fastest, drops what slower ones bring for closed windows, and so passes a silent one over.
    """
    marked = [
        rows.where(F.col("bid_time").isNotNull()).withWatermark("bid_time", delay) for rows in sources
    ]
    merged = functools.reduce(DataFrame.unionByName, marked)
    return windowed(merged, price_strict(F.col("price")), F.col("supplier"), size)


class UpdateLog:
    """``foreachBatch`` sink for update mode: each batch's changed rows, in a folder of its own.

    A repeated batch overwrites its folder, so retries leave no duplicates.
    """

    def __init__(self, path: str) -> None:
        self.path = path

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def writer(self, rows: DataFrame, checkpoint: str) -> DataStreamWriter:
        return (
            rows.writeStream.outputMode("update")
            .option("checkpointLocation", checkpoint)
            .foreachBatch(self)
        )

    def updates(self, spark: SparkSession) -> DataFrame:
        """Every update sent, with its ``batch``."""
        return spark.read.parquet(self.path)

    def latest(self, spark: SparkSession, keys: list[str]) -> DataFrame:
        """What a reader of the updates holds: the last one per key."""
        updates = self.updates(spark)
        rest = [c for c in updates.columns if c not in (*keys, "batch")]
        return (
            updates.groupBy(*keys)
            .agg(F.max_by(F.struct(*rest), F.col("batch")).alias("_row"))
            .select(*keys, "_row.*")
        )
