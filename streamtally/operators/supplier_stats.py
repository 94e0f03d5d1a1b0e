"""Total price and row count per supplier and window, one function per published semantics.

All variants share the plan: a projection, one partial/final hash aggregation, a projection. They
differ in what bad or missing input means, which is why they are separate and named.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import millis_time, price_lenient, price_strict, utc_text
from .sliding import latest_per_key

WINDOW = "5 seconds"
UNKNOWN = "UNKNOWN"


def windowed(
    orders: DataFrame, price: Column, supplier: Column, size: str, total: str = "total_price"
) -> DataFrame:
    """Sum and count per window and supplier; usable on batch and streaming frames alike."""
    return (
        orders.groupBy(F.window("bid_time", size).alias("_w"), supplier.alias("supplier"))
        .agg(F.sum(price).alias(total), F.count(F.lit(1)).alias("count"))
        .select(
            F.col("_w.start").alias("window_start"),
            F.col("_w.end").alias("window_end"),
            "supplier",
            total,
            "count",
        )
    )


def with_text_bounds(stats: DataFrame) -> DataFrame:
    return stats.withColumns(
        {"window_start": utc_text(F.col("window_start")), "window_end": utc_text(F.col("window_end"))}
    )


def strict_stats(orders: DataFrame, size: str = WINDOW) -> DataFrame:
    """Decimal sums. Bad price text fails the job, a null price is counted but not summed, a null
    supplier is a group of its own, and rows without a time belong to no window."""
    return with_text_bounds(windowed(orders, price_strict(F.col("price")), F.col("supplier"), size))


def lenient_stats(orders: DataFrame, size: str = WINDOW) -> DataFrame:
    """Unrounded double sums. Bad or null prices count as 0.0, a null supplier as ``UNKNOWN``."""
    supplier = F.coalesce(F.col("supplier"), F.lit(UNKNOWN))
    return with_text_bounds(windowed(orders, price_lenient(F.col("price")), supplier, size))


def rounded_stats(orders: DataFrame, size: str = WINDOW) -> DataFrame:
    """Double sums rounded to cents after adding. Bad or null prices count as 0.0, rows without a
    valid time are dropped first."""
    valid = orders.where(F.col("bid_time").isNotNull())
    stats = windowed(valid, price_lenient(F.col("price")), F.col("supplier"), size)
    return with_text_bounds(stats.withColumn("total_price", F.round("total_price", 2)))


def arithmetic_windows(
    orders: DataFrame,
    size_ms: int = 5_000,
    now: dt.datetime | None = None,
    trailing_ms: int | None = None,
) -> DataFrame:
    """Windows by integer arithmetic on epoch milliseconds, over the trailing part of the table.

    With neither ``now`` nor ``trailing_ms`` the whole table is read. The trailing condition is on
    the plain time column, so it reaches the scan.
    """
    if trailing_ms is not None:
        reference = F.lit(now) if now is not None else F.current_timestamp()
        orders = orders.where(
            F.col("bid_time") >= reference - F.expr(f"INTERVAL {trailing_ms / 1000:.3f} SECOND")
        )
    start = F.floor(F.unix_millis("bid_time") / F.lit(size_ms)) * size_ms
    return (
        orders.where(F.col("bid_time").isNotNull())
        .groupBy(start.alias("_start"), "supplier")
        .agg(
            F.round(F.sum(F.col("price").cast("double")), 2).alias("total_price"),
            F.count(F.lit(1)).alias("count"),
        )
        .select(
            utc_text(millis_time(F.col("_start"))).alias("window_start"),
            utc_text(millis_time(F.col("_start") + size_ms)).alias("window_end"),
            "supplier",
            "total_price",
            "count",
        )
    )


def latest_windows(
    orders: DataFrame,
    size_ms: int = 5_000,
    now: dt.datetime | None = None,
    trailing_ms: int | None = 50_000,
) -> DataFrame:
    """The most recent window of every supplier."""
    windows = arithmetic_windows(orders, size_ms, now, trailing_ms)
    return latest_per_key(windows, ["supplier"], ["window_start"])


def hourly_stats(orders: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Totals per supplier, day and hour; ``as_of`` keeps one day, as a range the scan can use."""
    if as_of is not None:
        start = dt.datetime.combine(as_of, dt.time())
        orders = orders.where(
            (F.col("bid_time") >= F.lit(start.isoformat(" ")).cast("timestamp"))
            & (
                F.col("bid_time")
                < F.lit((start + dt.timedelta(days=1)).isoformat(" ")).cast("timestamp")
            )
        )
    return (
        orders.groupBy(
            "supplier",
            F.to_date("bid_time").alias("bid_date"),
            F.hour("bid_time").alias("bid_hour"),
        )
        .agg(
            F.sum(price_strict(F.col("price"))).alias("total_price"),
            F.count(F.lit(1)).alias("total_count"),
        )
    )
