"""Daily revenue summaries over enriched orders."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Prices from here on do not fit into 64 bits as millionths.
LARGEST = 9e12


def _daily(orders: DataFrame, *dimensions: str) -> DataFrame:
    """Revenue is exact in millionths of a unit price, so that no cent depends on the order of adding.

    A price is taken to the nearest millionth, halves upwards. What whole millionths in 64 bits can't
    hold (a price or a group's sum beyond some 9 * 10^12) fails the job, as does a price that is no
    number; nothing is cut off without a word.
    """
    price = F.col("unit_price")
    # Not a number is greater than any.
    millionths = F.when(F.abs(price) >= LARGEST, F.raise_error(F.lit("unit price out of range"))).otherwise(
        F.floor(price * 1_000_000 + 0.5)
    )
    whole = F.sum(F.col("quantity").cast("bigint") * millionths).cast("decimal(20,0)")
    revenue = whole * F.lit(Decimal("0.000001"))
    return orders.groupBy(*dimensions, F.to_date("created_at").alias("report_date")).agg(
        revenue.cast("decimal(15,2)").alias("total_revenue"),
        F.count(F.lit(1)).alias("total_orders"),
    )


def user_daily_stats(orders: DataFrame) -> DataFrame:
    """Revenue and orders per user name, email and day (the user id is no part of the key)."""
    return _daily(orders, "user_first_name", "user_last_name", "user_email")


def category_daily_stats(orders: DataFrame) -> DataFrame:
    return _daily(orders, "category")
