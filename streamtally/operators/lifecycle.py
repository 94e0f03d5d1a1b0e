"""Order status changes that the order lifecycle does not allow."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .slices import previous_value

# The allowed moves between order states.
ALLOWED = {
    "Processing": ["Shipped", "Cancelled"],
    "Shipped": ["Delivered"],
    "Delivered": ["Returned"],
}


def illegal_transitions(changes: DataFrame, slice_seconds: int = 4 * 365 * 86_400) -> DataFrame:
    """Status changes from one state to another outside ``ALLOWED``; repeats are no change.

    ``changes`` has ``order_id``, ``status``, ``changed_at`` and a tie-breaking ``seq``. Slices are long
    because the life of an order is short: most orders lie in one.
    """
    timed = changes.withColumn("_at", F.unix_seconds("changed_at"))
    moved = previous_value(
        timed, "order_id", "_at", ["changed_at", "seq"], "status", slice_seconds, "from_status"
    ).where(F.col("from_status").isNotNull() & (F.col("from_status") != F.col("status")))
    allowed = F.lit(False)
    for state, following in ALLOWED.items():
        allowed = allowed | ((F.col("from_status") == state) & F.col("status").isin(following))
    return moved.where(~allowed).select(
        "order_id", "seq", "changed_at", "from_status", F.col("status").alias("to_status")
    )
