"""Keyed changelogs: materialise, drop no-ops, diff two boards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .slices import previous_value


def materialize(
    log: DataFrame, key: str, value: str, order: str, keep_deleted: bool = False
) -> DataFrame:
    """Last value per key. A null value deletes the key, or with ``keep_deleted`` is ignored."""
    if keep_deleted:
        log = log.where(F.col(value).isNotNull())
    last = log.groupBy(key).agg(
        F.max_by(F.struct(value, order), F.col(order)).alias("_last")
    )
    return last.where(F.col(f"_last.{value}").isNotNull()).select(key, "_last.*")


def effective_updates(
    log: DataFrame, key: str, value: str, order: str, slice_width: int = 1_000_000
) -> DataFrame:
    """The messages that change anything: null values ignored, repeats of the held value skipped."""
    held = previous_value(
        log.where(F.col(value).isNotNull()), key, order, [order], value, slice_width, "_held"
    )
    return held.where(F.col("_held").isNull() | (F.col("_held") != F.col(value))).drop("_held")


def diff_boards(old: DataFrame, new: DataFrame, key: str = "rnk") -> DataFrame:
    """Changelog that turns board ``old`` into ``new``: ``U`` rows to upsert, ``D`` keys to delete."""
    values = [c for c in new.columns if c != key]
    left = old.select(F.col(key), F.struct(*values).alias("_old"))
    right = new.select(F.col(key), F.struct(*values).alias("_new"))
    return (
        left.join(right, key, "full_outer")
        .where(~F.col("_old").eqNullSafe(F.col("_new")))
        .select(
            F.when(F.col("_new").isNull(), F.lit("D")).otherwise(F.lit("U")).alias("op"),
            key,
            "_new.*",
        )
    )
