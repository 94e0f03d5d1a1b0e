"""Row-change envelopes: unwrap, time, current state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import micros_or_epoch


def _image() -> Column:
    return F.coalesce(F.col("after"), F.col("before"))


def event_time(envelopes: DataFrame, now: Column | None = None) -> DataFrame:
    """Change time: the source's, else the envelope's, else ``now``."""
    fallback = now if now is not None else F.current_timestamp()
    millis = F.coalesce(F.col("source.ts_ms"), F.col("ts_ms"))
    return envelopes.withColumn(
        "event_time", F.coalesce(F.timestamp_millis(millis), fallback.cast("timestamp"))
    )


def unwrap(envelopes: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The row image of each change: the new one, for a delete the old one; neither drops the row.

    A deleted row therefore still comes out as a live one (see :func:`current_state` otherwise).
    """
    return (
        envelopes.withColumn("_image", _image())
        .where(F.col("_image").isNotNull())
        .select(*(keep or []), "_image.*")
    )


def unwrap_users(envelopes: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """User images; missing texts are empty, a missing creation time is the epoch."""
    users = unwrap(envelopes, keep)
    empty = F.lit("")
    return users.withColumns(
        {
            **{
                c: F.coalesce(F.col(c), empty)
                for c in ("first_name", "last_name", "email", "postal_code")
            },
            "created_at": micros_or_epoch(F.col("created_at")),
        }
    )


def unwrap_orders(envelopes: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Order images; missing numbers are zero, a missing creation time is the epoch."""
    return unwrap(envelopes, keep).withColumns(
        {
            "quantity": F.coalesce(F.col("quantity"), F.lit(0)),
            "unit_price": F.coalesce(F.col("unit_price"), F.lit(0.0)),
            "created_at": micros_or_epoch(F.col("created_at")),
        }
    )


def current_state(changes: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The table a change log describes: the newest image per key, deleted keys left out."""
    return (
        changes.withColumn("_image", _image())
        .where(F.col("_image").isNotNull())
        .groupBy(F.col(f"_image.{key}").alias("_key"))
        .agg(F.max_by(F.struct("op", "_image"), F.struct(*order)).alias("_last"))
        .where("_last.op <> 'd'")
        .select("_last._image.*")
    )


def signed_amounts(envelopes: DataFrame, groups: Sequence[str], amount: str) -> DataFrame:
    """What each change takes away (its image before) and adds (its image after): the image's
    ``groups``, its ``amount`` with its sign, and 1 or -1 as ``n``.

    Sums of these are totals of the current rows after any number of changes, batch or stream: an
    update moves an amount between groups, a delete takes it away. Updates and deletes must carry the
    whole image before, and each change must come once. An image without amount counts as a row of
    amount null.
    """

    def side(image: str, sign: int) -> Column:
        row = F.struct(
            *[F.col(f"{image}.{g}").alias(g) for g in groups],
            (F.col(f"{image}.{amount}") * F.lit(sign)).cast(kind).alias("amount"),
            F.lit(sign).cast("bigint").alias("n"),
        )
        return F.when(F.col(image).isNotNull(), row)

    kind = envelopes.select(f"after.{amount}").schema[0].dataType
    # Sides that are not there are dropped after the explode: a lambda over the array would run interpreted.
    sides = envelopes.select(F.explode(F.array(side("before", -1), side("after", 1))).alias("_side"))
    return sides.where(F.col("_side").isNotNull()).select("_side.*")


def running_totals(envelopes: DataFrame, groups: Sequence[str], amount: str) -> DataFrame:
    """Per group the total and the number of its current rows; an emptied group has ``n`` 0."""
    signed = signed_amounts(envelopes, groups, amount)
    return signed.groupBy(*groups).agg(F.sum("amount").alias("total"), F.sum("n").alias("n"))
