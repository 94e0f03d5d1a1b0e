"""Orders joined with users: current version, as-of version, dead letter."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .slices import SLICE, slice_start

WAIT_SECONDS = 30
MICROS = 1_000_000
# At equal times a version sorts before an order.
VERSION, ORDER = 0, 1
USER_FIELDS = ("first_name", "last_name", "email", "postal_code")
ORDER_FIELDS = (
    "order_id",
    "user_id",
    "product_name",
    "category",
    "quantity",
    "unit_price",
    "created_at",
)
SINK_FIELDS = (*ORDER_FIELDS, *(f"user_{f}" for f in USER_FIELDS))


def _user_columns(users: DataFrame) -> DataFrame:
    return users.select("user_id", *[F.col(f).alias(f"user_{f}") for f in USER_FIELDS])


def enrich_current(orders: DataFrame, users: DataFrame) -> DataFrame:
    """Orders with the one current version of their user; orders without a user are left out.

    No broadcast is forced: adaptive execution takes the join that the measured sizes allow, and
    splits a hot user's orders, since the user side has one row per key.
    """
    return orders.join(_user_columns(users), "user_id").select(*SINK_FIELDS)


def missing_users(orders: DataFrame, users: DataFrame) -> DataFrame:
    """Orders whose user does not exist at all."""
    return orders.join(users.select("user_id"), "user_id", "left_anti").select(*ORDER_FIELDS)


def match_as_of(
    orders: DataFrame,
    versions: DataFrame,
    wait_seconds: int = WAIT_SECONDS,
    slice_seconds: int = 600,
) -> DataFrame:
    """Each order with the user version it meets.

    That is the newest version at or before the order; without one, the first version within
    ``wait_seconds`` after it; without that, none (``route`` is then ``missing``, else
    ``enriched``). ``versions`` carries ``version_at`` and the user fields.

    Orders and versions are merged and scanned in time order, so the work is linear and no pairs
    are formed. The time of every user is cut into slices; a slice gets the last version before it,
    and the versions of the ``wait_seconds`` after it, as extra rows. Of versions at one instant the
    one with the greatest fields is the newest (the first after an order: the one with the least).
    """
    if not 0 <= wait_seconds <= slice_seconds:
        raise ValueError("need 0 <= wait_seconds <= slice_seconds")
    width = slice_seconds * MICROS
    at = F.col("_at")
    own_slice = slice_start(at, width)
    order_rows = orders.select(
        "user_id",
        F.unix_micros("created_at").alias("_at"),
        F.lit(ORDER).alias("_kind"),
        F.struct(*ORDER_FIELDS).alias("_order"),
    ).withColumn(SLICE, own_slice)
    version_rows = versions.select(
        "user_id",
        F.unix_micros("version_at").alias("_at"),
        F.lit(VERSION).alias("_kind"),
        F.struct(*USER_FIELDS).alias("_user"),
    ).withColumn(SLICE, own_slice)
    merged = order_rows.unionByName(version_rows, allowMissingColumns=True)
    # Rows without a time have no slice and are of no other slice.
    waited_for = slice_start(at - wait_seconds * MICROS, width)
    ahead = version_rows.where(waited_for != F.col(SLICE)).withColumn(SLICE, waited_for)
    before = _versions_before_slices(order_rows, version_rows)
    merged = merged.unionByName(ahead, allowMissingColumns=True).unionByName(
        before, allowMissingColumns=True
    )
    version = F.when(F.col("_kind") == VERSION, F.struct("_at", "_user"))
    in_slice = Window.partitionBy("user_id", SLICE)
    upward = in_slice.orderBy("_at", "_kind", "_user")
    downward = in_slice.orderBy(F.desc("_at"), F.desc("_kind"), F.desc("_user"))
    seen = merged.select(
        "_order",
        "_at",
        F.last(version, ignorenulls=True)
        .over(upward.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        .alias("_before"),
        F.last(version, ignorenulls=True)
        .over(downward.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        .alias("_after"),
    ).where(F.col("_order").isNotNull())
    in_time = F.col("_after._at") <= F.col("_at") + wait_seconds * MICROS
    user = F.coalesce(F.col("_before._user"), F.when(in_time, F.col("_after._user")))
    return seen.select("_order.*", user.alias("_user")).select(
        *ORDER_FIELDS,
        *[F.col(f"_user.{f}").alias(f"user_{f}") for f in USER_FIELDS],
        F.when(F.col("_user").isNull(), F.lit("missing"))
        .otherwise(F.lit("enriched"))
        .alias("route"),
    )


def _versions_before_slices(orders: DataFrame, versions: DataFrame) -> DataFrame:
    """Per user and slice with orders: the newest version of all earlier slices."""
    tails = (
        versions.groupBy("user_id", SLICE)
        .agg(F.max(F.struct("_at", "_user")).alias("_tail"))
        .withColumn("_wanted", F.lit(False))
    )
    wanted = (
        orders.select("user_id", SLICE)
        .distinct()
        .withColumn("_wanted", F.lit(True))
    )
    # The wanted marker of a slice sorts before that slice's own tail.
    earlier = (
        Window.partitionBy("user_id")
        .orderBy(SLICE, F.desc("_wanted"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        tails.unionByName(wanted, allowMissingColumns=True)
        .withColumn("_last", F.last("_tail", ignorenulls=True).over(earlier))
        .where(F.col("_wanted") & F.col("_last").isNotNull())
        .select("user_id", SLICE, F.lit(VERSION).alias("_kind"), "_last._at", "_last._user")
    )


def enriched(matched: DataFrame) -> DataFrame:
    return matched.where("route = 'enriched'").select(*SINK_FIELDS)


def dead_letter(matched: DataFrame) -> DataFrame:
    return matched.where("route = 'missing'").select(*ORDER_FIELDS)


def sink_shape(orders: DataFrame, names: tuple[str, ...] = SINK_FIELDS) -> DataFrame:
    """Columns in the sink's positional order; user columns that are absent come out as null."""
    have = set(orders.columns)
    return orders.select(
        *[F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in names]
    )


def lookup(rows: DataFrame, keys: DataFrame, row_key: str, key: str) -> DataFrame:
    """All rows whose ``row_key`` is among ``keys`` (a batch of point selects as one semi-join)."""
    wanted = keys.select(F.col(key).alias("_key"))
    return rows.join(wanted, rows[row_key] == wanted["_key"], "left_semi")

