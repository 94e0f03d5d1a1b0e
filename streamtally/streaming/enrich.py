"""Orders enriched with users that may arrive later: waiting in the engine's join state, dead letters."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions import hash_salt
from ..operators.enrich import ORDER_FIELDS, SINK_FIELDS, USER_FIELDS, WAIT_SECONDS
from ..schemas import record
from ..sinks.routes import fan_out
from ..sinks.text import json_text, tsv_lines
from .keyed_log import KeyedLog

_ORDER_TYPES = {
    "order_id": "string",
    "user_id": "string",
    "product_name": "string",
    "category": "string",
    "quantity": "integer",
    "unit_price": "double",
    "created_at": "timestamp",
}
ROUTED = record(
    **_ORDER_TYPES,
    **{f"user_{f}": "string" for f in USER_FIELDS},
    route="string",
)
USER_VERSION = record(user_id="string", version_at="timestamp", **{f: "string" for f in USER_FIELDS})
# Rows of the stream between the join and the sink.
ORDER, VERSION = "order", "version"


def default_salts(spark: SparkSession) -> int:
    """Keys that one user's orders are spread over: the root of the state's partitions, so that a hot
    user's share per task falls as the cluster grows, and copies of a user stay few."""
    return max(1, math.isqrt(int(spark.conf.get("spark.sql.shuffle.partitions"))))


def meet_users(
    orders: DataFrame,
    users: DataFrame,
    wait_seconds: int = WAIT_SECONDS,
    arrival: str | None = None,
    slack: str = "1 second",
    salts: int | None = None,
    ticks: DataFrame | None = None,
) -> DataFrame:
    """Streaming orders that have met a user, or waited in vain, and the users' versions beside them.

    An order leaves in the batch in which it arrives if its user has arrived by then, else in the
    batch in which the user first arrives, at most ``wait_seconds`` later, else unmet. What waits is
    the engine's own outer join in time; so every order leaves exactly once. Orders wait in arrival
    time: that of their batch, or column ``arrival`` of both streams, which all rows of a batch must
    share. Time of that kind never runs backwards by more than ``slack``, whatever the rows
    themselves say about theirs, so no row is late, and a row without time is like any other.

    Waiting ends when later input arrives. ``ticks`` is a stream whose rows only say that time goes
    on, for sources that may fall silent (:func:`clock_ticks`).

    State: one key per user and salt for good, orders until their wait is over. ``salts`` spreads a
    user's orders; like the number of partitions it is fixed for the life of a checkpoint.
    """
    if salts is None:
        salts = default_salts(orders.sparkSession)
    arrived = (F.current_timestamp() if arrival is None else F.col(arrival)).alias("arrived_at")
    empty_order = [F.lit(None).cast(kind).alias(name) for name, kind in _ORDER_TYPES.items()]
    order_rows = orders.select(
        F.lit(ORDER).alias("kind"), F.col("user_id").alias("key"), F.struct(*ORDER_FIELDS).alias("row"), arrived
    )
    empty = F.struct(*empty_order).alias("row")
    user_rows = users.where(F.col("user_id").isNotNull()).select(
        F.lit(VERSION).alias("kind"), F.col("user_id").alias("key"), empty, arrived
    )
    rows = order_rows.unionByName(user_rows)
    if ticks is not None:
        silent = F.lit(None).cast("string")
        rows = rows.unionByName(ticks.select(F.lit("tick").alias("kind"), silent.alias("key"), empty, arrived))
    # One watermark over all arrivals, so that neither side holds up the other when it is silent.
    marked = rows.withWatermark("arrived_at", slack)

    def only(kind: str) -> Column:
        # Compares the time as well: otherwise the filter would move below the watermark.
        always = F.col("arrived_at") > F.lit("0001-01-01").cast("timestamp")
        return F.when(always, F.col("kind") == kind)

    waiting = marked.where(only(ORDER)).select(
        "row", F.col("key").alias("order_user"), hash_salt(F.col("row.order_id"), salts).alias("order_salt"),
        F.col("arrived_at").alias("order_arrived"),
    )
    first_seen = (
        marked.where(only(VERSION))
        .select(F.col("key").alias("seen_user"), F.col("arrived_at").alias("user_arrived"))
        .dropDuplicates(["seen_user"])
        .withColumn("seen_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    )
    wait = F.expr(f"INTERVAL {wait_seconds} SECONDS")
    met = waiting.join(
        first_seen,
        (F.col("order_user") == F.col("seen_user"))
        & (F.col("order_salt") == F.col("seen_salt"))
        & (F.col("user_arrived") <= F.col("order_arrived") + wait),
        "left_outer",
    )
    no_version = F.lit(None).cast(USER_VERSION)
    versions = users.where(F.col("user_id").isNotNull()).select(
        F.lit(VERSION).alias("kind"), F.lit(None).cast("boolean").alias("met"),
        F.struct(*empty_order).alias("order"), F.struct(*USER_VERSION.names).alias("version"),
    )
    return met.select(
        F.lit(ORDER).alias("kind"), F.col("seen_user").isNotNull().alias("met"), F.col("row").alias("order"),
        no_version.alias("version"),
    ).unionByName(versions)


def clock_ticks(spark: SparkSession, per_second: int = 1) -> DataFrame:
    """A stream that never falls silent, for waits in batch time."""
    return spark.readStream.format("rate").option("rowsPerSecond", per_second).load()


class Enrichment:
    """``foreachBatch`` sink of :func:`meet_users`: gives ``write`` the routed orders of each batch.

    The batch's versions go to a log first; then its orders that met a user take that user's newest
    version, by time and then by the greatest fields, a version without time being the oldest. Only
    versions of the batch's users are looked at. ``write(routed, batch_id)`` must overwrite by batch
    id, then a repeated batch has the effect of one.
    """

    def __init__(self, path: str, write: Callable[[DataFrame, int], None], fold: int = 64) -> None:
        order = ("version_at", *USER_FIELDS)
        self.write = write
        self.versions = KeyedLog(f"{path}/versions", USER_VERSION, ["user_id"], order, fold)

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        held = rows.persist()
        try:
            self.versions.append(held.where(F.col("kind") == VERSION).select("version.*"), batch_id)
            orders = held.where(F.col("kind") == ORDER).select("order.*", "met")
            users = orders.where("met").select("user_id")
            newest = self.versions.read(spark, batch_id, users).select(
                "user_id", *[F.col(f).alias(f"user_{f}") for f in USER_FIELDS]
            )
            route = F.when(F.col("met"), F.lit("enriched")).otherwise(F.lit("missing")).alias("route")
            # An order without user has met none, and one that waited in vain takes no later version.
            known = F.when(F.col("met"), F.col("user_id"))
            routed = orders.withColumn("known", known).join(
                newest.withColumnRenamed("user_id", "known"), "known", "left"
            )
            self.write(routed.select(*SINK_FIELDS, route).select(*ROUTED.names), batch_id)
        finally:
            held.unpersist()

    def writer(self, rows: DataFrame, checkpoint: str) -> DataStreamWriter:
        return (
            rows.writeStream.outputMode("append")
            .option("checkpointLocation", checkpoint)
            .foreachBatch(self)
        )


class FanOut:
    """Writes routed orders by batch: enriched ones to the lake and as text, missing ones as JSON."""

    def __init__(self, path: str) -> None:
        self.path = path

    def __call__(self, routed: DataFrame, batch_id: int) -> None:
        def lake(rows: DataFrame) -> None:
            rows.select(*SINK_FIELDS).write.mode("overwrite").parquet(
                f"{self.path}/enriched/batch={batch_id}"
            )

        def text(rows: DataFrame) -> None:
            lines = tsv_lines(rows.select(*SINK_FIELDS))
            lines.write.mode("overwrite").text(f"{self.path}/text/batch={batch_id}")

        def letters(rows: DataFrame) -> None:
            missing = rows.select(*ORDER_FIELDS)
            missing.select(json_text(missing).alias("line")).write.mode("overwrite").text(
                f"{self.path}/missing/batch={batch_id}"
            )

        known = F.col("route") == "enriched"
        fan_out(routed, {"lake": (known, lake), "text": (known, text), "missing": (~known, letters)})
