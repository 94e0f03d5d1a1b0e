"""Logical tables of the pipelines, derived from the driver's Parquet tables.

Every adapter is a projection (one is a join) over whole tables; column pruning and filters reach
the scan. Times are cut to milliseconds, as the streams carry them.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import millis_time, to_millis_precision

TEAMS = 15
SUPPLIERS = 8
LINE_SUPPLIERS = 20
# Fixed order of the event types; the position is the log partition of a record.
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# Game scores ------------------------------------------------------------------------------------


def as_user_scores(events: DataFrame) -> DataFrame:
    """Score events with a computed event time."""
    team = F.col("user_id") % TEAMS
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    return events.select(
        F.concat(F.lit("USR-"), "user_id").alias("user_id"),
        F.lpad(team.cast("string"), 10, "0").alias("team_id"),
        F.concat(F.lit("Team-"), team).alias("team_name"),
        F.floor("value").cast("int").alias("score"),
        millis.alias("event_time_millis"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("readable_time"),
        "event_type",
        millis_time(millis).alias("event_time"),
    )


def user_scores(spark: SparkSession, folder: str) -> DataFrame:
    return as_user_scores(table(spark, folder, "events"))


# Order stream -----------------------------------------------------------------------------------


def as_bids(events: DataFrame) -> DataFrame:
    """The order stream: prices are text, suppliers eight."""
    return events.select(
        F.col("event_id").cast("string").alias("order_id"),
        F.col("event_type").alias("item"),
        F.col("value").cast("decimal(10,2)").cast("string").alias("price"),
        F.concat(F.lit("S-"), F.col("user_id") % SUPPLIERS).alias("supplier"),
        to_millis_precision(F.col("ts")).alias("bid_time"),
    )


def as_dirty_bids(events: DataFrame) -> DataFrame:
    """The order stream as careless writers send it: by event type, prices are missing or no
    number, suppliers are missing; events of no value have no time. ``arrived_at`` is the log's own
    time, ``bid_time_text`` the time as loosely typed text."""
    clean = as_bids(events)
    kind = F.col("item")
    worthless = F.col("price").cast("double") < 1
    return clean.select(
        "order_id",
        "item",
        F.when(kind == "error", F.lit("n/a"))
        .when(kind == "signup", F.lit(None))
        .otherwise(F.col("price"))
        .alias("price"),
        F.when(kind != "view", F.col("supplier")).alias("supplier"),
        F.when(~worthless, F.col("bid_time")).alias("bid_time"),
        F.when(worthless, F.lit("unknown"))
        .otherwise(F.unix_millis("bid_time").cast("string"))
        .alias("bid_time_text"),
        (F.col("bid_time") + F.expr("INTERVAL 1 SECOND")).alias("arrived_at"),
    )


def bids(spark: SparkSession, folder: str) -> DataFrame:
    return as_bids(table(spark, folder, "events"))


def dirty_bids(spark: SparkSession, folder: str) -> DataFrame:
    return as_dirty_bids(table(spark, folder, "events"))


# Change log -------------------------------------------------------------------------------------


def _user_image(user_id: Column) -> Column:
    number = F.col("user_id").cast("string")
    return F.struct(
        user_id.alias("user_id"),
        F.when(F.col("event_type") != "purchase", F.concat(F.lit("First"), number)).alias(
            "first_name"
        ),
        F.concat(F.lit("Last"), number).alias("last_name"),
        F.concat(F.lit("u"), number, F.lit(".v"), F.col("event_id"), F.lit("@example.com")).alias(
            "email"
        ),
        F.when(F.col("value") < 200, F.lpad(F.floor("value").cast("string"), 5, "0")).alias(
            "postal_code"
        ),
        F.when(F.col("value") < 100, F.unix_micros(F.col("ts").cast("timestamp"))).alias(
            "created_at"
        ),
    )


def as_change_log(events: DataFrame) -> DataFrame:
    """User changes: sign-ups create, errors delete, the rest update; changes of no value carry no
    image, and of those with little value only the envelope (or nothing) knows the time."""
    image = _user_image(F.concat(F.lit("USR-"), "user_id"))
    op = (
        F.when(F.col("event_type") == "signup", "c")
        .when(F.col("event_type") == "error", "d")
        .otherwise("u")
    )
    empty = F.col("value") < 1
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    return events.select(
        F.col("event_id").alias("seq"),
        op.alias("op"),
        F.when((op != "c") & ~empty, image).alias("before"),
        F.when((op != "d") & ~empty, image).alias("after"),
        F.when(F.col("value") >= 2, F.struct(millis.alias("ts_ms"))).alias("source"),
        F.when(F.col("value") >= 1, millis + 5).alias("ts_ms"),
    )


def change_log(spark: SparkSession, folder: str) -> DataFrame:
    return as_change_log(table(spark, folder, "events"))


def order_change_log(spark: SparkSession, folder: str) -> DataFrame:
    """Order changes, one per event: images lack numbers or times where values are small or large, and
    changes of no value carry no image."""
    value = F.col("value")
    image = F.struct(
        F.col("event_id").cast("string").alias("order_id"),
        F.concat(F.lit("USR-"), "user_id").alias("user_id"),
        F.concat(F.lit("Product "), "event_type").alias("product_name"),
        F.col("event_type").alias("category"),
        F.when(value >= 5, F.floor(value).cast("int")).alias("quantity"),
        F.when(value < 200, value).alias("unit_price"),
        F.when(value < 100, F.unix_micros(F.col("ts").cast("timestamp"))).alias("created_at"),
    )
    deleted, empty = F.col("event_type") == "error", value < 1
    return table(spark, folder, "events").select(
        F.when(deleted, "d").when(F.col("event_type") == "purchase", "c").otherwise("u").alias("op"),
        F.when((F.col("event_type") != "purchase") & ~empty, image).alias("before"),
        F.when(~deleted & ~empty, image).alias("after"),
    )


# Purchases and user versions --------------------------------------------------------------------


def as_purchases(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Orders of the event stream, with the events' columns to ``keep``."""
    return events.where("event_type = 'purchase'").select(
        F.col("event_id").cast("string").alias("order_id"),
        F.concat(F.lit("USR-"), "user_id").alias("user_id"),
        F.concat(F.lit("Product "), F.get_json_object("props", "$.k")).alias("product_name"),
        F.concat(F.lit("Category "), F.substring(F.get_json_object("props", "$.k"), 1, 1)).alias(
            "category"
        ),
        (F.floor("value") + 1).cast("int").alias("quantity"),
        F.col("value").alias("unit_price"),
        to_millis_precision(F.col("ts")).alias("created_at"),
        *keep,
    )


def as_user_versions(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """User versions of the event stream: each sign-up is a new version of its user."""
    number = F.col("user_id").cast("string")
    return events.where("event_type = 'signup'").select(
        F.concat(F.lit("USR-"), number).alias("user_id"),
        F.concat(F.lit("First"), number).alias("first_name"),
        F.concat(F.lit("Last"), number).alias("last_name"),
        F.concat(F.lit("u"), number, F.lit(".v"), F.col("event_id"), F.lit("@example.com")).alias(
            "email"
        ),
        F.lpad(F.floor("value").cast("string"), 5, "0").alias("postal_code"),
        to_millis_precision(F.col("ts")).alias("version_at"),
        *keep,
    )


def purchases(spark: SparkSession, folder: str) -> DataFrame:
    return as_purchases(table(spark, folder, "events"))


def user_versions(spark: SparkSession, folder: str) -> DataFrame:
    return as_user_versions(table(spark, folder, "events"))


# Shop tables ------------------------------------------------------------------------------------


def shop_users(spark: SparkSession, folder: str) -> DataFrame:
    number = F.col("c_custkey").cast("string")
    return table(spark, folder, "customer").select(
        number.alias("user_id"),
        F.col("c_mktsegment").alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.concat(F.lit("c"), number, F.lit("@example.com")).alias("email"),
        F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("postal_code"),
    )


def shop_orders(spark: SparkSession, folder: str) -> DataFrame:
    """One order per line item; user and time come from its order header."""
    headers = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"
    )
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"
    )
    return lines.join(headers, lines["l_orderkey"] == headers["o_orderkey"]).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("order_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.concat(F.lit("Part "), "l_partkey").alias("product_name"),
        F.col("o_orderpriority").alias("category"),
        F.floor("l_quantity").cast("int").alias("quantity"),
        (F.col("l_extendedprice") / F.nullif(F.col("l_quantity"), F.lit(0.0))).alias("unit_price"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
    )


def order_status_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Order states over time, told from the flags of the shipped lines."""
    state = (
        F.when(F.col("l_returnflag") == "R", "Returned")
        .when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F"), "Delivered")
        .when(F.col("l_linestatus") == "F", "Shipped")
        .when(F.col("l_returnflag") == "A", "Cancelled")
        .otherwise("Processing")
    )
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        # Breaks ties of time; rows equal in all of it also have equal states.
        F.concat_ws("-", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus").alias("seq"),
        F.col("l_shipdate").cast("timestamp").alias("changed_at"),
        state.alias("status"),
    )


LINE_IMAGE = "struct<supplier:string,amount:decimal(12,2)>"
LINE_CHANGES = f"step int, op string, before {LINE_IMAGE}, after {LINE_IMAGE}"


def line_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Changes of order lines: each is created; those with status F move on to the next supplier at a
    price higher by one; returned ones are deleted; at last all lines of suppliers 8 and up are."""
    lines = table(spark, folder, "lineitem")
    moves = F.col("l_linestatus") == "F"
    price = F.col("l_extendedprice").cast("decimal(12,2)")

    def image(number: Column, amount: Column) -> Column:
        supplier = F.concat(F.lit("S-"), (number % LINE_SUPPLIERS).cast("string"))
        return F.struct(supplier.alias("supplier"), amount.cast("decimal(12,2)").alias("amount")).cast(LINE_IMAGE)

    first, moved = image(F.col("l_suppkey"), price), image(F.col("l_suppkey") + 1, price + 1)
    last = F.when(moves, moved).otherwise(first)
    number = F.when(moves, F.col("l_suppkey") + 1).otherwise(F.col("l_suppkey")) % LINE_SUPPLIERS
    returned, closed = F.col("l_returnflag") == "R", number >= 8
    none = F.lit(None).cast(LINE_IMAGE)

    # A scan for each step, whose condition and number are seen by the optimizer: who wants one step reads one.
    steps = [
        ("c", F.lit(True), none, first),
        ("u", moves, first, moved),
        ("d", returned, last, none),
        ("d", closed & ~returned, last, none),
    ]
    found = [
        lines.where(condition).select(
            F.lit(i).alias("step"), F.lit(op).alias("op"), before.alias("before"), after.alias("after")
        )
        for i, (op, condition, before, after) in enumerate(steps, 1)
    ]
    return functools.reduce(DataFrame.unionByName, found)


# Log messages -----------------------------------------------------------------------------------


def log_partition(event_type: Column) -> Column:
    return (
        F.array_position(F.array(*[F.lit(t) for t in EVENT_TYPES]), event_type) - 1
    ).cast("int")


def as_messages(events: DataFrame) -> DataFrame:
    """JSON order messages as a log holds them. Some amounts are text, words or missing, and some
    messages are cut off."""
    value = F.col("value")
    words = '"rather a lot"'
    amount = (
        F.when((F.col("event_type") == "error") & (value > 50), F.lit(words))
        .when(F.col("event_type") == "view", F.concat(F.lit('"'), value.cast("string"), F.lit('"')))
        .when((F.col("event_type") == "signup") & (value > 50), F.lit("null"))
        .otherwise(value.cast("string"))
    )
    full = F.concat(
        F.lit('{"order_id":"'),
        F.col("event_id").cast("string"),
        F.lit('","amount":'),
        amount,
        F.lit(',"status":"'),
        F.col("event_type"),
        F.lit('"}'),
    )
    return events.select(
        log_partition(F.col("event_type")).alias("partition"),
        F.col("event_id").alias("offset"),
        F.concat(F.lit("USR-"), "user_id").alias("key"),
        F.when((F.col("event_type") == "click") & (value > 100), F.substring(full, 1, 24))
        .otherwise(full)
        .alias("value"),
        to_millis_precision(F.col("ts")).alias("timestamp"),
    )


def messages(spark: SparkSession, folder: str) -> DataFrame:
    return as_messages(table(spark, folder, "events"))


def log_records(spark: SparkSession, folder: str) -> DataFrame:
    level = (
        F.when(F.col("event_type") == "error", "ERROR")
        .when(F.col("value") > 50, "WARN")
        .otherwise("INFO")
    )
    return table(spark, folder, "events").select(
        level.alias("log_level"),
        F.col("props").alias("message"),
        F.concat(F.lit("service-"), F.col("event_type")).alias("service_name"),
    )


def board_changelog(spark: SparkSession, folder: str) -> DataFrame:
    """Keyed messages with deletions: errors send a null value for their key."""
    return table(spark, folder, "events").select(
        F.concat(F.lit("USR-"), "user_id").alias("key"),
        F.when(
            F.col("event_type") != "error",
            F.concat_ws(":", F.col("event_type"), (F.floor(F.col("value") / 50)).cast("string")),
        ).alias("value"),
        F.col("event_id").alias("offset"),
    )
