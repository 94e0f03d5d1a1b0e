"""Declared record schemas."""

from __future__ import annotations

from pyspark.sql import types as T


def record(*, _nullable: bool = True, **types: str) -> T.StructType:
    """A flat schema from field names and simple type names (needs no session)."""
    schema = T.StructType()
    for name, kind in types.items():
        schema.add(name, kind, _nullable)
    return schema


# Inputs -----------------------------------------------------------------------------------------
EVENTS = record(
    event_id="long",
    ts="timestamp_ntz",
    user_id="long",
    event_type="string",
    value="double",
    props="string",
)
ORDER_STREAM = record(
    order_id="string",
    item="string",
    price="string",
    supplier="string",
    bid_time="timestamp",
)
ORDER_V1 = record(
    order_id="string",
    bid_time="long",
    price="double",
    item="string",
    supplier="string",
)
ORDER_V2 = record(
    order_id="string",
    bid_time="long",
    price="double",
    item="string",
    supplier="string",
    is_premium="boolean",
)
USER_SCORES = record(
    user_id="string",
    team_id="string",
    team_name="string",
    score="integer",
    event_time_millis="long",
    readable_time="string",
    event_type="string",
    event_time="timestamp",
)
USER_IMAGE = record(
    user_id="string",
    first_name="string",
    last_name="string",
    email="string",
    postal_code="string",
    created_at="long",
)
ORDER_IMAGE = record(
    order_id="string",
    user_id="string",
    product_name="string",
    category="string",
    quantity="integer",
    unit_price="double",
    created_at="long",
)

# Outputs ----------------------------------------------------------------------------------------
ORDERS_TABLE = record(
    order_id="string",
    item="string",
    price="decimal(10,2)",
    supplier="string",
    bid_time="timestamp",
)
CATEGORY_DAILY_STATS = record(
    _nullable=False,
    category="string",
    report_date="date",
    total_revenue="decimal(15,2)",
    total_orders="long",
)


def envelope(image: T.StructType) -> T.StructType:
    """A row-change record around ``image``."""
    return T.StructType(
        [
            T.StructField("op", T.StringType()),
            T.StructField("before", image),
            T.StructField("after", image),
            T.StructField("source", record(ts_ms="long")),
            T.StructField("ts_ms", T.LongType()),
        ]
    )
