"""Record-level work: selection, defaults, evolution, validation, sampling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import decimal_or_null, is_number, price_strict
from ..session import stored


def select_rows(
    table: DataFrame,
    columns: Sequence[str] | None = None,
    where: Column | str | None = None,
    order_by: Sequence[Column] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """A parametrised select; each part is optional."""
    if where is not None:
        table = table.where(where)
    if order_by:
        table = table.orderBy(*order_by)
    if limit is not None:
        table = table.limit(limit)
    return table.select(*columns) if columns else table


def project_orders(orders: DataFrame) -> DataFrame:
    """The order stream in the lake table's types."""
    return orders.select(
        "order_id", "item", price_strict(F.col("price")).alias("price"), "supplier", "bid_time"
    )


def filter_valid_time(orders: DataFrame, column: str = "bid_time") -> DataFrame:
    """Rows whose loosely typed time is a whole number (epoch milliseconds)."""
    return orders.where(F.col(column).try_cast("bigint").isNotNull())


def time_or_fallback(orders: DataFrame, column: str, fallback: str) -> DataFrame:
    """The record's own time, else the time the log assigned to it."""
    return orders.withColumn(column, F.coalesce(F.col(column), F.col(fallback)))


def evolve_to(
    records: DataFrame, schema: T.StructType, defaults: Mapping[str, object] | None = None
) -> DataFrame:
    """Records of any older or newer version, read as ``schema``.

    Fields the writer did not know get their default, fields the reader does not know are dropped.
    """
    defaults = defaults or {}
    have = set(records.columns)
    columns = []
    for field in schema.fields:
        default = F.lit(defaults.get(field.name)).cast(field.dataType)
        if field.name not in have:
            columns.append(default.alias(field.name))
        elif field.name in defaults:
            columns.append(
                F.coalesce(F.col(field.name).cast(field.dataType), default).alias(field.name)
            )
        else:
            columns.append(F.col(field.name).cast(field.dataType).alias(field.name))
    return records.select(*columns)


def with_verdict(messages: DataFrame, value: str = "value") -> DataFrame:
    """Adds the parsed ``amount`` and, for records that cannot be processed, a ``reason``.

    The amount may be a JSON number or numeric text; unreadable JSON, no amount, other text and
    numbers that 38 digits with 18 decimals cannot hold exactly (``amount out of range``) are
    failures. The message is read as the only element of an array, so that text before or after
    the object makes it unreadable.
    """
    elements = F.from_json(
        F.concat(F.lit("["), F.col(value), F.lit("]")), "array<struct<amount:string>>"
    )
    order = F.get("_elements", F.lit(0))
    amount = decimal_or_null(order["amount"])
    unreadable = F.coalesce(F.size("_elements") != 1, F.lit(True)) | order.isNull()
    return (
        # As a generator's only row: the optimizer would copy a plain column into every use of it,
        # and parse as often.
        messages.select("*", F.explode_outer(F.array(elements)).alias("_elements"))
        .withColumns(
            {
                "amount": F.when(~unreadable, amount),
                "reason": F.when(unreadable, F.lit("unreadable json"))
                .when(order["amount"].isNull(), F.lit("no amount"))
                .when(~is_number(order["amount"]), F.lit("amount is not a number"))
                .when(amount.isNull(), F.lit("amount out of range")),
            }
        )
        .drop("_elements")
    )


def good_records(messages: DataFrame, value: str = "value") -> DataFrame:
    return with_verdict(messages, value).where(F.col("amount").isNotNull()).drop("reason")


def quarantined(messages: DataFrame, value: str = "value") -> DataFrame:
    return with_verdict(messages, value).where(F.col("amount").isNull()).drop("amount")


def stall_report(messages: DataFrame) -> DataFrame:
    """Per partition: the first record a strict consumer would stop at, how many such records
    there are, and how many records wait behind the first.

    The first part is written out: it has a row per log partition, and joining it as an unknown
    quantity would shuffle the whole log by a handful of keys.
    """
    first = stored(
        quarantined(messages)
        .groupBy("partition")
        .agg(F.min("offset").alias("stalled_at"), F.count(F.lit(1)).alias("bad_records")),
        "stalled",
    )
    behind = (
        messages.select("partition", "offset")
        .join(first.select("partition", "stalled_at"), "partition")
        .where("offset > stalled_at")
        .groupBy("partition")
        .agg(F.count(F.lit(1)).alias("waiting"))
    )
    return first.join(behind, "partition", "left").select(
        "partition", "stalled_at", "bad_records", F.coalesce("waiting", F.lit(0)).alias("waiting")
    )


def null_counts(table: DataFrame, required: Sequence[str]) -> DataFrame:
    """NOT NULL check: how many rows break each declared column, in one pass."""
    counts = table.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    return counts.unpivot([], list(required), "column_name", "violations")


def require_not_null(table: DataFrame, required: Sequence[str]) -> DataFrame:
    """The same rows; reading one with a null in a required column fails the job."""
    checks = {
        c: F.when(F.col(c).isNotNull(), F.col(c)).otherwise(
            F.raise_error(F.lit(f"null in required column {c}"))
        )
        for c in required
    }
    return table.withColumns(checks)


def lower_columns(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    return table.withColumns({c: F.lower(F.col(c)) for c in columns})


def level_counts(logs: DataFrame) -> DataFrame:
    return logs.groupBy("service_name", "log_level").agg(F.count(F.lit(1)).alias("records"))


def _draw(key: str, seed: int) -> Column:
    """A number in [0, 1) that depends on key and seed only, not on how the table is laid out."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(2.0**52)


def weighted_sample(
    table: DataFrame, weight: str, n: int, key: str, seed: int = 7, place: Column | None = None
) -> DataFrame:
    """``n`` rows without replacement, chance proportional to weight (exponential keys, top-n).

    The draw is a hash of ``key``, so it is the same at every rerun. ``place`` restricts the sample
    to rows that fulfil it."""
    order = -F.log(F.lit(1.0) - _draw(key, seed)) / F.col(weight)
    table = table if place is None else table.where(place)
    return (
        table.where(F.col(weight) > 0)
        .withColumn("_order", order)
        .orderBy("_order", key)
        .limit(n)
        .drop("_order")
    )


def seats(n: int, proportions: Mapping[str, float]) -> dict[str, int]:
    """``n`` split by the proportions in whole numbers: each share rounded down, and what is left goes
    to the largest remainders (of equal ones to the first name). Shares that are not positive get none."""
    exact = {k: Fraction(v).limit_denominator(10**9) for k, v in proportions.items() if v > 0}
    whole = sum(exact.values())
    quotas = {k: n * v / whole for k, v in exact.items()}
    found = {k: int(q) for k, q in quotas.items()}
    by_remainder = sorted(quotas, key=lambda k: (found[k] - quotas[k], k))
    for k in by_remainder[: n - sum(found.values())]:
        found[k] += 1
    return found


def weighted_sample_by_place(
    table: DataFrame,
    weight: str,
    n: int,
    key: str,
    place: str,
    proportions: Mapping[str, float],
    seed: int = 7,
) -> DataFrame:
    """``n`` rows without replacement, of each place as many as its proportion says, and within a place
    with chance proportional to weight. Places that are not named give no rows; one with too few rows
    of positive weight gives them all, and its seats stay empty.

    The draw is a hash of ``key``. Each task keeps no more rows of a place than its seats."""
    given = {k: m for k, m in seats(n, proportions).items() if m}
    if not given:
        return table.limit(0)
    order = -F.log(F.lit(1.0) - _draw(key, seed)) / F.col(weight)
    drawn = table.where(F.col(place).isin(list(given)) & (F.col(weight) > 0)).withColumn("_order", order)
    rank = F.row_number().over(Window.partitionBy(place).orderBy("_order", key))
    limit = F.coalesce(*[F.when(F.col(place) == k, F.lit(m)) for k, m in given.items()])
    # The constant bound lets the rank be limited before the shuffle.
    ranked = drawn.withColumn("_rank", rank).where(F.col("_rank") <= max(given.values()))
    return ranked.where(F.col("_rank") <= limit).drop("_order", "_rank")


def random_row(table: DataFrame, key: str, seed: int = 7) -> DataFrame:
    """One row, by a hash of its key."""
    return table.orderBy(_draw(key, seed), key).limit(1)
