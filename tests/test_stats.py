"""Supplier statistics: what bad, missing and late input means in each variant."""

import datetime as dt
from decimal import Decimal

import pytest

from streamtally.operators import daily, supplier_stats
from streamtally.schemas import ORDER_STREAM

START = dt.datetime(2024, 1, 1)


def orders(spark, rows):
    full = [(str(i), "item", p, s, t) for i, (p, s, t) in enumerate(rows)]
    return spark.createDataFrame(full, ORDER_STREAM)


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def found(frame):
    return {
        (r.window_start, r.supplier): (r.total_price, r["count"]) for r in frame.collect()
    }


DIRTY = [
    ("1.25", "a", at(0)), (None, "a", at(1)), ("abc", "a", at(2)), ("12.345", None, at(3)),
    ("9", "a", None),
]


def test_lenient(spark):
    start = "2024-01-01T00:00:00Z"
    assert found(supplier_stats.lenient_stats(orders(spark, DIRTY))) == {
        (start, "a"): (1.25, 3), (start, "UNKNOWN"): (12.345, 1),
    }


def test_rounded_has_no_default_supplier(spark):
    start = "2024-01-01T00:00:00Z"
    have = found(supplier_stats.rounded_stats(orders(spark, DIRTY)))
    assert have[(start, "a")] == (1.25, 3)
    assert have[(start, None)][1] == 1
    assert abs(have[(start, None)][0] - 12.345) < 0.006


def test_strict_fails_on_bad_text(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        supplier_stats.strict_stats(orders(spark, DIRTY)).collect()


def test_strict_counts_null_prices_and_groups_null_suppliers(spark):
    rows = [("1.25", "a", at(0)), (None, "a", at(4)), ("2", None, at(4))]
    start = "2024-01-01T00:00:00Z"
    assert found(supplier_stats.strict_stats(orders(spark, rows))) == {
        (start, "a"): (Decimal("1.25"), 2), (start, None): (Decimal("2.00"), 1),
    }


def test_window_edge_belongs_to_the_next_window(spark):
    rows = [("1", "a", at(4.999)), ("2", "a", at(5))]
    assert found(supplier_stats.strict_stats(orders(spark, rows))) == {
        ("2024-01-01T00:00:00Z", "a"): (Decimal("1.00"), 1),
        ("2024-01-01T00:00:05Z", "a"): (Decimal("2.00"), 1),
    }


def test_arithmetic_windows_equal_time_windows(spark):
    rows = [(str(i), f"s{i % 3}", at(i * 1.7)) for i in range(40)]
    by_time = found(supplier_stats.rounded_stats(orders(spark, rows)))
    by_number = found(supplier_stats.arithmetic_windows(orders(spark, rows)))
    assert by_time == by_number


def test_latest_window_looks_back_only_so_far(spark):
    rows = [("1", "a", at(0)), ("2", "a", at(58)), ("3", "b", at(2))]
    have = found(supplier_stats.latest_windows(orders(spark, rows), now=at(60)))
    assert have == {("2024-01-01T00:00:55Z", "a"): (2.0, 1)}


def test_hourly_day_filter(spark):
    rows = [("1", "a", at(-1)), ("2", "a", at(0)), ("3", "a", at(86_399)), ("4", "a", at(86_400))]
    have = supplier_stats.hourly_stats(orders(spark, rows), START.date()).collect()
    assert {(r.bid_hour, r.total_price) for r in have} == {
        (0, Decimal("2.00")), (23, Decimal("3.00")),
    }


def test_aggregation_is_partial_before_the_shuffle(spark):
    plan = supplier_stats.lenient_stats(orders(spark, DIRTY))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in text and text.count("Exchange") == 1


def test_users_of_one_name_and_email_are_one(spark):
    columns = "user_first_name string, user_last_name string, user_email string, " \
        "category string, quantity int, unit_price double, created_at timestamp"
    rows = [("A", "B", "m", "c", 2, 1.5, at(0)), ("A", "B", "m", "d", 1, 2.0, at(10))]
    frame = spark.createDataFrame(rows, columns)
    [row] = daily.user_daily_stats(frame).collect()
    assert (row.total_revenue, row.total_orders) == (Decimal("5.00"), 2)
    assert daily.category_daily_stats(frame).count() == 2
