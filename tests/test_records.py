"""Parsing, validation, evolution, text formats and option building."""

import datetime as dt
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from streamtally import functions as fn
from streamtally.operators import daily, records
from streamtally.schemas import ORDER_V1, ORDER_V2
from streamtally.sinks import database as database_sink
from streamtally.sinks import keyed
from streamtally.sinks import log as log_sink
from streamtally.sinks import text
from streamtally.sources import database, log


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column).first()[0]


def test_clock_text_with_other_zone(spark):
    parsed = one(spark, fn.parse_clock_text(F.col("t")), t="Fri Nov 15 14:08:44 PST 2024")
    assert parsed == dt.datetime(2024, 11, 15, 22, 8, 44)
    assert one(spark, fn.parse_clock_text(F.col("t")), t="yesterday") is None


@pytest.mark.parametrize(
    "micros,iso,sql",
    [
        (0, "2024-01-01T00:00:00Z", "2024-01-01 00:00:00.0"),
        (120_000, "2024-01-01T00:00:00.120Z", "2024-01-01 00:00:00.12"),
        (7, "2024-01-01T00:00:00.000007Z", "2024-01-01 00:00:00.000007"),
    ],
)
def test_time_texts(spark, micros, iso, sql):
    time = dt.datetime(2024, 1, 1, microsecond=micros)
    assert one(spark, fn.iso_instant(F.col("t")), t=time) == iso
    assert one(spark, fn.sql_time_text(F.col("t")), t=time) == sql


def test_surrogate_key_is_the_hash_prefix_in_decimal(spark):
    import hashlib

    want = str(int(hashlib.sha1(b"Team A").hexdigest()[:8], 16)).zfill(10)
    assert one(spark, fn.surrogate_key(F.col("n")), n="Team A") == want


def test_escapes(spark):
    raw = "a\\b\tc\nd\re"
    assert one(spark, fn.escaped_field(F.col("v")), v=raw) == "a\\\\b\\tc\\nd\\re"
    assert one(spark, fn.escaped_field(F.lit(None).cast("string"))) == "\\N"


def test_tsv_and_json_lines(spark):
    frame = spark.createDataFrame(
        [("x\ty", None, 1.5, dt.datetime(2024, 1, 1))], "a string, b int, c double, t timestamp"
    )
    assert text.tsv_lines(frame).first()[0] == "x\\ty\t\\N\t1.5\t2024-01-01 00:00:00.0"
    assert (
        text.json_lines(frame).first()[0]
        == '{"a":"x\\ty","b":null,"c":1.5,"t":"2024-01-01T00:00:00Z"}'
    )


def test_validation_reasons(spark):
    values = ['{"amount": 12.5}', '{"amount": "12.5"}', '{"amount": "ONE"}', '{"amount": null}',
              '{"status": "x"}', '{"amount": 1', None, '{"amount": 1} x', '{"amount": 1} {"amount": 2}',
              '{"amount": 1},{"amount": 2}', "[1]", "3", "", '{"amount": {"a": 1}}', " {\"amount\": 1} "]
    frame = spark.createDataFrame(list(enumerate(values)), "offset int, value string")
    good = {r.offset for r in records.good_records(frame).collect()}
    bad = {r.offset: r.reason for r in records.quarantined(frame).collect()}
    assert good == {0, 1, 14}
    assert bad == {
        2: "amount is not a number", 3: "no amount", 4: "no amount", 13: "amount is not a number",
        **{i: "unreadable json" for i in range(5, 13)},
    }


def test_stall_report_counts_what_waits(spark):
    rows = [(0, 1, '{"amount":1}'), (0, 2, "bad"), (0, 3, '{"amount":1}'), (0, 4, "bad"),
            (1, 1, '{"amount":1}'), (2, 9, "bad")]
    frame = spark.createDataFrame(rows, "partition int, offset bigint, value string")
    have = {tuple(r) for r in records.stall_report(frame).collect()}
    assert have == {(0, 2, 2, 2), (2, 9, 1, 0)}


def test_evolution_both_ways(spark):
    old = spark.createDataFrame([("1", 5, 2.0, "i", "s")], ORDER_V1)
    new = spark.createDataFrame([("2", 6, 3.0, "i", "s", True), ("3", 7, 1.0, "i", "s", None)], ORDER_V2)
    default = {"is_premium": False}
    assert [r.is_premium for r in records.evolve_to(old, ORDER_V2, default).collect()] == [False]
    read = records.evolve_to(new, ORDER_V2, default).orderBy("order_id").collect()
    assert [r.is_premium for r in read] == [True, False]
    assert records.evolve_to(new, ORDER_V1).columns == ORDER_V1.names


def test_select_parts_are_optional(spark):
    frame = spark.range(10)
    assert records.select_rows(frame).count() == 10
    picked = records.select_rows(frame, ["id"], "id > 3", [F.desc("id")], 2)
    assert [r.id for r in picked.collect()] == [9, 8]


def test_required_columns(spark):
    frame = spark.createDataFrame([(1, None), (2, "b")], "a int, b string")
    counts = {r.column_name: r.violations for r in records.null_counts(frame, ["a", "b"]).collect()}
    assert counts == {"a": 0, "b": 1}
    assert records.require_not_null(frame, ["a"]).count() == 2
    with pytest.raises(Exception, match="null in required column b"):
        records.require_not_null(frame, ["b"]).collect()


def test_weighted_sample_prefers_weight_and_skips_none(spark):
    frame = spark.range(200).withColumn("w", F.when(F.col("id") < 10, 1e6).otherwise(1.0))
    frame = frame.withColumn("w", F.when(F.col("id") == 0, 0.0).otherwise(F.col("w")))
    ids = {r.id for r in records.weighted_sample(frame, "w", 9, "id").collect()}
    assert ids == set(range(1, 10))
    near = {r.id for r in records.weighted_sample(frame, "w", 5, "id", place=F.col("id") >= 100).collect()}
    assert len(near) == 5 and min(near) >= 100
    # The same draw on another layout of the table.
    again = records.weighted_sample(frame.repartition(7), "w", 60, "id").collect()
    assert set(again) == set(records.weighted_sample(frame, "w", 60, "id").collect())


@pytest.mark.parametrize(
    "text, amount, reason",
    [
        ("123456789012345678901234", None, "amount out of range"),
        ("0.12345678901234567890", None, "amount out of range"),
        ("1e-20", None, "amount out of range"),
        ("12345678901234567890.5000000000000000000000", "12345678901234567890.500000000000000000", None),
        ("1.5e3", "1500.000000000000000000", None),
        ("-.5", "-0.500000000000000000", None),
        ("12x", None, "amount is not a number"),
        ("", None, "amount is not a number"),
    ],
)
def test_amounts_are_exact_or_out_of_range(spark, text, amount, reason):
    frame = spark.createDataFrame([(f'{{"amount": "{text}"}}',)], "value string")
    row = records.with_verdict(frame).first()
    assert (None if row.amount is None else str(row.amount), row.reason) == (amount, reason)


def test_utc_texts_in_another_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        micros = [0, 1_709_968_200_123_000, 1_709_965_800_000_001, -1]
        frame = spark.createDataFrame([(m,) for m in micros], "m bigint").select(F.timestamp_micros("m").alias("t"))
        have = [tuple(r) for r in frame.select(fn.utc_text(F.col("t")), fn.iso_instant(F.col("t"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert have == [
        ("1970-01-01T00:00:00Z", "1970-01-01T00:00:00Z"),
        ("2024-03-09T07:10:00Z", "2024-03-09T07:10:00.123Z"),
        ("2024-03-09T06:30:00Z", "2024-03-09T06:30:00.000001Z"),
        ("1969-12-31T23:59:59Z", "1969-12-31T23:59:59.999999Z"),
    ]


def test_of_repeated_updates_the_newest_counts(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, at int")
    updates = spark.createDataFrame([(1, "z", 2), (1, "y", 3), (3, "c", 1), (3, "d", 1)], "k int, v string, at int")
    have = sorted(tuple(r) for r in keyed.merge(target, updates, ["k"], order=["at"]).collect())
    assert have == [(1, "y", 3), (2, "b", 1), (3, "d", 1)]


def test_committed_positions(spark):
    frame = spark.createDataFrame(
        [(0, 1), (0, 2), (0, 3), (1, 1), (1, 2)], "partition int, offset bigint"
    )
    done = spark.createDataFrame([(0, 3)], "partition int, next_offset bigint")
    have = {tuple(r) for r in log.from_committed(frame, done).collect()}
    assert have == {(0, 3), (1, 1), (1, 2)}
    late = {tuple(r) for r in log.from_committed(frame, done, log.LATEST).collect()}
    assert late == {(0, 3)}


def test_log_options():
    options = log.reader_options("h:1", partitions={"t": [0]}, start={"t": {0: "earliest", 1: 7}})
    assert options["assign"] == '{"t": [0]}'
    assert options["startingOffsets"] == '{"t": {"0": -2, "1": 7}}'
    assert log.reader_options("h:1", ["a", "b"])["subscribe"] == "a,b"
    with pytest.raises(ValueError):
        log.reader_options("h:1")
    assert log_sink.writer_options("h:1", "t")["kafka.acks"] == "all"


def test_missing_connector_is_named(spark):
    with pytest.raises(RuntimeError, match="spark-sql-kafka"):
        log.stream_log(spark, log.reader_options("h:1", ["a"]))


def test_jdbc_options_and_upsert_statement():
    options = database.jdbc_options("u", "t", partition_column="id", lower=0, upper=9, partitions=3)
    assert options["numPartitions"] == "3"
    with pytest.raises(ValueError):
        database.jdbc_options("u", "t", partition_column="id")
    assert database_sink.upsert_statement("t", "s", ["k", "a", "b"], ["k"], ["a"]) == (
        "INSERT INTO t (k, a, b) SELECT k, a, b FROM s "
        "ON CONFLICT (k) DO UPDATE SET a = EXCLUDED.a"
    )
    assert database_sink.upsert_statement("t", "s", ["k"], ["k"]).endswith("DO NOTHING")


def test_upsert_messages_write_tombstones(spark):
    changes = spark.createDataFrame(
        [("U", 1, "a"), ("D", 2, None)], "op string, rnk bigint, team string"
    )
    have = {r.key: r.value for r in log_sink.upsert_messages(changes).collect()}
    assert have == {"1": '{"team":"a"}', "2": None}


def test_validation_parses_each_message_once(spark):
    rows = spark.createDataFrame([('{"amount": 1}', 1), ("{", 2), ('{"amount":1},{"amount":2}', 3), (None, 4)], "value string, offset int")
    for frame in (records.good_records(rows), records.quarantined(rows)):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 1, plan
    assert [r.offset for r in records.good_records(rows).collect()] == [1]
    assert {r.offset: r.reason for r in records.quarantined(rows).collect()} == {
        2: "unreadable json", 3: "unreadable json", 4: "unreadable json",
    }


@pytest.mark.parametrize("price", [1e13, float("nan"), float("-inf")])
def test_prices_that_do_not_fit_fail_the_job(spark, price):
    rows = spark.createDataFrame([("c", 1, price, dt.datetime(2024, 1, 1))], "category string, quantity int, unit_price double, created_at timestamp")
    with pytest.raises(Exception, match="unit price out of range"):
        daily.category_daily_stats(rows).collect()


def test_revenue_is_exact_to_the_millionth_of_a_price(spark):
    prices = [0.1] * 30 + [1 / 3] * 3 + [None, 0.0000005, 0.0000004, -1e12]
    rows = spark.createDataFrame([("c", 10**6, p, dt.datetime(2024, 1, 1)) for p in prices], "category string, quantity int, unit_price double, created_at timestamp")
    small = daily.category_daily_stats(rows.where("unit_price > -1 or unit_price is null")).first()
    assert (str(small.total_revenue), small.total_orders) == (str(Decimal(30 * 100_000 + 3 * 333_333 + 1).quantize(Decimal("0.01"))), 36)


def test_seats_go_to_the_largest_remainders():
    assert records.seats(101, {"b": 0.5, "m": 0.3, "a": 0.2}) == {"b": 51, "m": 30, "a": 20}
    assert records.seats(2, {"x": 1, "y": 1, "z": 1}) == {"x": 1, "y": 1, "z": 0}
    assert records.seats(10, {"x": 0, "y": -1}) == {} and records.seats(0, {"x": 2}) == {"x": 0}


def test_sample_by_place_gives_each_place_its_seats(spark):
    rows = spark.createDataFrame([(i, "abc"[i % 3] if i % 7 else None, float(i % 5)) for i in range(300)], "k int, place string, w double")
    got = records.weighted_sample_by_place(rows, "w", 41, "k", "place", {"a": 3, "b": 1, "none": 1, "c": 0}).collect()
    assert Counter(r.place for r in got) == {"a": 25, "b": 8} and all(r.w > 0 for r in got)
    assert len({r.k for r in got}) == 33
    few = records.weighted_sample_by_place(rows, "w", 10_000, "k", "place", {"a": 1})
    assert few.count() == rows.where("place = 'a' and w > 0").count()
