"""Change capture, changelogs and the as-of enrichment."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from streamtally.operators import cdc, changelog, enrich, lifecycle, slices
from streamtally.schemas import ORDER_IMAGE, USER_IMAGE, envelope, record

START = dt.datetime(2024, 1, 1)
ORDERS = record(
    order_id="string", user_id="string", product_name="string", category="string",
    quantity="integer", unit_price="double", created_at="timestamp",
)
VERSIONS = record(
    user_id="string", first_name="string", last_name="string", email="string",
    postal_code="string", version_at="timestamp",
)


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def order(order_id, user_id, seconds):
    return (order_id, user_id, "p", "c", 1, 1.0, at(seconds))


def version(user_id, name, seconds):
    return (user_id, name, "L", "e", "z", at(seconds))


def match(spark, orders, versions, **options):
    frame = enrich.match_as_of(
        spark.createDataFrame(orders, ORDERS), spark.createDataFrame(versions, VERSIONS), **options
    )
    return {r.order_id: (r.user_first_name, r.route) for r in frame.collect()}


def test_waiting_time(spark):
    orders = [order("29", "a", 1), order("31", "b", 0), order("never", "c", 0), order("null", None, 0)]
    versions = [version("a", "A", 30), version("b", "B", 31)]
    assert match(spark, orders, versions, slice_seconds=30) == {
        "29": ("A", "enriched"), "31": (None, "missing"), "never": (None, "missing"),
        "null": (None, "missing"),
    }


def test_newest_version_before_wins_over_a_later_one(spark):
    orders = [order("x", "u", 100), order("same", "u", 200)]
    versions = [version("u", "old", 0), version("u", "new", 99), version("u", "later", 101),
                version("u", "now", 200)]
    assert match(spark, orders, versions) == {
        "x": ("new", "enriched"), "same": ("now", "enriched"),
    }


def as_of_brute_force(orders, versions, wait):
    found = {}
    for o in orders:
        mine = sorted((v for v in versions if v[0] == o[1]), key=lambda v: v[5])
        before = [v for v in mine if v[5] <= o[6]]
        after = [v for v in mine if o[6] < v[5] <= o[6] + dt.timedelta(seconds=wait)]
        chosen = before[-1] if before else after[0] if after else None
        found[o[0]] = (chosen[1], "enriched") if chosen else (None, "missing")
    return found


@pytest.mark.parametrize("width", [30, 60, 600, 100_000])
def test_as_of_equals_brute_force(spark, width):
    rng = random.Random(width)
    orders = [
        order(str(i), "u0" if i % 2 else f"u{rng.randrange(4)}", rng.randrange(4000))
        for i in range(150)
    ]
    times = rng.sample(range(500, 4000), 12)
    versions = [version(f"u{i % 3}", f"n{i}", t) for i, t in enumerate(times)]
    have = match(spark, orders, versions, slice_seconds=width)
    assert have == as_of_brute_force(orders, versions, 30)


def test_sink_shape_adds_missing_tail(spark):
    frame = enrich.sink_shape(spark.createDataFrame([order("1", "u", 0)], ORDERS))
    assert frame.columns == list(enrich.SINK_FIELDS)
    assert frame.first().user_email is None


@pytest.mark.parametrize("width", [1, 25, 10_000])
def test_previous_value_equals_lag(spark, width):
    rng = random.Random(9)
    rows = [
        (None if i % 17 == 0 else f"k{min(rng.randrange(5), 2)}", i, f"v{rng.randrange(3)}")
        for i in rng.sample(range(1000), 200)
    ]
    frame = spark.createDataFrame(rows, "k string, pos bigint, v string")
    have = slices.previous_value(frame, "k", "pos", ["pos"], "v", width)
    last, want = {}, {}
    for k, pos, v in sorted(rows, key=lambda r: r[1]):
        want[pos] = last.get(k)
        last[k] = v
    assert {r.pos: r.previous for r in have.collect()} == want


def test_versions_at_one_instant_have_an_order(spark):
    versions = [version("u", "b", 5), version("u", "a", 5)]
    orders = [order("x", "u", 9), order("early", "u", 0)]
    for given in (versions, versions[::-1]):
        assert match(spark, orders, given) == {"x": ("b", "enriched"), "early": ("a", "enriched")}


def user(name, created=1):
    return ("u", name, None, "e", None, created)


def test_unwrap_uses_old_image_of_a_delete_and_drops_empty_changes(spark):
    rows = [("c", None, user("new"), (5,), 6), ("d", user(None, None), None, None, 7),
            ("u", None, None, None, None)]
    frame = spark.createDataFrame(rows, envelope(USER_IMAGE))
    have = cdc.unwrap_users(frame, ["op"]).orderBy("op").collect()
    assert [(r.op, r.first_name, r.last_name) for r in have] == [("c", "new", ""), ("d", "", "")]
    assert have[1].created_at == dt.datetime(1970, 1, 1)
    times = cdc.event_time(frame, F.lit("2030-01-01"))
    assert [r.event_time.year for r in times.collect()] == [1970, 1970, 2030]


def test_order_defaults(spark):
    image = ("o", "u", "p", "c", None, None, None)
    frame = spark.createDataFrame([("c", None, image, None, 1)], envelope(ORDER_IMAGE))
    [row] = cdc.unwrap_orders(frame).collect()
    assert (row.quantity, row.unit_price, row.created_at) == (0, 0.0, dt.datetime(1970, 1, 1))


def test_current_state_drops_deleted_and_reborn_lives(spark):
    def change(seq, op, key):
        image = (key, f"{key}{seq}", None, None, None, None)
        return (op, image if op == "d" else None, None if op == "d" else image, None, seq)

    rows = [change(1, "c", "a"), change(2, "d", "a"), change(3, "c", "b"), change(4, "d", "b"),
            change(5, "c", "b")]
    frame = spark.createDataFrame(rows, envelope(USER_IMAGE))
    have = cdc.current_state(frame, "user_id", ["ts_ms"]).collect()
    assert [r.first_name for r in have] == ["b5"]


def test_changelog_tombstones(spark):
    rows = [("a", "1", 1), ("a", None, 2), ("b", "1", 1), ("b", "2", 3)]
    frame = spark.createDataFrame(rows, "k string, v string, o int")
    drop = changelog.materialize(frame, "k", "v", "o").collect()
    keep = changelog.materialize(frame, "k", "v", "o", keep_deleted=True).collect()
    assert {(r.k, r.v) for r in drop} == {("b", "2")}
    assert {(r.k, r.v) for r in keep} == {("a", "1"), ("b", "2")}


def test_effective_updates_skip_repeats_also_across_deletions(spark):
    rows = [("a", "1", 1), ("a", "1", 2), ("a", None, 3), ("a", "1", 4), ("a", "2", 5)]
    frame = spark.createDataFrame(rows, "k string, v string, o bigint")
    have = changelog.effective_updates(frame, "k", "v", "o").collect()
    assert [(r.v, r.o) for r in have] == [("1", 1), ("2", 5)]


def test_board_diff_deletes_when_the_board_shrinks(spark):
    old = spark.createDataFrame([(1, "a", 9), (2, "b", 5), (3, "c", 1)], "rnk int, id string, n int")
    new = spark.createDataFrame([(1, "a", 9), (2, "c", 6)], "rnk int, id string, n int")
    have = {tuple(r) for r in changelog.diff_boards(old, new).collect()}
    assert have == {("U", 2, "c", 6), ("D", 3, None, None)}


def test_lifecycle(spark):
    path = ["Processing", "Shipped", "Shipped", "Delivered", "Returned"]
    rows = [("good", s, at(i), i) for i, s in enumerate(path)]
    rows += [("bad", "Processing", at(0), 0), ("bad", "Delivered", at(1), 1),
             ("late", "Cancelled", at(0), 0), ("late", "Shipped", at(9e6), 1)]
    frame = spark.createDataFrame(rows, "order_id string, status string, changed_at timestamp, seq int")
    have = lifecycle.illegal_transitions(frame).collect()
    assert {(r.order_id, r.from_status, r.to_status) for r in have} == {
        ("bad", "Processing", "Delivered"), ("late", "Cancelled", "Shipped"),
    }
