"""Streams: restarts, repeated batches, late rows, expiry, timers."""

import datetime as dt
import random
import time
from decimal import Decimal

from pyspark.sql import functions as F

from streamtally.operators import cdc, leaderboard, sliding, supplier_stats
from streamtally.schemas import ORDER_STREAM, USER_SCORES, record
from streamtally.session import fresh_folder
from streamtally.sinks import lake
from streamtally.sources.files import stream_parquet
from streamtally.streaming import boards, enrich, expiring, run, supplier
from streamtally.streaming.keyed_log import KeyedLog

START = dt.datetime(2024, 1, 1)
SCORES = record(
    user_id="string", team_id="string", team_name="string", score="integer", event_time="timestamp"
)


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def orders(spark, rows):
    return spark.createDataFrame([(i, "x", p, s, t) for i, p, s, t in rows], ORDER_STREAM)


def test_restart_reads_each_row_once(spark):
    root = fresh_folder(spark, "restart")
    first = orders(spark, [("1", "1", "a", at(0)), ("2", "1", "a", at(1))])
    second = orders(spark, [("3", "1", "a", at(2))])

    def writer(stream):
        return (
            stream.writeStream.format("parquet")
            .option("path", f"{root}/out")
            .option("checkpointLocation", f"{root}/checkpoint")
        )

    run.replay(spark, [first, second], ORDER_STREAM, writer, f"{root}/landing")
    # Nothing new arrived: draining again adds nothing.
    run.drain(writer(stream_parquet(spark, f"{root}/landing", ORDER_STREAM)))
    have = sorted(r.order_id for r in spark.read.parquet(f"{root}/out").collect())
    assert have == ["1", "2", "3"]


def test_update_mode_refires_for_late_rows_within_the_delay_only(spark):
    root = fresh_folder(spark, "updates")
    sink = supplier.UpdateLog(f"{root}/out")
    arrivals = [
        orders(spark, [("1", "1", "a", at(1)), ("2", "5", "a", at(14))]),
        # The watermark is at 4 s: the window [0 s, 5 s) is open for the first of these rows.
        orders(spark, [("3", "bad", "a", at(2)), ("4", "5", "a", at(30))]),
        # Now it is at 20 s: too late.
        orders(spark, [("5", "7", "a", at(3))]),
    ]
    run.replay(
        spark, arrivals, ORDER_STREAM,
        lambda s: sink.writer(supplier.refired_windows(s), f"{root}/checkpoint"),
        f"{root}/landing",
    )
    latest = sink.latest(spark, ["window_start", "window_end", "supplier"])
    counts = {(r.window_start - START).seconds: r["count"] for r in latest.collect()}
    assert counts == {0: 2, 10: 1, 30: 1}
    updates = sink.updates(spark).where("window_start = '2024-01-01'").collect()
    assert sorted(r["count"] for r in updates) == [1, 2]


def test_console_writer_runs(spark):
    root = fresh_folder(spark, "console")
    orders(spark, [("only-one", "1", "a", at(1))]).write.parquet(root)
    query = run.drain(run.console_writer(stream_parquet(spark, root, ORDER_STREAM)))
    assert sum(p.numInputRows for p in query.recentProgress) == 1


def test_shared_root_is_the_named_folder_or_local(spark, monkeypatch):
    from streamtally import session

    named = spark.conf.get(session.CHECKPOINT_CONF, None)
    if named:
        assert session.shared_root(spark) == named.rstrip("/")
    monkeypatch.setattr(session, "CHECKPOINT_CONF", "spark.not.set")
    assert session.shared_root(spark) == session.shared_root(spark)


def test_closed_windows_equal_the_batch_twin(spark):
    rng = random.Random(1)
    rows = [(str(i), str(rng.randrange(100)), f"s{rng.randrange(3)}", at(rng.randrange(120)))
            for i in range(200)]
    root = fresh_folder(spark, "closed")
    orders(spark, rows).repartition(4).write.parquet(f"{root}/landing")
    stream = stream_parquet(spark, f"{root}/landing", ORDER_STREAM)
    out = run.stream_to_folder(spark, supplier.closed_windows(stream), "closed")
    end = max(r[3] for r in rows) - dt.timedelta(seconds=5)
    price = F.col("price").cast("decimal(10,2)")
    twin = supplier_stats.windowed(
        orders(spark, rows), price, F.col("supplier"), "5 seconds"
    ).where(F.col("window_end") <= F.lit(end))
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, twin.collect()))


def test_stream_appends_to_a_declared_table(spark):
    root = fresh_folder(spark, "table")
    lake.create_table(
        spark, "streamed_orders", ORDER_STREAM, ["supplier"], f"{root}/table", {"purpose": "a test"}
    )
    lake.create_table(spark, "streamed_orders", ORDER_STREAM, ["supplier"], f"{root}/table")
    try:
        orders(spark, [("1", "1", "a", at(0)), ("2", "1", "b", at(1))]).write.parquet(f"{root}/in")
        stream = stream_parquet(spark, f"{root}/in", ORDER_STREAM)
        run.drain_to_table(stream, "streamed_orders", f"{root}/checkpoint")
        assert spark.table("streamed_orders").where("supplier = 'b'").count() == 1
    finally:
        lake.drop_table(spark, "streamed_orders")
    assert not spark.catalog.tableExists("streamed_orders")


def board_of(spark, sink, batch_id):
    return [(r.rnk, r.team_id, r.total_score) for r in sink.board(spark, batch_id).orderBy("rnk").collect()]


def team(i, n):
    return (str(i), f"T{i}", n)


def send(spark, sink, rows, batch_id):
    frame = spark.createDataFrame(rows, boards.TEAM_TOTAL)
    # A repeated batch has the effect of one.
    sink(frame, batch_id)
    sink(frame, batch_id)
    return board_of(spark, sink, batch_id)


def test_board_changes_and_repeated_batches(spark):
    sink = boards.top_teams_board(fresh_folder(spark, "board"), k=2)
    assert send(spark, sink, [team(1, 5), team(2, 9), team(3, 1)], 0) == [(1, "2", 9), (2, "1", 5)]
    assert send(spark, sink, [team(1, 15)], 1) == [(1, "1", 15), (2, "2", 9)]
    assert send(spark, sink, [team(3, 2)], 2) == [(1, "1", 15), (2, "2", 9)]
    changes = {}
    for row in sink.changes(spark).collect():
        assert not row.recomputed
        changes.setdefault(row.batch, set()).add((row.op, row.rnk, row.team_name))
    assert changes == {0: {("U", 1, "T2"), ("U", 2, "T1")}, 1: {("U", 1, "T1"), ("U", 2, "T2")}}
    assert [(r.rnk, r.team_name) for r in sink.current(spark).orderBy("rnk").collect()] == [(1, "T1"), (2, "T2")]


def test_board_looks_at_all_keys_only_where_its_last_row_falls(spark):
    rng = random.Random(8)
    sink = boards.RunningBoard(
        fresh_folder(spark, "falls"), boards.TEAM_TOTAL, ["team_id"], leaderboard.rank_order_teams(), 3,
        live=F.col("total_score") > 0, fold=3,
    )
    state, recomputed = {}, []
    for batch_id in range(9):
        old = sorted(state.items(), key=lambda x: (-x[1], f"T{x[0]}"))
        changed = {rng.randrange(8): rng.randrange(30) if batch_id % 2 else 20 + batch_id for _ in range(3)}
        if batch_id == 7:
            changed = {i: 0 for i in range(7)}
        state |= changed
        want = sorted(((n, i) for i, n in state.items() if n > 0), key=lambda x: (-x[0], f"T{x[1]}"))[:3]
        got = send(spark, sink, [team(i, n) for i, n in changed.items()], batch_id)
        assert got == [(r + 1, str(i), n) for r, (n, i) in enumerate(want)], (batch_id, old)
    for row in sink.changes(spark).select("batch", "recomputed", "op").distinct().collect():
        recomputed.append((row.batch, row.recomputed, row.op))
    assert any(r for _, r, _ in recomputed) and any(not r for _, r, _ in recomputed)
    assert any(op == "D" for _, _, op in recomputed)
    rebuilt = [(r.rnk, r.team_id) for r in sink.current(spark).orderBy("rnk").collect()]
    assert rebuilt == [(r, t) for r, t, _ in board_of(spark, sink, 8)]


def test_keyed_log_folds_and_keeps_the_newest(spark):
    schema = record(k="string", v="long")
    log = KeyedLog(fresh_folder(spark, "log"), schema, ["k"], fold=2)
    want = {}
    for batch_id in range(6):
        rows = {f"k{batch_id % 4}": batch_id, "all": batch_id * 10}
        want |= rows
        for _ in range(2):
            log.append(spark.createDataFrame(list(rows.items()), schema), batch_id)
        assert {r.k: r.v for r in log.read(spark, batch_id).collect()} == want
    only = spark.createDataFrame([("k1",), ("none",)], "k string")
    assert {r.k: r.v for r in log.read(spark, 5, only).collect()} == {"k1": 5}
    assert {r.k: r.v for r in log.read(spark, 1).collect()} == {"k0": 0, "k1": 1, "all": 10}


def test_a_teams_total_moves_players_without_new_scores(spark):
    sink = boards.TeamMvps(fresh_folder(spark, "mvps"), fold=2)
    arrivals = [
        [("u1", "1", "A", 60, at(0)), ("u2", "1", "A", 40, at(0)), ("u3", "2", "B", 9, at(0)), ("u4", "2", "B", 1, at(0))],
        # Team A's other player scores: u1's share falls, and u2 takes over without passing by u3.
        [("u2", "1", "A", 30, at(1))],
        [("u5", "3", "C", 5, at(2)), ("u4", "2", "B", 20, at(2))],
    ]
    seen = []
    for batch_id, rows in enumerate(arrivals):
        seen += rows
        parts = boards.running_parts(spark.createDataFrame(seen, SCORES))
        changed = parts.join(spark.createDataFrame([r[:3] for r in rows], "user_id string, team_id string, team_name string"),
                             ["user_id", "team_id", "team_name"], "left_semi")
        sink(changed, batch_id)
        sink(changed, batch_id)
        want = leaderboard.team_mvps(spark.createDataFrame(seen, SCORES))
        board = sink.board.board(spark, batch_id).select(*want.columns)
        assert sorted(map(tuple, board.collect())) == sorted(map(tuple, want.collect()))
    one = {r.team_name: r.contrib_ratio for r in sink.board.board(spark, 0).collect()}
    two = {r.team_name: r.contrib_ratio for r in sink.board.board(spark, 1).collect()}
    assert one["A"] == 0.6 and two["A"] == 70 / 130 and one["B"] == two["B"] == 0.9


def test_totals_follow_updates_and_deletes(spark):
    image = "struct<g:string,a:decimal(10,2)>"
    rows = [(None, ("x", 5)), (None, ("x", 7)), (("x", 5), ("y", 6)), (("x", 7), None), (None, ("z", None)), (None, None)]
    frame = spark.createDataFrame(
        [tuple(None if i is None else (i[0], None if i[1] is None else Decimal(i[1])) for i in r) for r in rows],
        f"before {image}, after {image}",
    )
    got = {r.g: (r.total, r.n) for r in cdc.running_totals(frame, ["g"], "a").collect()}
    assert got == {"x": (Decimal(0), 0), "y": (Decimal(6), 1), "z": (None, 1)}


def score(user, value, seconds):
    return (user, "1", "A", value, at(seconds))


def test_hot_streaks_over_batches_equal_the_batch_operator(spark):
    rng = random.Random(3)
    # Out of order by less than the delay of 5 s.
    rows = sorted(
        (score(f"u{rng.randrange(3)}", rng.randrange(20), rng.randrange(900) / 2) for _ in range(300)),
        key=lambda r: r[4] + dt.timedelta(seconds=rng.random() * 4),
    )
    sink = boards.HotStreaks(fresh_folder(spark, "hot"), idle_seconds=None)
    for batch_id in range(4):
        batch = spark.createDataFrame(rows[batch_id * 75 : batch_id * 75 + 75], SCORES)
        sink(batch, batch_id)
        sink(batch, batch_id)
    end = max(r[4] for r in rows) - dt.timedelta(seconds=5)
    complete = spark.createDataFrame([r for r in rows if r[4] <= end], SCORES)
    want = sliding.hot_streaks(complete)
    assert sorted(map(tuple, sink.current(spark).collect())) == sorted(map(tuple, want.collect()))


def test_hot_streaks_drop_late_rows_and_forget_idle_users(spark):
    sink = boards.HotStreaks(fresh_folder(spark, "hot"), idle_seconds=100)
    sink(spark.createDataFrame([score("a", 5, 0), score("a", 5, 20)], SCORES), 0)
    sink(spark.createDataFrame([score("a", 100, 10), score("b", 1, 60)], SCORES), 1)
    users = {r.user_id: r.long_term_avg for r in sink.users.read(spark, 1).collect()}
    assert users == {"a": 5.0}
    sink(spark.createDataFrame([score("c", 1, 300)], SCORES), 2)
    assert {r.user_id for r in sink.users.read(spark, 2).collect()} == set()


def test_totals_expire(spark):
    now = [0.0]
    sink = expiring.ExpiringTotals(fresh_folder(spark, "ttl"), ttl_seconds=60, clock=lambda: now[0])

    def send(batch_id, *teams):
        rows = [("u", t, f"T{t}", 1, at(0)) for t in teams]
        sink(spark.createDataFrame(rows, SCORES), batch_id)
        return {r.team_id: r.total_score for r in sink.current(spark).collect()}

    assert send(0, "1", "2") == {"1": 1, "2": 1}
    now[0] = 50
    assert send(1, "1") == {"1": 2, "2": 1}
    assert send(1, "1") == {"1": 2, "2": 1}
    now[0] = 100
    assert send(2, "1") == {"1": 3}
    now[0] = 101
    assert send(3, "2") == {"1": 3, "2": 1}


ARRIVAL = record(
    kind="string", order_id="string", user_id="string", name="string", happened_at="timestamp",
    arrived_at="timestamp",
)


def met(stream, **options):
    order_rows = stream.where("kind = 'order'").select(
        "order_id", "user_id", F.lit("p").alias("product_name"), F.lit("c").alias("category"),
        F.lit(1).alias("quantity"), F.lit(2.0).alias("unit_price"),
        F.col("happened_at").alias("created_at"), "arrived_at",
    )
    user_rows = stream.where("kind = 'user'").select(
        "user_id", F.col("name").alias("first_name"), F.lit("L").alias("last_name"),
        F.lit(None).cast("string").alias("email"), F.lit("z").alias("postal_code"),
        F.col("happened_at").alias("version_at"), "arrived_at",
    )
    return enrich.meet_users(order_rows, user_rows, **options)


def arrive(spark, root, phases, **options):
    """Lets (seconds, rows) arrive one after another and returns what was routed."""
    sink = enrich.Enrichment(root, run.BatchFolders(f"{root}/out"), fold=2)
    frames = [spark.createDataFrame([(*row, at(seconds)) for row in rows], ARRIVAL) for seconds, rows in phases]
    run.replay(
        spark, frames, ARRIVAL,
        lambda s: sink.writer(met(s, arrival="arrived_at", **options), f"{root}/checkpoint"), f"{root}/landing",
    )
    out = spark.read.schema(enrich.ROUTED).parquet(f"{root}/out")
    return [(r.order_id, r.user_first_name, r.route) for r in out.collect()]


def test_enrichment_waits_then_gives_up(spark):
    phases = [
        (0, [("order", "early", "u", None, at(0)), ("order", "lost", "v", None, at(1)),
             ("user", None, "w", "W1", at(1)), ("user", None, "w", "W2", at(2)),
             ("order", "known", "w", None, at(0)), ("order", "nobody", None, None, at(0)),
             ("user", None, None, "nobody", at(0))]),
        # Late by its own time, and without any time: both are like other rows.
        (20, [("user", None, "u", "U1", at(-9999)), ("order", "again", "w", None, at(-5000)),
              ("order", "timeless", "w", None, None), ("user", None, "w", "W0", None)]),
        (40, [("order", "tick", "w", None, at(40)), ("user", None, "w", "W3", at(41))]),
        (50, [("user", None, "v", "V1", at(50)), ("order", "found", "v", None, at(51))]),
        (200, [("user", None, "x", "X1", at(3))]),
    ]
    have = arrive(spark, fresh_folder(spark, "enrich"), phases, wait_seconds=30)
    assert sorted(have) == sorted([
        ("early", "U1", "enriched"), ("known", "W2", "enriched"), ("again", "W2", "enriched"),
        ("timeless", "W2", "enriched"), ("tick", "W3", "enriched"), ("lost", None, "missing"),
        ("found", "V1", "enriched"), ("nobody", None, "missing"),
    ])


def test_each_order_comes_out_once(spark):
    """Random arrivals against the rule, one row after another."""
    rng = random.Random(11)
    seconds = [0, 30, 31, 300]
    phases = []
    for s in seconds:
        orders_ = [] if s == 300 else [("order", f"o{s}-{i}", f"u{rng.randrange(6)}", None, None if i % 5 == 0 else at(rng.randrange(400))) for i in range(12)]
        users = [("user", None, f"u{u}", f"n{s}-{u}-{i}", None if rng.random() < 0.2 else at(rng.randrange(400))) for u in range(6) for i in range(2) if rng.random() < 0.25]
        phases.append((s, orders_ + users + [("user", None, "x", "x", at(0))]))
    want = []
    for s, rows in phases:
        for _, order_id, user, _, _ in (r for r in rows if r[0] == "order"):
            arrivals = sorted(t for t, other in phases for r in other if r[0] == "user" and r[2] == user)
            first = arrivals[0] if arrivals else 10**9
            leaves = s if first <= s else first if first <= s + 30 else None
            versions = [(r[4] or dt.datetime.min, r[3]) for t, other in phases for r in other
                        if leaves is not None and t <= leaves and r[0] == "user" and r[2] == user]
            want.append((order_id, max(versions)[1] if versions else None, "enriched" if versions else "missing"))
    assert sorted(arrive(spark, fresh_folder(spark, "once"), phases, salts=3)) == sorted(want)
    assert {r for _, _, r in want} == {"enriched", "missing"}


def test_a_hot_users_orders_are_spread(spark):
    assert enrich.default_salts(spark) == 2
    rows = [("order", str(i), "u", None, at(i)) for i in range(40)] + [("user", None, "u", "U", at(3))]
    have = arrive(spark, fresh_folder(spark, "hot"), [(0, rows), (100, [("user", None, "u", "V", at(2))])], salts=4)
    assert sorted(have) == sorted((str(i), "U", "enriched") for i in range(40))
    plan = met(stream_parquet(spark, fresh_folder(spark, "none") + "/*", ARRIVAL), salts=4, arrival="arrived_at")
    text = plan._jdf.queryExecution().analyzed().toString()
    assert "LeftOuter" in text and "Python" not in text


def test_waiting_ends_without_input_where_the_clock_ticks(spark):
    """Runs against the clock, so it only waits a second."""
    root = fresh_folder(spark, "clock")
    spark.createDataFrame([("order", "lost", "v", None, at(1), at(1))], ARRIVAL).write.parquet(f"{root}/landing")
    sink = enrich.Enrichment(root, enrich.FanOut(f"{root}/out"))
    stream = stream_parquet(spark, f"{root}/landing", ARRIVAL)
    rows = met(stream, wait_seconds=1, ticks=enrich.clock_ticks(spark))
    query = sink.writer(rows, f"{root}/checkpoint").start()
    try:
        deadline = time.time() + 90
        letters = []
        while not letters and time.time() < deadline and query.isActive:
            time.sleep(1)
            try:
                letters = spark.read.text(f"{root}/out/missing").collect()
            except Exception:  # noqa: BLE001 - the first batch is not written yet
                letters = []
    finally:
        query.stop()
    assert [r.value for r in letters] == [
        '{"order_id":"lost","user_id":"v","product_name":"p","category":"c","quantity":1,'
        '"unit_price":2.0,"created_at":"2024-01-01T00:00:01Z"}'
    ]


def test_user_scores_schema_matches_the_adapter(spark):
    from streamtally.sources import tables

    frame = tables.user_scores(spark, "/root/testdata/sf0.001")
    assert [(f.name, f.dataType) for f in frame.schema] == [
        (f.name, f.dataType) for f in USER_SCORES
    ]
