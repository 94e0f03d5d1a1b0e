"""Leaderboards and trailing sums on small hand-made or random tables."""

import datetime as dt
import random

import pytest

from streamtally.operators import leaderboard, sliding
from streamtally.schemas import record

SCORES = record(
    user_id="string", team_id="string", team_name="string", score="integer", event_time="timestamp"
)
START = dt.datetime(2024, 1, 1)


def scores(spark, rows):
    return spark.createDataFrame(rows, SCORES)


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def test_ties_of_the_total_go_by_name(spark):
    rows = [("u1", "2", "B", 5, at(0)), ("u2", "1", "A", 5, at(0)), ("u3", "3", "C", 9, at(0))]
    board = leaderboard.top_teams(scores(spark, rows)).orderBy("rnk").collect()
    assert [(r.rnk, r.team_name, r.total_score) for r in board] == [
        (1, "C", 9), (2, "A", 5), (3, "B", 5),
    ]


def test_team_with_two_names_keeps_the_greater(spark):
    rows = [("u1", "1", "A", 5, at(0)), ("u1", "1", "Z", 7, at(1)), ("u2", "1", "A", 1, at(1))]
    [row] = leaderboard.team_totals(scores(spark, rows)).collect()
    assert (row.team_name, row.total_score) == ("Z", 13)


def test_board_is_cut_at_k(spark):
    rows = [(f"u{i:02d}", "1", "A", i, at(0)) for i in range(30)]
    board = leaderboard.top_players(scores(spark, rows)).orderBy("rnk").collect()
    assert [r.user_id for r in board] == [f"u{i:02d}" for i in range(29, 19, -1)]


def test_team_without_points_has_no_ratio(spark):
    rows = [("u1", "1", "A", 0, at(0)), ("u2", "1", "A", 0, at(0)), ("u3", "2", "B", 4, at(0))]
    board = leaderboard.team_mvps(scores(spark, rows)).orderBy("rnk").collect()
    assert [(r.rnk, r.user_id, r.contrib_ratio) for r in board] == [(1, "u3", 1.0), (2, "u1", None)]


def test_mvp_tie_goes_to_the_smaller_user(spark):
    rows = [("u2", "1", "A", 5, at(0)), ("u1", "1", "A", 5, at(0))]
    [row] = leaderboard.team_mvps(scores(spark, rows)).collect()
    assert (row.user_id, row.contrib_ratio) == ("u1", 0.5)


def brute_force(rows, short, long):
    found = []
    for user, _, _, _, now in rows:
        def window(length, user=user, now=now):
            low = now - dt.timedelta(seconds=length)
            inside = [r for r in rows if r[0] == user and low <= r[4] <= now]
            known = [r[3] for r in inside if r[3] is not None]
            return (sum(known) if known else None), len(known)

        found.append((user, now, *window(short), *window(long)))
    return sorted(found, key=repr)


def random_scores(seed, users=3, n=250, span=3000):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        # The first user holds most rows; whole seconds make ties and exact edges common.
        user = "u0" if rng.random() < 0.6 else f"u{rng.randrange(users)}"
        rows.append((user, "1", "A", rng.randrange(20), at(rng.randrange(span))))
    return rows


@pytest.mark.parametrize("seed,slices", [(1, 60), (2, 600), (3, 61)])
def test_trailing_sums_equal_brute_force(spark, seed, slices):
    rows = random_scores(seed)
    frame = scores(spark, rows).repartition(5)
    sums = sliding.trailing_sums(frame, 10, 60, slices)
    expanded = sliding.repeat_rows(sums, "_rows", chunk=2).drop("_rows")
    names = ["user_id", "event_time", "short_term_sum", "short_term_count", "long_term_sum",
             "long_term_count"]
    have = sorted((tuple(r) for r in expanded.select(*names).collect()), key=repr)
    assert have == brute_force(rows, 10, 60)


@pytest.mark.parametrize("seed", [4, 5])
def test_latest_sums_are_the_last_trailing_sums(spark, seed):
    frame = scores(spark, random_scores(seed, span=500))
    newest = {}
    for row in sliding.trailing_sums(frame).collect():
        if row.user_id not in newest or row.event_time > newest[row.user_id].event_time:
            newest[row.user_id] = row
    have = {r.user_id: r for r in sliding.latest_sums(frame).collect()}
    assert have.keys() == newest.keys()
    for user, row in have.items():
        for name in ("short_term_sum", "short_term_count", "long_term_sum", "long_term_count"):
            assert row[name] == newest[user][name]


def test_frame_edges_are_inside(spark):
    rows = [("u", "1", "A", 1, at(0)), ("u", "1", "A", 2, at(10)), ("u", "1", "A", 4, at(60)),
            ("u", "1", "A", 8, at(60.001))]
    have = {
        r.event_time: (r.short_term_sum, r.long_term_sum)
        for r in sliding.sliding_sums(scores(spark, rows)).collect()
    }
    assert have == {
        at(0): (1, 1), at(10): (3, 3), at(60): (4, 7), at(60.001): (12, 14),
    }


def test_all_zero_minute_has_no_hotness(spark):
    rows = [("cold", "1", "A", 0, at(0)), ("cold", "1", "A", 0, at(5)), ("hot", "1", "A", 3, at(0)),
            ("hot", "1", "A", 9, at(30))]
    board = sliding.hot_streaks(scores(spark, rows)).orderBy("rnk").collect()
    assert [(r.user_id, r.peak_hotness) for r in board] == [("hot", 1.5), ("cold", None)]


def test_events_without_time_are_ignored(spark):
    rows = [("u", "1", "A", 5, None), ("u", "1", "A", 3, at(1))]
    frame = scores(spark, rows)
    assert [r.short_term_sum for r in sliding.sliding_sums(frame).collect()] == [3]
    assert [r.short_term_sum for r in sliding.latest_sums(frame).collect()] == [3]


def test_slices_must_hold_the_window(spark):
    with pytest.raises(ValueError):
        sliding.trailing_sums(scores(spark, []), 10, 60, 30)


def test_ranking_limits_before_it_ranks(spark):
    plan = leaderboard.top_players(scores(spark, random_scores(6)))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.index("Window") < text.index("TakeOrderedAndProject(limit=10")
    hot = sliding.latest_sums(scores(spark, random_scores(6)))
    assert "WindowGroupLimit" in hot._jdf.queryExecution().executedPlan().toString()
