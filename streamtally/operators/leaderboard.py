"""Top-k leaderboards over score events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import guarded_ratio

TOP = 10


def _totals(scores: DataFrame, key: str) -> DataFrame:
    """Sum of scores per key, with the greatest team name seen for it.

    Grouping by the name first keeps the big aggregation a hash aggregation (a string maximum would
    make Spark sort its whole input); the maximum then runs over one row per key and name.
    """
    return (
        scores.groupBy(key, "team_name")
        .agg(F.sum("score").alias("_part"))
        .groupBy(key)
        .agg(F.max("team_name").alias("team_name"), F.sum("_part").alias("total_score"))
    )


def team_totals(scores: DataFrame) -> DataFrame:
    return _totals(scores, "team_id")


def player_totals(scores: DataFrame) -> DataFrame:
    return _totals(scores, "user_id")


def top_k(rows: DataFrame, order: Sequence[Column], k: int = TOP) -> DataFrame:
    """The first ``k`` rows by ``order``, numbered from 1 in column ``rnk``.

    The limit comes first, so every task keeps k rows and the ranking sees k rows in all.
    """
    first = rows.orderBy(*order).limit(k)
    return first.select(
        F.row_number().over(Window.orderBy(*order)).cast("bigint").alias("rnk"), *rows.columns
    )


def top_teams(scores: DataFrame, k: int = TOP) -> DataFrame:
    return top_k(team_totals(scores), rank_order_teams(), k)


def rank_order_teams() -> list[Column]:
    return [F.desc_nulls_last("total_score"), F.asc_nulls_last("team_name"), F.asc("team_id")]


def rank_order_players() -> list[Column]:
    return [F.desc_nulls_last("total_score"), F.asc_nulls_last("user_id")]


def top_players(scores: DataFrame, k: int = TOP) -> DataFrame:
    return top_k(player_totals(scores), rank_order_players(), k)


def contributions(scores: DataFrame) -> DataFrame:
    """Each player's share of the team total.

    Both grains come from one pass: (player, team, name) totals are shared, and sums of sums give
    the two coarser ones.
    """
    base = scores.groupBy("user_id", "team_id", "team_name").agg(F.sum("score").alias("_part"))
    players = base.groupBy("user_id", "team_id").agg(F.sum("_part").alias("player_total"))
    teams = base.groupBy("team_id", "team_name").agg(F.sum("_part").alias("team_total"))
    return players.join(teams, "team_id").select(
        "user_id",
        "team_name",
        "player_total",
        "team_total",
        guarded_ratio(F.col("player_total"), F.col("team_total")).alias("contrib_ratio"),
    )


def rank_order_mvps() -> list[Column]:
    return [F.desc_nulls_last("contrib_ratio"), F.asc_nulls_last("user_id"), F.asc_nulls_last("team_name")]


def team_best(shares: DataFrame) -> DataFrame:
    """The best contributor of each team. The per-team pick is a filtered row number, which Spark
    limits to one row per team before the shuffle."""
    order = [F.desc_nulls_last("contrib_ratio"), F.asc_nulls_last("user_id")]
    return (
        shares.withColumn("_place", F.row_number().over(Window.partitionBy("team_name").orderBy(*order)))
        .where("_place = 1")
        .drop("_place")
    )


def team_mvps(scores: DataFrame, k: int = TOP) -> DataFrame:
    """The best contributor of each team; of those, the first ``k``. A tie of the final ranking goes
    to the smaller user id."""
    return top_k(team_best(contributions(scores)), rank_order_mvps(), k)


def as_dashboard(board: DataFrame, ratio: str) -> DataFrame:
    """A stored board as the dashboard shows it: by rank, the ratio in percent."""
    return board.withColumn(ratio, F.col(ratio) * 100).orderBy("rnk")
