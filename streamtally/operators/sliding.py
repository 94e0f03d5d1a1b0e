"""Trailing sums over event time and the hot-streak board."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import guarded_ratio
from .leaderboard import TOP, top_k
from .slices import SLICE, repeat_rows, slice_start

SHORT, LONG = 10, 60
SECOND = 1_000_000


def score_points(scores: DataFrame) -> DataFrame:
    """One row per user and instant. RANGE frames give peers equal results, so this loses nothing."""
    return scores.groupBy("user_id", "event_time").agg(
        F.sum("score").cast("bigint").alias("_sum"),
        F.count("score").alias("_count"),
        F.count(F.lit(1)).alias("_rows"),
    )


def _marks(short: int, long: int) -> Column:
    """What a point does to the running totals: it enters both at once and leaves each later."""

    def mark(after: int, leaves: int, short_sign: int, long_sign: int) -> Column:
        return F.struct(
            (F.col("_at") + after * SECOND).alias("at"),
            F.lit(leaves).alias("leaves"),
            (F.col("_sum") * short_sign).alias("ss"),
            (F.col("_count") * short_sign).alias("sc"),
            (F.col("_sum") * long_sign).alias("ls"),
            (F.col("_count") * long_sign).alias("lc"),
        )

    return F.array(mark(0, 0, 1, 1), mark(short, 1, -1, 0), mark(long, 1, 0, -1))


def trailing_sums(
    scores: DataFrame, short: int = SHORT, long: int = LONG, slice_seconds: int = 600
) -> DataFrame:
    """Sum and count of a user's scores over the last ``short`` and ``long`` seconds, both ends in.

    One row per user and instant (``_rows`` says how many events it stands for). Equal to
    ``RANGE BETWEEN INTERVAL n SECOND PRECEDING AND CURRENT ROW``, but

    * a user's time axis is cut into slices, each of which also gets the points of the ``long``
      seconds before it, so a hot user spreads over many tasks;
    * sums are running totals of arrivals minus departures: one step per point, where a sliding
      frame re-adds its whole content for every row.
    """
    if not 0 < short <= long <= slice_seconds:
        raise ValueError("need 0 < short <= long <= slice_seconds")
    width = slice_seconds * SECOND
    points = (
        score_points(scores)
        .where(F.col("event_time").isNotNull())
        .withColumn("_at", F.unix_micros("event_time"))
        .withColumn("_own", slice_start(F.col("_at"), width))
    )
    copies = points.withColumn(
        SLICE,
        F.explode(
            F.array_distinct(
                F.array(F.col("_own"), slice_start(F.col("_at") + long * SECOND, width))
            )
        ),
    )
    marks = copies.select("*", F.explode(_marks(short, long)).alias("m")).where(
        F.col("m.at") < F.col(SLICE) + width
    )
    running = (
        Window.partitionBy("user_id", SLICE)
        .orderBy("m.at", "m.leaves")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        marks.select(
            "user_id",
            "event_time",
            "_rows",
            "m.leaves",
            (F.col("_own") == F.col(SLICE)).alias("_home"),
            F.sum("m.ss").over(running).alias("short_term_sum"),
            F.sum("m.sc").over(running).alias("short_term_count"),
            F.sum("m.ls").over(running).alias("long_term_sum"),
            F.sum("m.lc").over(running).alias("long_term_count"),
        )
        .where("leaves = 0 AND _home")
        .drop("leaves", "_home")
    )


def sliding_sums(scores: DataFrame, short: int = SHORT, long: int = LONG) -> DataFrame:
    """The trailing sums, one row per event."""
    return repeat_rows(trailing_sums(scores, short, long), "_rows").drop("_rows")


def with_hotness(sums: DataFrame) -> DataFrame:
    short = guarded_ratio(F.col("short_term_sum"), F.col("short_term_count"))
    long = guarded_ratio(F.col("long_term_sum"), F.col("long_term_count"))
    others = [
        c
        for c in sums.columns
        if c not in ("short_term_sum", "short_term_count", "long_term_sum", "long_term_count")
    ]
    return sums.select(
        *others,
        short.alias("short_term_avg"),
        long.alias("long_term_avg"),
        (short / F.nullif(long, F.lit(0.0))).alias("current_hotness_ratio"),
    )


def hotness(scores: DataFrame, short: int = SHORT, long: int = LONG) -> DataFrame:
    """Hotness ratio at every event."""
    return with_hotness(sliding_sums(scores, short, long))


def latest_sums(scores: DataFrame, short: int = SHORT, long: int = LONG) -> DataFrame:
    """The trailing sums at each user's latest event only.

    A user's latest ``long`` seconds lie in its last two slices of that width. Spark applies that
    rank limit in the map tasks, so only those rows are shuffled, once, and the rest of the work
    stays in place.
    """
    width = long * SECOND
    newest_first = Window.partitionBy("user_id").orderBy(F.desc(SLICE))
    recent = (
        scores.where(F.col("event_time").isNotNull())
        .select(
            "user_id",
            "event_time",
            "score",
            slice_start(F.unix_micros("event_time"), width).alias(SLICE),
        )
        .withColumn("_place", F.dense_rank().over(newest_first))
        .where("_place <= 2")
        .withColumn("_latest", F.max("event_time").over(Window.partitionBy("user_id")))
        .where(F.col("event_time") >= F.col("_latest") - F.expr(f"INTERVAL {long} SECONDS"))
    )
    inside_short = F.col("event_time") >= F.col("_latest") - F.expr(f"INTERVAL {short} SECONDS")
    short_score = F.when(inside_short, F.col("score"))
    return recent.groupBy("user_id", F.col("_latest").alias("event_time")).agg(
        F.sum(short_score).alias("short_term_sum"),
        F.count(short_score).alias("short_term_count"),
        F.sum("score").alias("long_term_sum"),
        F.count("score").alias("long_term_count"),
    )


def hot_streaks(
    scores: DataFrame, k: int = TOP, short: int = SHORT, long: int = LONG
) -> DataFrame:
    """The ``k`` users whose latest short-term average most exceeds their long-term one."""
    return rank_hot_users(with_hotness(latest_sums(scores, short, long)), k)


def rank_hot_users(current: DataFrame, k: int = TOP) -> DataFrame:
    rows = current.select(
        "user_id",
        "short_term_avg",
        "long_term_avg",
        F.col("current_hotness_ratio").alias("peak_hotness"),
    )
    return top_k(rows, [F.desc_nulls_last("peak_hotness"), F.asc_nulls_last("user_id")], k)


def latest_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The latest row per key, combined map-side; no key is sorted or held as a whole."""
    rest = [c for c in rows.columns if c not in keys]
    return (
        rows.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
        .select(*keys, "_row.*")
        .select(*rows.columns)
    )
