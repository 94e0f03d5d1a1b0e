"""Always-current leaderboards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from ..operators.changelog import diff_boards, materialize
from ..operators.leaderboard import (
    TOP,
    contributions,
    rank_order_mvps,
    rank_order_players,
    rank_order_teams,
    team_best,
    top_k,
)
from ..operators.sliding import (
    LONG,
    SECOND,
    SHORT,
    latest_per_key,
    rank_hot_users,
    trailing_sums,
    with_hotness,
)
from ..schemas import record
from .keyed_log import KeyedLog
from .versions import VersionedTable

TEAM_TOTAL = record(team_id="string", team_name="string", total_score="long")
PLAYER_TOTAL = record(user_id="string", team_name="string", total_score="long")
PART = record(user_id="string", team_id="string", team_name="string", part="long")
LINE_TOTAL = record(supplier="string", total="decimal(22,2)", n="long")
MVP = record(
    user_id="string", team_name="string", player_total="long", team_total="long", contrib_ratio="double"
)


def running_team_totals(scores: DataFrame) -> DataFrame:
    """Totals over the whole stream. The sum is combined map-side first."""
    return scores.groupBy("team_id").agg(
        F.max("team_name").alias("team_name"), F.sum("score").alias("total_score")
    )


def running_player_totals(scores: DataFrame) -> DataFrame:
    return scores.groupBy("user_id").agg(
        F.max("team_name").alias("team_name"), F.sum("score").alias("total_score")
    )


class RunningBoard:
    """``foreachBatch`` sink for rows in update mode: the first ``k``, from the changed rows and the
    stored board alone.

    A key that did not change and is not on the board ranks behind the board's last row. So the first
    k of (stored board, with the changed rows in place of their old selves) are the first k of all, as
    long as the new last row does not rank behind the old one. Where it does (values may fall, rows of
    ``live`` false leave), the board is taken from the log of all keys' newest rows, once for such a
    batch. Stored by batch: the board, and its changes against the last board, among them deletions
    of ranks that are no longer filled. A repeated batch overwrites its own.
    """

    def __init__(
        self,
        path: str,
        schema: T.StructType,
        keys: Sequence[str],
        order: Sequence[Column],
        k: int = TOP,
        live: Column | None = None,
        fold: int = 64,
    ) -> None:
        self.path, self.schema, self.keys, self.order, self.k = path, schema, list(keys), list(order), k
        self.live = F.lit(True) if live is None else live
        self.rows = KeyedLog(f"{path}/rows", schema, keys, fold=fold)
        self.board_schema = T.StructType([T.StructField("rnk", T.LongType()), *schema.fields])

    def board(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The board after a batch; empty before the first."""
        if batch_id < 0:
            return spark.createDataFrame([], self.board_schema)
        return spark.read.schema(self.board_schema).parquet(f"{self.path}/board/batch={batch_id}")

    def __call__(self, changed: DataFrame, batch_id: int) -> None:
        spark = changed.sparkSession
        rows = self.rows.append(changed, batch_id)
        old = self.board(spark, batch_id - 1)
        unchanged = old.join(rows.select(*self.keys), self.keys, "left_anti").select(*self.schema.names)
        self._store(self._first(unchanged.unionByName(rows)), batch_id)
        recomputed = self._fell_behind(old, self.board(spark, batch_id))
        if recomputed:
            self._store(self._first(self.rows.read(spark, batch_id)), batch_id)
        changes = diff_boards(old, self.board(spark, batch_id)).withColumn("recomputed", F.lit(recomputed))
        changes.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/changes/batch={batch_id}")

    def _first(self, rows: DataFrame) -> DataFrame:
        return top_k(rows.where(self.live), self.order, self.k)

    def _store(self, board: DataFrame, batch_id: int) -> None:
        board.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/board/batch={batch_id}")

    def _fell_behind(self, old: DataFrame, new: DataFrame) -> bool:
        """Whether fewer than k rows of the new board rank with or before the old board's last one. A
        board that was not full held every key, so nothing can be missing from the new one."""
        last = old.where(F.col("rnk") == self.k).withColumn("_old", F.lit(True))
        both = new.withColumn("_old", F.lit(False)).unionByName(last)
        places = both.select(
            "_old", F.row_number().over(Window.orderBy(*self.order, "_old")).alias("_place")
        )
        return not places.where(F.col("_old") & (F.col("_place") <= self.k)).isEmpty()

    def writer(self, rows: DataFrame, checkpoint: str) -> DataStreamWriter:
        return (
            rows.writeStream.outputMode("update")
            .option("checkpointLocation", checkpoint)
            .foreachBatch(self)
        )

    def changes(self, spark: SparkSession) -> DataFrame:
        """Every change of the board, with its ``batch``: ``U`` sets a rank, ``D`` empties it."""
        return spark.read.parquet(f"{self.path}/changes")

    def current(self, spark: SparkSession) -> DataFrame:
        """The board as a reader of the changelog rebuilds it."""
        value = F.when(F.col("op") == "U", F.struct(*self.schema.names))
        log = self.changes(spark).withColumn("value", value)
        return materialize(log, "rnk", "value", "batch").select("rnk", "value.*")


def top_teams_board(path: str, k: int = TOP) -> RunningBoard:
    return RunningBoard(path, TEAM_TOTAL, ["team_id"], rank_order_teams(), k)


def top_players_board(path: str, k: int = TOP) -> RunningBoard:
    return RunningBoard(path, PLAYER_TOTAL, ["user_id"], rank_order_players(), k)


def line_totals_board(path: str, k: int = TOP) -> RunningBoard:
    """The suppliers with the highest totals of current lines; those without any line leave."""
    order = [F.desc_nulls_last("total"), F.asc_nulls_last("supplier")]
    return RunningBoard(path, LINE_TOTAL, ["supplier"], order, k, live=F.col("n") > 0)


def running_parts(scores: DataFrame) -> DataFrame:
    """The finest totals, of which both a player's and a team's are sums."""
    return scores.groupBy("user_id", "team_id", "team_name").agg(F.sum("score").alias("part"))


class TeamMvps:
    """``foreachBatch`` sink of :func:`running_parts` in update mode: the best contributors of all teams.

    A team's total is in the ratio of each of its players, so the changed teams say what is computed
    anew: the parts of their players are read from the log, joined with the sums of the teams, and the
    best of each team replaces the one before. Teams without new scores are not looked at.
    """

    def __init__(self, path: str, k: int = TOP, fold: int = 64) -> None:
        self.parts = KeyedLog(f"{path}/parts", PART, ["user_id", "team_id", "team_name"], fold=fold)
        self.board = RunningBoard(f"{path}/board", MVP, ["team_name"], rank_order_mvps(), k, fold=fold)

    def __call__(self, changed: DataFrame, batch_id: int) -> None:
        spark = changed.sparkSession
        teams = self.parts.append(changed, batch_id).select("team_id").distinct()
        # A player's total counts what the player scored under any name of the team.
        parts = self.parts.read(spark, batch_id, teams).withColumnRenamed("part", "score")
        self.board(team_best(contributions(parts)), batch_id)

    def writer(self, parts: DataFrame, checkpoint: str) -> DataStreamWriter:
        return (
            parts.writeStream.outputMode("update")
            .option("checkpointLocation", checkpoint)
            .foreachBatch(self)
        )


POOL = record(
    user_id="string",
    event_time="timestamp",
    score="integer",
)
HOT_USER = record(
    user_id="string",
    event_time="timestamp",
    short_term_avg="double",
    long_term_avg="double",
    current_hotness_ratio="double",
)
MARK = record(
    watermark="timestamp",
)


BEGINNING = -62_135_596_800 * SECOND


def _time(micros: int) -> Column:
    return F.timestamp_micros(F.lit(micros))


class HotStreaks:
    """``foreachBatch`` sink: trailing sums at every event, current hotness per user, top-k.

    Streams have no RANGE frames, so each batch runs the batch operator over its own rows and the
    carried ones. Carried are the rows of the last ``long`` seconds before the watermark (history)
    and those after it (not yet complete): a time slice, not the table. Rows at or before the
    previous watermark are late and dropped. Users idle for ``idle_seconds`` of event time are
    forgotten, which bounds the state by the active users (None keeps all).
    """

    def __init__(
        self,
        path: str,
        k: int = TOP,
        delay_seconds: int = 5,
        short: int = SHORT,
        long: int = LONG,
        idle_seconds: int | None = 300,
    ) -> None:
        self.k, self.delay, self.short, self.long = k, delay_seconds, short, long
        self.idle = idle_seconds
        self.pool = VersionedTable(f"{path}/pool", POOL)
        self.users = VersionedTable(f"{path}/users", HOT_USER)
        self.mark = VersionedTable(f"{path}/mark", MARK)
        self.path = path

    def __call__(self, scores: DataFrame, batch_id: int) -> None:
        spark = scores.sparkSession
        fresh = scores.select(*POOL.names).where(F.col("event_time").isNotNull()).persist()
        try:
            before = self._watermark(spark, batch_id - 1)
            newest = fresh.agg(F.max(F.unix_micros("event_time"))).first()[0]
            after = before if newest is None else max(before, newest - self.delay * SECOND)
            mark = F.timestamp_micros(F.lit(after)).alias("watermark")
            self.mark.write(spark.range(1).select(mark), batch_id)
            self._step(spark, fresh, _time(before), _time(after), batch_id)
        finally:
            fresh.unpersist()

    def _watermark(self, spark: SparkSession, version: int) -> int:
        """Stored watermark in epoch microseconds; before all times for the first batch."""
        if version < 0:
            return BEGINNING
        return self.mark.read(spark, version).select(F.unix_micros("watermark")).first()[0]

    def _step(
        self, spark: SparkSession, fresh: DataFrame, before: Column, after: Column, batch_id: int
    ) -> None:
        carried = self.pool.read(spark, batch_id - 1)
        rows = carried.unionByName(fresh.where(F.col("event_time") > before))
        history = F.expr(f"INTERVAL {self.long} SECONDS")
        self.pool.write(rows.where(F.col("event_time") >= after - history), batch_id)
        complete = rows.where(F.col("event_time") <= after)
        ready = with_hotness(
            trailing_sums(complete, self.short, self.long).drop("_rows")
        ).where(F.col("event_time") > before)
        users = latest_per_key(
            self.users.read(spark, batch_id - 1).unionByName(ready.select(*HOT_USER.names)),
            ["user_id"],
            ["event_time"],
        )
        if self.idle is not None:
            users = users.where(
                F.col("event_time") > after - F.expr(f"INTERVAL {self.idle} SECONDS")
            )
        current = self.users.write(users, batch_id)
        rank_hot_users(current, self.k).write.mode("overwrite").parquet(
            f"{self.path}/boards/batch={batch_id}"
        )

    def writer(self, scores: DataFrame, checkpoint: str) -> DataStreamWriter:
        return scores.writeStream.option("checkpointLocation", checkpoint).foreachBatch(self)

    def current(self, spark: SparkSession) -> DataFrame:
        """The board of the last batch."""
        boards = spark.read.parquet(f"{self.path}/boards")
        last = boards.agg(F.max("batch")).first()[0]
        return boards.where(F.col("batch") == last).drop("batch")
