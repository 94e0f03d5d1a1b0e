"""Streaming queries: replay tables as streams, drain them and return what the sink holds."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import cdc
from ..operators.records import project_orders, time_or_fallback
from ..operators.supplier_stats import with_text_bounds
from ..schemas import EVENTS, record
from ..session import fresh_folder
from ..sources import tables
from ..sources.files import stream_parquet, stream_table
from ..streaming import boards, enrich, expiring, late, run, supplier
from .batch import HOT_STREAKS, RUNNING_TOTALS, SLIDING, TEAM_MVPS, TEAM_TOTALS, TOP_PLAYERS, TOP_TEAMS
from .landed import ORDER_JSON, SQL_TIME, TSV_TAIL
from .oracle_tables import BIDS, DIRTY_BIDS, LINES, PURCHASES, USER_SCORES, VERSIONS, query
from .registry import Registry

REGISTRY = Registry()
add = REGISTRY.add

HOUR = "1 hour"


def _events(spark, folder):
    return stream_table(spark, folder, "events", EVENTS)


@add(query(BIDS, "SELECT * FROM bids"))
def stream_scan_orders(spark, folder):
    return run.stream_to_folder(spark, tables.as_bids(_events(spark, folder)), "scan")


@add(
    query(
        BIDS,
        """SELECT order_id, item, CAST(price AS DECIMAL(10,2)) AS price, supplier, bid_time,
       strftime(bid_time, '%Y-%m-%d') AS bid_date FROM bids""",
    )
)
def stream_ingest(spark, folder):
    rows = project_orders(tables.as_bids(_events(spark, folder))).withColumn(
        "bid_date", F.date_format("bid_time", "yyyy-MM-dd")
    )
    return run.stream_to_folder(spark, rows, "ingest", ["bid_date"])


CLOSED = """SELECT strftime(w, '%Y-%m-%dT%H:%M:%SZ') AS window_start,
       strftime(w + INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%SZ') AS window_end, supplier,
       CAST(SUM(CAST(price AS DECIMAL(10,2))) AS DECIMAL(20,2)) AS total_price, COUNT(*) AS "count"
FROM (SELECT *, time_bucket(INTERVAL 1 HOUR, bid_time) AS w FROM bids)
WHERE w + INTERVAL 1 HOUR <= (SELECT MAX(bid_time) - INTERVAL 5 SECOND FROM bids)
GROUP BY w, supplier"""



@add(query(BIDS, CLOSED))
def stream_supplier_stats(spark, folder):
    """Each window once, after it closed; the last ones stay open."""
    stats = supplier.closed_windows(tables.as_bids(_events(spark, folder)), HOUR)
    return with_text_bounds(run.stream_to_folder(spark, stats, "stats"))


@add(query(BIDS, CLOSED))
def stream_collect(spark, folder):
    """The same, as a bounded collection."""
    stats = supplier.closed_windows(tables.as_bids(_events(spark, folder)), HOUR)
    return with_text_bounds(run.collect_for(spark, stats, 600))


UPDATED = """, timed AS (
  SELECT *, {supplier} AS by_supplier, {time} AS sent_at, {time} >= TIMESTAMP '2024-01-16 00:30:00' OR
         ({time} >= TIMESTAMP '2024-01-16' AND CAST(order_id AS BIGINT) % 2 = 1) AS second
  FROM dirty_bids WHERE {time} IS NOT NULL),
sent AS (
  SELECT a.arrival, time_bucket(INTERVAL 1 HOUR, sent_at) AS w, by_supplier AS supplier, price,
         second = (a.arrival = 2) AS is_new
  FROM timed, (VALUES (1), (2)) a(arrival) WHERE a.arrival = 2 OR NOT second)
SELECT arrival, strftime(w, '%Y-%m-%dT%H:%M:%SZ') AS window_start,
       strftime(w + INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%SZ') AS window_end, supplier,
       round(SUM(coalesce(TRY_CAST(price AS DOUBLE), 0.0)), {digits}) AS total_price,
       COUNT(*) AS "count"
FROM sent GROUP BY arrival, w, supplier HAVING bool_or(is_new)"""


def _updated_sql(supplier, time, digits):
    return f"WITH {DIRTY_BIDS}" + UPDATED.format(supplier=supplier, time=time, digits=digits)


def _update_log(spark, folder, time, stats, digits):
    """All updates of two arrivals; the second brings rows of a window that the first has sent."""
    root = fresh_folder(spark, "updates")
    sink = supplier.UpdateLog(f"{root}/out")
    rows = tables.dirty_bids(spark, folder)
    cut, day = F.lit("2024-01-16 00:30:00").cast("timestamp"), F.lit("2024-01-16").cast("timestamp")
    second = (time >= cut) | ((time >= day) & (F.col("order_id").cast("bigint") % 2 == 1))
    run.replay(
        spark,
        [rows.where(~F.coalesce(second, F.lit(False))), rows.where(second)],
        rows.schema,
        lambda stream: sink.writer(stats(stream), f"{root}/checkpoint"),
        f"{root}/landing",
    )
    # Batches without input send nothing and have no number here.
    arrival = F.dense_rank().over(Window.orderBy("batch")).alias("arrival")
    updates = with_text_bounds(sink.updates(spark).withColumn("total_price", F.round("total_price", digits)))
    return updates.select(arrival, *[c for c in updates.columns if c != "batch"])


@add(_updated_sql("supplier", "bid_time", 2))
def stream_supplier_stats_update(spark, folder):
    """Windows are sent again for late rows: every update, by arrival."""
    return _update_log(
        spark, folder, F.col("bid_time"), lambda rows: supplier.refired_windows(rows, HOUR), 2
    )


@add(_updated_sql("coalesce(supplier, 'UNKNOWN')", "coalesce(bid_time, arrived_at)", 6))
def stream_stats_every_update(spark, folder):
    """Every change is sent; orders without a time take the log's."""

    def stats(rows):
        return supplier.updated_windows(time_or_fallback(rows, "bid_time", "arrived_at"), HOUR)

    return _update_log(spark, folder, F.coalesce("bid_time", "arrived_at"), stats, 6)


@add(
    query(
        BIDS + """, marks AS (
  SELECT MAX(bid_time) FILTER (item <> 'error') - INTERVAL 5 SECOND AS first_mark,
         MAX(bid_time) - INTERVAL 5 SECOND AS last_mark FROM bids)""",
        """SELECT strftime(w, '%Y-%m-%dT%H:%M:%SZ') AS window_start,
       strftime(w + INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%SZ') AS window_end, supplier,
       CAST(SUM(CAST(price AS DECIMAL(10,2))) AS DECIMAL(20,2)) AS total_price, COUNT(*) AS "count"
FROM (SELECT *, time_bucket(INTERVAL 1 HOUR, bid_time) AS w FROM bids), marks
WHERE w + INTERVAL 1 HOUR <= last_mark
  AND (item <> 'error' OR w + INTERVAL 1 HOUR > first_mark)
GROUP BY w, supplier""",
    )
)
def stream_late_drop(spark, folder):
    """Errors arrive after everything else; those whose window is closed by then are dropped."""
    events = tables.table(spark, folder, "events")
    root = fresh_folder(spark, "late")

    def writer(stream):
        stats = supplier.closed_windows(tables.as_bids(stream), HOUR)
        return (
            stats.writeStream.format("parquet")
            .option("path", f"{root}/out")
            .option("checkpointLocation", f"{root}/checkpoint")
        )

    on_time, late = events.where("event_type <> 'error'"), events.where("event_type = 'error'")
    run.replay(spark, [on_time, late], EVENTS, writer, f"{root}/landing")
    return with_text_bounds(spark.read.parquet(f"{root}/out"))


SCORE_ARRIVALS = ["2024-01-11", "2024-01-21"]


def _replayed_scores(spark, folder, root, sink, totals):
    """Three arrivals of the scores into a board kept in update mode."""
    run.replay(
        spark,
        _by_time(tables.table(spark, folder, "events"), SCORE_ARRIVALS),
        EVENTS,
        lambda stream: sink.writer(totals(tables.as_user_scores(stream)), f"{root}/checkpoint"),
        f"{root}/landing",
    )


@add(query(USER_SCORES, TOP_TEAMS))
def stream_top_teams(spark, folder):
    """The board as a reader of its changelog rebuilds it."""
    root = fresh_folder(spark, "teams")
    sink = boards.top_teams_board(root)
    _replayed_scores(spark, folder, root, sink, boards.running_team_totals)
    return sink.current(spark)


@add(query(USER_SCORES, TOP_PLAYERS))
def stream_top_players(spark, folder):
    """From changed players and the stored board; no batch reads all totals."""
    root = fresh_folder(spark, "players")
    sink = boards.top_players_board(root)
    _replayed_scores(spark, folder, root, sink, boards.running_player_totals)
    return sink.current(spark)


@add(query(USER_SCORES, TEAM_MVPS))
def stream_team_mvps(spark, folder):
    """A join of two aggregates, kept up by changed teams."""
    root = fresh_folder(spark, "mvps")
    sink = boards.TeamMvps(root)
    _replayed_scores(spark, folder, root, sink, boards.running_parts)
    return sink.board.current(spark)


def _replayed_lines(spark, folder, root, writer):
    """The changes of order lines in four arrivals: created, moved, returned, closed."""
    changes = tables.line_changes(spark, folder)
    run.replay(
        spark,
        [changes.where(F.col("step") == step) for step in (1, 2, 3, 4)],
        changes.schema,
        lambda stream: writer(cdc.running_totals(stream, ["supplier"], "amount")),
        f"{root}/landing",
    )


@add(query(LINES, RUNNING_TOTALS))
def stream_cdc_totals(spark, folder):
    """Totals kept up from changes: the last update of each group, emptied groups left out."""
    root = fresh_folder(spark, "line-totals")
    sink = supplier.UpdateLog(f"{root}/out")
    _replayed_lines(spark, folder, root, lambda totals: sink.writer(totals, f"{root}/checkpoint"))
    return sink.latest(spark, ["supplier"]).where("n > 0")


@add(
    query(
        LINES + """, totals AS (
  SELECT step, supplier, CAST(SUM(amount) AS DECIMAL(22,2)) AS total, COUNT(*) AS n FROM line_states GROUP BY ALL),
boards AS (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY step ORDER BY total DESC, supplier) AS rnk FROM totals)
  WHERE rnk <= 10),
ranks AS (SELECT step, rnk FROM (SELECT unnest(range(1, 5)) AS step), (SELECT unnest(range(1, 11)) AS rnk))""",
        """SELECT CAST(r.step AS INTEGER) AS arrival, CASE WHEN n.rnk IS NULL THEN 'D' ELSE 'U' END AS op, r.rnk,
       n.supplier, n.total, n.n
FROM ranks r LEFT JOIN boards n ON n.step = r.step AND n.rnk = r.rnk
LEFT JOIN boards o ON o.step = r.step - 1 AND o.rnk = r.rnk
WHERE (n.supplier, n.total, n.n) IS DISTINCT FROM (o.supplier, o.total, o.n)""",
    )
)
def stream_board_changelog(spark, folder):
    """Every message of the board's log: as suppliers lose their last line the board shrinks, and the
    ranks that are no longer filled are deleted."""
    root = fresh_folder(spark, "line-board")
    sink = boards.line_totals_board(root)
    _replayed_lines(spark, folder, root, lambda totals: sink.writer(totals, f"{root}/checkpoint"))
    arrival = F.dense_rank().over(Window.orderBy("batch")).alias("arrival")
    return sink.changes(spark).select(arrival, "op", "rnk", "supplier", "total", "n")


@add(
    query(
        USER_SCORES.replace("user_scores AS", "all_scores AS", 1)
        + """, user_scores AS (
  SELECT * FROM all_scores
  WHERE event_time <= (SELECT MAX(event_time) - INTERVAL 5 SECOND FROM all_scores)), """
        + SLIDING,
        HOT_STREAKS,
    )
)
def stream_hot_streaks(spark, folder):
    """Two arrivals; events after the last watermark are not complete yet."""
    root = fresh_folder(spark, "hot")
    sink = boards.HotStreaks(root, idle_seconds=None)
    events = tables.table(spark, folder, "events")
    run.replay(
        spark,
        _by_time(events, ["2024-01-16"]),
        EVENTS,
        lambda stream: sink.writer(tables.as_user_scores(stream), f"{root}/checkpoint"),
        f"{root}/landing",
    )
    return sink.current(spark)


def _by_time(events, cuts):
    """All events, split into consecutive arrivals at the given times."""
    times = [F.lit(c).cast("timestamp_ntz") for c in cuts]
    edges = [None, *times, None]
    for low, high in zip(edges, edges[1:], strict=False):
        rows = events
        if low is not None:
            rows = rows.where(F.col("ts") >= low)
        if high is not None:
            rows = rows.where(F.col("ts") < high)
        yield rows


# Arrivals of the enrichment, in seconds after the first: orders come in the first two, users in any.
ARRIVED = [0, 20, 300]
ARRIVALS = record(
    event_id="long", ts="timestamp_ntz", user_id="long", event_type="string", value="double", props="string",
    arrived_at="timestamp",
)
ROUTED = (
    PURCHASES
    + ", "
    + VERSIONS
    + """, times AS (
  SELECT * FROM (VALUES (1, 0), (2, 20), (3, 300)) t(phase, since)),
arrivals AS (
  SELECT * REPLACE (CASE WHEN quantity > 1 THEN created_at END AS created_at),
         1 + CAST(order_id AS BIGINT) % 2 AS phase FROM purchases),
user_arrivals AS (
  SELECT * REPLACE (CASE WHEN postal_code <> '00000' THEN version_at END AS version_at),
         greatest(1 + CAST(regexp_extract(email, '[.]v([0-9]+)@', 1) AS BIGINT) % 2,
                  CAST(substr(user_id, 5) AS BIGINT) % 4) AS phase FROM versions),
first_seen AS (SELECT user_id, MIN(phase) AS phase FROM user_arrivals GROUP BY 1),
met AS (
  SELECT a.*, CASE WHEN s.phase <= a.phase THEN a.phase
                   WHEN ts.since <= ta.since + 30 THEN s.phase END AS met_phase
  FROM arrivals a JOIN times ta ON ta.phase = a.phase
  LEFT JOIN first_seen s ON s.user_id = a.user_id LEFT JOIN times ts ON ts.phase = s.phase),
newest AS (
  SELECT m.order_id, u.*, ROW_NUMBER() OVER (PARTITION BY m.order_id ORDER BY u.version_at DESC NULLS LAST,
         u.first_name DESC, u.last_name DESC, u.email DESC, u.postal_code DESC) AS rn
  FROM met m JOIN user_arrivals u ON u.user_id = m.user_id AND u.phase <= m.met_phase),
routed AS (
  SELECT m.order_id, m.user_id, m.product_name, m.category, m.quantity, m.unit_price, m.created_at,
         n.first_name AS user_first_name, n.last_name AS user_last_name, n.email AS user_email,
         n.postal_code AS user_postal_code,
         CASE WHEN m.met_phase IS NULL THEN 'missing' ELSE 'enriched' END AS route
  FROM met m LEFT JOIN newest n ON n.order_id = m.order_id AND n.rn = 1)"""
)


def _arrivals(events):
    """All events in three arrivals that have little to do with their own times."""
    number = F.when(F.col("event_type") == "purchase", F.col("event_id") % 2 + 1).when(
        F.col("event_type") == "signup", F.greatest(F.col("event_id") % 2 + 1, F.col("user_id") % 4)
    )
    for i, seconds in enumerate(ARRIVED, 1):
        arrived = F.timestamp_seconds(F.lit(1_704_067_200 + seconds)).alias("arrived_at")
        yield events.where(number == i).select(*EVENTS.names, arrived)


def _enrich_arrivals(spark, folder, root, write):
    """Lets the arrivals come one by one; every sixth order or so has no time, as have some versions."""
    sink = enrich.Enrichment(root, write, fold=3)

    def writer(stream):
        orders = tables.as_purchases(stream, ["arrived_at"]).withColumn(
            "created_at", F.when(F.col("quantity") > 1, F.col("created_at"))
        )
        users = tables.as_user_versions(stream, ["arrived_at"]).withColumn(
            "version_at", F.when(F.col("postal_code") != "00000", F.col("version_at"))
        )
        met = enrich.meet_users(orders, users, arrival="arrived_at")
        return sink.writer(met, f"{root}/checkpoint")

    events = tables.table(spark, folder, "events")
    run.replay(spark, _arrivals(events), ARRIVALS, writer, f"{root}/landing")


@add(query(ROUTED, "SELECT * FROM routed"))
def stream_enrich(spark, folder):
    """Orders meet the newest user version that has arrived, or go out as missing once no arrival can
    still bring their user in time. Every order comes out once, however late its own time is."""
    root = fresh_folder(spark, "enrich")
    _enrich_arrivals(spark, folder, root, run.BatchFolders(f"{root}/out"))
    return spark.read.schema(enrich.ROUTED).parquet(f"{root}/out").select(*enrich.ROUTED.names)


@add(
    query(
        ROUTED,
        f"""SELECT 'enriched' AS sink, concat_ws('|', order_id, user_id, user_email, user_postal_code) AS content
FROM routed WHERE route = 'enriched'
UNION ALL
SELECT 'text', order_id || chr(9) || user_id || chr(9) || product_name || chr(9) || category ||
       chr(9) || quantity || chr(9) || CAST(unit_price AS VARCHAR) || chr(9) ||
       coalesce({SQL_TIME}, '\\N') || chr(9) || {TSV_TAIL}
FROM routed WHERE route = 'enriched'
UNION ALL
SELECT 'missing', {ORDER_JSON} FROM routed WHERE route = 'missing'""",
    )
)
def stream_enrich_fanout(spark, folder):
    """One stream into three sinks, and what each of them holds: lake, delimited text, dead letters."""
    root = fresh_folder(spark, "fanout")
    _enrich_arrivals(spark, folder, root, enrich.FanOut(root))
    lake_rows = spark.read.schema(enrich.ROUTED).parquet(f"{root}/enriched")
    fields = F.concat_ws("|", "order_id", "user_id", "user_email", "user_postal_code")
    found = [
        rows.select(F.lit(name).alias("sink"), content.alias("content"))
        for name, rows, content in (
            ("enriched", lake_rows, fields),
            ("text", spark.read.text(f"{root}/text"), F.col("value")),
            ("missing", spark.read.text(f"{root}/missing"), F.col("value")),
        )
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


@add(query(USER_SCORES, TEAM_TOTALS))
def stream_ttl_totals(spark, folder):
    """Within the time to live nothing expires, so these are the plain totals."""
    root = fresh_folder(spark, "ttl")
    sink = expiring.ExpiringTotals(root)
    events = tables.table(spark, folder, "events")
    run.replay(
        spark,
        _by_time(events, ["2024-01-16"]),
        EVENTS,
        lambda stream: sink.writer(tables.as_user_scores(stream), f"{root}/checkpoint"),
        f"{root}/landing",
    )
    return sink.current(spark)


def _landed_files(spark, folder, root, files=6):
    """The bids as a stream of several files, one a batch."""
    rows = tables.bids(spark, folder)
    rows.repartition(files).write.parquet(f"{root}/landing")
    return stream_parquet(spark, f"{root}/landing", rows.schema, files_per_trigger=1)


@add(query(BIDS, "SELECT * FROM bids"))
def stream_restart(spark, folder):
    """Stopped after some batches and started again from its checkpoint: every row once."""
    root = fresh_folder(spark, "restart")
    rows = _landed_files(spark, folder, root)

    def writer():
        return (
            rows.writeStream.format("parquet")
            .option("path", f"{root}/out")
            .option("checkpointLocation", f"{root}/checkpoint")
        )

    run.run_batches(writer(), 2)
    run.drain(writer())
    return spark.read.schema(rows.schema).parquet(f"{root}/out")


class _AnswerLost:
    """Fails after the sink has done its work for a batch, the first time it comes."""

    def __init__(self, sink, batch_id):
        self.sink, self.lost, self.delivered = sink, batch_id, []

    def __call__(self, rows, batch_id):
        self.sink(rows, batch_id)
        self.delivered.append(batch_id)
        if batch_id == self.lost and self.delivered.count(batch_id) == 1:
            raise RuntimeError("the answer of the sink was lost")


@add(query(BIDS, "SELECT *, 2 AS deliveries_of_lost_batch FROM bids"))
def stream_replay_batch(spark, folder):
    """A batch that is delivered twice, because the stream fails right after writing it: the sink
    overwrites by batch id, so its rows are there once."""
    root = fresh_folder(spark, "replay-batch")
    rows = _landed_files(spark, folder, root)
    sink = _AnswerLost(run.BatchFolders(f"{root}/out"), 1)

    def writer():
        return rows.writeStream.option("checkpointLocation", f"{root}/checkpoint").foreachBatch(sink)

    try:
        run.drain(writer())
    except StreamingQueryException:
        run.drain(writer())
    found = spark.read.schema(rows.schema).parquet(f"{root}/out").select(*rows.columns)
    return found.withColumn("deliveries_of_lost_batch", F.lit(sink.delivered.count(1)))


@add(
    query(
        BIDS + """, marks AS (
  SELECT MAX(bid_time) FILTER (item <> 'error') - INTERVAL 5 SECOND AS mark FROM bids)""",
        """SELECT CAST(1 AS INTEGER) AS arrival, COUNT(*) AS input_rows, CAST(0 AS BIGINT) AS late_rows
FROM bids WHERE item <> 'error'
UNION ALL
SELECT 2, COUNT(*), COUNT(*) FILTER (bid_time <= mark) FROM bids, marks WHERE item = 'error'""",
    )
)
def stream_late_counts(spark, folder):
    """Errors arrive after everything else; how many of them the watermark drops."""
    events = tables.table(spark, folder, "events")
    root = fresh_folder(spark, "late-counts")

    def writer(stream):
        rows = late.accept_in_time(tables.as_bids(stream), "order_id", "bid_time", supplier.DELAY)
        return (
            rows.writeStream.format("parquet")
            .option("path", f"{root}/out")
            .option("checkpointLocation", f"{root}/checkpoint")
        )

    phases = [events.where("event_type <> 'error'"), events.where("event_type = 'error'")]
    queries = run.replay(spark, phases, EVENTS, writer, f"{root}/landing")
    arrival = F.dense_rank().over(Window.orderBy("batch")).alias("arrival")
    return late.late_counts(spark, queries).select(arrival, "input_rows", "late_rows")


@add(
    query(
        BIDS + """, heard AS (
  SELECT *, item = 'error' AS faint FROM bids WHERE item <> 'error' OR bid_time < TIMESTAMP '2024-01-10'),
marks AS (
  SELECT MAX(bid_time) FILTER (faint) - INTERVAL 5 SECOND AS faint_mark,
         MAX(bid_time) FILTER (NOT faint) - INTERVAL 5 SECOND AS clear_mark FROM heard),
policies AS (
  SELECT 'min' AS policy, least(faint_mark, clear_mark) AS mark FROM marks
  UNION ALL SELECT 'max', greatest(faint_mark, clear_mark) FROM marks)""",
        """SELECT policy, strftime(w, '%Y-%m-%dT%H:%M:%SZ') AS window_start,
       strftime(w + INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%SZ') AS window_end, supplier,
       CAST(SUM(CAST(price AS DECIMAL(10,2))) AS DECIMAL(20,2)) AS total_price, COUNT(*) AS "count"
FROM (SELECT *, time_bucket(INTERVAL 1 HOUR, bid_time) AS w FROM heard), policies
WHERE w + INTERVAL 1 HOUR <= mark GROUP BY policy, w, supplier""",
    )
)
def stream_idle_source(spark, folder):
    """Two sources, one of which falls silent: the windows that close if the slowest source decides,
    and if the fastest does."""
    root = fresh_folder(spark, "idle")
    rows = tables.bids(spark, folder)
    silent = (F.col("item") == "error") & (F.col("bid_time") < F.lit("2024-01-10").cast("timestamp"))
    rows.where("item <> 'error'").write.parquet(f"{root}/clear")
    rows.where(silent).write.parquet(f"{root}/faint")
    found = []
    for policy in ("min", "max"):
        # A session of its own, so that the caller's settings stay.
        own = spark.newSession()
        for name in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
            own.conf.set(name, spark.conf.get(name))
        own.conf.set("spark.sql.streaming.multipleWatermarkPolicy", policy)
        sources = [stream_parquet(own, f"{root}/{name}", rows.schema) for name in ("clear", "faint")]
        stats = supplier.merged_windows(sources, HOUR)
        run.drain_to_files(stats, f"{root}/{policy}", f"{root}/{policy}-checkpoint")
        closed = spark.read.schema(stats.schema).parquet(f"{root}/{policy}")
        found.append(with_text_bounds(closed).select(F.lit(policy).alias("policy"), "*"))
    return found[0].unionByName(found[1])
