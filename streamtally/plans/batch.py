"""Queries that read tables and return a result."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import parse_clock_text
from ..functions import surrogate_key as key_of_name
from ..operators import (
    cdc,
    changelog,
    daily,
    enrich,
    leaderboard,
    lifecycle,
    records,
    sliding,
    supplier_stats,
)
from ..schemas import ORDER_V2, record
from ..session import stored
from ..sinks.log import key_value
from ..sources import log, tables
from ..sources.files import parse_json
from .oracle_tables import (
    AS_OF,
    BIDS,
    BOARD_LOG,
    CHANGE_LOG,
    DIRTY_BIDS,
    LINES,
    MESSAGES,
    PURCHASES,
    SHOP,
    STATUS_CHANGES,
    USER_SCORES,
    VERSIONS,
    query,
)
from .registry import Registry

REGISTRY = Registry()
add = REGISTRY.add

# Leaderboards -----------------------------------------------------------------------------------

TEAM_TOTALS = """SELECT team_id, MAX(team_name) AS team_name,
       CAST(SUM(score) AS BIGINT) AS total_score FROM user_scores GROUP BY team_id"""
PLAYER_TOTALS = """SELECT user_id, MAX(team_name) AS team_name,
       CAST(SUM(score) AS BIGINT) AS total_score FROM user_scores GROUP BY user_id"""
TOP_TEAMS = f"""SELECT * FROM (
  SELECT ROW_NUMBER() OVER (ORDER BY total_score DESC NULLS LAST, team_name ASC NULLS LAST,
                            team_id ASC) AS rnk, *
  FROM ({TEAM_TOTALS})) WHERE rnk <= 10"""
TOP_PLAYERS = f"""SELECT * FROM (
  SELECT ROW_NUMBER() OVER (ORDER BY total_score DESC NULLS LAST, user_id ASC NULLS LAST) AS rnk, *
  FROM ({PLAYER_TOTALS})) WHERE rnk <= 10"""
TEAM_MVPS = """SELECT * FROM (
  SELECT ROW_NUMBER() OVER (ORDER BY contrib_ratio DESC NULLS LAST, user_id ASC NULLS LAST,
                            team_name ASC NULLS LAST) AS rnk,
         user_id, team_name, player_total, team_total, contrib_ratio
  FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY team_name ORDER BY contrib_ratio DESC NULLS LAST,
                                 user_id ASC NULLS LAST) AS place
    FROM (
      SELECT p.user_id, t.team_name, p.player_total, t.team_total,
             CAST(p.player_total AS DOUBLE) / nullif(CAST(t.team_total AS DOUBLE), 0) AS contrib_ratio
      FROM (SELECT user_id, team_id, CAST(SUM(score) AS BIGINT) AS player_total
            FROM user_scores GROUP BY user_id, team_id) p
      JOIN (SELECT team_id, team_name, CAST(SUM(score) AS BIGINT) AS team_total
            FROM user_scores GROUP BY team_id, team_name) t ON p.team_id = t.team_id))
  WHERE place = 1) WHERE rnk <= 10"""
SLIDING = """sliding AS (
  SELECT user_id, event_time,
         CAST(SUM(score) OVER short AS BIGINT) AS short_term_sum,
         COUNT(score) OVER short AS short_term_count,
         CAST(SUM(score) OVER long AS BIGINT) AS long_term_sum,
         COUNT(score) OVER long AS long_term_count
  FROM user_scores
  WINDOW short AS (PARTITION BY user_id ORDER BY event_time
                   RANGE BETWEEN INTERVAL 10 SECOND PRECEDING AND CURRENT ROW),
         long AS (PARTITION BY user_id ORDER BY event_time
                  RANGE BETWEEN INTERVAL 60 SECOND PRECEDING AND CURRENT ROW)),
hot AS (
  SELECT user_id, event_time,
         CAST(short_term_sum AS DOUBLE) / nullif(CAST(short_term_count AS DOUBLE), 0) AS short_term_avg,
         CAST(long_term_sum AS DOUBLE) / nullif(CAST(long_term_count AS DOUBLE), 0) AS long_term_avg,
         (CAST(short_term_sum AS DOUBLE) / nullif(CAST(short_term_count AS DOUBLE), 0)) /
         nullif(CAST(long_term_sum AS DOUBLE) / nullif(CAST(long_term_count AS DOUBLE), 0), 0)
           AS current_hotness_ratio
  FROM sliding)"""
HOT_STREAKS = """SELECT * FROM (
  SELECT ROW_NUMBER() OVER (ORDER BY current_hotness_ratio DESC NULLS LAST, user_id ASC) AS rnk,
         user_id, short_term_avg, long_term_avg, current_hotness_ratio AS peak_hotness
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_time DESC) AS rn FROM hot)
  WHERE rn = 1) WHERE rnk <= 10"""


@add(query(USER_SCORES, TEAM_TOTALS))
def team_totals(spark, folder):
    return leaderboard.team_totals(tables.user_scores(spark, folder))


@add(query(USER_SCORES, PLAYER_TOTALS))
def player_totals(spark, folder):
    return leaderboard.player_totals(tables.user_scores(spark, folder))


@add(query(USER_SCORES, TOP_TEAMS))
def top_teams(spark, folder):
    return leaderboard.top_teams(tables.user_scores(spark, folder))


@add(query(USER_SCORES, TOP_PLAYERS))
def top_players(spark, folder):
    return leaderboard.top_players(tables.user_scores(spark, folder))


@add(query(USER_SCORES, TEAM_MVPS))
def team_mvps(spark, folder):
    return leaderboard.team_mvps(tables.user_scores(spark, folder))


@add(query(USER_SCORES + ", " + SLIDING, "SELECT * FROM sliding"))
def sliding_sums(spark, folder):
    return sliding.sliding_sums(tables.user_scores(spark, folder))


@add(query(USER_SCORES + ", " + SLIDING, "SELECT * FROM hot"))
def hotness(spark, folder):
    return sliding.hotness(tables.user_scores(spark, folder))


@add(
    query(
        USER_SCORES,
        """SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_time DESC, score DESC, event_type DESC) AS rn
  FROM user_scores) WHERE rn = 1""",
    )
)
def latest_per_user(spark, folder):
    """Of events of one user at one instant the one of the highest score, then of the last type."""
    order = ["event_time", "score", "event_type"]
    return sliding.latest_per_key(tables.user_scores(spark, folder), ["user_id"], order)


@add(query(USER_SCORES + ", " + SLIDING, HOT_STREAKS))
def hot_streaks(spark, folder):
    return sliding.hot_streaks(tables.user_scores(spark, folder))


# Supplier statistics ----------------------------------------------------------------------------


def _stats_sql(
    source: str,
    price: str,
    supplier: str = "supplier",
    seconds: int = 5,
    total: str = "{sum}",
) -> str:
    return f"""SELECT strftime(w, '%Y-%m-%dT%H:%M:%SZ') AS window_start,
       strftime(w + INTERVAL {seconds} SECOND, '%Y-%m-%dT%H:%M:%SZ') AS window_end,
       supplier, total_price, "count"
FROM (SELECT time_bucket(INTERVAL {seconds} SECOND, bid_time) AS w, {supplier} AS supplier,
             {total.format(sum=f"SUM({price})")} AS total_price, COUNT(*) AS "count"
      FROM {source} WHERE bid_time IS NOT NULL GROUP BY 1, 2)"""


STRICT = "CAST(price AS DECIMAL(10,2))"
LENIENT = "coalesce(TRY_CAST(price AS DOUBLE), 0.0)"
AS_MONEY = "CAST({sum} AS DECIMAL(20,2))"


@add(query(BIDS, _stats_sql("bids", STRICT, total=AS_MONEY)))
def supplier_stats_5s(spark, folder):
    return supplier_stats.strict_stats(tables.bids(spark, folder))


@add(query(BIDS, _stats_sql("bids", STRICT, seconds=3600, total=AS_MONEY)))
def supplier_stats_1h(spark, folder):
    return supplier_stats.strict_stats(tables.bids(spark, folder), "1 hour")


@add(
    query(
        DIRTY_BIDS,
        _stats_sql(
            "dirty_bids", LENIENT, "coalesce(supplier, 'UNKNOWN')", 3600, "round({sum}, 6)"
        ),
    )
)
def stats_lenient(spark, folder):
    stats = supplier_stats.lenient_stats(tables.dirty_bids(spark, folder), "1 hour")
    # Unrounded double sums depend on the order of adding in their last bits.
    return stats.withColumn("total_price", F.round("total_price", 6))


@add(query(DIRTY_BIDS, _stats_sql("dirty_bids", LENIENT, seconds=3600, total="round({sum}, 2)")))
def stats_rounded(spark, folder):
    return supplier_stats.rounded_stats(tables.dirty_bids(spark, folder), "1 hour")


ARITHMETIC = """SELECT strftime(make_timestamp(s * 1000), '%Y-%m-%dT%H:%M:%SZ') AS window_start,
       strftime(make_timestamp((s + {ms}) * 1000), '%Y-%m-%dT%H:%M:%SZ') AS window_end,
       supplier, round(total, 2) AS total_price, n AS "count"
FROM (SELECT CAST(floor(epoch_ms(bid_time) / {ms}.0) AS BIGINT) * {ms} AS s, supplier,
             SUM(CAST(price AS DOUBLE)) AS total, COUNT(*) AS n
      FROM bids GROUP BY 1, 2)"""


@add(query(BIDS, ARITHMETIC.format(ms=3_600_000)))
def supplier_window_arith(spark, folder):
    return supplier_stats.arithmetic_windows(tables.bids(spark, folder), 3_600_000)


@add(
    query(
        BIDS,
        f"""SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY supplier ORDER BY window_start DESC) AS rn
  FROM ({ARITHMETIC.format(ms=5000)})) WHERE rn = 1""",
    )
)
def supplier_latest_window(spark, folder):
    """Over the whole table, as its SQL."""
    return supplier_stats.latest_windows(tables.bids(spark, folder), trailing_ms=None)


@add(
    query(
        BIDS,
        """SELECT supplier, CAST(bid_time AS DATE) AS bid_date,
       CAST(hour(bid_time) AS INTEGER) AS bid_hour,
       CAST(SUM(CAST(price AS DECIMAL(10,2))) AS DECIMAL(20,2)) AS total_price,
       COUNT(*) AS total_count
FROM bids GROUP BY 1, 2, 3""",
    )
)
def supplier_hourly(spark, folder):
    return supplier_stats.hourly_stats(tables.bids(spark, folder))


@add(
    query(
        BIDS,
        """SELECT supplier, CAST(bid_time AS DATE) AS bid_date,
       CAST(hour(bid_time) AS INTEGER) AS bid_hour,
       CAST(SUM(CAST(price AS DECIMAL(10,2))) AS DECIMAL(20,2)) AS total_price,
       COUNT(*) AS total_count
FROM bids WHERE CAST(bid_time AS DATE) = DATE '2024-01-15' GROUP BY 1, 2, 3""",
    )
)
def supplier_hourly_one_day(spark, folder):
    return supplier_stats.hourly_stats(tables.bids(spark, folder), dt.date(2024, 1, 15))


# Change capture and enrichment ------------------------------------------------------------------


@add(
    query(
        CHANGE_LOG,
        """SELECT seq, op, user_id, coalesce(first_name, '') AS first_name, last_name, email,
       coalesce(postal_code, '') AS postal_code,
       coalesce(created_at, TIMESTAMP '1970-01-01') AS created_at
FROM raw_changes WHERE has_image""",
    )
)
def cdc_unwrap(spark, folder):
    return cdc.unwrap_users(tables.change_log(spark, folder), ["seq", "op"])


@add(
    query(
        CHANGE_LOG,
        """SELECT seq, coalesce(make_timestamp(at_ms * 1000), TIMESTAMP '2024-02-01') AS event_time
FROM raw_changes""",
    )
)
def cdc_event_time(spark, folder):
    now = F.lit("2024-02-01 00:00:00")
    return cdc.event_time(tables.change_log(spark, folder), now).select("seq", "event_time")


@add(
    query(
        CHANGE_LOG,
        """SELECT user_id, first_name, last_name, email, postal_code,
       CAST(epoch_us(created_at) AS BIGINT) AS created_at FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY seq DESC) AS rn
  FROM raw_changes WHERE has_image) WHERE rn = 1 AND op <> 'd'""",
    )
)
def cdc_current_state(spark, folder):
    return cdc.current_state(tables.change_log(spark, folder), "user_id", ["seq"])


ENRICHED = "order_id, user_id, product_name, category, quantity, unit_price, created_at"
USER_COLUMNS = "user_first_name, user_last_name, user_email, user_postal_code"
SHOP_ENRICHED = SHOP + """, enriched AS (
  SELECT o.*, u.first_name AS user_first_name, u.last_name AS user_last_name,
         u.email AS user_email, u.postal_code AS user_postal_code
  FROM shop_orders o JOIN shop_users u ON o.user_id = u.user_id)"""


def _shop_enriched(spark, folder):
    return enrich.enrich_current(
        tables.shop_orders(spark, folder), tables.shop_users(spark, folder)
    )


def _matched(spark, folder):
    return enrich.match_as_of(
        tables.purchases(spark, folder), tables.user_versions(spark, folder)
    )


@add(query(SHOP_ENRICHED, "SELECT * FROM enriched"))
def enrich_orders(spark, folder):
    return _shop_enriched(spark, folder)


@add(query(AS_OF, "SELECT * FROM matched"))
def enrich_asof(spark, folder):
    return _matched(spark, folder)


@add(query(AS_OF, f"SELECT {ENRICHED} FROM matched WHERE route = 'missing'"))
def enrich_missing(spark, folder):
    return enrich.dead_letter(_matched(spark, folder))


@add(
    query(
        PURCHASES + ", " + VERSIONS,
        "SELECT * FROM purchases WHERE user_id NOT IN (SELECT user_id FROM versions)",
    )
)
def orders_without_user(spark, folder):
    return enrich.missing_users(
        tables.purchases(spark, folder), tables.user_versions(spark, folder)
    )


@add(
    query(
        PURCHASES + ", " + VERSIONS,
        """SELECT * FROM purchases WHERE user_id NOT IN (
  SELECT user_id FROM versions WHERE CAST(substr(user_id, 5) AS BIGINT) % 4 <> 0)""",
    )
)
def orders_of_closed_accounts(spark, folder):
    """Dead letters where a quarter of the users do not exist (any more)."""
    number = F.substring("user_id", 5, 20).cast("bigint")
    users = tables.user_versions(spark, folder).where(number % 4 != 0)
    return enrich.missing_users(tables.purchases(spark, folder), users)


@add(query(AS_OF, f"SELECT {ENRICHED}, {USER_COLUMNS} FROM matched"))
def enriched_sink_shape(spark, folder):
    return enrich.sink_shape(_matched(spark, folder))


@add(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders
                     WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0))"""
)
def order_items_lookup(spark, folder):
    """Items of all orders of the customers in debt."""
    debtors = tables.table(spark, folder, "customer").where("c_acctbal < 0")
    orders = tables.table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    theirs = enrich.lookup(orders, debtors, "o_custkey", "c_custkey")
    items = tables.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"
    )
    return enrich.lookup(items, theirs, "l_orderkey", "o_orderkey")


@add(
    query(
        SHOP_ENRICHED,
        """SELECT user_first_name, user_last_name, user_email, CAST(created_at AS DATE) AS report_date,
       CAST(CAST(SUM(quantity * CAST(floor(unit_price * 1000000 + 0.5) AS BIGINT)) AS DECIMAL(30,0)) * 0.000001 AS DECIMAL(15,2)) AS total_revenue,
       COUNT(*) AS total_orders
FROM enriched GROUP BY 1, 2, 3, 4""",
    )
)
def user_daily_stats(spark, folder):
    return daily.user_daily_stats(_shop_enriched(spark, folder))


@add(
    query(
        SHOP_ENRICHED,
        """SELECT category, CAST(created_at AS DATE) AS report_date,
       CAST(CAST(SUM(quantity * CAST(floor(unit_price * 1000000 + 0.5) AS BIGINT)) AS DECIMAL(30,0)) * 0.000001 AS DECIMAL(15,2)) AS total_revenue,
       COUNT(*) AS total_orders
FROM enriched GROUP BY 1, 2""",
    )
)
def category_daily_stats(spark, folder):
    return daily.category_daily_stats(_shop_enriched(spark, folder))


LAST_VALUES = """SELECT key, value, "offset" FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY key ORDER BY "offset" DESC) AS rn
  FROM board_log{ignoring}) WHERE rn = 1 AND value IS NOT NULL"""


@add(query(BOARD_LOG, LAST_VALUES.format(ignoring="")))
def changelog_materialize(spark, folder):
    return changelog.materialize(tables.board_changelog(spark, folder), "key", "value", "offset")


@add(query(BOARD_LOG, LAST_VALUES.format(ignoring=" WHERE value IS NOT NULL")))
def changelog_materialize_keep(spark, folder):
    """Deletions are ignored, so removed keys linger."""
    return changelog.materialize(
        tables.board_changelog(spark, folder), "key", "value", "offset", keep_deleted=True
    )


@add(
    query(
        BOARD_LOG,
        """SELECT key, value, "offset" FROM (
  SELECT *, LAG(value) OVER (PARTITION BY key ORDER BY "offset") AS held
  FROM board_log WHERE value IS NOT NULL) WHERE held IS NULL OR held <> value""",
    )
)
def changelog_effective_updates(spark, folder):
    return changelog.effective_updates(
        tables.board_changelog(spark, folder), "key", "value", "offset"
    )


@add(
    query(
        STATUS_CHANGES,
        """SELECT order_id, seq, changed_at, from_status, status AS to_status FROM (
  SELECT *, LAG(status) OVER (PARTITION BY order_id ORDER BY changed_at, seq) AS from_status
  FROM status_changes)
WHERE from_status <> status
  AND NOT ((from_status = 'Processing' AND status IN ('Shipped', 'Cancelled'))
        OR (from_status = 'Shipped' AND status = 'Delivered')
        OR (from_status = 'Delivered' AND status = 'Returned'))""",
    )
)
def illegal_transitions(spark, folder):
    return lifecycle.illegal_transitions(tables.order_status_changes(spark, folder))


@add(
    query(
        USER_SCORES + """, old_scores AS (
  SELECT * FROM user_scores WHERE event_time < TIMESTAMP '2024-01-16'),
old_board AS (""" + TOP_PLAYERS.replace("user_scores", "old_scores") + """),
new_board AS (""" + TOP_PLAYERS + ")",
        """SELECT CASE WHEN n.rnk IS NULL THEN 'D' ELSE 'U' END AS op, coalesce(n.rnk, o.rnk) AS rnk,
       n.user_id, n.team_name, n.total_score
FROM old_board o FULL JOIN new_board n ON o.rnk = n.rnk
WHERE (o.user_id, o.team_name, o.total_score) IS DISTINCT FROM (n.user_id, n.team_name, n.total_score)""",
    )
)
def topk_changelog_diff(spark, folder):
    """The player board of the whole table against that of its first half."""
    scores = tables.user_scores(spark, folder)
    first_half = scores.where(F.col("event_time") < F.lit("2024-01-16").cast("timestamp"))
    return changelog.diff_boards(
        leaderboard.top_players(first_half), leaderboard.top_players(scores)
    )


# Scans, projection, parsing, validation ---------------------------------------------------------


@add(query(BIDS, "SELECT * FROM bids"))
def scan_orders(spark, folder):
    return tables.bids(spark, folder)


@add(query(USER_SCORES, "SELECT * FROM user_scores"))
def scan_user_scores(spark, folder):
    return tables.user_scores(spark, folder)


@add("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def scan_json_props(spark, folder):
    events = tables.table(spark, folder, "events").select("event_id", "props")
    return parse_json(events, "props", record(k="integer")).drop("props")


@add(
    query(
        MESSAGES + """, committed AS (
  SELECT "partition", MAX("offset") + 1 AS next_offset FROM messages
  WHERE "timestamp" < TIMESTAMP '2024-01-16' AND "partition" <> 1 GROUP BY 1)""",
        """SELECT m.* FROM messages m LEFT JOIN committed c ON m."partition" = c."partition"
WHERE c.next_offset IS NULL OR m."offset" >= c.next_offset""",
    )
)
def scan_from_offsets(spark, folder):
    """All partitions but one have committed the first half; that one starts at its beginning."""
    messages = tables.messages(spark, folder)
    committed = stored(
        messages.where(
            (F.col("timestamp") < F.lit("2024-01-16").cast("timestamp"))
            & (F.col("partition") != 1)
        )
        .groupBy("partition")
        .agg((F.max("offset") + 1).alias("next_offset")),
        "committed",
    )
    return log.from_committed(messages, committed)


@add(query(MESSAGES, 'SELECT * FROM messages WHERE "partition" IN (0, 2)'))
def scan_partition(spark, folder):
    return log.from_partitions(tables.messages(spark, folder), [0, 2])


@add(
    """SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders
WHERE o_orderstatus = 'O' AND o_totalprice > 100000
ORDER BY o_totalprice DESC, o_orderkey LIMIT 100"""
)
def select_where_order_limit(spark, folder):
    return records.select_rows(
        tables.table(spark, folder, "orders"),
        columns=["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"],
        where="o_orderstatus = 'O' AND o_totalprice > 100000",
        order_by=[F.desc("o_totalprice"), F.asc("o_orderkey")],
        limit=100,
    )


@add(
    query(
        BIDS,
        "SELECT order_id, item, CAST(price AS DECIMAL(10,2)) AS price, supplier, bid_time FROM bids",
    )
)
def project_orders(spark, folder):
    return records.project_orders(tables.bids(spark, folder))


@add(
    query(
        DIRTY_BIDS,
        """SELECT order_id, price, supplier, bid_time_text FROM dirty_bids
WHERE TRY_CAST(bid_time_text AS BIGINT) IS NOT NULL""",
    )
)
def filter_valid_time(spark, folder):
    rows = tables.dirty_bids(spark, folder).select("order_id", "price", "supplier", "bid_time_text")
    return records.filter_valid_time(rows, "bid_time_text")


@add(
    query(
        DIRTY_BIDS,
        "SELECT order_id, coalesce(bid_time, arrived_at) AS bid_time, arrived_at FROM dirty_bids",
    )
)
def event_time_fallback(spark, folder):
    rows = tables.dirty_bids(spark, folder).select("order_id", "bid_time", "arrived_at")
    return records.time_or_fallback(rows, "bid_time", "arrived_at")


@add(query(BIDS, "SELECT order_id, date_trunc('second', bid_time) AS bid_time FROM bids"))
def parse_text_timestamp(spark, folder):
    texts = tables.bids(spark, folder).select(
        "order_id", F.date_format("bid_time", "EEE MMM dd HH:mm:ss zzz yyyy").alias("text")
    )
    return texts.select("order_id", parse_clock_text(F.col("text")).alias("bid_time"))


@add(
    """SELECT CAST(event_id AS VARCHAR) AS order_id, (epoch_us(ts) // 1000) AS bid_time, value AS price,
       event_type AS item, 'S-' || (user_id % 8) AS supplier,
       CASE WHEN event_type IN ('purchase', 'signup') THEN value > 50 ELSE false END AS is_premium
FROM events"""
)
def schema_evolve_v1_v2(spark, folder):
    """Old writers do not know the premium flag; all rows are read with it."""
    events = tables.table(spark, folder, "events")
    first = events.select(
        F.col("event_id").cast("string").alias("order_id"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("bid_time"),
        F.col("value").alias("price"),
        F.col("event_type").alias("item"),
        F.concat(F.lit("S-"), F.col("user_id") % tables.SUPPLIERS).alias("supplier"),
    )
    is_new = F.col("item").isin("purchase", "signup")
    second = first.where(is_new).withColumn("is_premium", F.col("price") > 50)
    default = {"is_premium": False}
    return records.evolve_to(first.where(~is_new), ORDER_V2, default).unionByName(
        records.evolve_to(second, ORDER_V2, default)
    )


@add(
    query(
        MESSAGES,
        """SELECT "partition", "offset", key, value, "timestamp", amount FROM verdicts
WHERE reason IS NULL""",
    )
)
def validate_good(spark, folder):
    return records.good_records(tables.messages(spark, folder))


@add(
    query(
        MESSAGES,
        """SELECT "partition", "offset", key, value, "timestamp", reason FROM verdicts
WHERE reason IS NOT NULL""",
    )
)
def validate_quarantine(spark, folder):
    return records.quarantined(tables.messages(spark, folder))


@add(
    query(
        MESSAGES + """, first_bad AS (
  SELECT "partition", MIN("offset") AS stalled_at, COUNT(*) AS bad_records
  FROM verdicts WHERE reason IS NOT NULL GROUP BY 1)""",
        """SELECT f."partition", f.stalled_at, f.bad_records,
       (SELECT COUNT(*) FROM messages m
        WHERE m."partition" = f."partition" AND m."offset" > f.stalled_at) AS waiting
FROM first_bad f""",
    )
)
def stall_report(spark, folder):
    return records.stall_report(tables.messages(spark, folder))


@add(
    """SELECT c_custkey, lpad(CAST(CAST('0x' || substr(sha1(c_name), 1, 8) AS BIGINT) AS VARCHAR), 10, '0')
  AS surrogate_id FROM customer"""
)
def surrogate_key(spark, folder):
    return tables.table(spark, folder, "customer").select(
        "c_custkey", key_of_name(F.col("c_name")).alias("surrogate_id")
    )


@add(
    """SELECT c_custkey, lower(c_name) AS c_name, lower(c_mktsegment) AS c_mktsegment
FROM customer"""
)
def lower_dims(spark, folder):
    rows = tables.table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return records.lower_columns(rows, ["c_name", "c_mktsegment"])


@add(
    """SELECT 'service-' || event_type AS service_name,
       CASE WHEN event_type = 'error' THEN 'ERROR' WHEN value > 50 THEN 'WARN' ELSE 'INFO' END AS log_level,
       COUNT(*) AS records
FROM events GROUP BY 1, 2"""
)
def log_counts(spark, folder):
    return records.level_counts(tables.log_records(spark, folder))


@add(
    query(
        DIRTY_BIDS,
        """SELECT 'order_id' AS column_name, COUNT(*) FILTER (order_id IS NULL) AS violations FROM dirty_bids
UNION ALL SELECT 'price', COUNT(*) FILTER (price IS NULL) FROM dirty_bids
UNION ALL SELECT 'supplier', COUNT(*) FILTER (supplier IS NULL) FROM dirty_bids
UNION ALL SELECT 'bid_time', COUNT(*) FILTER (bid_time IS NULL) FROM dirty_bids""",
    )
)
def not_null_violations(spark, folder):
    return records.null_counts(
        tables.dirty_bids(spark, folder), ["order_id", "price", "supplier", "bid_time"]
    )


@add(
    query(
        BIDS,
        """SELECT order_id AS key,
       '{"order_id":"' || order_id || '","item":"' || item || '","price":"' || price ||
       '","supplier":"' || supplier || '","bid_time":"' ||
       CASE WHEN epoch_ms(bid_time) % 1000 = 0 THEN strftime(bid_time, '%Y-%m-%dT%H:%M:%SZ')
            ELSE strftime(bid_time, '%Y-%m-%dT%H:%M:%S.%gZ') END || '"}' AS value
FROM bids""",
    )
)
def kafka_key_value(spark, folder):
    return key_value(tables.bids(spark, folder), "order_id")


DRAW = "('0x' || substr(md5('7:' || CAST(c_custkey AS VARCHAR)), 1, 13))::BIGINT / pow(2.0, 52)"


@add(
    f"""SELECT * FROM customer WHERE c_acctbal > 0
ORDER BY -ln(1.0 - {DRAW}) / c_acctbal, c_custkey LIMIT 100"""
)
def weighted_sample(spark, folder):
    customers = tables.table(spark, folder, "customer")
    return records.weighted_sample(customers, "c_acctbal", 100, "c_custkey")


@add(f"SELECT * FROM customer ORDER BY {DRAW}, c_custkey LIMIT 1")
def random_row(spark, folder):
    return records.random_row(tables.table(spark, folder, "customer"), "c_custkey")


PLACES = {"BUILDING": 0.5, "MACHINERY": 0.3, "AUTOMOBILE": 0.2}


@add(
    f"""WITH quotas AS (
  SELECT place, 101 * share AS quota, CAST(floor(101 * share) AS BIGINT) AS whole
  FROM (VALUES ('BUILDING', 0.5), ('MACHINERY', 0.3), ('AUTOMOBILE', 0.2)) p(place, share)),
seats AS (
  SELECT place, whole + CASE WHEN ROW_NUMBER() OVER (ORDER BY quota - whole DESC, place)
                                  <= 101 - (SELECT SUM(whole) FROM quotas) THEN 1 ELSE 0 END AS seats
  FROM quotas)
SELECT * EXCLUDE (place, seats, rn) FROM (
  SELECT c.*, s.place, s.seats,
         ROW_NUMBER() OVER (PARTITION BY c_mktsegment ORDER BY -ln(1.0 - {DRAW}) / c_acctbal, c_custkey) AS rn
  FROM customer c JOIN seats s ON s.place = c_mktsegment WHERE c_acctbal > 0) WHERE rn <= seats"""
)
def weighted_sample_by_place(spark, folder):
    customers = tables.table(spark, folder, "customer")
    return records.weighted_sample_by_place(
        customers, "c_acctbal", 101, "c_custkey", "c_mktsegment", PLACES
    )


RUNNING_TOTALS = """SELECT supplier, CAST(SUM(amount) AS DECIMAL(22,2)) AS total, COUNT(*) AS n
FROM line_states WHERE step = 4 GROUP BY 1"""


@add(query(LINES, RUNNING_TOTALS))
def cdc_running_totals(spark, folder):
    """Totals from the changes alone; they are those of the rows that are left."""
    changes = tables.line_changes(spark, folder)
    return cdc.running_totals(changes, ["supplier"], "amount").where("n > 0")


@add(
    """SELECT CASE event_type WHEN 'error' THEN 'd' WHEN 'purchase' THEN 'c' ELSE 'u' END AS op,
       CAST(event_id AS VARCHAR) AS order_id, 'USR-' || user_id AS user_id,
       'Product ' || event_type AS product_name, event_type AS category,
       CASE WHEN value >= 5 THEN CAST(floor(value) AS INTEGER) ELSE 0 END AS quantity,
       CASE WHEN value < 200 THEN value ELSE 0.0 END AS unit_price,
       CASE WHEN value < 100 THEN ts ELSE TIMESTAMP '1970-01-01' END AS created_at
FROM events WHERE value >= 1"""
)
def cdc_unwrap_orders(spark, folder):
    """Order images with their defaults: the new one, for a delete the old one."""
    return cdc.unwrap_orders(tables.order_change_log(spark, folder), ["op"])
