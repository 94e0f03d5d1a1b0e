"""Queries that write through a sink and return what a reader then finds."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import daily, enrich, leaderboard
from ..operators.changelog import diff_boards
from ..operators.records import project_orders
from ..schemas import CATEGORY_DAILY_STATS, ORDERS_TABLE, record
from ..session import fresh_folder
from ..sinks import keyed, lake, text
from ..sinks.log import upsert_messages
from ..sinks.routes import write_by_topic
from ..sources import tables
from ..sources.files import read_csv_text
from .batch import TEAM_MVPS, TOP_PLAYERS
from .oracle_tables import AS_OF, BIDS, PURCHASES, USER_SCORES, query
from .registry import Registry

REGISTRY = Registry()
add = REGISTRY.add


def _dated(spark, folder):
    return project_orders(tables.bids(spark, folder)).withColumn(
        "bid_date", F.date_format("bid_time", "yyyy-MM-dd")
    )


DATED_SCHEMA = T.StructType([*ORDERS_TABLE.fields, T.StructField("bid_date", T.StringType())])


@add(
    query(
        BIDS,
        """SELECT order_id, item, CAST(price AS DECIMAL(10,2)) AS price, supplier, bid_time,
       strftime(bid_time, '%Y-%m-%d') AS bid_date
FROM bids""",
    )
)
def ingest_orders_daily(spark, folder):
    path = fresh_folder(spark, "orders")
    lake.append(_dated(spark, folder), path, ["bid_date"])
    return spark.read.schema(DATED_SCHEMA).parquet(path)


@add(
    query(
        BIDS,
        """SELECT order_id, item, CAST(price AS DECIMAL(10,2)) AS price, supplier, bid_time FROM bids
WHERE bid_time >= TIMESTAMP '2024-01-10 06:00:00' AND bid_time < TIMESTAMP '2024-01-12 18:00:00'""",
    )
)
def scan_pruned_days(spark, folder):
    """A time range of a table partitioned by the day of a time: only its three days are opened."""
    path = fresh_folder(spark, "days")
    lake.append(project_orders(tables.bids(spark, folder)), path, ["days(bid_time)"])
    schema = T.StructType([*ORDERS_TABLE.fields, T.StructField(lake.day_column("bid_time"), T.DateType())])
    stored = spark.read.schema(schema).parquet(path)
    return lake.between(stored, "bid_time", "2024-01-10 06:00:00", "2024-01-12 18:00:00")


DAILY = """SELECT category, CAST(created_at AS DATE) AS report_date,
       CAST(round(SUM({quantity} * unit_price), 2) AS DECIMAL(15,2)) AS total_revenue,
       COUNT(*) AS total_orders
FROM purchases {where} GROUP BY 1, 2"""
RESTATED = DAILY.format(
    quantity="(quantity + 1)", where="WHERE created_at >= TIMESTAMP '2024-01-20'"
)


def _restated_table(spark, folder, overwrite):
    """Daily statistics of all purchases, then a restatement of the last days through ``overwrite``."""
    purchases = tables.purchases(spark, folder)
    path = fresh_folder(spark, "daily")
    lake.append(daily.category_daily_stats(purchases), path, ["report_date"])
    restated = purchases.where(
        F.col("created_at") >= F.lit("2024-01-20").cast("timestamp")
    ).withColumn("quantity", F.col("quantity") + 1)
    overwrite(daily.category_daily_stats(restated), path, ["report_date"])
    return spark.read.schema(CATEGORY_DAILY_STATS).parquet(path)


@add(query(PURCHASES, RESTATED))
def overwrite_static(spark, folder):
    return _restated_table(spark, folder, lake.overwrite_table)


@add(
    query(
        PURCHASES,
        DAILY.format(quantity="quantity", where="WHERE created_at < TIMESTAMP '2024-01-20'")
        + "\nUNION ALL\n"
        + RESTATED,
    )
)
def overwrite_dynamic(spark, folder):
    return _restated_table(spark, folder, lake.overwrite_partitions)


PLAYERS = record(user_id="string", first_seen="timestamp", total_score="long")
PLAYER_HALVES = USER_SCORES + """,
old AS (SELECT user_id, MIN(event_time) AS first_seen, CAST(SUM(score) AS BIGINT) AS total_score
        FROM user_scores WHERE event_time < TIMESTAMP '2024-01-03' GROUP BY 1),
new AS (SELECT user_id, MIN(event_time) AS first_seen, CAST(SUM(score) AS BIGINT) AS total_score
        FROM user_scores WHERE event_time >= TIMESTAMP '2024-01-03' GROUP BY 1)"""


def _upserted(spark, folder, fields):
    scores = tables.user_scores(spark, folder)
    cut = F.lit("2024-01-03").cast("timestamp")

    def summary(rows):
        return rows.groupBy("user_id").agg(
            F.min("event_time").alias("first_seen"), F.sum("score").alias("total_score")
        )

    table = keyed.KeyedTable(fresh_folder(spark, "players"), PLAYERS, ["user_id"])
    table.create(summary(scores.where(F.col("event_time") < cut)))
    table.upsert(summary(scores.where(F.col("event_time") >= cut)), fields)
    return table.read(spark)


@add(
    query(
        PLAYER_HALVES,
        """SELECT user_id, coalesce(n.first_seen, o.first_seen) AS first_seen,
       coalesce(n.total_score, o.total_score) AS total_score
FROM old o FULL JOIN new n USING (user_id)""",
    )
)
def upsert_by_key(spark, folder):
    return _upserted(spark, folder, None)


@add(
    query(
        PLAYER_HALVES,
        """SELECT user_id, coalesce(o.first_seen, n.first_seen) AS first_seen,
       coalesce(n.total_score, o.total_score) AS total_score
FROM old o FULL JOIN new n USING (user_id)""",
    )
)
def upsert_subset_fields(spark, folder):
    """The first sighting of a known player stays."""
    return _upserted(spark, folder, ["total_score"])


@add(
    query(
        USER_SCORES + """, old_scores AS (
  SELECT * FROM user_scores WHERE event_time < TIMESTAMP '2024-01-16'),
old_board AS (""" + TOP_PLAYERS.replace("user_scores", "old_scores") + """),
new_board AS (""" + TOP_PLAYERS + ")",
        """SELECT CAST(n.rnk AS VARCHAR) AS key,
       '{"user_id":"' || n.user_id || '","team_name":"' || n.team_name ||
       '","total_score":' || n.total_score || '}' AS value
FROM old_board o FULL JOIN new_board n ON o.rnk = n.rnk
WHERE (o.user_id, o.team_name, o.total_score) IS DISTINCT FROM (n.user_id, n.team_name, n.total_score)
  AND n.rnk IS NOT NULL""",
    )
)
def upsert_log_messages(spark, folder):
    """Board changes as messages of a compacted log."""
    scores = tables.user_scores(spark, folder)
    first_half = scores.where(F.col("event_time") < F.lit("2024-01-16").cast("timestamp"))
    changes = diff_boards(leaderboard.top_players(first_half), leaderboard.top_players(scores))
    return upsert_messages(changes)


@add(query(BIDS, "SELECT item AS topic, order_id, price, supplier, bid_time FROM bids"))
def route_by_topic(spark, folder):
    path = fresh_folder(spark, "topics")
    rows = tables.bids(spark, folder).withColumnRenamed("item", "topic")
    write_by_topic(rows, path)
    return spark.read.schema(rows.schema).parquet(path)


TSV_FIELD = "replace(replace(replace(replace({}, '\\', '\\\\'), chr(9), '\\t'), chr(10), '\\n'), chr(13), '\\r')"
SQL_TIME = """CASE WHEN epoch_us(created_at) % 1000000 = 0
            THEN strftime(created_at, '%Y-%m-%d %H:%M:%S') || '.0'
            ELSE rtrim(strftime(created_at, '%Y-%m-%d %H:%M:%S.%f'), '0') END"""
ORDER_JSON = """'{"order_id":"' || order_id || '","user_id":"' || user_id || '","product_name":"' ||
       product_name || '","category":"' || category || '","quantity":' || quantity ||
       ',"unit_price":' || CAST(unit_price AS VARCHAR) || ',"created_at":' || coalesce('"' ||
       CASE WHEN epoch_ms(created_at) % 1000 = 0 THEN strftime(created_at, '%Y-%m-%dT%H:%M:%SZ')
            ELSE strftime(created_at, '%Y-%m-%dT%H:%M:%S.%gZ') END || '"', 'null') || '}'"""
TSV_TAIL = " || chr(9) || ".join(
    f"coalesce({c}, '\\N')"
    for c in ("user_first_name", "user_last_name", "user_email", "user_postal_code")
)


@add(
    query(
        AS_OF,
        f"""SELECT order_id || chr(9) || user_id || chr(9) || product_name || chr(9) || category ||
       chr(9) || quantity || chr(9) || CAST(unit_price AS VARCHAR) || chr(9) || {SQL_TIME}
       || chr(9) || {TSV_TAIL} AS line
FROM matched""",
    )
)
def tsv_export(spark, folder):
    matched = enrich.match_as_of(
        tables.purchases(spark, folder), tables.user_versions(spark, folder)
    )
    path = fresh_folder(spark, "tsv")
    text.write_lines(text.tsv_lines(enrich.sink_shape(matched)), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@add(
    f"""SELECT doc_id || chr(9) || {TSV_FIELD.format("lang")} || chr(9) ||
       {TSV_FIELD.format("source")} || chr(9) || {TSV_FIELD.format("text")} AS line
FROM documents"""
)
def tsv_export_texts(spark, folder):
    """Whole texts with tabs and line breaks survive as one line each."""
    documents = tables.table(spark, folder, "documents")
    path = fresh_folder(spark, "tsv")
    text.write_lines(text.tsv_lines(documents, ["doc_id", "lang", "source", "text"]), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@add(
    query(
        AS_OF,
        f"""SELECT {ORDER_JSON} AS line
FROM matched WHERE route = 'missing'""",
    )
)
def dlq_json(spark, folder):
    matched = enrich.match_as_of(
        tables.purchases(spark, folder), tables.user_versions(spark, folder)
    )
    path = fresh_folder(spark, "dead-letters")
    text.write_lines(text.json_lines(enrich.dead_letter(matched)), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@add(
    query(
        BIDS,
        """SELECT item AS topic, COUNT(*) AS records, true AS files_within_limit
FROM bids GROUP BY 1""",
    )
)
def jsonl_sink_counts(spark, folder):
    path = fresh_folder(spark, "jsonl")
    rows = tables.bids(spark, folder).withColumnRenamed("item", "topic")
    writers = spark.sparkContext.defaultParallelism
    text.write_json_files(rows, path, ["topic"], writers=writers)
    per_file = (
        spark.read.schema(rows.schema)
        .json(path)
        .groupBy("topic", F.col("_metadata.file_path").alias("file"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return per_file.groupBy("topic").agg(
        F.sum("n").alias("records"), (F.max("n") <= 100).alias("files_within_limit")
    )


@add(query(BIDS, "SELECT item AS topic, order_id, price, supplier, bid_time FROM bids"))
def jsonl_sink_rows(spark, folder):
    """What a reader finds in the files."""
    path = fresh_folder(spark, "jsonl")
    rows = tables.bids(spark, folder).withColumnRenamed("item", "topic")
    text.write_json_files(rows, path, ["topic"], writers=spark.sparkContext.defaultParallelism)
    found = spark.read.schema(rows.schema).json(path)
    return found.select("topic", "order_id", "price", "supplier", "bid_time")


@add(
    """SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name,
       CAST(s_nationkey AS VARCHAR) AS s_nationkey, CAST(s_acctbal AS VARCHAR) AS s_acctbal
FROM supplier"""
)
def scan_csv_roundtrip(spark, folder):
    suppliers = tables.table(spark, folder, "supplier")
    path = fresh_folder(spark, "csv")
    suppliers.write.option("header", True).csv(path)
    return read_csv_text(spark, path, suppliers.columns)


@add(
    query(
        USER_SCORES,
        f"""SELECT rnk, user_id, team_name, player_total, team_total,
       contrib_ratio * 100 AS contrib_ratio FROM ({TEAM_MVPS})""",
    )
)
def leaderboard_read(spark, folder):
    """A stored board, read by rank with the ratio in percent."""
    board = leaderboard.team_mvps(tables.user_scores(spark, folder))
    path = fresh_folder(spark, "board")
    lake.overwrite_table(board, path)
    stored = spark.read.schema(board.schema).parquet(path)
    return leaderboard.as_dashboard(stored, "contrib_ratio")
