"""DuckDB SQL of the logical tables, the counterpart of ``sources.tables``."""

USER_SCORES = """user_scores AS (
  SELECT 'USR-' || user_id AS user_id, lpad(CAST(user_id % 15 AS VARCHAR), 10, '0') AS team_id,
         'Team-' || (user_id % 15) AS team_name, CAST(floor(value) AS INTEGER) AS score,
         (epoch_us(ts) // 1000) AS event_time_millis, strftime(ts, '%Y-%m-%d %H:%M:%S') AS readable_time,
         event_type, date_trunc('millisecond', ts) AS event_time
  FROM events)"""

BIDS = """bids AS (
  SELECT CAST(event_id AS VARCHAR) AS order_id, event_type AS item,
         CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR) AS price,
         'S-' || (user_id % 8) AS supplier, date_trunc('millisecond', ts) AS bid_time
  FROM events)"""

DIRTY_BIDS = BIDS + """, dirty_bids AS (
  SELECT order_id, item,
         CASE item WHEN 'error' THEN 'n/a' WHEN 'signup' THEN NULL ELSE price END AS price,
         CASE WHEN item <> 'view' THEN supplier END AS supplier,
         CASE WHEN CAST(price AS DOUBLE) >= 1 THEN bid_time END AS bid_time,
         CASE WHEN CAST(price AS DOUBLE) < 1 THEN 'unknown'
              ELSE CAST(epoch_ms(bid_time) AS VARCHAR) END AS bid_time_text,
         bid_time + INTERVAL 1 SECOND AS arrived_at
  FROM bids)"""

CHANGE_LOG = """raw_changes AS (
  SELECT event_id AS seq,
         CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
         'USR-' || user_id AS user_id,
         CASE WHEN event_type <> 'purchase' THEN 'First' || user_id END AS first_name,
         'Last' || user_id AS last_name,
         'u' || user_id || '.v' || event_id || '@example.com' AS email,
         CASE WHEN value < 200
              THEN lpad(CAST(CAST(floor(value) AS BIGINT) AS VARCHAR), 5, '0') END AS postal_code,
         CASE WHEN value < 100 THEN ts END AS created_at,
         value >= 1 AS has_image,
         CASE WHEN value >= 2 THEN (epoch_us(ts) // 1000) WHEN value >= 1 THEN (epoch_us(ts) // 1000) + 5 END AS at_ms
  FROM events)"""

PURCHASES = """purchases AS (
  SELECT CAST(event_id AS VARCHAR) AS order_id, 'USR-' || user_id AS user_id,
         'Product ' || json_extract_string(props, '$.k') AS product_name,
         'Category ' || substr(json_extract_string(props, '$.k'), 1, 1) AS category,
         CAST(floor(value) + 1 AS INTEGER) AS quantity, value AS unit_price,
         date_trunc('millisecond', ts) AS created_at
  FROM events WHERE event_type = 'purchase')"""

VERSIONS = """versions AS (
  SELECT 'USR-' || user_id AS user_id, 'First' || user_id AS first_name,
         'Last' || user_id AS last_name,
         'u' || user_id || '.v' || event_id || '@example.com' AS email,
         lpad(CAST(CAST(floor(value) AS BIGINT) AS VARCHAR), 5, '0') AS postal_code,
         date_trunc('millisecond', ts) AS version_at
  FROM events WHERE event_type = 'signup')"""

SHOP = """shop_orders AS (
  SELECT l_orderkey || '-' || l_linenumber AS order_id, CAST(o_custkey AS VARCHAR) AS user_id,
         'Part ' || l_partkey AS product_name, o_orderpriority AS category,
         CAST(floor(l_quantity) AS INTEGER) AS quantity,
         l_extendedprice / nullif(l_quantity, 0) AS unit_price,
         o_orderdate AS created_at
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
shop_users AS (
  SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_mktsegment AS first_name, c_name AS last_name,
         'c' || c_custkey || '@example.com' AS email,
         lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS postal_code
  FROM customer)"""

STATUS_CHANGES = """status_changes AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
         l_linenumber || '-' || l_partkey || '-' || l_returnflag || '-' || l_linestatus AS seq,
         l_shipdate AS changed_at,
         CASE WHEN l_returnflag = 'R' THEN 'Returned'
              WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'Delivered'
              WHEN l_linestatus = 'F' THEN 'Shipped'
              WHEN l_returnflag = 'A' THEN 'Cancelled'
              ELSE 'Processing' END AS status
  FROM lineitem)"""

LINES = """lines AS (
  SELECT 'S-' || (l_suppkey % 20) AS supplier, CAST(l_extendedprice AS DECIMAL(12,2)) AS amount,
         l_linestatus = 'F' AS moves, 'S-' || ((l_suppkey + 1) % 20) AS next_supplier,
         l_returnflag = 'R' AS returned, (l_suppkey + CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) % 20 >= 8 AS closed
  FROM lineitem),
line_states AS (
  SELECT step, CASE WHEN moves AND step > 1 THEN next_supplier ELSE supplier END AS supplier,
         CASE WHEN moves AND step > 1 THEN amount + 1 ELSE amount END AS amount
  FROM lines, (SELECT unnest(range(1, 5)) AS step)
  WHERE NOT (returned AND step > 2) AND NOT (closed AND step > 3))"""

MESSAGES = """messages_full AS (
  SELECT CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2
              WHEN 'signup' THEN 3 WHEN 'view' THEN 4 END AS "partition",
         event_id AS "offset", 'USR-' || user_id AS key, event_type, value AS v,
         '{"order_id":"' || event_id || '","amount":' ||
         CASE WHEN event_type = 'error' AND value > 50 THEN '"rather a lot"'
              WHEN event_type = 'view' THEN '"' || CAST(value AS VARCHAR) || '"'
              WHEN event_type = 'signup' AND value > 50 THEN 'null'
              ELSE CAST(value AS VARCHAR) END || ',"status":"' || event_type || '"}' AS full_text,
         date_trunc('millisecond', ts) AS "timestamp"
  FROM events),
messages AS (
  SELECT "partition", "offset", key,
         CASE WHEN event_type = 'click' AND v > 100 THEN substr(full_text, 1, 24)
              ELSE full_text END AS value, "timestamp"
  FROM messages_full),
judged AS (
  SELECT *, json_valid(value) AS readable,
         CASE WHEN json_valid(value) THEN json_extract_string(value, '$.amount') END AS amount_text
  FROM messages),
verdicts AS (
  SELECT *, TRY_CAST(amount_text AS DECIMAL(38,18)) AS amount,
         CASE WHEN NOT readable THEN 'unreadable json' WHEN amount_text IS NULL THEN 'no amount'
              WHEN TRY_CAST(amount_text AS DECIMAL(38,18)) IS NULL
              THEN 'amount is not a number' END AS reason
  FROM judged)"""

BOARD_LOG = """board_log AS (
  SELECT 'USR-' || user_id AS key,
         CASE WHEN event_type <> 'error'
              THEN event_type || ':' || CAST(CAST(floor(value / 50) AS BIGINT) AS VARCHAR) END AS value,
         event_id AS "offset"
  FROM events)"""

AS_OF = PURCHASES + ", " + VERSIONS + """, matched AS (
  SELECT p.*,
         CASE WHEN b.user_id IS NOT NULL THEN b.first_name
              WHEN a.version_at <= p.created_at + INTERVAL 30 SECOND THEN a.first_name END AS user_first_name,
         CASE WHEN b.user_id IS NOT NULL THEN b.last_name
              WHEN a.version_at <= p.created_at + INTERVAL 30 SECOND THEN a.last_name END AS user_last_name,
         CASE WHEN b.user_id IS NOT NULL THEN b.email
              WHEN a.version_at <= p.created_at + INTERVAL 30 SECOND THEN a.email END AS user_email,
         CASE WHEN b.user_id IS NOT NULL THEN b.postal_code
              WHEN a.version_at <= p.created_at + INTERVAL 30 SECOND THEN a.postal_code END AS user_postal_code,
         CASE WHEN b.user_id IS NOT NULL OR a.version_at <= p.created_at + INTERVAL 30 SECOND
              THEN 'enriched' ELSE 'missing' END AS route
  FROM purchases p
  ASOF LEFT JOIN versions b ON p.user_id = b.user_id AND p.created_at >= b.version_at
  ASOF LEFT JOIN versions a ON p.user_id = a.user_id AND p.created_at < a.version_at)"""


def query(tables: str, select: str) -> str:
    return f"WITH {tables}\n{select}"
