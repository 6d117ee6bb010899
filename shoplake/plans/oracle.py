"""DuckDB SQL giving the same rows as each registered query.

Written independently of the Spark code: the adapter rules are applied
directly to the table columns, and the per-device logic uses plain window
functions (the Spark side uses aggregates and bucketed joins instead).
"""

from __future__ import annotations

_GAP_MS = 6 * 3600 * 1000
_JOIN_MS = 30 * 86400 * 1000

_LOG = """
WITH ev AS (
  SELECT event_id AS seq, CAST(user_id AS VARCHAR) AS mid, event_type,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         epoch_us(ts) // 1000 AS ts, ts AS ts0
  FROM events),
rep AS (
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY mid ORDER BY ts, seq) = 1
                 THEN '1' ELSE '0' END AS is_new
  FROM ev)
"""

_LAST_PAGE = "CASE WHEN event_type <> 'view' THEN event_type END"

_CHANGES = """
WITH ch AS (
  SELECT event_id AS seq, event_type AS table_name,
         ['insert', 'insert', 'update', 'delete', 'start'][event_id % 5 + 1] AS op_type,
         event_id, user_id, value, props
  FROM events),
clean AS (SELECT * FROM ch WHERE op_type IN ('insert', 'update')),
cfg(source_table, operate_type, sink_type, sink_table, sink_columns, sink_pk, sink_extend) AS (
  VALUES ('purchase', 'insert', 'kafka', 'dwd_purchase', 'event_id,user_id,value', NULL, NULL),
         ('purchase', 'update', 'kafka', 'dwd_purchase_upd', 'event_id,value', NULL, NULL),
         ('signup', 'insert', 'hbase', 'dim_user', 'user_id,value', 'user_id', NULL),
         ('signup', 'update', 'hbase', 'dim_user', 'user_id,value', 'user_id', NULL),
         ('view', 'insert', 'other', 'x', 'event_id', NULL, NULL)),
routed AS (
  SELECT c.seq, f.sink_type, f.sink_table, f.sink_columns, f.sink_pk, f.sink_extend,
         CASE WHEN list_contains(string_split(f.sink_columns, ','), 'event_id') THEN c.event_id END AS event_id,
         CASE WHEN list_contains(string_split(f.sink_columns, ','), 'user_id') THEN c.user_id END AS user_id,
         CASE WHEN list_contains(string_split(f.sink_columns, ','), 'value') THEN c.value END AS value
  FROM clean c JOIN cfg f ON c.table_name = f.source_table AND c.op_type = f.operate_type)
"""

_ORDERS = f"""
WITH o AS (
  SELECT o_orderkey AS id, o_orderkey % 25 AS province_id, o_orderstatus AS order_status,
         o_custkey AS user_id,
         CAST(CAST(o_totalprice AS DECIMAL(16,2)) AS DOUBLE) AS total_amount,
         CAST(0 AS DOUBLE) AS activity_reduce_amount, CAST(0 AS DOUBLE) AS coupon_reduce_amount,
         CAST(CAST(o_totalprice AS DECIMAL(16,2)) AS DOUBLE) AS original_total_amount,
         CAST(0 AS DOUBLE) AS feight_fee,
         o_orderdate + to_seconds(o_orderkey % 86400) AS ct
  FROM orders),
d AS (
  SELECT l_orderkey * 100 + l_linenumber AS detail_id, l_orderkey AS order_id, l_partkey AS sku_id,
         CAST(CAST(l_extendedprice AS DECIMAL(16,2)) AS DOUBLE) AS order_price,
         CAST(l_quantity AS BIGINT) AS sku_num, 'sku-' || CAST(l_partkey AS VARCHAR) AS sku_name,
         CAST(CAST(l_extendedprice AS DECIMAL(16,2)) AS DOUBLE) AS split_total_amount,
         CAST(CAST(l_discount AS DECIMAL(16,2)) AS DOUBLE) AS split_activity_amount,
         CAST(CAST(l_tax AS DECIMAL(16,2)) AS DOUBLE) AS split_coupon_amount,
         l_shipdate + to_seconds(l_partkey % 86400) AS ct
  FROM lineitem),
w AS (
  SELECT d.detail_id, o.id AS order_id, d.sku_id, d.sku_name, d.order_price, d.sku_num,
         d.split_activity_amount, d.split_coupon_amount, d.split_total_amount,
         o.province_id, o.order_status, o.user_id, o.total_amount,
         o.activity_reduce_amount, o.coupon_reduce_amount, o.original_total_amount, o.feight_fee,
         strftime(o.ct, '%Y-%m-%d %H:%M:%S') AS create_time,
         strftime(o.ct, '%Y-%m-%d') AS create_date,
         strftime(o.ct, '%H') AS create_hour,
         CAST(NULL AS DOUBLE) AS split_feight_fee,
         CAST(NULL AS VARCHAR) AS expire_time, CAST(NULL AS VARCHAR) AS operate_time
  FROM o JOIN d ON o.id = d.order_id
   AND epoch_ms(d.ct) BETWEEN epoch_ms(o.ct) - {_JOIN_MS} AND epoch_ms(o.ct) + {_JOIN_MS})
"""

_KINDS = """'STRING' AS mid_kind, 'BIGINT' AS vc_kind, 'OBJECT' AS geo_kind, false AS has_null, 'BIGINT' AS ts_kind"""
_REST = "'OBJECT' AS err_kind, 'BIGINT' AS code_kind, 'STRING' AS msg_kind, 'ARRAY' AS actions_kind"

ORACLE_SQL: dict[str, str] = {
    "log_start": _LOG + """
SELECT seq, mid, is_new, 'icon' AS start_entry, CAST(k AS BIGINT) AS loading_time, ts
FROM rep WHERE event_type = 'signup'
""",
    "log_page": _LOG + f"""
SELECT seq, mid, is_new, event_type AS page_id, {_LAST_PAGE} AS last_page_id,
       CAST(k AS BIGINT) AS during_time, CAST(k % 4 AS INTEGER) AS n_displays, ts
FROM rep WHERE event_type <> 'signup'
""",
    "log_display": _LOG + f""",
x AS (SELECT *, unnest(generate_series(1, k % 4)) AS i FROM rep WHERE event_type <> 'signup')
SELECT seq, CAST(i - 1 AS INTEGER) AS display_pos, mid, is_new, event_type AS page_id,
       {_LAST_PAGE} AS last_page_id,
       ['activity', 'promotion', 'query', 'recommend'][((k + i) % 4) + 1] AS display_type,
       CAST(k * 10 + i AS VARCHAR) AS item, CAST(i AS INTEGER) AS display_order,
       CAST(k AS BIGINT) AS during_time, ts
FROM x
""",
    "published_start": _LOG + f"""
SELECT seq, is_new, k + 0.5::DOUBLE AS lat, {_KINDS}, 'OBJECT' AS start_kind, 'BIGINT' AS time_kind, {_REST}
FROM rep WHERE event_type = 'signup'
""",
    "published_page": _LOG + f"""
SELECT seq, is_new, k + 0.5::DOUBLE AS lat, {_KINDS}, 'BIGINT' AS during_kind,
       CASE WHEN k % 4 > 0 THEN 'BIGINT' END AS order_kind, CASE WHEN k % 4 > 0 THEN 'STRING' END AS item_kind, {_REST}
FROM rep WHERE event_type <> 'signup'
""",
    "published_display": _LOG + f""",
x AS (SELECT *, unnest(generate_series(1, k % 4)) AS i FROM rep WHERE event_type <> 'signup')
SELECT seq, is_new, k + 0.5::DOUBLE AS lat, {_KINDS}, 'BIGINT' AS during_kind, 'BIGINT' AS order_kind, 'STRING' AS item_kind
FROM x
""",
    "published_topic": _CHANGES + """
SELECT sink_table AS topic, seq, event_id, value, true AS event_id_is_number,
       CASE WHEN user_id IS NOT NULL THEN true END AS user_id_is_number, CASE WHEN value IS NOT NULL THEN true END AS value_is_number
FROM routed WHERE sink_type = 'kafka'
""",
    "new_visitor_repair": _LOG + """
SELECT seq, mid, ts, is_new FROM rep
""",
    "unique_visitor_daily": _LOG + f""",
p AS (
  SELECT *, strftime(ts0, '%Y-%m-%d') AS visit_date FROM rep WHERE event_type <> 'signup'),
r AS (
  SELECT *, row_number() OVER (PARTITION BY mid, visit_date ORDER BY ts, seq) AS rn FROM p)
SELECT mid, visit_date, seq, ts, event_type AS page_id, {_LAST_PAGE} AS last_page_id, is_new
FROM r WHERE rn = 1
""",
    "bounce_strict": _LOG + f""",
p AS (SELECT seq, mid, ts, event_type AS page_id, event_type = 'view' AS is_entry
      FROM ev WHERE event_type <> 'signup'),
n AS (SELECT *, lead(ts) OVER w AS nts, lead(is_entry) OVER w AS n_entry
      FROM p WINDOW w AS (PARTITION BY mid ORDER BY ts, seq))
SELECT seq, mid, ts, page_id FROM n
WHERE is_entry AND (nts IS NULL OR nts - ts >= {_GAP_MS})
""",
    "bounce_reentry": _LOG + f""",
p AS (SELECT seq, mid, ts, event_type AS page_id, event_type = 'view' AS is_entry
      FROM ev WHERE event_type <> 'signup'),
n AS (SELECT *, lead(ts) OVER w AS nts, lead(is_entry) OVER w AS n_entry
      FROM p WINDOW w AS (PARTITION BY mid ORDER BY ts, seq))
SELECT seq, mid, ts, page_id FROM n
WHERE is_entry AND (nts IS NULL OR nts - ts >= {_GAP_MS} OR n_entry)
""",
    "cdc_clean": _CHANGES + """
SELECT seq, table_name, op_type, event_id, user_id, value, props FROM clean
""",
    "cdc_route_topic": _CHANGES + """
SELECT sink_table AS topic, seq, event_id, user_id, value FROM routed WHERE sink_type = 'kafka'
""",
    "cdc_route_versions": """
WITH c AS (
  SELECT event_id AS seq, event_type AS tbl, CASE WHEN event_id % 5 = 2 THEN 'update' ELSE 'insert' END AS typ, event_id, user_id, value
  FROM events WHERE event_id % 5 IN (0, 1, 2)
), v AS (
  SELECT event_id AS config_seq, event_type AS tbl, event_id // 40 AS n,
         CASE WHEN (event_id // 160) % 2 = 0 THEN 'insert' ELSE 'update' END AS typ
  FROM events WHERE event_id % 40 = 0 AND (event_id // 40) % 4 IN (0, 2)
)
SELECT c.seq, v.config_seq, CASE WHEN n % 3 = 0 THEN 'hbase' ELSE 'kafka' END AS sink_type, 'v' || v.config_seq AS sink_table, c.tbl AS table_name,
       c.event_id, CASE WHEN n % 2 = 0 THEN c.user_id END AS user_id, c.value
FROM c ASOF JOIN v ON c.tbl = v.tbl AND c.typ = v.typ AND c.seq >= v.config_seq
""",
    "cdc_route_dim": _CHANGES + """
SELECT sink_table, seq, user_id AS pk, user_id, value FROM routed WHERE sink_type = 'hbase'
""",
    "dim_upsert_latest": _CHANGES + """,
r AS (SELECT *, row_number() OVER (PARTITION BY sink_table, user_id ORDER BY seq DESC) AS rn
      FROM routed WHERE sink_type = 'hbase')
SELECT sink_table, user_id, value, seq FROM r WHERE rn = 1
""",
    "dim_table_schema": _CHANGES + """,
f AS (SELECT *, row_number() OVER (PARTITION BY sink_table ORDER BY seq) AS rn
      FROM routed WHERE sink_type = 'hbase'),
c AS (SELECT sink_table, sink_pk, sink_extend,
             unnest(string_split(sink_columns, ',')) AS column_name,
             unnest(generate_series(0, len(string_split(sink_columns, ',')) - 1)) AS pos
      FROM f WHERE rn = 1)
SELECT sink_table, CAST(pos AS INTEGER) AS position, column_name, 'string' AS data_type,
       list_contains(string_split(coalesce(sink_pk, 'id'), ','), column_name) AS is_pk,
       coalesce(sink_extend, '') AS extend
FROM c
""",
    "order_interval_join": _ORDERS + """
SELECT * FROM w
""",
    "order_wide_dims": _ORDERS + """
SELECT w.*, n.n_name AS province_name, r.r_name AS province_area,
       c.c_name AS user_name, c.c_mktsegment AS user_segment,
       p.p_name AS spu_name, p.p_brand AS tm_name, p.p_type AS category3_name
FROM w
LEFT JOIN nation n ON w.province_id = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN customer c ON w.user_id = c.c_custkey
LEFT JOIN part p ON w.sku_id = p.p_partkey
""",
    "order_wide_six_dims": _ORDERS + """,
sku AS (SELECT p_partkey AS id, p_partkey % 500 AS spu_id, p_partkey % 100 AS tm_id,
               length(p_type) * 256 + ascii(p_type) AS category3_id, p_name, p_type FROM part),
spu AS (SELECT spu_id AS id, max_by(p_name, id) AS spu_name FROM sku GROUP BY 1),
cat AS (SELECT DISTINCT category3_id AS id, p_type AS name FROM sku)
SELECT w.detail_id, w.order_id, w.user_id, w.sku_id, n.n_name AS province_name, r.r_name AS province_area,
       c.c_name AS user_name, c.c_mktsegment AS user_segment,
       CAST(sku.spu_id AS VARCHAR) AS spu_id, CAST(sku.tm_id AS VARCHAR) AS tm_id, CAST(sku.category3_id AS VARCHAR) AS category3_id,
       spu.spu_name, s.s_name AS tm_name, cat.name AS category3_name
FROM w
LEFT JOIN nation n ON w.province_id = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN customer c ON w.user_id = c.c_custkey AND c.c_mktsegment <> 'BUILDING'
LEFT JOIN sku ON w.sku_id = sku.id
LEFT JOIN spu ON sku.spu_id = spu.id
LEFT JOIN supplier s ON sku.tm_id = s.s_suppkey
LEFT JOIN cat ON sku.category3_id = cat.id
""",
    "raw_landing_daily": """
SELECT strftime(ts, '%Y-%m-%d') AS landing_date, count(*) AS n_lines,
       min(epoch_us(ts) // 1000) AS first_ts, max(epoch_us(ts) // 1000) AS last_ts
FROM events GROUP BY 1
""",
}
ORACLE_SQL["cdc_route_versions_topic"] = f"SELECT sink_table AS topic, seq, event_id, user_id, value FROM ({ORACLE_SQL['cdc_route_versions']}) WHERE sink_type = 'kafka'"
