"""Independent DuckDB SQL for every registered query (same names, same column names).

Written from the semantics, not from the Spark code: the views ``events``,
``orders`` … are the driver's Parquet tables. Epoch ms is ``epoch_us // 1000``
(truncation, as Spark's), money sums add decimals.
"""

from __future__ import annotations

D = "2024-01-15"
PREV = "2024-01-14"
SPLIT = "2024-01-15 12:00:00"

# default topic names (same as actimetry.schemas)
TOPIC_START = "startup_log"
TOPIC_EVENT = "event_log"

LOGS = """logs AS (
  SELECT event_id AS seq, CAST(user_id AS VARCHAR) AS mid, CAST(user_id AS VARCHAR) AS uid,
         CASE WHEN event_type = 'view' THEN 'startup' WHEN event_type IS NOT NULL THEN 'event' END AS type,
         CASE WHEN event_type <> 'view' THEN event_type END AS evid,
         epoch_us(ts) // 1000 AS ts,
         strftime(ts, '%Y-%m-%d') AS log_date, strftime(ts, '%H') AS log_hour,
         ts AS raw_ts, props
  FROM events)"""
STARTUP = """startup AS (SELECT * FROM logs WHERE type = 'startup')"""
DAU = """dau AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY mid, log_date ORDER BY ts, seq) AS rn FROM startup) t
  WHERE rn = 1)"""
ORDERS = """ord AS (
  SELECT event_id AS order_id, strftime(ts, '%Y-%m-%d') AS create_date,
         strftime(ts, '%H') AS create_hour, value AS amount
  FROM events WHERE event_type = 'purchase')"""
FIRST = f"""firsts AS (
  SELECT mid, min(log_date) AS first_date, arg_min(log_hour, log_date) AS first_hour
  FROM dau WHERE log_date <= '{D}' GROUP BY mid)"""
BATCHES = f"""seen AS (
  SELECT DISTINCT mid, log_date FROM startup WHERE raw_ts < TIMESTAMP '{SPLIT}'),
batch AS (SELECT * FROM startup WHERE raw_ts >= TIMESTAMP '{SPLIT}')"""

MONEY = "CAST(sum(CAST(amount AS DECIMAL(28, 8))) AS DOUBLE)"
DAU_OUT = "seq, mid, uid, type, ts, log_date, log_hour"
LOG_OUT = "seq, mid, uid, type, evid, ts, log_date, log_hour"

_MID = "CAST(user_id AS VARCHAR)"
LINE = f"""CASE WHEN event_type = 'view'
  THEN json_object('type', 'startup', 'mid', {_MID}, 'uid', {_MID}, 'seq', event_id)
  ELSE json_object('type', 'event', 'mid', {_MID}, 'uid', {_MID}, 'evid', event_type,
                   'itemid', TRY_CAST(props->>'$.k' AS INTEGER), 'seq', event_id) END"""
STAMPED = f"""CASE WHEN event_type = 'view'
  THEN json_object('type', 'startup', 'mid', {_MID}, 'uid', {_MID}, 'seq', event_id,
                   'ts', epoch_us(ts) // 1000)
  ELSE json_object('type', 'event', 'mid', {_MID}, 'uid', {_MID}, 'evid', event_type,
                   'itemid', TRY_CAST(props->>'$.k' AS INTEGER), 'seq', event_id,
                   'ts', epoch_us(ts) // 1000) END"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


W_LOGS = _with(LOGS)
W_START = _with(LOGS, STARTUP)
W_DAU = _with(LOGS, STARTUP, DAU)
W_ORD = _with(ORDERS)
W_FIRST = _with(LOGS, STARTUP, DAU, FIRST)
W_BATCH = _with(LOGS, STARTUP, BATCHES)


def _hour_doc(pairs_sql: str) -> str:
    """``{yesterday: map, today: map}`` JSON from a (period, hour, value) relation."""
    def fold(p):
        return (f"coalesce(map_from_entries(list({{'k': hour, 'v': value}} ORDER BY hour) "
                f"FILTER (WHERE period = '{p}')), MAP {{}})")
    return f"SELECT CAST(to_json({{'yesterday': {fold('yesterday')}, 'today': {fold('today')}}}) AS VARCHAR) AS doc FROM ({pairs_sql}) p"


def _period(col: str) -> str:
    return f"CASE WHEN {col} = '{D}' THEN 'today' ELSE 'yesterday' END"


DAU_PAIRS = (f"SELECT {_period('log_date')} AS period, log_hour AS hour, count(*) AS value "
             f"FROM dau WHERE log_date IN ('{PREV}', '{D}') GROUP BY 1, 2")
GMV_PAIRS = (f"SELECT {_period('create_date')} AS period, create_hour AS hour, {MONEY} AS value "
             f"FROM ord WHERE create_date IN ('{PREV}', '{D}') GROUP BY 1, 2")
NEW_PAIRS = (f"SELECT {_period('first_date')} AS period, first_hour AS hour, count(*) AS value "
             f"FROM firsts WHERE first_date IN ('{PREV}', '{D}') GROUP BY 1, 2")
NEW_TOTAL = f"SELECT count(*) FROM firsts WHERE first_date = '{D}'"
DAU_TABLE = (f"SELECT {DAU_OUT}, CAST(CASE WHEN raw_ts < TIMESTAMP '{SPLIT}' THEN 0 ELSE 1 END AS BIGINT) "
             f"AS batch_id FROM dau")

ORACLE: dict[str, str] = {
    # sources
    "s1_stream_source": W_LOGS + f"SELECT {LOG_OUT} FROM logs",
    "s2_raw_ingest": f"SELECT CAST({LINE} AS VARCHAR) AS value FROM events",
    "s3_dau_scan": W_DAU + f"SELECT * FROM ({DAU_TABLE}) t WHERE log_date = '{D}'",
    "s4_seen_keys": W_DAU + f"SELECT mid FROM dau WHERE log_date = '{D}'",
    "s5_order_scan": W_ORD + "SELECT order_id, create_date, create_hour, amount FROM ord",
    # sinks
    "k1_routed_sink": (f"SELECT CASE WHEN event_type = 'view' THEN '{TOPIC_START}' ELSE '{TOPIC_EVENT}' END "
                       f"AS topic, CAST({STAMPED} AS VARCHAR) AS value FROM events"),
    "k2_raw_archive": f"SELECT strftime(ts, '%Y-%m-%d') AS dt, CAST({STAMPED} AS VARCHAR) AS value FROM events",
    "k3_dau_sink": W_DAU + DAU_TABLE,
    "k4_seen_write": W_START + "SELECT DISTINCT mid, log_date FROM startup",
    "k5_preview": W_DAU + f"SELECT {DAU_OUT} FROM dau ORDER BY ts, seq LIMIT 10",
    "k6_json_result": W_FIRST + W_ORD.replace("WITH ", ", ", 1) + f"""
SELECT '[' || string_agg(j, ',' ORDER BY o) || ']' AS doc FROM (
  SELECT 0 AS o, CAST(json_object('id', 'dau', 'name', '新增日活', 'value',
         (SELECT count(*) FROM dau WHERE log_date = '{D}')) AS VARCHAR) AS j
  UNION ALL SELECT 1, CAST(json_object('id', 'new_id', 'name', '新增设备', 'value', ({NEW_TOTAL})) AS VARCHAR)
  UNION ALL SELECT 2, CAST(json_object('id', 'order_amount', 'name', '新增交易额', 'value',
         (SELECT {MONEY} FROM ord WHERE create_date = '{D}')) AS VARCHAR)) t""",
    # projections
    "p1_json_parse": W_LOGS + """SELECT type, mid, uid, NULL::VARCHAR AS appid, NULL::VARCHAR AS area,
  NULL::VARCHAR AS os, NULL::VARCHAR AS ch, NULL::VARCHAR AS vs, evid, NULL::INTEGER AS pgid,
  NULL::INTEGER AS npgid, CASE WHEN type = 'event' THEN TRY_CAST(props->>'$.k' AS INTEGER) END AS itemid,
  seq, ts, NULL::VARCHAR AS _corrupt_record FROM logs""",
    "p2_json_field": W_LOGS + "SELECT seq, type, CASE WHEN type = 'event' THEN props->>'$.k' END AS itemid FROM logs",
    "p3_stamp_ts": f"SELECT CAST({STAMPED} AS VARCHAR) AS value FROM events",
    "p4_date_hour": W_LOGS + "SELECT seq, ts, strftime(raw_ts, '%Y-%m-%d %H') AS date_hour FROM logs",
    "p5_split_parts": W_LOGS + "SELECT seq, log_date, log_hour FROM logs",
    "p6_derive_cols": W_LOGS + f"SELECT {LOG_OUT} FROM logs",
    "p7_composite_key": W_START + "SELECT seq, mid || '_' || log_date AS dedup_key FROM startup",
    "p8_namespaced_key": W_DAU + "SELECT mid, 'DAU:' || log_date AS set_key FROM dau",
    "p9_as_of_date": "SELECT strftime(max(ts), '%Y-%m-%d') AS as_of FROM events",
    "p10_prev_day": W_LOGS + """SELECT log_date, strftime(CAST(log_date AS DATE) - 1, '%Y-%m-%d') AS prev_date
  FROM (SELECT DISTINCT log_date FROM logs) t""",
    "p11_upper_columns": W_DAU + """SELECT mid AS MID, uid AS UID, NULL::VARCHAR AS APPID, NULL::VARCHAR AS AREA,
  NULL::VARCHAR AS OS, NULL::VARCHAR AS CH, type AS TYPE, NULL::VARCHAR AS VS, log_date AS LOGDATE, log_hour AS LOGHOUR,
  ts AS TS FROM dau""",
    "p12_select_cols": W_DAU + """SELECT mid, uid, NULL::VARCHAR AS appid, NULL::VARCHAR AS area,
  NULL::VARCHAR AS os, NULL::VARCHAR AS ch, type, NULL::VARCHAR AS vs, log_date, log_hour, ts FROM dau""",
    "p14_result_cast": W_DAU + W_ORD.replace("WITH ", ", ", 1) + f"""
SELECT 'dau' AS metric, log_date AS day, log_hour AS hour, CAST(count(*) AS DOUBLE) AS value FROM dau GROUP BY 2, 3
UNION ALL
SELECT 'order_amount', create_date, create_hour, {MONEY} FROM ord GROUP BY 2, 3""",
    "p16_json_write": W_DAU + """SELECT CAST(json_object('seq', seq, 'mid', mid, 'uid', uid, 'type', type,
  'ts', ts, 'log_date', log_date, 'log_hour', log_hour) AS VARCHAR) AS line FROM dau""",
    # filters
    "f1_route_startup": W_LOGS + f"SELECT {DAU_OUT} FROM logs WHERE type IS NOT DISTINCT FROM 'startup'",
    "f1_route_event": W_LOGS + f"SELECT {LOG_OUT} FROM logs WHERE type IS DISTINCT FROM 'startup'",
    "f2_date_filter": W_DAU + f"SELECT {DAU_OUT} FROM dau WHERE log_date = '{D}'",
    "f3_metric_dispatch": W_FIRST + W_ORD.replace("WITH ", ", ", 1) + f"""
SELECT 'dau' AS id, period, hour, CAST(value AS DOUBLE) AS value FROM ({DAU_PAIRS}) a
UNION ALL SELECT 'order_amount', period, hour, value FROM ({GMV_PAIRS}) b
UNION ALL SELECT 'new_mid', period, hour, CAST(value AS DOUBLE) FROM ({NEW_PAIRS}) c
UNION ALL SELECT 'new_id', period, hour, CAST(value AS DOUBLE) FROM ({NEW_PAIRS}) d""",
    # joins
    "j1_anti_asof": W_BATCH + f"""SELECT {DAU_OUT} FROM batch b
  WHERE b.mid NOT IN (SELECT mid FROM seen WHERE log_date = '{D}')""",
    "j2_anti_by_date": W_BATCH + f"""SELECT {DAU_OUT} FROM batch b
  WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.mid = b.mid AND s.log_date = b.log_date)""",
    "j3_two_day_pair": W_DAU + DAU_PAIRS,
    # aggregations
    "a1_dau_total": W_DAU + f"SELECT count(*) AS dau FROM dau WHERE log_date = '{D}'",
    "a1_dau_daily": W_DAU + "SELECT log_date, count(*) AS dau FROM dau GROUP BY log_date",
    "a2_dau_hours": W_DAU + f"SELECT log_hour AS lh, count(*) AS ct FROM dau WHERE log_date = '{D}' GROUP BY 1",
    "a1_dau_total_sql": W_DAU + f"SELECT count(*) AS dau FROM dau WHERE log_date = '{D}'",
    "a2_dau_hours_sql": W_DAU + f"SELECT log_hour AS lh, count(*) AS ct FROM dau WHERE log_date = '{D}' GROUP BY 1",
    "a5_gmv_total_sql": W_ORD + f"SELECT {MONEY} AS gmv FROM ord WHERE create_date = '{D}'",
    "a6_gmv_hours_sql": W_ORD + f"SELECT create_hour, {MONEY} AS sum_amount FROM ord WHERE create_date = '{D}' GROUP BY 1",
    "a3_first_per_key": W_DAU + f"SELECT {DAU_OUT} FROM dau",
    "a4_stage_counts": W_BATCH + """, kept AS (
  SELECT * FROM batch b WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.mid = b.mid AND s.log_date = b.log_date))
SELECT 'input' AS stage, count(*) AS n_rows FROM batch
UNION ALL SELECT 'after_anti', count(*) FROM kept
UNION ALL SELECT 'after_dedup', count(*) FROM (SELECT DISTINCT mid, log_date FROM kept) k""",
    "a5_gmv_total": W_ORD + f"SELECT {MONEY} AS gmv FROM ord WHERE create_date = '{D}'",
    "a5_gmv_daily_orders": """SELECT strftime(o_orderdate, '%Y-%m-%d') AS create_date,
  CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100.0 AS gmv FROM orders GROUP BY 1""",
    "a6_gmv_hours": W_ORD + f"SELECT create_hour, {MONEY} AS sum_amount FROM ord WHERE create_date = '{D}' GROUP BY 1",
    "a7_hour_map": W_DAU + """SELECT log_date,
  CAST(to_json(map_from_entries(list({'k': log_hour, 'v': ct} ORDER BY log_hour))) AS VARCHAR) AS hours
  FROM (SELECT log_date, log_hour, count(*) AS ct FROM dau GROUP BY 1, 2) t GROUP BY log_date""",
    "a8_new_device_total": W_FIRST + f"SELECT ({NEW_TOTAL}) AS new_devices",
    "a9_new_device_hours": W_FIRST + f"""SELECT first_date AS log_date, first_hour AS log_hour, count(*) AS ct
  FROM firsts WHERE first_date IN ('{PREV}', '{D}') GROUP BY 1, 2""",
    "a8_new_device_daily": W_DAU + """SELECT first_date AS log_date, count(*) AS new_devices
  FROM (SELECT mid, min(log_date) AS first_date FROM dau GROUP BY mid) t GROUP BY 1""",
    "a9_new_device_hours_all": W_DAU + """SELECT first_date AS log_date, first_hour AS log_hour, count(*) AS ct
  FROM (SELECT mid, min(log_date) AS first_date, arg_min(log_hour, log_date) AS first_hour
        FROM dau GROUP BY mid) t GROUP BY 1, 2""",
    "a9_first_seen_table": W_DAU + f"""SELECT first_date AS log_date, first_hour AS log_hour, count(*) AS ct
  FROM (SELECT mid, min(log_date) AS first_date, arg_min(log_hour, log_date) AS first_hour
        FROM dau GROUP BY mid) t GROUP BY 1, 2""",
    "a10_distinct_devices": W_START + "SELECT log_date, count(DISTINCT mid) AS devices FROM startup GROUP BY 1",
    # unions
    "u1_realtime_total": W_FIRST + W_ORD.replace("WITH ", ", ", 1) + f"""
SELECT 'dau' AS id, '新增日活' AS name, CAST((SELECT count(*) FROM dau WHERE log_date = '{D}') AS DOUBLE) AS value
UNION ALL SELECT 'new_id', '新增设备', CAST(({NEW_TOTAL}) AS DOUBLE)
UNION ALL SELECT 'order_amount', '新增交易额', (SELECT {MONEY} FROM ord WHERE create_date = '{D}')""",
    "u2_realtime_hours": W_FIRST + W_ORD.replace("WITH ", ", ", 1) + f"""
SELECT 'dau' AS id, doc FROM ({_hour_doc(DAU_PAIRS)}) a
UNION ALL SELECT 'order_amount', doc FROM ({_hour_doc(GMV_PAIRS)}) b
UNION ALL SELECT 'new_mid', doc FROM ({_hour_doc(NEW_PAIRS)}) c""",
    # quality
    "q1_quarantine": """SELECT CASE WHEN event_id % 50 IN (1, 4) THEN 'malformed_json'
  WHEN event_id % 50 = 2 OR user_id IS NULL THEN 'null_mid' WHEN event_id % 50 = 3 OR ts IS NULL THEN 'null_ts' ELSE 'ok' END
  AS reason, count(*) AS n_rows FROM events GROUP BY 1""",
    # streaming (stream result = batch result when slices arrive in ts order)
    "r2_stream_dedup": W_DAU + f"SELECT {DAU_OUT} FROM dau",
    "r2_stream_dropdup": W_START + "SELECT DISTINCT mid, log_date FROM startup",
    "r2_stream_from_json": W_DAU + "SELECT mid, uid, type, ts, log_date, log_hour FROM dau",
    "a4_stream_stage_totals": W_DAU + """SELECT (SELECT count(*) FROM startup) AS rows_in,
  (SELECT count(*) FROM dau) AS rows_new""",
    "r7_stream_daily": W_DAU + "SELECT log_date, count(*) AS dau FROM dau GROUP BY log_date",
    "r7_stream_hours": W_DAU + "SELECT log_date, log_hour, count(*) AS ct FROM dau GROUP BY 1, 2",
}

# the reports with new devices are about a day that has some
NEW_D, NEW_PREV = "2024-01-03", "2024-01-02"
for _key in ("k6_json_result", "f3_metric_dispatch", "a8_new_device_total", "a9_new_device_hours",
             "u1_realtime_total", "u2_realtime_hours"):
    ORACLE[_key] = ORACLE[_key].replace(PREV, NEW_PREV).replace(D, NEW_D)
