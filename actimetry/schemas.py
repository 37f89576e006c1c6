"""Record schemas and the fixed values the results must carry.

Field names follow the log records: a startup log (device start) and an event
log (in-app action), both JSON lines stamped with ``ts`` (epoch ms) on arrival.
"""

from pyspark.sql import types as T

# Default topic names of the two routed log streams (deployment configuration:
# pass your own to ``with_topic`` / ``Collector``).
TOPIC_START = "startup_log"
TOPIC_EVENT = "event_log"

# ---------------------------------------------------------------------------
# Fixed values (must equal the original system's output for compatible results)
# ---------------------------------------------------------------------------
# The value of ``type`` that marks a startup log.
STARTUP_TYPE = "startup"
# Metric ids and display names of the dashboard totals and hourly series.
METRIC_DAU = "dau"
METRIC_DAU_NAME = "新增日活"
METRIC_NEW_DEVICE_TOTAL_ID = "new_id"
METRIC_NEW_DEVICE_HOURS_ID = "new_mid"
METRIC_NEW_DEVICE_NAME = "新增设备"
METRIC_GMV = "order_amount"
METRIC_GMV_NAME = "新增交易额"
# Prefix of the per-day device-set key.
DAU_KEY_PREFIX = "DAU:"
# ---------------------------------------------------------------------------

STARTUP_RAW = T.StructType([
    T.StructField("mid", T.StringType()),
    T.StructField("uid", T.StringType()),
    T.StructField("appid", T.StringType()),
    T.StructField("area", T.StringType()),
    T.StructField("os", T.StringType()),
    T.StructField("ch", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("vs", T.StringType()),
    T.StructField("ts", T.LongType()),
])

# Union of both log shapes plus ``seq`` (a record id some sources carry; used as
# the tie-break when two logs of a device share a ts). Parsing every line with
# one schema lets a single pass route and validate both kinds.
LOG_RAW = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("mid", T.StringType()),
    T.StructField("uid", T.StringType()),
    T.StructField("appid", T.StringType()),
    T.StructField("area", T.StringType()),
    T.StructField("os", T.StringType()),
    T.StructField("ch", T.StringType()),
    T.StructField("vs", T.StringType()),
    T.StructField("evid", T.StringType()),
    T.StructField("pgid", T.IntegerType()),
    T.StructField("npgid", T.IntegerType()),
    T.StructField("itemid", T.IntegerType()),
    T.StructField("seq", T.LongType()),
    T.StructField("ts", T.LongType()),
])

CORRUPT_COL = "_corrupt_record"

# Column order of the DAU sink (declaration order of the startup record).
DAU_COLUMNS = ["mid", "uid", "appid", "area", "os", "ch", "type", "vs", "log_date", "log_hour", "ts"]
# Sink-side names: upper case, as the wide table stores them.
DAU_SINK_NAMES = ["MID", "UID", "APPID", "AREA", "OS", "CH", "TYPE", "VS", "LOGDATE", "LOGHOUR", "TS"]
