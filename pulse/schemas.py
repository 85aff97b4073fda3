"""Record schemas, declared up front (JSON is bound by field name, never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

_S = T.StringType()
_L = T.LongType()

# Startup log as it travels on the wire: `type` (bound to `logType` after parsing),
# no `ts` until the collector stamps the arrival time.
STARTUP_WIRE = T.StructType([
    T.StructField("type", _S), T.StructField("mid", _S), T.StructField("uid", _S),
    T.StructField("appid", _S), T.StructField("area", _S), T.StructField("os", _S),
    T.StructField("ch", _S), T.StructField("vs", _S), T.StructField("ts", _L),
])

# Parsed startup record, plus the two derived columns.
STARTUP_FIELDS = ["mid", "uid", "appid", "area", "os", "ch", "logType", "vs",
                  "logDate", "logHour", "ts"]

# Order record: every column travels as a string from the change feed;
# total_amount becomes a double, the last three columns are derived.
ORDER_SOURCE_FIELDS = [
    "id", "province_id", "consignee", "order_comment", "consignee_tel", "order_status",
    "payment_way", "user_id", "img_url", "total_amount", "expire_time", "delivery_address",
    "create_time", "operate_time", "tracking_no", "parent_order_id", "out_trade_no",
    "trade_body",
]
ORDER_WIRE = T.StructType([T.StructField(n, _S) for n in ORDER_SOURCE_FIELDS])
ORDER_FIELDS = ORDER_SOURCE_FIELDS + ["create_date", "create_hour", "is_first_order"]

# Change-feed envelope: one entry = (entry type, table, operation, rows);
# a row is its after-image as an ordered list of (column name, value) pairs.
CHANGE_ENVELOPE = T.StructType([
    T.StructField("entry_type", _S),
    T.StructField("table", _S),
    T.StructField("op", _S),
    T.StructField("rows", T.ArrayType(T.ArrayType(T.StructType([
        T.StructField("name", _S), T.StructField("value", _S)])))),
])

# Sink column lists, in the order the result tables declare them.
DAU_SINK_COLUMNS = ["MID", "UID", "APPID", "AREA", "OS", "CH", "TYPE", "VS",
                    "LOGDATE", "LOGHOUR", "TS"]
DAU_SINK_SOURCE = ["mid", "uid", "appid", "area", "os", "ch", "logType", "vs",
                   "logDate", "logHour", "ts"]

# Wide order-detail row served to the drill-down grid.
SALE_DETAIL_COLUMNS = ["order_detail_id", "order_id", "user_id", "sku_id", "user_gender",
                       "user_age", "user_level", "sku_price", "sku_name", "sku_tm_id", "dt"]
