"""Log collection and change-feed relay as DataFrame transformations.

They take and return plain (batch or streaming) DataFrames, so the same code runs in
a stream job and in a batch check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.functions import mask_phone, route_topic, stamp_ts, with_create_date_hour, with_date_hour
from pulse.schemas import CHANGE_ENVELOPE, ORDER_SOURCE_FIELDS, ORDER_WIRE, STARTUP_WIRE

# Default topic names (parameters everywhere; these are only the defaults).
TOPIC_STARTUP = "startup_log"
TOPIC_EVENT = "event_log"
TOPIC_ORDER = "order_info"

_PERMISSIVE = {"mode": "PERMISSIVE"}


# --- collector ---------------------------------------------------------------

def stamp_lines(df: DataFrame, arrival_ms: str = "arrival_ms", value: str = "value") -> DataFrame:
    """Set ``ts`` (arrival millis) inside every JSON line; other fields keep their types."""
    return df.withColumn(value, stamp_ts(F.col(value), F.col(arrival_ms)))


def route_logs(df: DataFrame, value: str = "value", startup_topic: str = TOPIC_STARTUP,
               event_topic: str = TOPIC_EVENT) -> DataFrame:
    """Add ``topic``: startup lines to one topic, everything else to the other."""
    return df.withColumn("topic", route_topic(F.col(value), startup_topic, event_topic))


def with_log_day(df: DataFrame, value: str = "value", col: str = "dt") -> DataFrame:
    """Day of the stamped ``ts`` of a JSON line (the landing partition)."""
    ts = F.get_json_object(F.col(value), "$.ts").cast("long")
    return df.withColumn(col, F.date_format(F.timestamp_millis(ts), "yyyy-MM-dd"))


# --- parsing -------------------------------------------------------------------

def parse_startup(df: DataFrame, value: str = "value") -> DataFrame:
    """JSON line -> startup record (by field name; unknown fields ignored, missing -> null),
    ``type`` bound to ``logType``, with ``logDate``/``logHour`` from ``ts``."""
    r = F.from_json(F.col(value), STARTUP_WIRE, _PERMISSIVE)
    parsed = df.select(r.alias("_r")).select(
        "_r.mid", "_r.uid", "_r.appid", "_r.area", "_r.os", "_r.ch",
        F.col("_r.type").alias("logType"), "_r.vs", "_r.ts")
    return with_date_hour(parsed).select(
        "mid", "uid", "appid", "area", "os", "ch", "logType", "vs", "logDate", "logHour", "ts")


def split_valid_startups(lines: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(startup records, quarantine): lines that have a device and a time, parsed; every other
    line as it came (``value``), malformed ones included."""
    fields = F.from_json(F.col(value), STARTUP_WIRE, _PERMISSIVE)
    ok = F.coalesce(fields["mid"].isNotNull() & fields["ts"].isNotNull(), F.lit(False))
    return parse_startup(lines.where(ok), value), lines.where(~ok).select(value)


def parse_order(df: DataFrame, value: str = "value") -> DataFrame:
    """JSON line -> order record; ``total_amount`` string -> double (bad number -> null)."""
    r = F.from_json(F.col(value), ORDER_WIRE, _PERMISSIVE)
    cols = [F.col(f"_r.{n}").alias(n) for n in ORDER_SOURCE_FIELDS]
    out = df.select(r.alias("_r")).select(*cols)
    return out.withColumn("total_amount", F.col("total_amount").try_cast("double"))


def prepare_orders(orders: DataFrame) -> DataFrame:
    """Split ``create_time`` into ``create_date``/``create_hour`` and mask the phone."""
    return with_create_date_hour(orders).withColumn("consignee_tel", mask_phone("consignee_tel"))


def split_valid_orders(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, quarantine): rows without an id or whose create time is not a time of the form
    ``yyyy-MM-dd HH:mm:ss`` go to quarantine instead of failing the batch."""
    shaped = F.col("create_time").rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$")
    ok = F.col("id").isNotNull() & shaped & F.try_to_timestamp("create_time", F.lit("yyyy-MM-dd HH:mm:ss")).isNotNull()
    ok = F.coalesce(ok, F.lit(False))
    return orders.where(ok), orders.where(~ok)


# --- change feed ---------------------------------------------------------------

def parse_changes(df: DataFrame, value: str = "value") -> DataFrame:
    """JSON change envelopes -> (entry_type, table, op, rows); undecodable -> all null."""
    return df.select(F.from_json(F.col(value), CHANGE_ENVELOPE, _PERMISSIVE).alias("_e")).select("_e.*")


def tag_changes(lines: DataFrame, value: str = "value") -> DataFrame:
    """(value, _e, _ok): every line with its envelope and whether it has an entry type and a table."""
    env = F.from_json(F.col(value), CHANGE_ENVELOPE, _PERMISSIVE)
    ok = env.isNotNull() & env["entry_type"].isNotNull() & env["table"].isNotNull()
    return lines.select(F.col(value), env.alias("_e"), F.coalesce(ok, F.lit(False)).alias("_ok"))


def split_valid_changes(lines: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(envelopes, quarantine): lines that decode to an envelope with an entry type and a
    table, parsed; every other line as it came (``value``), instead of failing the job."""
    tagged = tag_changes(lines, value)
    return (tagged.where("_ok").select("_e.*"),
            tagged.where(~F.col("_ok")).select(value))


def filter_changes(df: DataFrame, table: str = "order_info", op: str = "INSERT") -> DataFrame:
    """Row-data entries of one table and operation that carry at least one row."""
    return df.where((F.col("entry_type") == "ROWDATA") & (F.col("table") == F.lit(table))
                     & (F.col("op") == F.lit(op)) & (F.size("rows") > 0))


def after_image_json(df: DataFrame) -> DataFrame:
    """One JSON object per changed row: its after-image (name -> value). A column
    named twice keeps its last value (session ``mapKeyDedupPolicy=LAST_WIN``)."""
    row = df.select(F.explode("rows").alias("_row"))
    return row.select(F.to_json(F.map_from_entries("_row")).alias("value"))


def relay_orders(envelopes: DataFrame, table: str = "order_info", op: str = "INSERT") -> DataFrame:
    """filter -> explode -> JSON: the order topic's lines."""
    return after_image_json(filter_changes(envelopes, table, op))
