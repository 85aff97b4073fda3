"""The driver's tables presented as the records this engine works on.

``events`` stands in for the app logs (``view`` = app start, the rest = behaviour
events, ``purchase`` = an order), ``orders``/``lineitem``/``customer``/``part``/``nation``
for the order-detail star. Every derived attribute is a deterministic function of a
source column, so the SQL oracle in ``pulse.plans.oracle`` rebuilds the same rows.
All views are lazy DataFrames over the parquet scans: filters and projections of the
queries on top still reach the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.functions import epoch_millis

# ---------------------------------------------------------------------------
# Fixed values of the synthetic log attributes.
# ---------------------------------------------------------------------------
APP_ID = "shop_app"
STARTUP_TYPE = "startup"
EVENT_TYPE = "event"
ORDER_STATUS_NEW = "1001"
ORDER_STATUS_PAID = "1002"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def on_days(df: DataFrame, days: tuple[str, str] | None, ts: str = "ts") -> DataFrame:
    """Rows of the days ``days[0] .. days[1]``, as a range of the raw time column: the scan gets it
    (row groups and files outside are skipped), which a comparison of formatted days would not do."""
    if days is None:
        return df
    kind = df.schema[ts].dataType
    end = F.date_add(F.lit(days[1]).cast("date"), 1).cast(kind)
    return df.where((F.col(ts) >= F.lit(days[0]).cast(kind)) & (F.col(ts) < end))


DEALT_SPLITS = 4  # a core, from which on a scan is taken to be even


def dealt(df: DataFrame) -> DataFrame:
    """``df`` dealt over the cores if its scan has few splits for them, for views that build and parse JSON row by
    row: splits can be empty (a file has fewer row groups than ranges) and hold unequal shares. A table of many splits, as
    any large one, is read as it lies: no shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(2 * cores) if 1 < cores and df.rdd.getNumPartitions() < DEALT_SPLITS * cores else df


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _os() -> Column:
    kinds = F.array(F.lit("phone"), F.lit("tablet"), F.lit("desktop"))
    return F.element_at(kinds, (F.col("user_id") % 3 + 1).cast("int"))


def _version(k: Column | None = None) -> Column:
    k = _k() if k is None else k
    return F.concat((F.floor(k / 40) + 2).cast("string"), F.lit("."), (k % 5).cast("string"))


def _channel() -> Column:
    return F.concat(F.lit("channel_"), (F.col("user_id") % 11).cast("string"))


def attach_area(df: DataFrame, spark: SparkSession, sf_dir: str, user_col: str = "user_id") -> DataFrame:
    """Add ``area`` (the user's nation name) to ``df``.

    ``df`` -> customer -> nation, in that order: the customer join is planned from the
    customer scan's own statistics (broadcast while small, shuffled when not); the
    25-row nation dimension is always broadcast."""
    key_type = df.schema[user_col].dataType
    cust = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast(key_type).alias("_area_user"), "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("area"))
    base = df.drop("area") if "area" in df.columns else df
    out = (base.join(cust, F.col(user_col) == F.col("_area_user"), "left")
               .join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"), "left"))
    return out.drop("_area_user", "c_nationkey", "n_nationkey")


def _events(spark: SparkSession, sf_dir: str, with_area: bool, days: tuple[str, str] | None = None) -> DataFrame:
    ev = on_days(table(spark, sf_dir, "events"), days)
    if with_area:
        return attach_area(ev, spark, sf_dir, "user_id")
    return ev.withColumn("area", F.lit(None).cast("string"))


def startup_log(spark: SparkSession, sf_dir: str, with_area: bool = True,
                days: tuple[str, str] | None = None) -> DataFrame:
    """Parsed startup records: mid, uid, appid, area, os, ch, logType, vs, ts (millis).

    ``with_area=False`` skips the customer join for queries that never read the area; ``days`` reads
    those days only.
    """
    ev = _events(spark, sf_dir, with_area, days).where(F.col("event_type") == "view")
    return ev.select(
        F.concat(F.lit("mid_"), F.col("user_id").cast("string")).alias("mid"),
        F.col("user_id").cast("string").alias("uid"),
        F.lit(APP_ID).alias("appid"),
        F.col("area"),
        _os().alias("os"),
        _channel().alias("ch"),
        F.lit(STARTUP_TYPE).alias("logType"),
        _version().alias("vs"),
        epoch_millis("ts").alias("ts"),
    )


def event_log(spark: SparkSession, sf_dir: str, with_area: bool = True) -> DataFrame:
    """Behaviour events (every type but ``view``)."""
    ev = _events(spark, sf_dir, with_area).where(F.col("event_type") != "view")
    k = _k()
    return ev.select(
        F.lit(EVENT_TYPE).alias("type"),
        F.concat(F.lit("mid_"), F.col("user_id").cast("string")).alias("mid"),
        F.col("user_id").cast("string").alias("uid"),
        _os().alias("os"), F.lit(APP_ID).alias("appid"), F.col("area"),
        F.col("event_type").alias("evid"),
        (k % 32 + 100).alias("pgid"), ((k * 3) % 32 + 100).alias("npgid"), (k % 25).alias("itemid"),
        epoch_millis("ts").alias("ts"),
    )


def raw_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines as the collector receives them: (key, value JSON, arrival_ms).

    App starts carry ``type=startup``; ``error`` events carry no ``type`` at all
    (a client that sends incomplete lines); ``ts`` is not in the line yet — the
    collector stamps it from ``arrival_ms``.
    """
    ev = attach_area(dealt(table(spark, sf_dir, "events")), spark, sf_dir, "user_id").withColumn("_k", _k())
    k = F.col("_k")  # parsed once, not in each field
    is_start = F.col("event_type") == "view"
    mid = F.concat(F.lit("mid_"), F.col("user_id").cast("string"))
    uid = F.col("user_id").cast("string")
    startup = F.struct(F.lit(STARTUP_TYPE).alias("type"), mid.alias("mid"), uid.alias("uid"),
                       F.lit(APP_ID).alias("appid"), F.col("area"), _os().alias("os"),
                       _channel().alias("ch"), _version(k).alias("vs"))
    event = F.struct(
        F.when(F.col("event_type") != "error", F.lit(EVENT_TYPE)).alias("type"),
        mid.alias("mid"), uid.alias("uid"), _os().alias("os"), F.lit(APP_ID).alias("appid"),
        F.col("area"), F.col("event_type").alias("evid"), (k % 32 + 100).alias("pgid"),
        ((k * 3) % 32 + 100).alias("npgid"), (k % 25).alias("itemid"))
    return ev.select(
        F.col("event_id").cast("string").alias("key"),
        F.when(is_start, F.to_json(startup)).otherwise(F.to_json(event)).alias("value"),
        epoch_millis("ts").alias("arrival_ms"),
    )


# --- orders ------------------------------------------------------------------

def _order_columns() -> list[Column]:
    """The 18 source columns of an order, all strings (as the change feed carries them)."""
    k = _k()
    fmt = "yyyy-MM-dd HH:mm:ss"
    return [
        F.col("event_id").cast("string").alias("id"),
        F.coalesce(F.col("c_nationkey").cast("string"), F.lit("")).alias("province_id"),
        F.coalesce(F.col("c_name"), F.lit("")).alias("consignee"),
        F.concat(F.lit("comment_"), k.cast("string")).alias("order_comment"),
        F.concat(F.lit("13"), F.lpad(F.col("user_id").cast("string"), 9, "0")).alias("consignee_tel"),
        F.lit(ORDER_STATUS_NEW).alias("order_status"),
        F.when(k % 2 == 0, F.lit("1")).otherwise(F.lit("2")).alias("payment_way"),
        F.col("user_id").cast("string").alias("user_id"),
        F.concat(F.lit("img/"), F.col("event_id").cast("string"), F.lit(".jpg")).alias("img_url"),
        F.col("value").cast("string").alias("total_amount"),
        F.date_format(F.col("ts") + F.expr("INTERVAL 15 MINUTES"), fmt).alias("expire_time"),
        F.concat(F.lit("addr_"), F.col("user_id").cast("string")).alias("delivery_address"),
        F.date_format("ts", fmt).alias("create_time"),
        F.lit("").alias("operate_time"),
        F.lit("").alias("tracking_no"),
        F.lit("").alias("parent_order_id"),
        F.concat(F.lit("otn_"), F.col("event_id").cast("string")).alias("out_trade_no"),
        F.concat(F.lit("item "), k.cast("string")).alias("trade_body"),
    ]


def _purchases(spark: SparkSession, sf_dir: str, days: tuple[str, str] | None = None,
               with_customer: bool = True, deal: bool = False) -> DataFrame:
    events = table(spark, sf_dir, "events")
    rows = on_days(dealt(events) if deal else events, days).where(F.col("event_type") == "purchase")
    if not with_customer:
        return rows.withColumns({"c_nationkey": F.lit(None).cast("int"), "c_name": F.lit(None).cast("string")})
    cust = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_nationkey", "c_name")
    return rows.join(cust, "user_id", "left")


def order_rows(spark: SparkSession, sf_dir: str, days: tuple[str, str] | None = None,
               with_customer: bool = True, deal: bool = False) -> DataFrame:
    """Orders as string columns, before parsing (= the after-image values). Without the customer
    join ``province_id`` and ``consignee`` are empty, for queries that never read them. ``deal``: see ``dealt``."""
    return _purchases(spark, sf_dir, days, with_customer, deal).select(*_order_columns())


def order_info(spark: SparkSession, sf_dir: str, days: tuple[str, str] | None = None,
               with_customer: bool = True) -> DataFrame:
    """Typed order records (``total_amount`` double), without the derived columns."""
    return order_rows(spark, sf_dir, days, with_customer).withColumn(
        "total_amount", F.col("total_amount").cast("double"))


def activity(spark: SparkSession, sf_dir: str, days: tuple[str, str] | None = None) -> DataFrame:
    """(mid, ts) of every log line, app starts and behaviour events alike, in one scan."""
    ev = on_days(table(spark, sf_dir, "events"), days)
    return ev.select(F.concat(F.lit("mid_"), F.col("user_id").cast("string")).alias("mid"), epoch_millis("ts").alias("ts"))


def change_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change-feed envelopes (entry_type, table, op, rows).

    Every purchase yields an ``INSERT`` of ``order_info`` (its after-image) and an
    ``UPDATE`` to the paid status; every click yields an ``INSERT`` into
    ``cart_info``; every signup a ``TRANSACTIONEND`` entry without rows. Only the
    first kind survives the relay's filter.
    """
    from pulse.schemas import ORDER_SOURCE_FIELDS
    purchases = _purchases(spark, sf_dir, deal=True).select(*_order_columns())
    image = F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("value"))
                      for n in ORDER_SOURCE_FIELDS])
    paid = F.array(F.struct(F.lit("id").alias("name"), F.col("id").alias("value")),
                   F.struct(F.lit("order_status").alias("name"),
                            F.lit(ORDER_STATUS_PAID).alias("value")))
    inserts = purchases.select(F.lit("ROWDATA").alias("entry_type"), F.lit("order_info").alias("table"),
                               F.lit("INSERT").alias("op"), F.array(image).alias("rows"),
                               F.col("id").alias("key"))
    updates = purchases.select(F.lit("ROWDATA").alias("entry_type"), F.lit("order_info").alias("table"),
                               F.lit("UPDATE").alias("op"), F.array(paid).alias("rows"),
                               F.col("id").alias("key"))
    ev = table(spark, sf_dir, "events")
    carts = ev.where(F.col("event_type") == "click").select(
        F.lit("ROWDATA").alias("entry_type"), F.lit("cart_info").alias("table"),
        F.lit("INSERT").alias("op"),
        F.array(F.array(F.struct(F.lit("id").alias("name"),
                                 F.col("event_id").cast("string").alias("value")))).alias("rows"),
        F.col("event_id").cast("string").alias("key"))
    ends = ev.where(F.col("event_type") == "signup").select(
        F.lit("TRANSACTIONEND").alias("entry_type"), F.lit("order_info").alias("table"),
        F.lit("INSERT").alias("op"),
        F.array().cast("array<array<struct<name:string,value:string>>>").alias("rows"),
        F.col("event_id").cast("string").alias("key"))
    return inserts.unionByName(updates).unionByName(carts).unionByName(ends)


def change_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The envelopes as JSON lines (key, value), the form a change topic carries."""
    env = change_entries(spark, sf_dir)
    return env.select("key", F.to_json(F.struct("entry_type", "table", "op", "rows")).alias("value"))


# --- order detail star ---------------------------------------------------------

GRID_SIDES = ("orders", "part")


def sale_detail(spark: SparkSession, sf_dir: str,
                sides: tuple[str, ...] = ("orders", "customer", "nation", "part")) -> DataFrame:
    """Order-detail rows: line item + order (user) + part (SKU) + customer and nation (province).

    ``sides`` names the tables a report needs; columns of the others are left out. That every line item has
    its order, part and customer is assumed (referential integrity), so leaving a side out loses no row."""
    from pulse.operators.joins import sale_detail_wide
    of = {t: table(spark, sf_dir, t) for t in sides}
    return sale_detail_wide(table(spark, sf_dir, "lineitem"), of.get("orders"), of.get("customer"),
                            of.get("part"), of.get("nation"))
