"""Joins: the hour axis, day-over-day alignment, dimension lookups, the detail star."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.functions import prev_day

HOURS = 24


def hour_spine(spark: SparkSession, col: str = "hour") -> DataFrame:
    """The 24 hours ``00`` … ``23`` as strings (fixed size: safe to broadcast)."""
    return spark.range(HOURS).select(F.format_string("%02d", F.col("id").cast("int")).alias(col))


def fill_hours(df: DataFrame, hour: str, values: list[str], fill=0) -> DataFrame:
    """Put ``df`` (at most one row per hour) on the 24-hour axis; missing -> ``fill``."""
    spark = df.sparkSession
    spine = F.broadcast(hour_spine(spark, hour))
    out = spine.join(df, hour, "left")
    return out.select(hour, *[F.coalesce(F.col(v), F.lit(fill).cast(df.schema[v].dataType)).alias(v)
                              for v in values])


def compare_days(df: DataFrame, date_col: str, hour: str, value, day: str, fill=0,
                 value_type: str = "bigint") -> DataFrame:
    """Yesterday's and today's per-hour series side by side on the 24-hour axis.

    One scan with ``date IN (day, day-1)`` and conditional aggregation (no second
    query, no join of two aggregates). ``value`` is an aggregate expression builder:
    ``lambda cond: F.count_if(cond)`` or ``lambda cond: F.sum(F.when(cond, x))``.
    """
    today = F.lit(day)
    yday = prev_day(today)
    sel = df.where((F.col(date_col) == today) | (F.col(date_col) == yday))
    per_hour = sel.groupBy(hour).agg(
        value(F.col(date_col) == yday).cast(value_type).alias("yesterday"),
        value(F.col(date_col) == today).cast(value_type).alias("today"))
    return fill_hours(per_hour, hour, ["yesterday", "today"], fill)


def with_province(orders: DataFrame, nation: DataFrame, key: str = "province_id",
                  name: str = "province_name") -> DataFrame:
    """Attach the province (nation) name. ``nation`` is a fixed 25-row dimension."""
    dim = nation.select(F.col("n_nationkey").cast("string").alias(key), F.col("n_name").alias(name))
    return orders.join(F.broadcast(dim), key, "left")


def sale_detail_wide(lineitem: DataFrame, orders: DataFrame | None, customer: DataFrame | None,
                     part: DataFrame | None, nation: DataFrame | None) -> DataFrame:
    """Line item ⋈ order ⋈ SKU (⋈ user ⋈ province), as the detail grid's rows; a side that is
    None is not joined and its columns are absent (the province needs order, customer and nation).

    Only ``nation`` carries a broadcast hint (fixed 25 rows). ``customer`` and
    ``part`` grow with the data; the planner broadcasts them while their scan
    statistics stay under ``autoBroadcastJoinThreshold`` and AQE re-plans from
    the real sizes, otherwise they are shuffle-joined.
    """
    j = lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice")
    # Join order (Catalyst keeps it; join reordering needs CBO statistics): the order
    # side is enriched first (orders ⋈ customer ⋈ nation), so the line items, the
    # biggest input, are shuffled once for the order key and once for the part key
    # when neither dimension is small enough to broadcast.
    if orders is not None:
        buyers = orders.select("o_orderkey", "o_custkey", "o_orderdate")
        if customer is not None:
            buyers = buyers.join(customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
            if nation is not None:
                dim = nation.select("n_nationkey", "n_name")
                buyers = buyers.join(F.broadcast(dim), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        j = j.join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
    if part is not None:
        j = j.join(part.select("p_partkey", "p_name", "p_brand", "p_retailprice"), F.col("l_partkey") == F.col("p_partkey"))
    user = F.col("o_custkey")
    columns = {  # name: (the joined column it needs, its expression)
        "order_detail_id": ("l_orderkey", F.concat(F.col("l_orderkey").cast("string"), F.lit("_"), F.col("l_linenumber").cast("string"))),
        "order_id": ("l_orderkey", F.col("l_orderkey").cast("string")),
        "user_id": ("o_custkey", user.cast("string")),
        "sku_id": ("l_orderkey", F.col("l_partkey").cast("string")),
        "user_gender": ("o_custkey", F.when(user % 2 == 0, F.lit("M")).otherwise(F.lit("F"))),
        "user_age": ("o_custkey", (F.lit(15) + user % 40).cast("int")),
        "user_level": ("o_custkey", (F.lit(1) + user % 10).cast("string")),
        "sku_price": ("p_retailprice", F.col("p_retailprice")),
        "sku_name": ("p_name", F.col("p_name")),
        "sku_tm_id": ("p_brand", F.col("p_brand")),
        "dt": ("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd")),
        "sku_num": ("l_orderkey", F.col("l_quantity")),
        "order_amount": ("l_orderkey", F.col("l_extendedprice")),
        "province": ("n_name", F.col("n_name")),
    }
    return j.select(*[c.alias(name) for name, (source, c) in columns.items() if source in j.columns])
