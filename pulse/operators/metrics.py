"""KPI aggregates over the result tables.

Inputs are DataFrames shaped like the result tables (the deduplicated startup
table ``dau``, the order table ``orders``, the detail rows). On the real tables
the date predicate is a partition filter; money is summed as DECIMAL(18,2) so the
result does not depend on the order rows arrive in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulse.functions import age_band, gender_label, on_date
from pulse.functions.columns import sales_band
from pulse.operators.joins import fill_hours

# ---------------------------------------------------------------------------
# KPI ids and display names of the headline list, in order.
# ---------------------------------------------------------------------------
KPI_DAU = ("dau", "新增日活")
KPI_NEW_MID = ("new_mid", "新增设备")
KPI_ORDER_AMOUNT = ("order_amount", "新增交易额")


def money_sum(col: str | Column) -> Column:
    """Order-independent sum of a 2-decimal money column, returned as double."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c.cast("decimal(18,2)")).cast("double")


# --- startup table -----------------------------------------------------------

def dau_total(dau: DataFrame, day: str) -> DataFrame:
    """Active devices on ``day`` = rows of the deduplicated table (0 when none)."""
    return on_date(dau, "logDate", day).agg(F.count(F.lit(1)).alias("dau"))


def dau_hour(dau: DataFrame, day: str) -> DataFrame:
    """(logHour, ct): devices by the hour of their first start; only hours with data."""
    return on_date(dau, "logDate", day).groupBy("logHour").agg(F.count(F.lit(1)).alias("ct"))


def dau_hour_filled(dau: DataFrame, day: str) -> DataFrame:
    """:func:`dau_hour` on the full 24-hour axis, 0 where there is no data."""
    return fill_hours(dau_hour(dau, day), "logHour", ["ct"], 0)


def launches(startups: DataFrame, day: str | None = None) -> DataFrame:
    """(logDate, launches): app starts per day, not deduplicated."""
    src = startups if day is None else on_date(startups, "logDate", day)
    return src.groupBy("logDate").agg(F.count(F.lit(1)).alias("launches"))


def hourly_active(logs: DataFrame, day: str, approx: bool = False) -> DataFrame:
    """(logHour, active): distinct devices seen in each hour (a device counts in
    every hour it was active). ``approx`` switches to HyperLogLog++."""
    dist = F.approx_count_distinct("mid") if approx else F.count_distinct("mid")
    return on_date(logs, "logDate", day).groupBy("logHour").agg(dist.alias("active"))


# log2 of the buckets of a device sketch: a relative standard error of 1.04 / sqrt(2**14), below 1 %.
SKETCH_SIZE = 14


def activity_sketches(logs: DataFrame) -> DataFrame:
    """(logDate, logHour, sketch): a mergeable sketch of the devices of each hour (a fixed few KB, whatever
    their number). Devices that come again change nothing, so batches may be delivered twice."""
    return logs.groupBy("logDate", "logHour").agg(F.hll_sketch_agg("mid", F.lit(SKETCH_SIZE)).alias("sketch"))


def hourly_active_merged(sketches: DataFrame, day: str) -> DataFrame:
    """(logHour, active): :func:`hourly_active` from the sketches of any number of batches, within 3 %
    (three standard errors)."""
    merged = F.hll_sketch_estimate(F.hll_union_agg("sketch"))
    return on_date(sketches, "logDate", day).groupBy("logHour").agg(merged.alias("active"))


def new_devices(dau: DataFrame, day: str) -> DataFrame:
    """Devices whose first-ever start falls on ``day``.

    ``min(logDate)`` per device is a partial aggregate over the whole history; the
    ``logDate <= day`` predicate is pushed below it (later days cannot change the
    answer) and prunes partitions on the real table."""
    upto = dau.where(F.col("logDate") <= F.lit(day))
    firsts = upto.groupBy("mid").agg(F.min("logDate").alias("first_day"))
    return firsts.agg(F.count_if(F.col("first_day") == F.lit(day)).cast("bigint").alias("new_mid"))


def new_devices_on(new_per_day: DataFrame, day: str) -> DataFrame:
    """Same answer as :func:`new_devices`, from the counts per day that the first-seen stream keeps
    (``streaming.jobs.read_new_devices``): one day's rows are read, whatever the length of the history."""
    return on_date(new_per_day, "logDate", day).agg(F.coalesce(F.sum("new_mid"), F.lit(0)).cast("bigint").alias("new_mid"))


def cum_dau(dau: DataFrame, day: str) -> DataFrame:
    """(logHour, ct, cum_ct): running total of first starts over the hours of ``day``.

    The window's single partition holds the 24 rows of the hour axis only."""
    per_hour = dau_hour_filled(dau, day).withColumn("_d", F.lit(day))
    w = (Window.partitionBy("_d").orderBy("logHour")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return per_hour.withColumn("cum_ct", F.sum("ct").over(w)).drop("_d")


def daily_dau(dau: DataFrame) -> DataFrame:
    return dau.groupBy("logDate").agg(F.count(F.lit(1)).alias("value"))


def day_over_day(daily: DataFrame, date_col: str = "logDate", value: str = "value") -> DataFrame:
    """(date, value, prev_value, pct_change) over a dense calendar.

    The calendar spans min..max date of the input (missing days count 0); the
    previous day is found with an equi-join on ``date - 1``, so no window has to
    move the series into one partition. ``pct_change`` is null when the previous
    day is 0 or outside the calendar."""
    d = daily.select(F.to_date(F.col(date_col)).alias("_d"), F.col(value).alias("_v"))
    bounds = d.agg(F.min("_d").alias("lo"), F.max("_d").alias("hi"))
    cal = bounds.select(F.explode(F.sequence("lo", "hi")).alias("_d"))
    dense = cal.join(d, "_d", "left").select("_d", F.coalesce("_v", F.lit(0)).alias("_v"))
    prev = dense.select(F.date_add("_d", 1).alias("_d"), F.col("_v").alias("_p"))
    out = dense.join(prev, "_d", "left")
    pct = F.when(F.col("_p") > 0, F.round((F.col("_v") - F.col("_p")) * 100.0 / F.col("_p"), 4))
    return out.select(F.date_format("_d", "yyyy-MM-dd").alias(date_col),
                      F.col("_v").cast("bigint").alias(value),
                      F.col("_p").cast("bigint").alias("prev_value"),
                      pct.alias("pct_change"))


# --- order table -------------------------------------------------------------

def order_amount(orders: DataFrame, day: str) -> DataFrame:
    """Revenue on ``day``; null when there are no orders."""
    return on_date(orders, "create_date", day).agg(money_sum("total_amount").alias("order_amount"))


def order_amount_hour(orders: DataFrame, day: str) -> DataFrame:
    """(create_hour, order_amount) for the hours that have orders."""
    return (on_date(orders, "create_date", day).groupBy("create_hour")
            .agg(money_sum("total_amount").alias("order_amount")))


def device_kpis(starts: DataFrame, day: str) -> DataFrame:
    """(dau, new_mid) of ``day`` from the starts up to it (or the DAU table), in one pass: per
    device, whether it started on the day and the first day it started."""
    per = (starts.where(F.col("logDate") <= F.lit(day)).groupBy("mid")
           .agg(F.min("logDate").alias("first_day"), F.max("logDate").alias("last_day")))
    return per.agg(F.count_if(F.col("last_day") == F.lit(day)).cast("bigint").alias("dau"),
                   F.count_if(F.col("first_day") == F.lit(day)).cast("bigint").alias("new_mid"))


def _kpi_row(place: int, kpi: tuple[str, str], df: DataFrame, col: str) -> DataFrame:
    return df.select(F.lit(place).alias("ord"), F.lit(kpi[0]).alias("id"), F.lit(kpi[1]).alias("name"), F.col(col).cast("double").alias("value"))


def kpi_summary(dau: DataFrame, orders: DataFrame, day: str) -> DataFrame:
    """Headline list (ord, id, name, value): dau, new devices, revenue, in that order.

    ``dau`` may be the DAU table or the starts themselves; both device numbers come from one pass over
    the history up to ``day``. :func:`kpi_totals` answers from totals instead."""
    named = [F.struct(F.lit(i).alias("ord"), F.lit(k[0]).alias("id"), F.lit(k[1]).alias("name"), F.col(c).cast("double").alias("value"))
             for i, k, c in ((1, KPI_DAU, "dau"), (2, KPI_NEW_MID, "new_mid"))]
    devices = device_kpis(dau, day).select(F.explode(F.array(*named)).alias("k")).select("k.*")
    return devices.unionByName(_kpi_row(3, KPI_ORDER_AMOUNT, order_amount(orders, day), "order_amount"))


def kpi_totals(device_hours: DataFrame, new_per_day: DataFrame, order_hours: DataFrame, day: str) -> DataFrame:
    """:func:`kpi_summary` from the totals that the stream jobs keep (``read_device_hours``,
    ``read_new_devices``, ``read_order_hours``): a few rows of one day are read, no device and no order."""
    active = on_date(device_hours, "logDate", day).agg(F.coalesce(F.sum("devices"), F.lit(0)).alias("dau"))
    money = on_date(order_hours, "create_date", day).where(F.col("orders") > 0).agg(F.sum("amount").cast("double").alias("order_amount"))
    return (_kpi_row(1, KPI_DAU, active, "dau").unionByName(_kpi_row(2, KPI_NEW_MID, new_devices_on(new_per_day, day), "new_mid"))
            .unionByName(_kpi_row(3, KPI_ORDER_AMOUNT, money, "order_amount")))


# --- detail rows ---------------------------------------------------------------

def _share(df: DataFrame, label: Column) -> DataFrame:
    """One pass: counts per label, then each count over their sum. The window spans the
    grouped rows only (at most a handful of labels), not the input."""
    counts = df.groupBy(label.alias("name")).agg(F.count(F.lit(1)).alias("value"))
    total = F.sum("value").over(Window.partitionBy(F.lit(1)))
    return counts.select("name", "value", F.round(F.col("value") * 100.0 / total, 6).alias("share"))


def gender_share(detail: DataFrame) -> DataFrame:
    """(name, value, share %): rows per gender of the (filtered) detail rows."""
    return _share(detail, gender_label("user_gender"))


def age_share(detail: DataFrame) -> DataFrame:
    """(name, value, share %): rows per age band of the (filtered) detail rows."""
    return _share(detail, age_band("user_age"))


def province_sales(detail: DataFrame, day: str | None = None) -> DataFrame:
    """(province, orders, sku_num, amount) per province; whole history when ``day`` is None."""
    src = detail if day is None else on_date(detail, "dt", day)
    return src.groupBy("province").agg(
        F.count_distinct("order_id").alias("orders"),
        F.sum("sku_num").cast("double").alias("sku_num"),
        money_sum("order_amount").alias("amount"))


def sales_bands(sales: DataFrame, value: str = "sku_num", name: str = "province") -> DataFrame:
    """(province, value, band): the legend band of each province's sales."""
    return sales.select(name, F.col(value).alias("value"), sales_band(value).alias("band"))


def sku_rank(detail: DataFrame, n: int = 10, day: str | None = None) -> DataFrame:
    """Top ``n`` SKU names by quantity sold (ties by name): a top-k report,
    planned as a partial aggregate + TakeOrderedAndProject."""
    src = detail if day is None else on_date(detail, "dt", day)
    return (src.groupBy(F.col("sku_name").alias("name"))
            .agg(F.sum("sku_num").cast("double").alias("num"))
            .orderBy(F.desc("num"), F.asc("name")).limit(n))
