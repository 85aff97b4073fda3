"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver's tables in full (through the views of
``pulse.sources.views``); date parameters select what the operator reports on,
never a sample of the input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse import session
from pulse.functions import mask_phone, on_date, prev_day, split_create_time, with_date_hour
from pulse.operators import dedup, ingest, joins, metrics, reports
from pulse.plans import params as P
from pulse.schemas import DAU_SINK_COLUMNS, DAU_SINK_SOURCE, SALE_DETAIL_COLUMNS
from pulse.sources import tables, views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def reg(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            session.configure(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run
    return reg


# --- shared building blocks -------------------------------------------------------

DAY = (P.DAY, P.DAY)
TWO_DAYS = (P.YESTERDAY, P.DAY)
UP_TO_DAY = ("0001-01-01", P.DAY)


def startups(spark, sf, with_area=True, days=None) -> DataFrame:
    """Startup records with logDate/logHour."""
    return with_date_hour(views.startup_log(spark, sf, with_area, days))


def dau_table(spark, sf, with_area=True, days=None) -> DataFrame:
    """The deduplicated startup table: first start per (device, day).

    ``area`` is a function of the device, so it cannot change which row wins: it is
    attached after the dedup, to one row per (device, day) instead of every start
    (one shuffle of the pre-aggregated rows instead of two of all rows). ``days`` reads those days only."""
    firsts = dedup.first_per_key(startups(spark, sf, with_area=False, days=days), ["mid", "logDate"], ["ts"])
    if not with_area:
        return firsts
    return views.attach_area(firsts, spark, sf, "uid").select(*firsts.columns)


def order_table(spark, sf, days=None) -> DataFrame:
    """Orders with create_date/create_hour and masked phone."""
    return ingest.prepare_orders(views.order_info(spark, sf, days, with_customer=False))


def stamped_lines(spark, sf) -> DataFrame:
    return ingest.stamp_lines(views.raw_logs(spark, sf))


# --- scans, sources, sinks ------------------------------------------------------------

@query("land_raw")
def q_land_raw(spark, sf):
    """Stamp every log line, land it by day, read the landing area back:
    (dt, log_type, n) per day and declared type."""
    path = session.shared_dir(spark, "landing")
    tables.land_raw(ingest.with_log_day(stamped_lines(spark, sf)), path)
    landed = tables.read_landed(spark, path)
    return landed.groupBy("dt", F.get_json_object("value", "$.type").alias("log_type")) \
        .agg(F.count(F.lit(1)).alias("n"))


@query("scan_by_date")
def q_scan_by_date(spark, sf):
    """Write the DAU table partitioned by day, then read one day (partition pruning)."""
    path = session.shared_dir(spark, "dau_table")
    tables.write_partitioned(dau_table(spark, sf), path, ["logDate"])
    return tables.scan_by_date(spark, path, "logDate", P.DAY).select(*startups(spark, sf).columns)


# --- projections, functions, filters ------------------------------------------------

@query("parse_startup")
def q_parse_startup(spark, sf):
    """Raw lines -> stamp -> route -> parse the startup topic."""
    routed = ingest.route_logs(stamped_lines(spark, sf))
    return ingest.parse_startup(routed.where(F.col("topic") == ingest.TOPIC_STARTUP))


@query("parse_order")
def q_parse_order(spark, sf):
    """Order rows as JSON lines -> parse (string columns, total_amount double)."""
    lines = views.order_rows(spark, sf).select(F.to_json(F.struct("*")).alias("value"))
    return ingest.parse_order(lines)


@query("stamp_ingest_ts")
def q_stamp(spark, sf):
    """(key, ts, type) read back from each stamped line."""
    out = stamped_lines(spark, sf)
    return out.select("key", F.get_json_object("value", "$.ts").cast("bigint").alias("ts"),
                      F.get_json_object("value", "$.type").alias("type"))


@query("epoch_to_date_hour")
def q_epoch(spark, sf):
    return startups(spark, sf, with_area=False).select("mid", "ts", "logDate", "logHour")


@query("datetime_split")
def q_split(spark, sf):
    o = views.order_info(spark, sf, with_customer=False)
    d, h = split_create_time("create_time")
    return o.select("id", "create_time", d.alias("create_date"), h.alias("create_hour"))


@query("mask_phone")
def q_mask(spark, sf):
    o = views.order_info(spark, sf, with_customer=False)
    return o.select("id", mask_phone("consignee_tel").alias("consignee_tel"))


@query("cdc_after_image")
def q_after_image(spark, sf):
    """Change envelopes (as JSON lines) -> parse -> filter -> one JSON per after-image."""
    return ingest.relay_orders(ingest.parse_changes(views.change_lines(spark, sf)))


@query("filter_cdc")
def q_filter_cdc(spark, sf):
    env = views.change_lines(spark, sf)
    parsed = env.select("key", F.from_json("value", ingest.CHANGE_ENVELOPE).alias("e")).select("key", "e.*")
    return ingest.filter_changes(parsed).select("key", "table", "op", F.size("rows").alias("n_rows"))


@query("route_by_type")
def q_route(spark, sf):
    return ingest.route_logs(views.raw_logs(spark, sf)).select("key", "topic")


@query("filter_date")
def q_filter_date(spark, sf):
    return on_date(dau_table(spark, sf, days=DAY), "logDate", P.DAY)


@query("shift_day")
def q_shift_day(spark, sf):
    days = startups(spark, sf, with_area=False).select("logDate").distinct()
    return days.select("logDate", prev_day("logDate").alias("prev_day"))


@query("sink_projection")
def q_sink_projection(spark, sf):
    d = dau_table(spark, sf)
    return d.select(*[F.col(s).alias(t) for s, t in zip(DAU_SINK_SOURCE, DAU_SINK_COLUMNS)])


@query("kv_fold")
def q_kv_fold(spark, sf):
    from pulse.functions import fold_map
    per_hour = metrics.dau_hour(dau_table(spark, sf, with_area=False, days=DAY), P.DAY)
    return per_hour.agg(F.to_json(fold_map("logHour", "ct")).alias("doc"))


@query("keyword_filter")
def q_keyword(spark, sf):
    return reports.filter_detail(views.sale_detail(spark, sf, views.GRID_SIDES), keyword=P.KEYWORD).select(*SALE_DETAIL_COLUMNS)


# --- joins -------------------------------------------------------------------------------

@query("anti_seen_today")
def q_anti_seen(spark, sf):
    """Afternoon startups minus devices already seen that morning (same day)."""
    s = startups(spark, sf, with_area=False)
    morning = dedup.first_per_key(s.where(F.col("logHour") < P.NOON), ["mid", "logDate"], ["ts"])
    afternoon = s.where(F.col("logHour") >= P.NOON)
    return dedup.drop_seen(afternoon, morning, ["mid", "logDate"]).select("mid", "logDate", "logHour", "ts")


@query("flag_first_order")
def q_flag_first(spark, sf):
    """Every order of the ``orders`` table, flagged "1" if it is the customer's first."""
    o = views.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("create_time"))
    return dedup.flag_first(o, "user_id", ["create_time", "id"])


@query("align_days")
def q_align(spark, sf):
    d = dau_table(spark, sf, with_area=False, days=TWO_DAYS)
    return joins.compare_days(d, "logDate", "logHour", lambda cond: F.count_if(cond), P.DAY)


@query("hour_spine")
def q_hour_spine(spark, sf):
    return metrics.dau_hour_filled(dau_table(spark, sf, with_area=False, days=DAY), P.DAY)


@query("sale_detail_wide")
def q_sale_detail(spark, sf):
    return views.sale_detail(spark, sf)


@query("province_dim")
def q_province(spark, sf):
    o = views.order_info(spark, sf).select("id", "province_id")
    return joins.with_province(o, views.table(spark, sf, "nation"))


# --- aggregations ---------------------------------------------------------------------------

@query("dau_total")
def q_dau_total(spark, sf):
    return metrics.dau_total(dau_table(spark, sf, with_area=False, days=DAY), P.DAY)


@query("dau_hour")
def q_dau_hour(spark, sf):
    return metrics.dau_hour(dau_table(spark, sf, with_area=False, days=DAY), P.DAY)


@query("order_amount")
def q_order_amount(spark, sf):
    return metrics.order_amount(order_table(spark, sf, DAY), P.DAY)


@query("order_amount_hour")
def q_order_amount_hour(spark, sf):
    return metrics.order_amount_hour(order_table(spark, sf, DAY), P.DAY)


@query("first_per_key")
def q_first_per_key(spark, sf):
    return dau_table(spark, sf)


@query("first_per_key_rn")
def q_first_per_key_rn(spark, sf):
    return dedup.first_per_key_rn(startups(spark, sf), ["mid", "logDate"], ["ts"])


@query("new_mid")
def q_new_mid(spark, sf):
    return metrics.new_devices(startups(spark, sf, with_area=False, days=UP_TO_DAY), P.DAY)


@query("kpi_summary")
def q_kpi(spark, sf):
    return metrics.kpi_summary(startups(spark, sf, with_area=False, days=UP_TO_DAY), order_table(spark, sf, DAY), P.DAY)


@query("launch_count")
def q_launches(spark, sf):
    return metrics.launches(startups(spark, sf, with_area=False))


@query("hourly_active")
def q_hourly_active(spark, sf):
    return metrics.hourly_active(with_date_hour(views.activity(spark, sf, DAY)), P.DAY)


@query("gender_share")
def q_gender(spark, sf):
    return metrics.gender_share(views.sale_detail(spark, sf, ("orders",)))


@query("age_share")
def q_age(spark, sf):
    return metrics.age_share(views.sale_detail(spark, sf, ("orders",)))


@query("province_sales")
def q_province_sales(spark, sf):
    return metrics.province_sales(views.sale_detail(spark, sf, ("orders", "customer", "nation")))


@query("sales_band")
def q_sales_band(spark, sf):
    return metrics.sales_bands(metrics.province_sales(views.sale_detail(spark, sf, ("orders", "customer", "nation"))))


@query("sku_rank")
def q_sku_rank(spark, sf):
    return metrics.sku_rank(views.sale_detail(spark, sf, ("part",)), P.TOP_N)


# --- windows ---------------------------------------------------------------------------------

@query("cum_dau")
def q_cum_dau(spark, sf):
    return metrics.cum_dau(dau_table(spark, sf, with_area=False, days=DAY), P.DAY)


@query("day_over_day")
def q_dod(spark, sf):
    return metrics.day_over_day(metrics.daily_dau(dau_table(spark, sf, with_area=False)))


# --- sort, limit, paging -----------------------------------------------------------------------

@query("paged_detail")
def q_paged(spark, sf):
    return reports.paged_detail(views.sale_detail(spark, sf, views.GRID_SIDES), P.PAGE_START, P.PAGE_LENGTH,
                                counted=views.sale_detail(spark, sf, ()))


@query("paged_detail_deep")
def q_paged_deep(spark, sf):
    """The page in the middle of the grid, sorted by price downwards, found by seeking."""
    grid, slim = views.sale_detail(spark, sf, views.GRID_SIDES), views.sale_detail(spark, sf, ())
    return reports.paged_detail(grid, slim.count() // 2, P.PAGE_LENGTH, order=[("sku_price", "desc"), ("order_id", "asc")], counted=slim, seek_from=0)


@query("detail_order_by")
def q_detail_order(spark, sf):
    return reports.detail_order_by(views.sale_detail(spark, sf, views.GRID_SIDES), P.DETAIL_ORDER, P.DETAIL_N)


# --- documents ------------------------------------------------------------------------------------

@query("report_total")
def q_report_total(spark, sf):
    kpis = metrics.kpi_summary(startups(spark, sf, with_area=False, days=UP_TO_DAY), order_table(spark, sf, DAY), P.DAY)
    return reports.report_total(kpis)


@query("report_hour")
def q_report_hour(spark, sf):
    d = dau_table(spark, sf, with_area=False, days=TWO_DAYS)
    o = order_table(spark, sf, TWO_DAYS)
    a = reports.report_hour("dau", d, o, P.DAY).select(F.lit("dau").alias("id"), "doc")
    b = reports.report_hour("order_amount", d, o, P.DAY).select(F.lit("order_amount").alias("id"), "doc")
    return a.unionByName(b)


@query("report_detail")
def q_report_detail(spark, sf):
    """The drill-down document for the keyword search: page 2 of 20 rows, total, shares."""
    return reports.report_detail(views.sale_detail(spark, sf, views.GRID_SIDES), P.DRAW, P.PAGE_START, P.PAGE_LENGTH,
                                 keyword=P.KEYWORD)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Devices by hour of first start on the report day, on the 24-hour axis."""
    return QUERIES["hour_spine"](spark, sf_dir)
