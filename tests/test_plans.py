"""The physical plans keep the shapes the design relies on (see PLANS.md)."""

import contextlib
import io

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    out = io.StringIO()
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "5000")  # whole filter lists
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.fixture(scope="module")
def q():
    return E.queries()


def test_paging_and_ranking_are_top_k(spark, q):
    assert "TakeOrderedAndProject" in plan_of(q["paged_detail"](spark, SF))
    assert "TakeOrderedAndProject" in plan_of(q["sku_rank"](spark, SF))


def test_dedup_is_partially_aggregated_and_scan_pruned(spark, q):
    p = plan_of(q["hour_spine"](spark, SF))
    assert "partial_min" in p
    scan = [line for line in p.splitlines() if "FileScan parquet" in line and "events" in line][0]
    assert "value" not in scan.split("ReadSchema:")[1] and "event_id" not in scan.split("ReadSchema:")[1]
    assert "EqualTo(event_type,view)" in p


DAY_QUERIES = ["dau_total", "dau_hour", "hour_spine", "filter_date", "kv_fold", "align_days", "cum_dau", "hourly_active", "order_amount",
               "order_amount_hour", "kpi_summary", "report_total", "report_hour", "new_mid"]


@pytest.mark.parametrize("name", DAY_QUERIES)
def test_the_day_reaches_the_scan(spark, q, name):
    """A range of the raw time column is pushed into every scan of events."""
    scans = [line for line in plan_of(q[name](spark, SF)).splitlines() if "FileScan parquet" in line and "events" in line]
    assert scans
    for scan in scans:
        pushed = scan.split("PushedFilters:")[1]
        assert "LessThan(ts," in pushed and "GreaterThanOrEqual(ts," in pushed


def scanned(spark, q, name):
    import re
    return sorted(re.findall(r"sf0\.001/(\w+)\.parquet", plan_of(q[name](spark, SF))))


def test_reports_scan_what_they_need(spark, q):
    assert scanned(spark, q, "gender_share") == scanned(spark, q, "age_share") == ["lineitem", "orders"]
    assert scanned(spark, q, "province_sales") == scanned(spark, q, "sales_band") == ["customer", "lineitem", "nation", "orders"]
    assert scanned(spark, q, "sku_rank") == ["lineitem", "part"]
    assert scanned(spark, q, "order_amount") == scanned(spark, q, "mask_phone") == scanned(spark, q, "datetime_split") == ["events"]
    assert scanned(spark, q, "hourly_active") == ["events"]
    assert scanned(spark, q, "kpi_summary") == ["events", "events"]
    assert set(scanned(spark, q, "paged_detail")) == {"lineitem", "orders", "part"}


def test_star_join_shuffles_line_items_twice_without_broadcast(spark, q):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = q["sale_detail_wide"](spark, SF)
        spark.conf.set("spark.sql.adaptive.enabled", "false")  # static plan
        p = plan_of(df)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    exchanges = [line for line in p.splitlines() if "Exchange hashpartitioning" in line]
    assert sum("l_orderkey" in e for e in exchanges) == 1
    assert sum("l_partkey" in e for e in exchanges) == 1
    assert "BroadcastExchange" in p  # the 25-row nation dimension keeps its hint


def test_first_order_join_is_salted_and_hot_list_broadcast(spark, q):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = q["flag_first_order"](spark, SF)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        p = plan_of(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert any("hashpartitioning(_spot" in line for line in p.splitlines())
    assert "BroadcastExchange" in p and "partial_min" in p


def test_kpi_list_is_a_union_without_joins(spark, q):
    p = plan_of(q["kpi_summary"](spark, SF))
    physical = p.split("== Physical Plan ==")[-1]
    assert "Union" in physical
    assert "CartesianProduct" not in physical and "BroadcastNestedLoopJoin" not in physical
