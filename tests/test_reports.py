"""Documents and paging."""

import json

import pytest
from pyspark.sql import functions as F

from pulse.operators import reports
from pulse.schemas import SALE_DETAIL_COLUMNS

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def detail(spark):
    from pulse.sources import views
    return views.sale_detail(spark, SF).cache()


def test_paging_is_a_window_of_the_total_order(spark, detail):
    full = [tuple(r) for r in detail.select(*SALE_DETAIL_COLUMNS).orderBy(*SALE_DETAIL_COLUMNS).collect()]
    page = reports.paged_detail(detail, 10, 10).collect()
    assert [tuple(r)[:-1] for r in page] == full[10:20]
    assert {r.total for r in page} == {len(full)}
    with pytest.raises(ValueError):
        reports.paged_detail(detail, 0, 0)


@pytest.mark.parametrize("order", [(), (("sku_price", "desc"), ("order_id", "asc")), (("user_level", "asc"), ("user_age", "desc"))])
def test_sought_pages_are_those_of_the_offset(spark, detail, order):
    """Pages at the start, the middle and the end, over heavy ties, at range ends and past the end."""
    total = detail.count()
    for start in (0, 7, total // 2, total - 5, total, total + 3):
        a = reports.paged_detail(detail, start, 20, order=order, seek_from=1 << 60).collect()
        b = reports.paged_detail(detail, start, 20, order=order, seek_from=0).collect()
        assert [tuple(r) for r in a] == [tuple(r) for r in b]


def test_seeking_reads_one_range(spark):
    """Nulls, ties and both directions; what is left to sort holds few rows and the page."""
    from pulse.operators import paging
    rows = [(None if i % 11 == 0 else i % 40, f"k{i % 7}", i) for i in range(3000)]
    df = spark.createDataFrame(rows, "a int, b string, c long")
    for order in ([("a", False), ("b", True), ("c", False)], [("a", True), ("b", False), ("c", True)], [("c", False)]):
        keys = [F.col(c).desc_nulls_last() if d else F.col(c).asc_nulls_first() for c, d in order]
        whole = [tuple(r) for r in df.orderBy(*keys).collect()]
        for start in (0, 1, 299, 1500, 2990, 2999):
            inside, offset, total = paging.seek(df, order, start, 20, few=50)
            left = df.where(inside)
            assert total == 3000 and left.count() <= 200
            assert [tuple(r) for r in left.orderBy(*keys).offset(offset).limit(20).collect()] == whole[start:start + 20]
    text = df.where(paging.seek(df, [("c", False)], 1500, 20, few=50)[0])._jdf.queryExecution().optimizedPlan().toString()
    assert "c#" in text and ">" in text and "<" in text  # a range of the plain column, which scans can use


def test_report_detail_shape(spark, detail):
    doc = json.loads(reports.report_detail(detail, 7, 0, 10, keyword="ring").first().doc)
    assert doc["draw"] == 7
    data = doc["data"]
    assert data["total"] == detail.where(F.lower("sku_name").contains("ring")).count()
    assert len(data["detail"]) == 10 and len(data["stat"]) == 2
    assert sum(o["value"] for o in data["stat"][0]["options"]) == data["total"]
    assert sum(o["value"] for o in data["stat"][1]["options"]) == data["total"]


def test_report_hour_unknown_metric(spark):
    d = spark.createDataFrame([("m", "2024-01-15", "01")], "mid string, logDate string, logHour string")
    assert reports.report_hour("nope", d, d, "2024-01-15").first().doc is None
    doc = json.loads(reports.report_hour("dau", d, d, "2024-01-15").first().doc)
    assert doc == {"yesterday": {}, "today": {"01": 1}}


def test_report_total_null_value_drops_key(spark):
    kpis = spark.createDataFrame([(2, "new_mid", "n", 4.0), (1, "dau", "d", 3.0), (3, "order_amount", "o", None)],
                                 "ord int, id string, name string, value double")
    doc = json.loads(reports.report_total(kpis).first().doc)
    assert doc == [{"id": "dau", "name": "d", "value": 3}, {"id": "new_mid", "name": "n", "value": 4},
                   {"id": "order_amount", "name": "o"}]


def test_level_and_day_filters(spark, detail):
    lvl = reports.filter_detail(detail, level=3)
    assert lvl.count() == detail.where(F.col("user_level") == "3").count() > 0
    day = detail.select("dt").first().dt
    assert reports.filter_detail(detail, day=day).count() == detail.where(F.col("dt") == day).count()
    assert reports.filter_detail(detail, day="not-a-day").count() == 0


def test_a_page_past_the_end_keeps_the_total(spark, detail):
    total = detail.count()
    rows = reports.paged_detail(detail, total + 10, 10).collect()
    assert [r.total for r in rows] == [total] and rows[0].order_detail_id is None
    last = reports.paged_detail(detail, max(0, total - 1), 10).collect()
    assert len(last) == 1 and last[0].order_detail_id is not None


def test_page_sizes_are_bounded(detail):
    import pytest
    for start, length in ((0, 11), (0, 0), (-1, 10), (0, 1000)):
        with pytest.raises(ValueError):
            reports.paged_detail(detail, start, length)
        with pytest.raises(ValueError):
            reports.report_detail(detail, 1, start, length)


def test_report_detail_takes_an_order(detail):
    import json
    doc = json.loads(reports.report_detail(detail, 1, 0, 20, order=[("sku_price", "desc"), ("user_age", "asc")]).first().doc)
    got = [r["order_detail_id"] for r in doc["data"]["detail"]]
    want = [r.order_detail_id for r in reports.detail_order_by(detail, [("sku_price", "desc"), ("user_age", "asc")], 20).collect()]
    assert got == want
