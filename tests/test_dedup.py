"""first-per-key, anti join and first-order flags."""

import random

from pyspark.sql import functions as F

from pulse.operators import dedup, metrics

SCHEMA = "mid string, logDate string, logHour string, ts long, vs string"


def test_keeps_earliest_in_batch(spark):
    df = spark.createDataFrame([("m", "2024-01-15", "00", 3000, "a"), ("m", "2024-01-15", "00", 1000, "b")], SCHEMA)
    r = dedup.first_per_key(df, ["mid", "logDate"], ["ts"]).collect()
    assert [(x.ts, x.vs) for x in r] == [(1000, "b")]


def test_two_days_two_rows(spark):
    df = spark.createDataFrame([("m", "2024-01-15", "23", 1, "a"), ("m", "2024-01-16", "00", 2, "a")], SCHEMA)
    assert dedup.first_per_key(df, ["mid", "logDate"], ["ts"]).count() == 2


def test_equal_ts_tiebreak_is_total(spark):
    df = spark.createDataFrame([("m", "d", "00", 5, "z"), ("m", "d", "00", 5, "a")], SCHEMA)
    assert dedup.first_per_key(df, ["mid", "logDate"], ["ts"]).first().vs == "a"
    assert dedup.first_per_key_rn(df, ["mid", "logDate"], ["ts"]).first().vs == "a"


def test_aggregate_form_equals_row_number_form(spark):
    rnd = random.Random(7)
    rows = [(f"m{rnd.randint(0, 20)}", f"2024-01-{rnd.randint(10, 12)}", f"{rnd.randint(0, 23):02d}",
             rnd.randint(0, 50), rnd.choice(["a", "b", None])) for _ in range(500)]
    df = spark.createDataFrame(rows, SCHEMA)
    a = sorted(map(tuple, dedup.first_per_key(df, ["mid", "logDate"], ["ts"]).collect()), key=str)
    b = sorted(map(tuple, dedup.first_per_key_rn(df, ["mid", "logDate"], ["ts"]).collect()), key=str)
    assert a == b


def test_first_per_key_is_partial_aggregate(spark):
    df = spark.createDataFrame([("m", "d", "00", 1, "a")], SCHEMA)
    plan = dedup.first_per_key(df, ["mid", "logDate"], ["ts"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan


def test_drop_seen(spark):
    batch = spark.createDataFrame([("a", "d", "01", 1, None), ("b", "d", "01", 1, None)], SCHEMA)
    seen = spark.createDataFrame([("a", "d", "00", 0, None), ("b", "e", "00", 0, None)], SCHEMA)
    assert [r.mid for r in dedup.drop_seen(batch, seen, ["mid", "logDate"]).collect()] == ["b"]


def test_flag_first_same_second_smaller_id(spark):
    df = spark.createDataFrame([("10", "u", "2024-01-15 10:00:00"), ("9", "u", "2024-01-15 10:00:00"),
                                ("1", "v", "2024-01-15 11:00:00")], "id string, user_id string, create_time string")
    out = dedup.flag_first(df, "user_id", ["create_time", *dedup.numeric_id("id")])
    assert {r.id: r.is_first_order for r in out.collect()} == {"10": "0", "9": "1", "1": "1"}
    known = spark.createDataFrame([("v",)], "user_id string")
    out = dedup.flag_first(df, "user_id", ["create_time", *dedup.numeric_id("id")], known)
    assert {r.id: r.is_first_order for r in out.collect()} == {"10": "0", "9": "1", "1": "0"}


def test_day_without_data(spark):
    dau = spark.createDataFrame([("m", "2024-01-14", "01", 1, "a")], SCHEMA)
    assert metrics.dau_total(dau, "2024-01-15").first().dau == 0
    orders = spark.createDataFrame([("2024-01-14", "01", 2.5)], "create_date string, create_hour string, total_amount double")
    assert metrics.order_amount(orders, "2024-01-15").first().order_amount is None
    assert metrics.order_amount(orders, None).first().order_amount is None


def test_hourly_active_exact_and_approx(spark):
    rows = [(f"m{i % 7}", "2024-01-15", f"{i % 3:02d}") for i in range(60)] + [("z", "2024-01-14", "00")]
    df = spark.createDataFrame(rows, "mid string, logDate string, logHour string")
    exact = {r.logHour: r.active for r in metrics.hourly_active(df, "2024-01-15").collect()}
    approx = {r.logHour: r.active for r in metrics.hourly_active(df, "2024-01-15", approx=True).collect()}
    assert exact == {"00": 7, "01": 7, "02": 7} and approx == exact


def test_kpi_totals_as_kpi_summary(spark):
    dau = spark.createDataFrame([("a", "2024-01-14", "01", 1, "x"), ("a", "2024-01-15", "02", 2, "x"),
                                 ("b", "2024-01-15", "03", 3, "x")], SCHEMA)
    orders = spark.createDataFrame([("2024-01-15", "01", 2.5)], "create_date string, create_hour string, total_amount double")
    per_hour = dau.groupBy("logDate", "logHour").agg(F.count(F.lit(1)).alias("devices"))
    new = dedup.first_per_key(dau, ["mid"], ["ts"]).groupBy("logDate").agg(F.count(F.lit(1)).alias("new_mid"))
    money = orders.groupBy("create_date", "create_hour").agg(F.sum("total_amount").cast("decimal(28,2)").alias("amount"), F.count(F.lit(1)).alias("orders"))
    for day in ("2024-01-15", "2024-01-14", "2024-02-01"):
        a = {r.id: r.value for r in metrics.kpi_summary(dau, orders, day).collect()}
        b = {r.id: r.value for r in metrics.kpi_totals(per_hour, new, money, day).collect()}
        assert a == b


def test_seen_bits_clear_new_keys(spark):
    """Rows cleared by the bitmap are surely new; the others are compared exactly."""
    seen = spark.createDataFrame([(f"m{i}", "2024-01-15") for i in range(500)], "mid string, logDate string")
    batch = spark.createDataFrame([(f"m{i}", "2024-01-15", i) for i in range(400, 2400)] + [("m1", "2024-01-16", 1), (None, "2024-01-15", 2)],
                                  "mid string, logDate string, ts long")
    keys = ["mid", "logDate"]
    parts = dedup.seen_bits(seen.limit(250), keys).unionByName(dedup.seen_bits(seen, keys))
    marked = dedup.maybe_seen(batch, dedup.merged_bits(parts), keys)
    assert {r.mid for r in marked.where("_maybe").collect()} >= {f"m{i}" for i in range(400, 500)}
    assert marked.where("_maybe").count() < 120
    new = dedup.drop_marked(marked, seen, keys)
    want = batch.join(seen, keys, "left_anti")
    assert sorted(map(str, new.collect())) == sorted(map(str, want.collect())) and new.columns == batch.columns


def test_merged_sketches_ignore_redelivery(spark):
    rows = [(f"m{i}", "2024-01-15", f"{i % 2:02d}") for i in range(20_000)]
    df = spark.createDataFrame(rows, "mid string, logDate string, logHour string")
    parts = [metrics.activity_sketches(df.where(F.pmod(F.xxhash64("mid"), F.lit(3)) == k)) for k in range(3)]
    for sketches in (parts[0].unionByName(parts[1]).unionByName(parts[2]), parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[1])):
        got = {r.logHour: r.active for r in metrics.hourly_active_merged(sketches, "2024-01-15").collect()}
        assert set(got) == {"00", "01"} and all(abs(n - 10_000) <= 300 for n in got.values())
    assert metrics.hourly_active_merged(parts[0], "2024-01-16").count() == 0
