"""Edge cases of the column functions and the ingest operators (FIXTURES §3)."""


from pulse.functions import (AGE_LABELS, age_band, mask_phone, match_keyword, on_date, prev_day,
                             route_topic, sales_band, split_create_time, stamp_ts)
from pulse.operators import ingest


def col_values(df, col):
    return [r[col] for r in df.select(col).collect()]


def test_mask_phone(spark):
    df = spark.createDataFrame([("13812348888",), ("12",), (None,)], "t string")
    assert col_values(df.select(mask_phone("t").alias("m")), "m") == ["138****8888", "12****", None]


def test_route_missing_type_goes_to_event_topic(spark):
    df = spark.createDataFrame([('{"type":"startup","mid":"a"}',), ('{"mid":"b"}',),
                                ('{"type":"event"}',), ("not json",)], "value string")
    out = col_values(df.select(route_topic("value", "S", "E").alias("t")), "t")
    assert out == ["S", "E", "E", "E"]


def test_prev_day(spark):
    df = spark.createDataFrame([("2024-03-01",), ("2024-01-01",), ("bad",), (None,)], "d string")
    assert col_values(df.select(prev_day("d").alias("p")), "p") == ["2024-02-29", "2023-12-31", None, None]


def test_split_create_time(spark):
    df = spark.createDataFrame([("2024-01-15 09:08:07",), ("2024-01-15",), (None,)], "c string")
    d, h = split_create_time("c")
    rows = df.select(d.alias("d"), h.alias("h")).collect()
    assert [(r.d, r.h) for r in rows] == [("2024-01-15", "09"), ("2024-01-15", None), (None, None)]


def test_on_date_null_day_selects_nothing(spark):
    df = spark.createDataFrame([("2024-01-15",), (None,)], "logDate string")
    assert on_date(df, "logDate", None).count() == 0
    assert on_date(df, "logDate", "2024-01-15").count() == 1


def test_match_keyword(spark):
    df = spark.createDataFrame([("red ring",), ("RING of Red",), ("red rod",), (None,)], "n string")
    assert df.where(match_keyword("n", "  ")).count() == 4
    assert col_values(df.where(match_keyword("n", "RING red")), "n") == ["red ring", "RING of Red"]


def test_age_band_edges(spark):
    df = spark.createDataFrame([(19,), (20,), (30,), (31,), (None,)], "a int")
    out = col_values(df.select(age_band("a").alias("b")), "b")
    assert out == [AGE_LABELS[0], AGE_LABELS[1], AGE_LABELS[1], AGE_LABELS[2], None]


def test_sales_band(spark):
    df = spark.createDataFrame([(-5.0,), (0.0,), (99.9,), (100.0,), (650.0,)], "v double")
    assert col_values(df.select(sales_band("v").alias("b")), "b") == [0, 0, 0, 1, 5]


def test_stamp_overwrites_ts_and_keeps_types(spark):
    df = spark.createDataFrame([('{"a":1,"ts":5,"b":{"c":[1,"x"]}}', 9), ("[1]", 9), ("nope", 9)],
                               "value string, t long")
    out = col_values(df.select(stamp_ts("value", "t").alias("v")), "v")
    assert out[0] == '{"a":1,"b":{"c":[1,"x"]},"ts":9}'
    assert out[1] is None and out[2] is None


def test_change_filter_and_after_image(spark):
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    rows = [
        ("ROWDATA", "order_info", "INSERT", [[("id", "1"), ("x", "a"), ("x", "b")]]),
        ("ROWDATA", "order_info", "INSERT", []),
        ("ROWDATA", "other", "INSERT", [[("id", "2")]]),
        ("ROWDATA", "order_info", "UPDATE", [[("id", "3")]]),
        ("ROWDATA", "order_info", "DELETE", [[("id", "4")]]),
        ("TRANSACTIONEND", "order_info", "INSERT", [[("id", "5")]]),
    ]
    df = spark.createDataFrame(rows, ingest.CHANGE_ENVELOPE)
    out = col_values(ingest.relay_orders(df), "value")
    assert out == ['{"id":"1","x":"b"}']


def test_parse_order_quarantine(spark):
    lines = spark.createDataFrame([('{"id":"1","create_time":"2024-01-15 10:00:00","total_amount":"1.5"}',),
                                   ('{"id":"2","create_time":"2024-01-15","total_amount":"x"}',),
                                   ("{broken",)], "value string")
    good, bad = ingest.split_valid_orders(ingest.prepare_orders(ingest.parse_order(lines)))
    g = good.collect()
    assert [(r.id, r.create_hour, r.total_amount) for r in g] == [("1", "10", 1.5)]
    assert bad.count() == 2


def test_parse_startup_binds_type_and_ignores_unknown(spark):
    lines = spark.createDataFrame([('{"type":"startup","mid":"m1","zzz":1,"ts":1705312800000}',)], "value string")
    r = ingest.parse_startup(lines).first()
    assert (r.mid, r.logType, r.logDate, r.logHour, r.uid) == ("m1", "startup", "2024-01-15", "10", None)


def test_undecodable_changes_are_quarantined(spark):
    lines = spark.createDataFrame([('{"entry_type":"ROWDATA","table":"order_info","op":"INSERT","rows":[]}',),
                                   ("{not json",), ('{"op":"INSERT"}',), ("[1,2]",)], "value string")
    good, bad = ingest.split_valid_changes(lines)
    assert [r.table for r in good.collect()] == ["order_info"]
    assert sorted(r.value for r in bad.collect()) == sorted(["{not json", '{"op":"INSERT"}', "[1,2]"])


def test_cdc_quarantine_stream(spark, scratch):
    from pulse.streaming import jobs
    src_dir, out, ck = scratch("cq_src"), scratch("cq_out"), scratch("cq_ck")
    spark.createDataFrame([("1", "{bad"), ("2", '{"entry_type":"ROWDATA","table":"t","op":"INSERT","rows":[]}')],
                          "key string, value string").write.parquet(src_dir)
    src = spark.readStream.schema("key string, value string").parquet(src_dir)
    jobs.run_cdc_quarantine(src, out, ck, "available_now").awaitTermination()
    assert [r.value for r in spark.read.parquet(out).collect()] == ["{bad"]
