"""Micro-batch functions and stream jobs: replay safety, split invariance, late data."""

import json
import random

from pyspark.sql import functions as F

from pulse.operators import ingest
from pulse.streaming import jobs, sinks

DAY_MS = 86_400_000
BASE = 1_705_276_800_000  # 2024-01-15 00:00:00 UTC


def startup_lines(spark, recs):
    """recs: (mid, ts) -> parsed startup frame."""
    lines = [(json.dumps({"type": "startup", "mid": m, "uid": "1", "ts": t}),) for m, t in recs]
    return ingest.parse_startup(spark.createDataFrame(lines, "value string"))


def table_rows(spark, path):
    return sorted((r.mid, r.logDate, r.ts) for r in sinks.read_result(spark, path).collect())


def test_replay_leaves_table_unchanged(spark, scratch):
    t = scratch("dau")
    b0 = startup_lines(spark, [("a", BASE + 3000), ("a", BASE + 1000), ("b", BASE + 5)])
    b1 = startup_lines(spark, [("a", BASE + 500), ("c", BASE + 7), ("b", BASE + DAY_MS)])
    jobs.dau_batch(b0, 0, t)
    jobs.dau_batch(b1, 1, t)
    before = table_rows(spark, t)
    jobs.dau_batch(b1, 1, t)
    jobs.dau_batch(b0, 0, t)
    assert table_rows(spark, t) == before
    # earliest of the batch kept; an earlier ts in a later batch does not replace it
    assert ("a", "2024-01-15", BASE + 1000) in before
    assert ("b", "2024-01-16", BASE + DAY_MS) in before
    assert len(before) == 4


def test_a_bitmap_spares_new_devices_the_comparison(spark, scratch):
    """The same table with and without the bitmap; only devices that may be known are compared."""
    plain, bits, logs = scratch("plain"), scratch("bits"), []
    parts = [[(f"m{i}", BASE + i) for i in range(200)], [(f"m{i}", BASE + i) for i in range(190, 400)],
             [("m5", BASE + 9), ("z", BASE + DAY_MS)]]
    frames = [startup_lines(spark, p) for p in parts]
    for bid in (0, 1, 2, 2, 1):
        jobs.dau_batch(frames[bid], bid, plain)
        jobs.dau_batch(frames[bid], bid, bits, log=logs.append, bitmap=True, activity=True)
    assert table_rows(spark, bits) == table_rows(spark, plain) and len(table_rows(spark, bits)) == 401
    assert "compared" not in logs[0] and 10 <= logs[1]["compared"] < 30 and logs[1]["rows_new"] == 200
    assert logs[2]["compared"] == 1 and logs[2]["rows_new"] == 1
    from pulse.operators import metrics
    assert metrics.hourly_active_merged(jobs.read_activity(spark, bits), "2024-01-15").first().active == 400


def test_any_split_gives_same_keys(spark, scratch):
    rnd = random.Random(3)
    recs = [(f"m{rnd.randint(0, 30)}", BASE + rnd.randint(0, 3 * DAY_MS)) for _ in range(300)]
    expected = {(m, (t - BASE) // DAY_MS) for m, t in recs}
    for trial in range(2):
        t = scratch(f"split{trial}")
        rnd.shuffle(recs)
        cuts = sorted(rnd.sample(range(1, len(recs)), 3))
        parts = [recs[i:j] for i, j in zip([0, *cuts], [*cuts, len(recs)])]
        for bid, part in enumerate(parts):
            jobs.dau_batch(startup_lines(spark, part), bid, t)
        got = {(m, int(d[-2:]) - 15) for m, d, _ in table_rows(spark, t)}
        assert got == expected


def test_retention_drops_and_counts_late_rows(spark, scratch):
    t = scratch("late")
    logs = []
    b = startup_lines(spark, [("a", BASE + 5 * DAY_MS), ("b", BASE)])
    jobs.dau_batch(b, 0, t, retention_days=2, log=logs.append)
    assert [r[0] for r in table_rows(spark, t)] == ["a"]
    assert logs[0]["rows_in"] == 2 and logs[0]["late"] == 1 and logs[0]["rows_new"] == 1


def test_orders_batch_flags_and_quarantine(spark, scratch):
    t = scratch("orders")
    def line(i, user, ct, amt="1.0"):
        return (str(i), json.dumps({"id": str(i), "user_id": user, "create_time": ct, "total_amount": amt,
                                    "consignee_tel": "13812348888"}))
    b0 = spark.createDataFrame([line(1, "u", "2024-01-15 10:00:00"), line(2, "u", "2024-01-15 10:00:00"),
                                line(3, "v", "2024-01-15")], "key string, value string")
    b1 = spark.createDataFrame([line(4, "u", "2024-01-16 09:00:00"), line(5, "w", "2024-01-16 09:00:00")],
                               "key string, value string")
    logs = []
    jobs.orders_batch(b0, 0, t, logs.append)
    jobs.orders_batch(b1, 1, t, logs.append)
    jobs.orders_batch(b1, 1, t)
    rows = {r.id: (r.is_first_order, r.consignee_tel, r.create_hour)
            for r in sinks.read_result(spark, t).collect()}
    assert rows == {"1": ("1", "138****8888", "10"), "2": ("0", "138****8888", "10"),
                    "4": ("0", "138****8888", "09"), "5": ("1", "138****8888", "09")}
    assert logs[0]["quarantined"] == 1 and logs[1]["quarantined"] == 0


def test_dau_stream_end_to_end(spark, scratch):
    """File topic -> run_dau (availableNow) twice, the second run resumes from the checkpoint."""
    topic, table, ckpt = scratch("topic"), scratch("table"), scratch("ckpt")
    def write(recs):
        lines = [(m, json.dumps({"type": "startup", "mid": m, "ts": t})) for m, t in recs]
        spark.createDataFrame(lines, "key string, value string").write.mode("append").parquet(topic)
    write([("a", BASE + 10), ("a", BASE + 5)])
    for extra in ([], [("a", BASE + 1), ("b", BASE + 2)]):
        if extra:
            write(extra)
        src = spark.readStream.schema("key string, value string").parquet(topic)
        q = jobs.run_dau(src, table, ckpt, "available_now")
        q.awaitTermination()
    assert table_rows(spark, table) == [("a", "2024-01-15", BASE + 5), ("b", "2024-01-15", BASE + 2)]


def test_micro_batch_trigger_default(spark, scratch):
    src = spark.readStream.format("rate").option("rowsPerSecond", 1).load() \
        .select(F.lit('{"type":"startup","mid":"x","ts":1}').alias("value"))
    q = jobs.run_dau(src, scratch("rate_table"), scratch("rate_ckpt"))
    try:
        assert q.isActive
        assert jobs.MICRO_BATCH == "5 seconds"
    finally:
        q.stop()


def test_collector_two_sinks(spark, scratch):
    landing, topics, ckpt, src_dir = scratch("landing"), scratch("topics"), scratch("ck"), scratch("src")
    raw = spark.createDataFrame([("1", '{"type":"startup","mid":"a"}', BASE), ("2", '{"mid":"b"}', BASE + DAY_MS)],
                                "key string, value string, arrival_ms long")
    raw.write.parquet(src_dir)
    src = spark.readStream.schema("key string, value string, arrival_ms long").parquet(src_dir)
    jobs.run_collector(src, landing, topics, ckpt, "available_now").awaitTermination()
    routed = {r.key: r.topic for r in spark.read.parquet(topics).collect()}
    assert routed == {"1": ingest.TOPIC_STARTUP, "2": ingest.TOPIC_EVENT}
    landed = sorted(r.dt for r in spark.read.text(landing).collect())
    assert landed == ["2024-01-15", "2024-01-16"]


def test_dau_publishes_new_rows_once(spark, scratch):
    t, pub = scratch("pub_table"), scratch("pub_topic")
    b = startup_lines(spark, [("a", BASE + 2), ("a", BASE + 1), ("b", BASE)])
    jobs.dau_batch(b, 0, t, publish=pub)
    jobs.dau_batch(b, 0, t, publish=pub)
    out = spark.read.parquet(pub)
    assert sorted(json.loads(r.value)["ts"] for r in out.collect()) == [BASE, BASE + 1]


def test_file_topics_round_trip(spark, scratch):
    from pulse.sources.topics import read_changes, read_topic, record_json, write_topic
    base = scratch("topics_rt")
    df = spark.createDataFrame([("1", '{"type":"startup"}', "startup_log"), ("2", '{"x":1}', "event_log")],
                               "key string, value string, topic string")
    write_topic(df, fmt="parquet", path=base)
    write_topic(record_json(spark.createDataFrame([("3", "INSERT")], "id string, op string"), key="id"),
                topic="changes", fmt="parquet", path=base)
    s = read_topic(spark, "startup_log", fmt="parquet", path=base, max_per_trigger=1)
    c = read_changes(spark, "changes", fmt="parquet", path=base)
    assert s.isStreaming and c.isStreaming
    q = s.writeStream.format("memory").queryName("rt_startup").trigger(availableNow=True).start()
    q.awaitTermination()
    assert [r.value for r in spark.sql("select value from rt_startup").collect()] == ['{"type":"startup"}']
    assert spark.read.parquet(f"{base}/topic=changes").first().value == '{"id":"3","op":"INSERT"}'


def test_keyed_state_dau_evicts_finished_days(spark, scratch):
    topic, table, ckpt = scratch("ks_topic"), scratch("ks_table"), scratch("ks_ckpt")
    def run(recs):
        lines = [(m, json.dumps({"type": "startup", "mid": m, "ts": t})) for m, t in recs]
        spark.createDataFrame(lines, "key string, value string").write.mode("append").parquet(topic)
        src = spark.readStream.schema("key string, value string").parquet(topic)
        q = jobs.run_dau_keyed_state(src, table, ckpt, "available_now", retention_days=1)
        q.awaitTermination()
        return [p["stateOperators"][0] for p in q[0].recentProgress if p["stateOperators"]]
    run([("a", BASE + 9), ("a", BASE + 4), ("b", BASE + 1)])
    assert run([("a", BASE + 5 * DAY_MS)])[0]["numRowsTotal"] >= 1
    late = run([("c", BASE + 3)])   # 5 days behind the watermark: counted, not taken
    assert sum(s["numRowsDroppedByWatermark"] for s in late) == 1
    assert late[-1]["numRowsTotal"] == 1  # the keys of the finished day were evicted, the open day's stays
    run([("a", BASE + 5 * DAY_MS + 1)])  # same key later: already seen
    got = sorted((r.mid, r.logDate, r.ts) for r in sinks.read_latest(spark, table, jobs.DAU_KEYS).collect())
    assert got == [("a", "2024-01-15", BASE + 4), ("a", "2024-01-20", BASE + 5 * DAY_MS), ("b", "2024-01-15", BASE + 1)]


def test_compaction_keeps_table_and_dedup(spark, scratch):
    import os
    t = scratch("compact")
    for bid in range(3):
        jobs.dau_batch(startup_lines(spark, [(f"m{bid}", BASE + bid), ("a", BASE + 10 + bid)]), bid, t)
    before = table_rows(spark, t)
    assert sinks.compact_days(spark, t, "logDate", ["2024-01-15"]) == len(before)
    assert table_rows(spark, t) == before
    local = t.replace("file:", "")
    assert sorted(os.listdir(f"{local}/logDate=2024-01-15")) == ["batch=compact"]
    jobs.dau_batch(startup_lines(spark, [("a", BASE), ("n", BASE + 99)]), 3, t)
    after = table_rows(spark, t)
    assert after == sorted(before + [("n", "2024-01-15", BASE + 99)])


def test_collector_quarantines_lines_that_are_not_objects(spark, scratch):
    landing, topics = scratch("q_landing"), scratch("q_topics")
    raw = spark.createDataFrame([("1", '{"type":"startup"}', BASE), ("2", "not json", BASE), ("3", "[1]", BASE)],
                                "key string, value string, arrival_ms long")
    jobs.collect_batch(raw, 0, landing, topics)
    jobs.collect_batch(raw, 0, landing, topics)
    assert sorted(r.value for r in spark.read.parquet(landing + "_invalid").collect()) == ["[1]", "not json"]
    assert [r.key for r in spark.read.parquet(topics).collect()] == ["1"]


def test_dau_job_compacts_finished_days(spark, scratch):
    import os
    t, plain = scratch("auto_compact"), scratch("no_compact")
    logs = []
    batches = [[("a", BASE + d * DAY_MS + 5), ("b", BASE + d * DAY_MS + 7)] for d in range(5)]
    batches.insert(2, [("c", BASE + 10)])  # a late start for the first day
    for bid, recs in enumerate(batches):
        jobs.dau_batch(startup_lines(spark, recs), bid, t, log=logs.append, compact_lag_days=1, compact_every=1)
        jobs.dau_batch(startup_lines(spark, recs), bid, plain)
    assert table_rows(spark, t) == table_rows(spark, plain)
    local = t.replace("file:", "")
    assert os.listdir(f"{local}/logDate=2024-01-15") == ["batch=compact"]
    assert os.listdir(f"{local}/logDate=2024-01-16") == ["batch=compact"]
    assert "batch=compact" not in os.listdir(f"{local}/logDate=2024-01-19")
    assert any(entry.get("compacted") for entry in logs)


def test_order_job_compacts_finished_days(spark, scratch):
    import os
    t = scratch("orders_compact")
    def line(i, day):
        return (str(i), json.dumps({"id": str(i), "user_id": "u", "create_time": f"2024-01-{day} 10:00:00",
                                    "total_amount": "1.0", "consignee_tel": "13812348888"}))
    for bid, day in enumerate([15, 15, 16, 17, 18]):
        b = spark.createDataFrame([line(bid, day)], "key string, value string")
        jobs.orders_batch(b, bid, t, compact_lag_days=1, compact_every=1)
    rows = {r.id: r.is_first_order for r in sinks.read_result(spark, t).collect()}
    assert rows == {"0": "1", "1": "0", "2": "0", "3": "0", "4": "0"}
    assert os.listdir(f"{t.replace('file:', '')}/create_date=2024-01-15") == ["batch=compact"]
    users = t.replace("file:", "") + "_users"
    assert sorted(os.listdir(f"{users}/gen=0")) == ["batch=compact"]


def test_late_start_after_compaction(spark, scratch):
    t = scratch("late_after_compact")
    jobs.dau_batch(startup_lines(spark, [("a", BASE + 5)]), 0, t)
    jobs.dau_batch(startup_lines(spark, [("b", BASE + 9)]), 1, t)
    sinks.compact_days(spark, t, "logDate", ["2024-01-15"])
    jobs.dau_batch(startup_lines(spark, [("a", BASE + 1), ("c", BASE + 2)]), 2, t)
    assert table_rows(spark, t) == [("a", "2024-01-15", BASE + 5), ("b", "2024-01-15", BASE + 9),
                                    ("c", "2024-01-15", BASE + 2)]
    jobs.dau_batch(startup_lines(spark, [("a", BASE + 1), ("c", BASE + 2)]), 2, t)  # replay
    assert len(table_rows(spark, t)) == 3


def feed(spark, topic, lines):
    spark.createDataFrame([(None, x) for x in lines], "key string, value string").write.mode("append").parquet(topic)
    return spark.readStream.schema("key string, value string").parquet(topic)


def start_line(mid, ts):
    return json.dumps({"type": "startup", "mid": mid, "ts": ts})


def test_late_and_malformed_starts_give_the_same_table_in_both_modes(spark, scratch):
    tables = {}
    for mode in ("table", "state"):
        topic, table, ckpt = (scratch(f"{mode}_{x}") for x in ("topic", "table", "ckpt"))
        logs = []
        for lines in ([start_line("a", BASE + 3 * DAY_MS), "not json", json.dumps({"mid": "x"})],
                      [start_line("b", BASE), start_line("a", BASE + 3 * DAY_MS + 1), json.dumps({"ts": 5})]):
            src = feed(spark, topic, lines)
            q = (jobs.run_dau(src, table, ckpt, "available_now", log=logs.append) if mode == "table"
                 else jobs.run_dau_keyed_state(src, table, ckpt, "available_now"))
            q.awaitTermination()
            assert not q.exception()
        tables[mode] = sorted((r.mid, r.logDate, r.ts) for r in sinks.read_latest(spark, table, jobs.DAU_KEYS).collect())
        bad = sorted(r.value for r in spark.read.parquet(f"{table}_quarantine").collect())
        assert bad == sorted(["not json", json.dumps({"mid": "x"}), json.dumps({"ts": 5})])
        if mode == "table":
            assert [x["quarantined"] for x in logs] == [2, 1]
    assert tables["table"] == tables["state"] == [("a", "2024-01-18", BASE + 3 * DAY_MS), ("b", "2024-01-15", BASE)]


def order_line(i, user, time, amount="1.0", operate=""):
    return json.dumps({"id": str(i), "user_id": user, "create_time": time, "total_amount": amount, "operate_time": operate,
                       "consignee_tel": "13812348888"})


ORDER_BATCHES = [
    [order_line(1, "u", "2024-01-15 10:00:00", "10.0"), order_line(1, "u", "2024-01-15 10:00:00", "10.0"),
     order_line(2, "u", "2024-01-15 11:00:00"), order_line(3, None, "2024-01-15 11:00:00"), order_line(9, "x", "2024/01/15 10:00:00"),
     order_line(10, "x", "garbage 10:00:00"), order_line(11, "x", ""), "{broken"],
    [order_line(1, "u", "2024-01-15 10:00:00", "10.0"), order_line(2, "u", "2024-01-15 11:00:00", "5.0", "2024-01-16 00:00:00"),
     order_line(2, "u", "2024-01-15 11:00:00", "4.0", "2024-01-15 23:00:00"), order_line(4, "v", "2024-01-16 09:00:00")],
    [order_line(5, "v", "2024-01-17 09:00:00"), order_line(6, None, "2024-01-17 09:00:00")],
]
ORDERS_WANTED = {"1": (10.0, "1"), "2": (5.0, "0"), "3": (1.0, "0"), "4": (1.0, "1"), "5": (1.0, "0"), "6": (1.0, "0")}


def test_orders_are_upserted_in_both_modes(spark, scratch):
    """Repeats inside and across batches, a corrected order, orders without a user, invalid times."""
    for mode in ("table", "state"):
        topic, table, ckpt = (scratch(f"up_{mode}_{x}") for x in ("topic", "table", "ckpt"))
        for lines in ORDER_BATCHES:
            src = feed(spark, topic, lines)
            run = jobs.run_orders if mode == "table" else jobs.run_orders_keyed_state
            q = run(src, table, ckpt, "available_now")
            q.awaitTermination()
            assert not q.exception()
        rows = jobs.read_orders(spark, table).collect()
        assert {r.id: (r.total_amount, r.is_first_order) for r in rows} == ORDERS_WANTED and len(rows) == 6
        assert spark.read.parquet(f"{table}_quarantine").count() == 4


def test_known_users_are_a_set_and_replays_change_nothing(spark, scratch):
    table = scratch("set")
    parts = [spark.createDataFrame([(x,) for x in lines], "value string") for lines in ORDER_BATCHES]
    for bid in (0, 1, 2, 2, 1, 0):
        jobs.orders_batch(parts[bid], bid, table)
    rows = jobs.read_orders(spark, table).collect()
    assert {r.id: (r.total_amount, r.is_first_order) for r in rows} == ORDERS_WANTED
    users = [r.user_id for r in spark.read.parquet(f"{table}_users").collect()]
    assert sorted(users) == ["u", "v"]
    assert sinks.compact_days(spark, table, "create_date", ["2024-01-15"], ["id"]) == 3
    assert {r.id: (r.total_amount, r.is_first_order) for r in jobs.read_orders(spark, table).collect()} == ORDERS_WANTED


def test_a_cluster_without_a_shared_folder_is_refused():
    import pytest

    from pulse import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        session.shared_dir(Session(), "x")


def test_only_a_missing_table_counts_as_not_written(spark, scratch):
    import pytest
    assert sinks.read_or_none(spark, scratch("nothing")) is None
    path = scratch("text")
    spark.createDataFrame([("no parquet",)], "value string").write.text(path)
    with pytest.raises(Exception, match="parquet|Parquet"):
        sinks.read_or_none(spark, path).count()
