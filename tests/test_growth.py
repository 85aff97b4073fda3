"""What the stream jobs pay per row: calls to the state, tasks of the input, plans that are not run again."""

import json
import random
import threading
from pathlib import Path

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from pulse import session
from pulse.operators import dedup
from pulse.plans import streams
from pulse.sources import views
from pulse.streaming import jobs, keyed


class Handle:
    """A map state that counts its calls."""

    def __init__(self):
        self.kept, self.calls = {}, 0

    def getMapState(self, name, key, value, ttlDurationMs=None):
        return self

    def getValue(self, key):
        self.calls += 1
        return self.kept.get(key)

    def updateValue(self, key, value):
        self.calls += 1
        self.kept[key] = value


class Clock:
    def __init__(self, now):
        self.now = now

    def getCurrentProcessingTimeInMs(self):
        return self.now


def test_slots_hold_any_number_of_keys_in_small_slots():
    handle, want, rng = Handle(), {}, random.Random(1)
    for _ in range(20):
        slots = keyed.Slots(handle)
        for _ in range(1_000):
            k = f"k{rng.randrange(9_000)}"
            assert slots.get(k) == want.get(k)
            want[k] = [rng.random()]
            slots.put(k, want[k])
        slots.flush()
    assert dict(keyed.Slots(handle).items()) == want and len(want) > 7_000
    assert max(len(json.loads(v[1])) for v in handle.kept.values()) <= 4 * keyed.SLOT_ENTRIES
    handle.calls = 0
    slots = keyed.Slots(handle)
    for k in want:
        slots.put(k, [0])
    slots.flush()
    assert dict(keyed.Slots(handle).items()) == {k: [0] for k in want}


def test_slots_beyond_the_cache_are_written_and_read_again(monkeypatch):
    monkeypatch.setattr(keyed, "CACHED", 3)
    handle, keys = Handle(), [f"k{i}" for i in range(2_000)]
    slots = keyed.Slots(handle, most=8)
    for k in keys:
        slots.put(k, [k])
    assert len(slots.slots) <= 3
    slots.flush()
    assert all(keyed.Slots(handle, most=8).get(k) == [k] for k in keys[::37])


def test_dead_entries_go_when_a_slot_is_written():
    handle = Handle()
    for now in (0, 10):
        slots = keyed.Slots(handle, alive=lambda e: e[0] > now)
        slots.put(f"k{now}", [now + 5])
        slots.flush()
    assert dict(keyed.Slots(handle).items()) == {"k10": [15]}


def orders(n, users):
    for i in range(n):
        u, time = f"u{i % users}", f"2024-01-15 {i % 24:02d}:00:00"
        record = json.dumps({"id": str(i), "user_id": u, "create_time": time, "create_date": "2024-01-15"})
        yield Row(user_id=u, _user=json.dumps({"user_id": u}, separators=(",", ":")), _key=json.dumps({"user_id": u, "id": str(i)}, separators=(",", ":")),
                  _id=str(i), _time=time, _date="2024-01-15", _record=record)


def test_orders_that_come_together_share_state_calls():
    handle = Handle()
    state = keyed.FirstOrders(["id", "user_id", "create_time", "create_date", "operate_time"], set(), "first")
    state.init(handle)
    out = {r["_record"]: r["first"] for r in sorted(state.handleInputRows((1,), orders(600, 50), Clock(1)), key=lambda r: r["_seq"])}
    assert len(out) == 600 and sum(v == "1" for v in out.values()) == 50
    assert handle.calls < 600
    handle.calls = 0
    assert list(state.handleInputRows((1,), orders(600, 50), Clock(2))) == [] and handle.calls < 600


def test_devices_are_grouped_by_buckets(spark):
    names = "mid string, logDate string, logHour string, ts bigint"
    rows = spark.createDataFrame([("m1", "2024-01-15", "00", 5), ("m1", "2024-01-15", "00", 3), ("m2", "2024-01-15", None, 4)], names)
    got = keyed._by_bucket(rows.coalesce(1), ["mid", "logDate"]).collect()
    assert {(r["_key"], r["_ts"]) for r in got} == {('{"mid":"m1","logDate":"2024-01-15"}', 3), ('{"mid":"m2","logDate":"2024-01-15"}', 4)}
    assert len(got) == 2 and all(0 <= r["_bucket"] < keyed.BUCKETS for r in got)


def test_few_splits_are_dealt_over_the_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    few = views.dealt(spark.range(0, 1_000, 1, 3))
    assert few.rdd.getNumPartitions() >= cores and few.count() == 1_000
    many = spark.range(0, 1_000, 1, 4 * cores)
    assert views.dealt(many) is many


def test_corrections_need_no_join(spark):
    part = spark.createDataFrame([(None if i == 7 else f"k{i}", f'{{"total_amount":"{i}.5"}}', i) for i in range(40)], "key string, value string, at bigint")
    first, late = streams.corrected([part])
    assert "Join" not in first._jdf.queryExecution().optimizedPlan().toString()
    old = streams.some(part, 3).select("key")
    kept = part.join(old, "key", "left_anti").select(*part.columns)
    changed = streams.some(part, 3).withColumn("value", F.lit('{"total_amount":"0.01"}'))
    by = lambda df: sorted(map(str, df.collect()))
    assert by(first) == by(changed.unionByName(kept)) and late.count() == old.count()


def test_orders_of_a_batch_are_parsed_once(spark, scratch, monkeypatch):
    kept, flag = [], dedup.flag_first
    monkeypatch.setattr(jobs.dedup, "flag_first", lambda df, *a, **kw: (kept.append(df.storageLevel.useMemory), flag(df, *a, **kw))[1])
    line = json.dumps({"id": "1", "user_id": "u", "create_time": "2024-01-15 10:00:00", "total_amount": "1.0"})
    jobs.orders_batch(spark.createDataFrame([(line,)], "value string"), 0, table := scratch("orders"))
    assert kept == [True] and [r.is_first_order for r in jobs.read_orders(spark, table).collect()] == ["1"]


def test_unique_orders_are_flagged_without_salts(spark):
    """Orders that share no id: the same flags as with salts, nobody counted as hot; ``new`` leaves known users out."""
    names = "id string, user_id string, create_time string"
    rows = [(str(i), None if i % 11 == 0 else f"u{i % 5}", f"2024-01-{15 + i % 3} 10:00:00") for i in range(60)] + [(None, "u9", "2024-01-15 10:00:00")]
    frame, order = spark.createDataFrame(rows, names), ["create_time", *dedup.numeric_id("id")]
    known = spark.createDataFrame([("u1", "21"), ("u2", "900"), ("u3", None), ("x", "5")], "user_id string, first_id string")
    for users in (None, known):
        salted = dedup.flag_first(frame, "user_id", order, users)
        got = dedup.flag_first(frame, "user_id", order, users, unique=True, new="buyer")
        assert sorted(map(str, got.drop("buyer").collect())) == sorted(map(str, salted.collect()))
        assert "_salt" not in got._jdf.queryExecution().optimizedPlan().toString()
        buyers = {r.user_id for r in got.where("buyer").collect()}
        assert buyers == {r.user_id for r in salted.where("is_first_order = '1'").collect()} - ({"u1", "u2", "u3"} if users is known else set())


def files(path):
    return [p for p in Path(path.removeprefix("file:")).rglob("*.parquet")]


def test_a_batch_writes_few_files_for_a_day(spark, scratch):
    """Rows in 8 partitions, all with two days: a file for each day, not one for each day and task."""
    starts = spark.range(400, numPartitions=8).select(F.concat(F.lit("m"), F.col("id").cast("string")).alias("mid"), *[F.lit("x").alias(c) for c in ("uid", "appid", "area", "os", "ch", "logType", "vs")],
        F.format_string("2024-01-%02d", (F.col("id") % 2 + 15).cast("int")).alias("logDate"), F.lit("10").alias("logHour"), F.col("id").alias("ts"))
    jobs.dau_batch(starts, 0, table := scratch("dau"))
    assert len(files(table)) == 2 and {(r.logDate, r.devices) for r in jobs.read_device_hours(spark, table).collect()} == {("2024-01-15", 200), ("2024-01-16", 200)}
    lines = [(json.dumps({"id": str(i), "user_id": f"u{i % 40}", "create_time": f"2024-01-{15 + i % 2} 10:00:00", "total_amount": "1.0"}),) for i in range(400)]
    jobs.orders_batch(spark.createDataFrame(lines, "value string").repartition(8), 0, orders := scratch("orders"))
    assert len(files(orders)) == 2 and jobs.read_orders(spark, orders).count() == 400


def test_devices_are_counted_from_what_the_table_has_stored(spark, scratch):
    """Devices without a day are stored and counted like the others; a batch of seen devices adds nothing."""
    names = "mid string, uid string, appid string, area string, os string, ch string, logType string, vs string, logDate string, logHour string, ts bigint"
    rows = [(m, *"abcdefg", day, hour, 5) for m, day, hour in (("m1", "2024-01-15", "10"), ("m2", "2024-01-15", None), ("m3", None, None))]
    table = scratch("dau")
    jobs.dau_batch(spark.createDataFrame(rows, names), 0, table)
    jobs.dau_batch(spark.createDataFrame(rows[:2], names), 1, table)
    kept = {(r.logDate, r.logHour, r.devices) for r in jobs.read_device_hours(spark, table).collect()}
    assert kept == {("2024-01-15", "10", 1), ("2024-01-15", None, 1), (None, None, 1)}


def test_jobs_run_side_by_side(spark):
    meet = threading.Barrier(2, timeout=60)
    assert session.side_by_side(spark, lambda: meet.wait() >= 0 and spark.range(3).count(), lambda: meet.wait() >= 0 and spark.range(5).count()) == [3, 5]
    with pytest.raises(ZeroDivisionError):
        session.side_by_side(spark, lambda: 1 / 0, lambda: 1)
    apart = session.sibling(spark)
    assert apart.conf.get("spark.sql.session.timeZone") == "UTC" and apart.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")
    apart.conf.set("spark.sql.shuffle.partitions", "3")
    assert spark.conf.get("spark.sql.shuffle.partitions") != "3"


def test_the_jobs_of_the_kept_totals_run_side_by_side(spark, scratch, monkeypatch):
    """The first batches of the device and the order job wait for each other."""
    spark.range(120).select(F.col("id").alias("event_id"), F.expr("timestamp_ntz'2024-01-13 00:00:00' + make_interval(0, 0, 0, 0, id)").alias("ts"), (F.col("id") % 7).alias("user_id"),
                            F.when(F.col("id") % 2 == 0, "view").otherwise("purchase").alias("event_type"), F.lit(1.5).alias("value"), F.lit('{"k": 1}').alias("props")).write.parquet(f"{(sf := scratch('tables'))}/events.parquet")
    spark.range(5).select(F.col("id").alias("c_custkey"), F.lit("c").alias("c_name"), F.lit(1).alias("c_nationkey")).write.parquet(f"{sf}/customer.parquet")
    spark.createDataFrame([(1, "n")], "n_nationkey int, n_name string").write.parquet(f"{sf}/nation.parquet")
    meet, met = threading.Barrier(2, timeout=120), []
    for name in ("dau_batch", "orders_batch"):
        def batch(part, i, table, name=name, run=getattr(jobs, name)):
            if i == 0 and name not in met:
                met.append(name)
                meet.wait()
            run(part, i, table)
        monkeypatch.setattr(jobs, name, batch)
    devices, new, orders = streams._kept_totals(spark, sf)
    assert sorted(met) == ["dau_batch", "orders_batch"]
    assert devices.agg(F.sum("devices")).first()[0] == 35 and new.agg(F.sum("new_mid")).first()[0] == 7
    assert orders.agg(F.sum("orders"), F.sum("amount")).first()[:] == (60, 90)


def test_slices_are_read_once_for_their_redeliveries_and_corrections(spark):
    rows = [(None if i % 9 == 7 else f"k{i}", f'{{"total_amount":"{i}.5"}}', i) for i in range(60)]
    parts = [spark.createDataFrame(rows[a:a + 30], "key string, value string, at bigint") for a in (0, 30)]
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    by = lambda df: sorted(map(str, df.collect()))
    first, second = streams.redelivered(parts)
    assert plan(first).count("LogicalRDD") == 1 and plan(second).count("LogicalRDD") == 2
    assert by(first) == by(parts[0].unionByName(streams.some(parts[0], 5)))
    assert by(second) == by(parts[1].unionByName(streams.some(parts[1], 5)).unionByName(streams.some(parts[0], 7)))
    old = streams.some(parts[0], 3).withColumn("value", F.lit('{"total_amount":"0.01"}'))
    kept = parts[0].where(~streams.chosen(3) | F.col("key").isNull())
    first, *_ = streams.corrected(parts)
    assert plan(first).count("LogicalRDD") == 1 and first.columns == parts[0].columns
    assert by(first) == by(old.unionByName(kept))
