"""Topic logs: offsets, start, bound in messages, even tasks, a commit per epoch."""

import json
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from pulse.sources import topic_log
from pulse.sources.topics import read_changes, read_topic, write_topic


def lines(spark, lo, hi, key=lambda i: str(i)):
    return spark.createDataFrame([(key(i), json.dumps({"n": i})) for i in range(lo, hi)], "key string, value string").repartition(3)


class Sink:
    """The batches of a stream, as lists of values."""

    def __init__(self):
        self.batches, self.tasks = [], []

    def __call__(self, df, bid):
        self.tasks.append(df.rdd.getNumPartitions())
        self.batches.append(sorted(json.loads(r.value)["n"] for r in df.collect()))

    @property
    def all(self):
        return sorted(x for b in self.batches for x in b)


def run(stream, ckpt, sink, trigger="drain"):
    w = stream.writeStream.foreachBatch(sink).option("checkpointLocation", ckpt)
    if trigger == "drain":
        topic_log.drain(w.trigger(processingTime="0 seconds").start())
    else:
        w.trigger(availableNow=True).start().awaitTermination()


def test_latest_resume_and_new_partitions(spark, scratch):
    base, ckpt = scratch("log"), scratch("ck")
    write_topic(lines(spark, 0, 50), "t", "log", base)
    sink = Sink()
    run(read_topic(spark, "t", "log", base), ckpt, sink, "available")
    assert sink.all == []  # it starts at the end
    write_topic(lines(spark, 50, 80), "t", "log", base)
    write_topic(lines(spark, 80, 90), "t", "log", base, options={"partitions": "6"})
    run(read_topic(spark, "t", "log", base), ckpt, sink, "available")
    write_topic(lines(spark, 90, 100), "t", "log", base)
    run(read_topic(spark, "t", "log", base), ckpt, sink, "available")
    assert sink.batches[-1] == list(range(90, 100)) and sink.all == list(range(50, 100))
    whole = Sink()
    run(read_topic(spark, "t", "log", base, {"startingOffsets": "earliest"}), scratch("ck2"), whole, "available")
    assert whole.all == list(range(100))
    topic_log.register(spark)
    batch = spark.read.format("topic_log").load(f"{base}/topic=t")
    assert batch.count() == 100
    spans = batch.groupBy("partition").agg(F.min("offset").alias("lo"), F.max("offset").alias("hi"), F.count("*").alias("n"), F.count_distinct("offset").alias("d"))
    assert all(r.lo == 0 and r.hi == r.n - 1 and r.d == r.n for r in spans.collect())


def test_a_thousand_envelopes_in_one_file_are_ten_batches(spark, scratch):
    base, ckpt = scratch("cdc"), scratch("ck")
    write_topic(lines(spark, 0, 1000).coalesce(1), "changes", "log", base, options={"partitions": "1"})
    assert len([f for f in os.listdir(f"{base.replace('file:', '')}/topic=changes/partition=0") if f.endswith("parquet")]) == 1
    sink = Sink()
    run(read_changes(spark, "changes", "log", base, {"startingOffsets": "earliest"}), ckpt, sink)
    assert [len(b) for b in sink.batches] == [100] * 10 and sink.all == list(range(1000))


def test_the_bound_holds_after_a_restart(spark, scratch):
    base, ckpt, sink = scratch("bound"), scratch("ck"), Sink()
    opts = {"startingOffsets": "earliest", "group": "g"}
    for lo, hi in ((0, 130), (130, 430), (430, 440)):
        write_topic(lines(spark, lo, hi), "t", "log", base)
        run(read_topic(spark, "t", "log", base, opts, max_per_trigger=50), ckpt, sink)
    assert sink.all == list(range(440)) and max(map(len, sink.batches)) == 50


def test_a_large_partition_is_read_by_several_tasks(spark, scratch):
    base, sink = scratch("large"), Sink()
    write_topic(lines(spark, 0, 5000, key=lambda i: "hot"), "t", "log", base)
    run(read_topic(spark, "t", "log", base, {"startingOffsets": "earliest", "messagesPerTask": "700"}), scratch("ck"), sink, "available")
    assert sink.all == list(range(5000)) and sink.tasks[0] >= 8


def test_admission_shares():
    at, end = {"0": 10, "1": 0}, {"0": 1010, "1": 10, "2": 100}
    got = topic_log.admitted(at, end, 100)
    assert sum(got.values()) - 10 == 100 and all(at.get(p, 0) <= got[p] <= end[p] for p in end)
    assert topic_log.admitted(at, end, 5000) == end
    steps = 0
    while at != end:
        at, steps = topic_log.admitted(at, end, 7), steps + 1
    assert steps == -(-1110 // 7)


def test_replayed_epochs_add_nothing(spark, scratch):
    """Replays of the last and of older batches, with other files and other rows' order."""
    base, sink, ckpt = scratch("replay"), Sink(), scratch("ck")
    def write(lo, hi, epoch, parts=3):
        write_topic(lines(spark, lo, hi).repartition(parts), "t", "log", base, {"writer": "w"}, epoch=epoch)
    opts = {"startingOffsets": "earliest"}
    for step in ((0, 40, 0), (0, 40, 0, 5), (40, 70, 1), (40, 70, 1, 1), (0, 40, 0), (70, 75, 2)):
        write(*step)
        run(read_topic(spark, "t", "log", base, opts), ckpt, sink, "available")
    assert sink.all == list(range(75))
    assert not os.listdir(f"{base.replace('file:', '')}/_staging")


def test_a_commit_that_broke_off_is_finished(spark, scratch, monkeypatch):
    """The commit dies between two moves; the epoch is written again: the noted moves are finished and
    its own files are dropped."""
    base = scratch("broken").replace("file:", "")
    log = topic_log.Log(topic_log.Options({"path": base, "writer": "w", "partitions": "4"}))
    batches = lambda: iter(lines(spark, 0, 40).select("key", "value").toArrow().to_batches())
    first = log.stage(batches())
    move, moved = topic_log.Folder.move, []

    def fail(self, a, b):
        if moved:
            raise OSError("lost")
        moved.append(b)
        move(self, a, b)

    monkeypatch.setattr(topic_log.Folder, "move", fail)
    with pytest.raises(OSError):
        log.commit([first], "0")
    monkeypatch.setattr(topic_log.Folder, "move", move)
    log.commit([log.stage(batches())], "0")
    topic_log.register(spark)
    rows = spark.read.format("topic_log").load(base)
    assert sorted(json.loads(r.value)["n"] for r in rows.collect()) == list(range(40))
    log.commit([log.stage(batches()), None], "1")
    assert rows.count() == 40 or spark.read.format("topic_log").load(base).count() == 80


def test_stream_writer_and_timestamps(spark, scratch):
    src, base, ckpt = scratch("src"), scratch("sink"), scratch("ck")
    lines(spark, 0, 30).withColumn("timestamp", F.timestamp_millis(F.lit(1_705_276_800_123))).write.parquet(src)
    topic_log.register(spark)
    for _ in range(2):
        stream = spark.readStream.schema("key string, value string, timestamp timestamp").parquet(src)
        q = (stream.writeStream.format("topic_log").option("path", f"{base}/topic=t").option("checkpointLocation", ckpt)
             .trigger(availableNow=True).start())
        q.awaitTermination()
        assert not q.exception()
    rows = spark.read.format("topic_log").load(f"{base}/topic=t")
    assert rows.count() == 30 and {r.ms for r in rows.select(F.unix_millis("timestamp").alias("ms")).collect()} == {1_705_276_800_123}
    for f in topic_log.segments(topic_log.Folder(f"{base.replace('file:', '')}/topic=t")):
        assert pq.ParquetFile(f"{base.replace('file:', '')}/topic=t/{f[3]}").metadata.num_rows == f[2]
    with pytest.raises(Exception, match="append"):
        lines(spark, 0, 1).write.format("topic_log").mode("overwrite").save(base)
