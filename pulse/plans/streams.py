"""Stream jobs registered as queries: the stream's result table, for comparison
with the batch SQL.

The input is cut by time into consecutive slices, inside days, so devices and users span several
micro-batches; each slice is written to a file topic, and after each write the job runs with
``availableNow`` and stops; the next run resumes from the checkpoint. Every row of the input goes through
the stream. Delivery is at least once: parts of a slice come twice in it, and again with the next one. Some
orders come first in an older version and are corrected by the next slice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse import session
from pulse.operators import ingest
from pulse.plans import params as P
from pulse.plans.catalog import query
from pulse.schemas import ORDER_FIELDS
from pulse.sources import topic_log, views
from pulse.sources.topics import LINE_SCHEMA, read_changes, read_topic, write_topic
from pulse.streaming import jobs, sinks

SLICES = 3


def time_slices(frame: DataFrame, k: int = SLICES) -> list[DataFrame]:
    """``frame`` split at ``at`` (millis) into ``k`` consecutive ranges (all rows kept), the cuts
    at noon of a day."""
    lo, hi = frame.agg(F.min("at"), F.max("at")).first()
    if lo is None:
        return [frame]
    day = 86_400_000
    cuts = [(lo + (hi - lo) * i // k) // day * day + day // 2 for i in range(1, k)]
    edges = [None, *cuts, None]
    out = []
    for a, b in zip(edges, edges[1:]):
        part = frame if a is None else frame.where(F.col("at") >= a)
        out.append(part if b is None else part.where(F.col("at") < b))
    return out


def chosen(every: int, key: str = "key") -> Column:
    """True for every so many keys, by hash."""
    return F.pmod(F.xxhash64(key), F.lit(every)) == 0


def some(df: DataFrame, every: int, key: str = "key") -> DataFrame:
    """Every so many keys, by hash."""
    return df.where(chosen(every, key))


def redelivered(parts: list[DataFrame]) -> list[DataFrame]:
    """The slices as an at-least-once topic delivers them: a slice is read once for itself and what comes twice in it."""
    twice = F.explode(F.when(chosen(5), F.sequence(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    out = [part.select(*part.columns, twice.alias("_time")).drop("_time") for part in parts]
    return [out[0], *[now.unionByName(some(before, 7)) for before, now in zip(parts, out[1:])]]


def corrected(parts: list[DataFrame]) -> list[DataFrame]:
    """Every third order of a slice comes with an older amount first; the real record follows
    with the next slice (a last, further one for the last slice). A slice is read once for both kinds; a line without a
    key comes in both."""
    old, real = F.regexp_replace("value", '"total_amount":"[^"]*"', '"total_amount":"0.01"'), F.col("value")
    values = F.filter(F.array(F.struct(chosen(3).alias("is"), old.alias("value")), F.struct((~chosen(3) | F.col("key").isNull()).alias("is"), real.alias("value"))),
                      lambda x: x["is"])
    first = [p.select(*[c for c in p.columns if c != "value"], F.explode(values).alias("_v"))
             .select(*[F.col("_v.value").alias(c) if c == "value" else c for c in p.columns]) for p in parts]
    late = [some(p, 3) for p in parts]
    return [first[0], *[f.unionByName(l) for f, l in zip(first[1:], late)], late[-1]]


def feed_and_run(spark: SparkSession, frame: DataFrame, cols: list[str],
                 start: Callable[[DataFrame, str], object], schema=LINE_SCHEMA,
                 topic: str = "lines", changes: bool = False,
                 deliver: Callable[[list[DataFrame]], list[DataFrame]] = list) -> None:
    """Write the slices of ``frame`` (``cols`` and ``at``) to a fresh file topic one by one, as
    ``deliver`` arranges them; after each, run the stream built by ``start(stream_df, checkpoint)`` to
    completion. The stream reads the topic with ``read_topic`` (``read_changes`` for a change feed)."""
    base = session.shared_dir(spark, "topics")
    ckpt = session.shared_dir(spark, "checkpoint")
    staged = session.shared_dir(spark, "staged_input")
    frame.select(*cols, "at").write.parquet(staged)  # derive the input once, slice the copy
    frame = spark.read.parquet(staged)
    for part in deliver(time_slices(frame)):
        write_topic(part.select(*cols), topic, fmt="parquet", path=base,
                    extra=tuple(c for c in cols if c not in ("key", "value")))
        if changes:
            stream = read_changes(spark, topic, fmt="parquet", path=base, max_per_trigger=None)
        else:
            stream = read_topic(spark, topic, fmt="parquet", path=base, schema=schema)
        q = start(stream.drop("topic"), ckpt)
        q.awaitTermination()
        if q.exception():
            raise q.exception()


def _state_partitions(spark: SparkSession) -> int:
    """State partitions for the keyed-state jobs: the cores the session has."""
    try:
        return max(1, spark.sparkContext.defaultParallelism)
    except Exception:  # sessions without a local SparkContext (Spark Connect)
        return int(spark.conf.get("spark.default.parallelism", "8"))


def _startup_lines(spark, sf) -> DataFrame:
    """Stamped lines of the startup topic, with their time for slicing."""
    # routed before they are stamped: the stamp changes no type, and only startups are parsed for it
    lines = ingest.route_logs(views.raw_logs(spark, sf)).where(F.col("topic") == ingest.TOPIC_STARTUP)
    return ingest.stamp_lines(lines).select("key", "value", F.col("arrival_ms").alias("at"))


def _order_lines(spark, sf) -> DataFrame:
    rows = views.order_rows(spark, sf, deal=True)
    return rows.select(F.col("id").alias("key"), F.to_json(F.struct(*rows.columns)).alias("value"),
                       F.unix_millis(F.to_timestamp("create_time")).alias("at"))


def _order_delivery(parts: list[DataFrame]) -> list[DataFrame]:
    return redelivered(corrected(parts))


def _dau_cols(df: DataFrame) -> DataFrame:
    return df.select("mid", "uid", "appid", "area", "os", "ch", "logType", "vs", "logDate", "logHour", "ts")


def _log_lines(lines: DataFrame) -> DataFrame:
    return lines.select("key", "value", F.timestamp_millis("at").alias("timestamp"))


@query("src_topic")
def q_src_topic(spark, sf):
    """A stream that starts at the latest message of a topic log with history, and goes on by offsets:
    (key, ts) of what is written after its start, in two appends and two runs."""
    base, ckpt, out = (session.shared_dir(spark, x) for x in ("topic_log", "checkpoint", "received"))
    _startup_lines(spark, sf).write.parquet(staged := session.shared_dir(spark, "staged_input"))
    old, new = time_slices(spark.read.parquet(staged), 2)
    appended = [new.where(F.pmod(F.xxhash64("key"), F.lit(2)) == k) for k in range(2)]
    for part, run in ((old, False), (None, True), (appended[0], True), (appended[1], True), (None, True)):
        if part is not None:
            write_topic(_log_lines(part), "startup_log", "log", base)
        if run:
            q = (read_topic(spark, "startup_log", "log", base, min_partitions=8).writeStream.format("parquet")
                 .option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start())
            q.awaitTermination()
            if q.exception():
                raise q.exception()
    return spark.read.schema("key string, value string").parquet(out).select("key", F.get_json_object("value", "$.ts").cast("bigint").alias("ts"))


FETCHES = 10


@query("src_cdc")
def q_src_cdc(spark, sf):
    """Change envelopes in one append, fetched in batches of at most a tenth of them: (fetch, messages,
    distinct_keys) per batch; the keys are numbered so that a message that came twice would show."""
    base, ckpt, out = (session.shared_dir(spark, x) for x in ("topic_log", "checkpoint", "fetched"))
    lines = views.change_lines(spark, sf)
    number = F.xxhash64("key", "value").cast("string")
    write_topic(lines.select(number.alias("key"), "value"), "changes", "log", base)
    most = -(-lines.count() // FETCHES)
    stream = read_changes(spark, "changes", "log", base, {"startingOffsets": "earliest", "group": "query"}, most)
    topic_log.drain(stream.writeStream.option("checkpointLocation", ckpt).trigger(processingTime="0 seconds")
                    .foreachBatch(lambda df, bid: sinks.write_batch(df.select("key"), out, None, bid)).start())
    got = spark.read.parquet(out)
    return got.groupBy(F.col(sinks.BATCH_COL).cast("bigint").alias("fetch")).agg(
        F.count(F.lit(1)).alias("messages"), F.count_distinct("key").alias("distinct_keys"))


@query("sink_topic")
def q_sink_topic(spark, sf):
    """The collector's batches on time slices, each run twice and the first once more at the end; a stream
    on the startup topic reads after every run and stores what it gets as it comes: (key, ts)."""
    landing, base, ckpt, out = (session.shared_dir(spark, x) for x in ("landing", "topic_log", "checkpoint", "received"))
    views.raw_logs(spark, sf).withColumn("at", F.col("arrival_ms")).write.parquet(staged := session.shared_dir(spark, "staged_input"))
    parts = list(enumerate(time_slices(spark.read.parquet(staged))))
    for bid, part in [x for p in parts for x in (p, p)] + parts[:1]:
        jobs.collect_batch(part.drop("at"), bid, landing, base)
        q = (read_topic(spark, ingest.TOPIC_STARTUP, "log", base, {"startingOffsets": "earliest"}).writeStream.format("parquet")
             .option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        q.awaitTermination()
        if q.exception():
            raise q.exception()
    return spark.read.schema("key string, value string").parquet(out).select("key", F.get_json_object("value", "$.ts").cast("bigint").alias("ts"))


@query("stream_collect")
def q_stream_collect(spark, sf):
    """Raw lines -> collector stream -> routed topics read back: (key, topic, ts)."""
    raw = views.raw_logs(spark, sf).withColumn("at", F.col("arrival_ms"))
    landing, topics = session.shared_dir(spark, "landing"), session.shared_dir(spark, "topics")
    schema = "key string, value string, arrival_ms bigint"
    feed_and_run(spark, raw, ["key", "value", "arrival_ms"],
                 lambda s, c: jobs.run_collector(s, landing, topics, c, "available_now"), schema)
    routed = spark.read.parquet(topics)
    return routed.select("key", "topic", F.get_json_object("value", "$.ts").cast("bigint").alias("ts"))


@query("stream_cdc")
def q_stream_cdc(spark, sf):
    """Change envelopes -> relay stream -> order topic read back (one JSON per order)."""
    env = views.change_entries(spark, sf)
    # Slice by the time of the event each entry comes from.
    ev = views.table(spark, sf, "events").select(F.col("event_id").cast("string").alias("key"),
                                                  F.unix_millis(F.col("ts").cast("timestamp")).alias("at"))
    lines = env.select("key", F.to_json(F.struct("entry_type", "table", "op", "rows")).alias("value")) \
        .join(ev, "key", "left")
    out = session.shared_dir(spark, "order_topic")
    feed_and_run(spark, lines, ["key", "value"],
                 lambda s, c: jobs.run_cdc_relay(s, out, c, trigger="available_now"), changes=True)
    return spark.read.parquet(out).select("value")


@query("stream_dau")
def q_stream_dau(spark, sf):
    """Startup topic -> DAU stream (foreachBatch upsert) -> the DAU table."""
    table = session.shared_dir(spark, "dau")
    feed_and_run(spark, _startup_lines(spark, sf), ["key", "value"],
                 lambda s, c: jobs.run_dau(s, table, c, "available_now"), deliver=redelivered)
    return _dau_cols(sinks.read_result(spark, table))


@query("stream_dau_state")
def q_stream_dau_state(spark, sf):
    """Startup topic -> DAU stream with keyed state (RocksDB) -> the latest version per device and day."""
    table = session.shared_dir(spark, "dau_state")
    feed_and_run(spark, _startup_lines(spark, sf), ["key", "value"],
                 lambda s, c: jobs.run_dau_keyed_state(s, table, c, "available_now",
                                                       state_partitions=_state_partitions(spark)), deliver=redelivered)
    return _dau_cols(sinks.read_latest(spark, table, jobs.DAU_KEYS))


@query("stream_dau_ttl")
def q_stream_dau_ttl(spark, sf):
    """Startup topic -> DAU stream whose seen devices expire a day after their last write."""
    table = session.shared_dir(spark, "dau_ttl")
    feed_and_run(spark, _startup_lines(spark, sf), ["key", "value"],
                 lambda s, c: jobs.run_dau_ttl(s, table, c, "available_now",
                                               state_partitions=_state_partitions(spark)), deliver=redelivered)
    return _dau_cols(sinks.read_result(spark, table))


@query("stream_new_mid")
def q_stream_new_mid(spark, sf):
    """Startup topic -> first-seen stream (keyed state per device) -> new devices per day."""
    from pulse.operators import metrics
    table = session.shared_dir(spark, "first_seen")
    feed_and_run(spark, _startup_lines(spark, sf), ["key", "value"],
                 lambda s, c: jobs.run_first_seen(s, table, c, "available_now",
                                                  state_partitions=_state_partitions(spark)), deliver=redelivered)
    per_day = jobs.read_new_devices(spark, table)
    on_day = metrics.new_devices_on(per_day, P.DAY).select(F.lit(P.DAY).alias("logDate"), "new_mid")
    return per_day.where((F.col("logDate") != P.DAY) & (F.col("new_mid") > 0)).unionByName(on_day)


@query("sink_dau")
def q_sink_dau(spark, sf):
    """The DAU micro-batch function called on time slices with redeliveries, then two batches
    replayed (the newest and the first): the table must not change."""
    table, topic = session.shared_dir(spark, "dau_sink"), session.shared_dir(spark, "dau_sink_topic")
    _startup_lines(spark, sf).write.parquet(topic)
    parts = [ingest.parse_startup(p) for p in redelivered(time_slices(spark.read.parquet(topic)))]
    for i, part in enumerate(parts):
        jobs.dau_batch(part, i, table)
    jobs.dau_batch(parts[-1], len(parts) - 1, table)
    jobs.dau_batch(parts[0], 0, table)
    return _dau_cols(sinks.read_result(spark, table))


@query("seen_union_bits")
def q_seen_union_bits(spark, sf):
    """The DAU stream with a bitmap of the days' devices in front of the exact comparison -> the DAU table."""
    table = session.shared_dir(spark, "dau_bits")
    feed_and_run(spark, _startup_lines(spark, sf), ["key", "value"],
                 lambda s, c: jobs.run_dau(s, table, c, "available_now", bitmap=True), deliver=redelivered)
    return _dau_cols(sinks.read_result(spark, table))


@query("hourly_active_kept")
def q_hourly_active_kept(spark, sf):
    """Devices per hour of the day from the sketches that the DAU stream keeps, next to the exact number:
    (logHour, active, near), near if the sketches are within 3 % (or one device)."""
    from pulse.operators import metrics
    table = session.shared_dir(spark, "dau_activity")
    feed_and_run(spark, lines := _startup_lines(spark, sf), ["key", "value"],
                 lambda s, c: jobs.run_dau(s, table, c, "available_now", activity=True), deliver=redelivered)
    exact = metrics.hourly_active(ingest.parse_startup(lines), P.DAY)
    about = metrics.hourly_active_merged(jobs.read_activity(spark, table), P.DAY).withColumnRenamed("active", "_about")
    gap = F.abs(F.col("active") - F.col("_about"))
    return exact.join(about, "logHour", "left").select("logHour", "active", F.coalesce(gap <= F.greatest(F.lit(1), F.col("active") * 0.03), F.lit(False)).alias("near"))


@query("stream_orders")
def q_stream_orders(spark, sf):
    """Order topic -> order stream (known-users table) -> the order table."""
    table = session.shared_dir(spark, "orders")
    feed_and_run(spark, _order_lines(spark, sf), ["key", "value"],
                 lambda s, c: jobs.run_orders(s, table, c, "available_now"), deliver=_order_delivery)
    return jobs.read_orders(spark, table).select(*ORDER_FIELDS)


@query("sink_order")
def q_sink_order(spark, sf):
    """The order micro-batch function on time slices with redeliveries and corrections, then the
    newest and the first batch replayed."""
    table, topic = session.shared_dir(spark, "orders_sink"), session.shared_dir(spark, "orders_sink_topic")
    _order_lines(spark, sf).write.parquet(topic)
    parts = [p.select("key", "value") for p in _order_delivery(time_slices(spark.read.parquet(topic)))]
    for i, part in enumerate(parts):
        jobs.orders_batch(part, i, table)
    jobs.orders_batch(parts[-1], len(parts) - 1, table)
    jobs.orders_batch(parts[0], 0, table)
    return jobs.read_orders(spark, table).select(*ORDER_FIELDS)


@query("stream_first_order")
def q_stream_first_order(spark, sf):
    """Order topic -> the orders of each user as keyed state, flagged in the stream -> the order table."""
    table = session.shared_dir(spark, "orders_state")
    feed_and_run(spark, _order_lines(spark, sf), ["key", "value"],
                 lambda s, c: jobs.run_orders_keyed_state(s, table, c, "available_now",
                                                          state_partitions=_state_partitions(spark)), deliver=_order_delivery)
    return jobs.read_orders(spark, table).select(*ORDER_FIELDS)


def _kept_totals(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The totals that the jobs keep: devices per hour, new devices per day, orders per hour; over slices with
    redeliveries, corrected orders, and a replayed batch of each foreachBatch job. The three jobs share nothing but
    their input and run side by side, as they do on a cluster."""
    dau, seen, orders = (session.shared_dir(spark, x) for x in ("dau_totals", "seen_totals", "order_totals"))
    apart = session.sibling(spark)

    def dau_job(starts: DataFrame) -> None:
        parts = [ingest.parse_startup(p) for p in redelivered(time_slices(starts))]
        for i, part in [*enumerate(parts), (0, parts[0])]:
            jobs.dau_batch(part, i, dau)

    def seen_job(starts: DataFrame) -> None:
        feed_and_run(apart, starts, ["key", "value"],
                     lambda s, c: jobs.run_first_seen(s, seen, c, "available_now", state_partitions=_state_partitions(apart)), deliver=redelivered)

    def start_jobs() -> None:
        _startup_lines(spark, sf).write.parquet(path := session.shared_dir(spark, "staged_starts"))
        session.side_by_side(spark, lambda: dau_job(spark.read.parquet(path)), lambda: seen_job(apart.read.parquet(path)))

    def order_job() -> None:
        _order_lines(spark, sf).write.parquet(path := session.shared_dir(spark, "staged_orders"))
        parts = [p.select("key", "value") for p in _order_delivery(time_slices(spark.read.parquet(path)))]
        for i, part in [*enumerate(parts), (len(parts) - 1, parts[-1])]:
            jobs.orders_batch(part, i, orders)

    session.side_by_side(spark, start_jobs, order_job)
    return jobs.read_device_hours(spark, dau), jobs.read_new_devices(spark, seen), jobs.read_order_hours(spark, orders)


@query("report_total_kept")
def q_report_total_kept(spark, sf):
    """The headline document from the totals that the stream jobs keep."""
    from pulse.operators import metrics, reports
    return reports.report_total(metrics.kpi_totals(*_kept_totals(spark, sf), P.DAY))


@query("report_hour_kept")
def q_report_hour_kept(spark, sf):
    """Both hour documents (id, doc) from the totals that the stream jobs keep."""
    from pulse.operators import reports
    devices, _, orders = _kept_totals(spark, sf)
    docs = [reports.report_hour_totals(m, devices, orders, P.DAY).select(F.lit(m).alias("id"), "doc") for m in ("dau", "order_amount")]
    return docs[0].unionByName(docs[1])
