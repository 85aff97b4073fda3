"""The stream jobs: log collector, change-feed relay, DAU table, order table.

Each job is ``readStream -> stateless DataFrame transformations -> writeStream``.
Where the sink needs keyed upserts, the micro-batch function (``*_batch``) is a
plain function of (DataFrame, batch id): it can be called directly for a batch
backfill or a test, and it is what ``foreachBatch`` calls in the stream.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pulse.functions import epoch_millis
from pulse.operators import dedup, ingest, metrics
from pulse.schemas import ORDER_FIELDS
from pulse.session import side_by_side
from pulse.sources.topics import write_topic
from pulse.streaming import sinks
from pulse.streaming.keyed import DAY_MS, device_days, earliest, first_orders

MICRO_BATCH = "5 seconds"
DAU_KEYS = ["mid", "logDate"]

BatchLog = Callable[[dict], None]


@contextlib.contextmanager
def _starting(spark, state_partitions: int | None, only_with_data: bool = False):
    """Settings that a stateful query takes over when it starts. ``state_partitions`` becomes its number of
    state partitions, recorded in the checkpoint at the first start; size it to the cluster's cores, not to
    the data. ``only_with_data``: no batches without input (a query on wall-clock time would have
    them for ever, also when it drains a topic; expired state is passed over when it is read)."""
    wanted = {}
    if state_partitions:
        wanted["spark.sql.shuffle.partitions"] = str(state_partitions)
    if only_with_data:
        wanted["spark.sql.streaming.noDataMicroBatches.enabled"] = "false"
    before = {k: spark.conf.get(k) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


class Queries(list):
    """Several streaming queries of one job, handled like one."""

    def awaitTermination(self, timeout: int | None = None) -> None:
        for q in self:
            q.awaitTermination() if timeout is None else q.awaitTermination(timeout)

    def processAllAvailable(self) -> None:
        for q in self:
            q.processAllAvailable()

    def exception(self):
        return next((e for e in (q.exception() for q in self) if e), None)

    def stop(self) -> None:
        for q in self:
            q.stop()

    @property
    def isActive(self) -> bool:
        return any(q.isActive for q in self)


def _trigger(writer, trigger: str | None):
    """``trigger``: a processing-time interval (default ``5 seconds``) or
    ``"available_now"`` (drain what is there, then stop)."""
    if trigger == "available_now":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger or MICRO_BATCH)


def _start(df: DataFrame, fn, checkpoint: str, trigger: str | None, name: str | None = None) -> StreamingQuery:
    """foreachBatch writer with a checkpoint."""
    w = df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    return _trigger(w, trigger).start()


# --- collector -------------------------------------------------------------------

def collect_batch(batch: DataFrame, batch_id: int, landing: str, topics: str,
                  arrival_col: str = "arrival_ms", invalid: str | None = None, options: dict | None = None) -> None:
    """Stamp, land by day and route one batch of raw lines: two sinks, one read.

    Lines that are not JSON objects cannot be stamped; they go to ``invalid``
    (default ``<landing>_invalid``) as they came. Landing and invalid lines are ``batch=<id>`` folders with
    dynamic overwrite, the topics are topic logs below ``topics`` with the batch as epoch: a batch that
    is run again changes none of them, and a stream on a topic sees no line twice."""
    # the day of the stamp is that of the arrival: the stamped line need not be parsed again for it
    stamped = ingest.stamp_lines(batch.withColumn("_raw", F.col("value")), arrival_col)
    stamped = stamped.withColumn("dt", F.date_format(F.timestamp_millis(arrival_col), "yyyy-MM-dd"))
    stamped = stamped.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        good = stamped.where(F.col("value").isNotNull())
        sinks.write_batch(good.select("value", "dt"), landing, "dt", batch_id, fmt="text")
        routed = ingest.route_logs(good).select("key", "value", "topic", F.timestamp_millis(arrival_col).alias("timestamp"))
        write_topic(routed, fmt="log", path=topics, options={"writer": "collector", **(options or {})}, epoch=batch_id)
        bad = stamped.where(F.col("value").isNull()).select(F.col("_raw").alias("value"))
        sinks.write_batch(bad, invalid or f"{landing.rstrip('/')}_invalid", None, batch_id)
    finally:
        stamped.unpersist()


def run_collector(source: DataFrame, landing: str, topics: str, checkpoint: str,
                  trigger: str | None = None, options: dict | None = None) -> StreamingQuery:
    """``source``: streaming (key, value[, arrival_ms | timestamp]) of raw log lines. ``options``: of the
    topic logs (``partitions``)."""
    if "arrival_ms" not in source.columns:
        stamp = epoch_millis("timestamp") if "timestamp" in source.columns else F.unix_millis(F.current_timestamp())
        source = source.withColumn("arrival_ms", stamp)
    return _start(source, lambda df, bid: collect_batch(df, bid, landing, topics, options=options), checkpoint, trigger)


# --- change-feed relay -----------------------------------------------------------

def _file_sink(lines: DataFrame, out_path: str, checkpoint: str, trigger: str | None) -> StreamingQuery:
    """Parquet file sink: its commit log makes the output exactly-once."""
    w = lines.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def relay_batch(batch: DataFrame, batch_id: int, out_path: str, quarantine: str, table: str = "order_info",
                op: str = "INSERT") -> None:
    """One batch of change envelopes (JSON lines), decoded once: the after-images of ``op`` on ``table``
    go to the topic log ``out_path`` with the batch as epoch, lines that do not decode to ``quarantine``."""
    tagged = ingest.tag_changes(batch).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        images = ingest.relay_orders(tagged.where("_ok").select("_e.*"), table, op)
        write_topic(images, fmt="log", path=out_path, options={"writer": "relay"}, epoch=batch_id)
        sinks.write_batch(tagged.where("not _ok").select("value"), quarantine, None, batch_id)
    finally:
        tagged.unpersist()


def run_cdc_relay(source: DataFrame, out_path: str, checkpoint: str, table: str = "order_info",
                  op: str = "INSERT", trigger: str | None = None, quarantine: str | None = None) -> StreamingQuery:
    """Change envelopes (JSON lines) -> order after-images (JSON lines) on the topic log ``out_path`` (a
    topic's folder, ``<base>/topic=<t>``). Lines that do not decode go to ``quarantine`` (default
    ``<out_path>_quarantine``) as they came, so the relay never blocks on them."""
    bad = quarantine or f"{out_path.rstrip('/')}_quarantine"
    return _start(source, lambda df, bid: relay_batch(df, bid, out_path, bad, table, op), checkpoint, trigger)


def run_cdc_quarantine(source: DataFrame, out_path: str, checkpoint: str,
                       trigger: str | None = None) -> StreamingQuery:
    """Only the lines of the change topic that do not decode to an envelope."""
    _, bad = ingest.split_valid_changes(source)
    return _file_sink(bad, out_path, checkpoint, trigger)


# --- daily active devices ----------------------------------------------------------

def dau_batch(batch: DataFrame, batch_id: int, table: str, retention_days: int | None = None,
              log: BatchLog | None = None, publish: str | None = None,
              compact_lag_days: int | None = None, compact_every: int = 100,
              bad: DataFrame | None = None, bitmap: bool = False, activity: bool = False) -> None:
    """One micro-batch of parsed startups -> new first-starts in the DAU table. ``bad``: lines of
    the batch that are no startups; they go to ``<table>_quarantine`` and are counted. ``bitmap``: keep a bitmap of the
    days' devices (``<table>_bits``) and compare only devices that it can't clear with the table (counted as
    ``compared``); worth it once a day's table is much larger than a batch. ``activity``: keep sketches of the
    devices per hour (``<table>_sketches``, ``read_activity``).

    first start per (device, day) inside the batch (partial aggregate) -> anti join
    with the keys stored by other batches for the same days -> write. With
    ``retention_days``, starts older than the batch's newest day minus the
    retention are dropped (counted as ``late``). With ``compact_lag_days``, every
    ``compact_every`` batches the finished days (more than the lag before this
    batch's oldest day) are rewritten into one folder each."""
    obs_in, obs_out = Observation(f"dau_in_{batch_id}"), Observation(f"dau_out_{batch_id}")
    rows = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        days = sinks.batch_days(rows, "logDate")
        late = F.lit(False)
        if retention_days is not None and days:
            oldest = F.date_format(F.date_sub(F.lit(days[-1]).cast("date"), retention_days), "yyyy-MM-dd")
            late = F.col("logDate") < oldest
        src = rows.observe(obs_in, F.count(F.lit(1)).alias("rows_in"),
                           F.count_if(late).alias("late")).where(~late)
        firsts = dedup.first_per_key(src, DAU_KEYS, ["ts"])
        seen = sinks.seen_keys(rows.sparkSession, table, DAU_KEYS, "logDate", days, batch_id)
        # firsts holds one row per key, so no key is hot here
        new = firsts if seen is None else firsts.join(seen, DAU_KEYS, "left_anti")
        obs_cmp = Observation(f"dau_compared_{batch_id}") if bitmap and seen is not None else None
        if obs_cmp is not None:
            kept = sinks.read_days(rows.sparkSession, f"{table}_bits", "logDate", days)
            if kept is None:  # the bitmap was not kept from the start: compare all
                obs_cmp = None
            else:
                kept = kept.where(F.col(sinks.BATCH_COL) != F.lit(str(batch_id)))
                doubtful = dedup.maybe_seen(firsts, dedup.merged_bits(kept), DAU_KEYS).observe(obs_cmp, F.count_if("_maybe").alias("compared"))
                new = dedup.drop_marked(doubtful, seen, DAU_KEYS)
        # Several sinks from one computation: the table first (the source of truth), then, side by side, from what it
        # has stored (a write to the table would drop ``new`` from the cache, as it is compared with the table) the counts
        # per hour, the same rows as JSON lines on a downstream topic folder, and the others.
        sinks.write_batch(sinks.together(new, "logDate").observe(obs_out, F.count(F.lit(1)).alias("rows_new")), table, "logDate", batch_id)
        stored, rest = sinks.read_batch(rows.sparkSession, table, "logDate", days, batch_id, new.schema), []
        if stored is not None:
            rest.append(lambda: _write_counts(stored, f"{table}_hours", ["logDate", "logHour"], "devices", batch_id))
            if bitmap:
                rest.append(lambda: sinks.write_batch(dedup.seen_bits(stored, DAU_KEYS, ["logDate"]), f"{table}_bits", "logDate", batch_id))
            if publish is not None:
                rest.append(lambda: sinks.write_batch(
                    stored.select(F.col("mid").alias("key"), F.to_json(F.struct(*new.columns)).alias("value")), publish, None, batch_id))
        if activity:
            rest.append(lambda: sinks.write_batch(metrics.activity_sketches(src), f"{table}_sketches", "logDate", batch_id))
        obs_bad = Observation(f"dau_bad_{batch_id}")
        if bad is not None:
            rest.append(lambda: sinks.write_batch(bad.observe(obs_bad, F.count(F.lit(1)).alias("quarantined")), f"{table}_quarantine", None, batch_id))
        side_by_side(rows.sparkSession, *rest)
        entry = {"batch": batch_id, **obs_in.get, **obs_out.get, **(obs_cmp.get if obs_cmp is not None else {})}
        if bad is not None:
            entry |= obs_bad.get
        if compact_lag_days is not None and days and batch_id % compact_every == 0:
            from datetime import date, timedelta
            horizon = (date.fromisoformat(days[0]) - timedelta(days=compact_lag_days)).isoformat()
            entry["compacted"] = sinks.compact_finished(rows.sparkSession, table, "logDate", horizon)
        if log is not None:
            log(entry)
    finally:
        rows.unpersist()


def run_dau(source: DataFrame, table: str, checkpoint: str, trigger: str | None = None,
            retention_days: int | None = None, log: BatchLog | None = None,
            publish: str | None = None, compact_lag_days: int | None = None,
            compact_every: int = 100, bitmap: bool = False, activity: bool = False) -> StreamingQuery:
    """``source``: streaming JSON lines of the startup topic. ``publish``: optional
    folder that also receives each batch's new first starts as JSON lines. ``bitmap``, ``activity``: see
    :func:`dau_batch`."""
    def batch(df: DataFrame, bid: int) -> None:
        good, bad = ingest.split_valid_startups(df)
        dau_batch(good, bid, table, retention_days, log, publish, compact_lag_days, compact_every, bad, bitmap, activity)

    return _start(source, batch, checkpoint, trigger)


def _compact_behind(batch: DataFrame, table: str, day_col: str, keys: list[str], batch_id: int,
                    lag_days: int | None, every: int) -> None:
    """Every so many batches, compacts the days that lie ``lag_days`` or more behind the batch's newest."""
    if lag_days is None or not batch_id or batch_id % every:
        return
    newest = batch.agg(F.max(day_col)).first()[0]
    if newest is not None:
        from datetime import date, timedelta
        horizon = (date.fromisoformat(newest) - timedelta(days=lag_days)).isoformat()
        sinks.compact_finished(batch.sparkSession, table, day_col, horizon, keys)


def _write_counts(changes: DataFrame, path: str, keys: list[str], name: str, batch_id: int) -> None:
    """What a batch adds to and takes from the number of devices by ``keys`` (a day first). ``_was``:
    where a device was counted before."""
    one = F.lit(1).cast("bigint")
    rows = changes.select(*keys, one.alias(name))
    if "_was" in changes.columns:
        taken = changes.where(F.col("_was").isNotNull()).select("_was.*").select(*keys, (-one).alias(name))
        rows = rows.unionByName(taken)
    sums = rows.groupBy(*keys).agg(F.sum(name).alias(name)).where(F.col(name) != 0)
    sinks.write_batch(sums, path, keys[0], batch_id)


def _changes(df: DataFrame, table: str, day_col: str | None, totals: tuple[str, list[str], str], checkpoint: str, trigger: str | None,
             state_partitions: int | None, compact_lag_days: int | None = None, compact_every: int = 100) -> StreamingQuery:
    """A stream of changed records into a last-write-wins table and its totals; with ``compact_lag_days``
    finished days are compacted every ``compact_every`` batches."""
    path, keys, name = totals

    def store(out: DataFrame, bid: int) -> None:
        out = out.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            sinks.write_batch(out.drop("_was"), table, day_col, bid)
            _write_counts(out, path, keys, name, bid)
            if day_col:
                _compact_behind(out, table, day_col, DAU_KEYS, bid, compact_lag_days, compact_every)
        finally:
            out.unpersist()

    w = df.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(store)
    with _starting(df.sparkSession, state_partitions):
        return _trigger(w, trigger).start()


def _startup_quarantine(source: DataFrame, table: str, checkpoint: str, trigger: str | None) -> StreamingQuery:
    _, bad = ingest.split_valid_startups(source)
    return _file_sink(bad, f"{table}_quarantine", f"{checkpoint.rstrip('/')}_quarantine", trigger)


def run_dau_keyed_state(source: DataFrame, table: str, checkpoint: str, trigger: str | None = None,
                        retention_days: int | None = None, state_partitions: int | None = None,
                        compact_lag_days: int | None = None, compact_every: int = 100) -> Queries:
    """DAU job with the earliest start of every (device, day) as keyed state (RocksDB; read the table with
    ``sinks.read_latest(..., DAU_KEYS)``), and the devices per hour of first start (``read_device_hours``).

    Each batch touches only the state of its own keys and writes only what changes. ``retention_days``
    evicts finished days; by default nothing is late. Lines that are no startups go to ``<table>_quarantine``."""
    good, _ = ingest.split_valid_startups(source)
    main = _changes(earliest(good, DAU_KEYS, retention_days), table, "logDate", (f"{table}_hours", ["logDate", "logHour"], "devices"),
                    checkpoint, trigger, state_partitions, compact_lag_days, compact_every)
    return Queries([main, _startup_quarantine(source, table, checkpoint, trigger)])


def run_dau_ttl(source: DataFrame, table: str, checkpoint: str, trigger: str | None = None,
                ttl_ms: int = DAY_MS, state_partitions: int | None = None) -> Queries:
    """DAU job whose seen devices expire ``ttl_ms`` after they were last written (wall clock): the
    first start of every (device, day) is appended when it is seen, nothing is written for the
    others, and state holds about a day. Read the table with ``sinks.read_result``."""
    good, _ = ingest.split_valid_startups(source)
    w = (device_days(good, ttl_ms).writeStream.outputMode("append").option("checkpointLocation", checkpoint)
         .foreachBatch(lambda out, bid: sinks.write_batch(out, table, "logDate", bid)))
    with _starting(source.sparkSession, state_partitions, only_with_data=True):
        main = _trigger(w, trigger).start()
    return Queries([main, _startup_quarantine(source, table, checkpoint, trigger)])


def run_first_seen(source: DataFrame, table: str, checkpoint: str, trigger: str | None = None,
                   state_partitions: int | None = None) -> Queries:
    """Table of each device's first start ever, kept by keyed state without expiry (read it with
    ``sinks.read_latest(..., ["mid"])``), and the number of new devices per day (``read_new_devices``): a row per day and
    batch, moved when an earlier start of a device arrives."""
    good, _ = ingest.split_valid_startups(source)
    main = _changes(earliest(good, ["mid"]), table, None, (f"{table}_days", ["logDate"], "new_mid"), checkpoint, trigger, state_partitions)
    return Queries([main, _startup_quarantine(source, table, checkpoint, trigger)])


def read_device_hours(spark, table: str) -> DataFrame | None:
    """(logDate, logHour, devices): devices by the hour of their first start of the day, as the batches
    have counted them."""
    return sinks.read_totals(spark, f"{table}_hours", ["logDate", "logHour"], ["devices"])


def read_activity(spark, table: str) -> DataFrame | None:
    """(logDate, logHour, sketch, batch) of the devices active per hour; see ``metrics.hourly_active_merged``."""
    return sinks.read_or_none(spark, f"{table}_sketches")


def read_new_devices(spark, table: str) -> DataFrame | None:
    """(logDate, new_mid) of the first-seen table."""
    return sinks.read_totals(spark, f"{table}_days", ["logDate"], ["new_mid"])


# --- orders ----------------------------------------------------------------------------

ORDER_KEYS = ["id", "create_date"]
ORDER_RANGE = 1_000_000  # ids of one folder of the id index
MOST_FOLDERS = 1_000     # of the index that a batch names; beyond, it reads the index unfiltered
# What an order contributes to the totals of its day.
CONTRIBUTION = ["create_date", "create_hour", "total_amount"]


def _order_paths(table: str) -> tuple[str, str]:
    return f"{table}_users", f"{table}_quarantine"


def _stored_orders(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(orders with the folder of their id, quarantine) of a batch of prepared orders; of several versions of an id
    in the batch the last by ``operate_time`` (then by the whole record)."""
    good, bad = ingest.split_valid_orders(batch)
    return dedup.last_per_key(good, ["id"], ["operate_time"]).withColumn("folder", _id_folder()), bad


def _id_folder() -> Column:
    """Folder of the id index: a range of numeric ids, so new orders and corrections of recent ones touch
    a few; other ids by hash."""
    number = F.floor(F.col("id").try_cast("bigint") / ORDER_RANGE).cast("string")
    return F.coalesce(number, F.concat(F.lit("h"), F.pmod(F.xxhash64("id"), F.lit(64)).cast("string")))


def _earlier_contributions(spark, index: str, orders: DataFrame, batch_id: int) -> DataFrame | None:
    """(id, _was struct) of those of ``orders`` that batches before ``batch_id`` have stored: only the
    folders of their ids are read."""
    known = sinks.read_or_none(spark, index)
    if known is None:
        return None
    folders = [r[0] for r in orders.select("folder").distinct().limit(MOST_FOLDERS + 1).collect()]
    if len(folders) <= MOST_FOLDERS:
        known = known.where(F.col("folder").isin(folders))
    known = known.where(sinks.version() < batch_id).withColumn("_at", sinks.version())
    known = known.join(orders.select("id"), "id", "left_semi")
    return known.groupBy("id").agg(F.max_by(F.struct(*CONTRIBUTION), "_at").alias("_was"))


def _write_totals(changes: DataFrame, table: str, batch_id: int) -> None:
    """What a batch adds to and takes from the totals per day and hour (``<table>_hours``). ``changes``:
    the contribution of each stored order and, in ``_was``, the one that it replaces."""
    money = F.col("total_amount").cast("decimal(18,2)")
    added = F.struct("create_date", "create_hour", money.alias("amount"), F.lit(1).alias("orders"))
    before = [F.col(f"_was.{c}") for c in ("create_date", "create_hour")]
    taken = F.when(F.col("_was").isNotNull(), F.struct(*before, (-F.col("_was.total_amount").cast("decimal(18,2)")).alias("amount"), F.lit(-1).alias("orders")))
    sums = changes.select(F.inline(F.array_compact(F.array(added, taken)))).groupBy("create_date", "create_hour").agg(
        F.sum("amount").cast("decimal(28,2)").alias("amount"), F.sum("orders").alias("orders"))
    sinks.write_batch(sums.where("orders <> 0 or amount <> 0"), f"{table}_hours", "create_date", batch_id)


def orders_batch(batch: DataFrame, batch_id: int, table: str, log: BatchLog | None = None,
                 compact_lag_days: int | None = None, compact_every: int = 100) -> None:
    """One micro-batch of order JSON lines -> the order table.

    parse -> split create time, mask phone -> quarantine rows without id or valid time -> one row per id ->
    first-order flag against the known-users table -> keyed upsert: the latest batch's version of an id
    counts (``read_orders``). A first order that is delivered again stays the first. New buyers are
    added to the known-users table, once each.

    The id index (``<table>_ids``, folders of id ranges) says where an id lies and what it contributes: an order
    that comes with another day leaves a ``_gone`` row in its old day, and the totals per day and hour
    (``<table>_hours``, ``read_order_hours``) get the difference to the version before. All writes are
    ``batch=<id>`` folders and look only at earlier batches; with ``compact_lag_days`` finished days of the
    order table and finished generations of the known-users table are compacted every ``compact_every`` batches."""
    users_path, bad_path = _order_paths(table)
    spark = batch.sparkSession
    parsed = ingest.prepare_orders(ingest.parse_order(batch)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        orders, bad = _stored_orders(parsed)
        orders = orders.persist(StorageLevel.MEMORY_AND_DISK)  # read several times below
        known = sinks.read_or_none(spark, users_path)
        if known is not None:  # only the batch's users take part in the join
            known = known.where(F.col(sinks.BATCH_COL) != F.lit(str(batch_id))).select("user_id", "first_id")
            known = known.join(orders.select("user_id").distinct(), "user_id", "left_semi")
        # an id comes once in orders
        placed = dedup.flag_first(orders, "user_id", ["create_time", *dedup.numeric_id("id")], known, unique=True, new="_buyer")
        earlier = _earlier_contributions(spark, f"{table}_ids", orders, batch_id)
        was = F.lit(None).cast("struct<create_date string, create_hour string, total_amount double>")
        placed = placed.withColumn("_was", was) if earlier is None else placed.join(earlier, "id", "left")
        placed = placed.persist(StorageLevel.MEMORY_AND_DISK)
        rows = placed.select(*ORDER_FIELDS, F.lit(False).alias(sinks.GONE))
        if earlier is not None:
            rows = rows.unionByName(placed.where(F.col("_was.create_date") != F.col("create_date")).select(
                *[F.col("id") if c == "id" else F.col("_was.create_date").alias(c) if c == "create_date" else F.lit(None).cast(placed.schema[c].dataType).alias(c)
                  for c in ORDER_FIELDS], F.lit(True).alias(sinks.GONE)))
        changed = placed.where(~F.struct(*CONTRIBUTION).eqNullSafe(F.col("_was")))
        # Known users: gen=<batch_id // compact_every>/batch=<id>; a finished generation is
        # rewritten into one folder when the next one starts.
        gen = batch_id // compact_every
        buyers = placed.where("_buyer").select("user_id", F.col("id").alias("first_id"), F.lit(str(gen)).alias("gen"))
        obs = Observation(f"quarantine_{batch_id}")
        # the table first (the source of truth), then the others side by side
        sinks.write_batch(sinks.together(rows, "create_date"), table, "create_date", batch_id)
        side_by_side(
            spark,
            lambda: _write_totals(changed, table, batch_id),
            lambda: sinks.write_batch(changed.select("id", *CONTRIBUTION, "folder"), f"{table}_ids", "folder", batch_id),
            lambda: sinks.write_batch(buyers, users_path, "gen", batch_id),
            lambda: sinks.write_batch(bad.observe(obs, F.count(F.lit(1)).alias("quarantined")), bad_path, None, batch_id))
        entry = {"batch": batch_id, **obs.get}
        if compact_lag_days is not None and batch_id % compact_every == 0:
            days = sinks.batch_days(placed, "create_date")
            if days:
                from datetime import date, timedelta
                horizon = (date.fromisoformat(days[0]) - timedelta(days=compact_lag_days)).isoformat()
                entry["compacted"] = sinks.compact_finished(spark, table, "create_date", horizon, ["id"])
            if gen > 0:
                sinks.compact_days(spark, users_path, "gen", [str(gen - 1)])
        if log is not None:
            log(entry)
        placed.unpersist()
        orders.unpersist()
    finally:
        parsed.unpersist()


def read_orders(spark, table: str) -> DataFrame | None:
    """The order table: one row per id, its latest version. An id's versions of a day are compared within the
    day (a version that moved has left a ``_gone`` row), so a filter on ``create_date`` prunes the scan."""
    return sinks.read_latest(spark, table, ORDER_KEYS)


def read_order_hours(spark, table: str) -> DataFrame | None:
    """(create_date, create_hour, amount, orders) as the batches have kept them, corrections included."""
    return sinks.read_totals(spark, f"{table}_hours", ["create_date", "create_hour"], ["amount", "orders"])


def run_orders(source: DataFrame, table: str, checkpoint: str, trigger: str | None = None,
               log: BatchLog | None = None, compact_lag_days: int | None = None,
               compact_every: int = 100) -> StreamingQuery:
    """``source``: streaming JSON lines of the order topic."""
    return _start(source, lambda df, bid: orders_batch(df, bid, table, log, compact_lag_days, compact_every),
                  checkpoint, trigger)


def run_orders_keyed_state(source: DataFrame, table: str, checkpoint: str,
                           trigger: str | None = None, state_partitions: int | None = None,
                           compact_lag_days: int | None = None, compact_every: int = 100) -> Queries:
    """Order job for a large user base: a user's orders are keyed state (RocksDB), so a batch reads
    neither the known users nor the order table. The stream carries ``is_first_order`` and only the rows that a
    batch changes; the table stores them as the batch's versions (``read_orders``), and the totals per day and hour
    get the differences (``read_order_hours``). A batch that changes nothing writes nothing; with
    ``compact_lag_days`` finished days are compacted every ``compact_every`` batches. Invalid orders go to
    ``<table>_quarantine``."""
    good, bad = ingest.split_valid_orders(ingest.prepare_orders(ingest.parse_order(source)))

    def store(out: DataFrame, bid: int) -> None:
        out = out.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows = dedup.last_per_key(out.drop("_was"), ORDER_KEYS, ["_seq"]).drop("_seq")
            sinks.write_batch(rows, table, "create_date", bid)
            # each row says what it replaces, so several of an id in one batch add up to the last
            _write_totals(out.where(~F.col(sinks.GONE) & ~F.struct(*CONTRIBUTION).eqNullSafe(F.col("_was"))), table, bid)
            _compact_behind(out, table, "create_date", ["id"], bid, compact_lag_days, compact_every)
        finally:
            out.unpersist()

    w = first_orders(good).writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(store)
    with _starting(source.sparkSession, state_partitions, only_with_data=True):
        main = _trigger(w, trigger).start()
    return Queries([main, _file_sink(bad, _order_paths(table)[1], f"{checkpoint.rstrip('/')}_quarantine", trigger)])
