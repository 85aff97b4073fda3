"""Arbitrary keyed state (``transformWithState``): devices that expire, first orders that change.

The processors run in Python workers; state lives in RocksDB, partitioned like the stream, so a batch touches
only the state of its own keys. Each call to the state, each key and each column of a row costs a worker a fixed time, so
records travel as one JSON string, small entries lie together in slots (:class:`Slots`), and devices are grouped by a hash
(``BUCKETS``). A group's rows are read one by one: what is held is ``CACHED`` slots and the keys of a bucket that a batch
changes; a user's orders are never gathered. The module is pickled by value, so executors need no copy of this package.
"""

from __future__ import annotations

import json
import sys
import zlib
from collections import OrderedDict
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAY_MS = 86_400_000
BUCKETS = 4096        # groups of devices: many for each state partition
SLOT_ENTRIES = 32     # of a slot, about; with more it is split
CACHED = 256          # slots of a group that a worker holds
PARTS = ["create_date", "create_hour", "total_amount"]  # what an order contributes to the totals


def use_rocksdb(spark: SparkSession) -> None:
    """State beyond an executor's memory; the conf is read when a query starts."""
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKSDB_PROVIDER:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)


def _nulls_first(values) -> tuple:
    """A sort key that orders like a struct: nulls first."""
    return tuple((v is not None, v if v is not None else 0) for v in values)


class Slots:
    """A map of a group's keys (strings) to entries (lists) in a map state: entries lie together in slots, each a JSON
    string, so keys that come together share a call to the state. The slots are a linear hash table: an entry into a full slot
    splits the next slot in turn, so a slot stays small whatever the size of the group. Slot 0 holds the number
    of slots, and is written whenever another one is, so it lives as long as any. ``alive`` tells which entries to keep when
    a slot is written."""

    def __init__(self, state, most: int = SLOT_ENTRIES, alive=None):
        self.state, self.most, self.alive, self.slots, self.dirty = state, most, alive, OrderedDict(), set()
        self.empty = True
        self.n = 1
        self._load(0)

    def _load(self, i: int) -> dict:
        if i in self.slots:
            self.slots.move_to_end(i)
            return self.slots[i]
        stored, entries = self.state.getValue((i,)), {}
        if stored is not None:
            self.n, entries = (max(self.n, stored[0]), json.loads(stored[1]))
            self.empty = False
        while len(self.slots) >= CACHED:
            self._write(*self.slots.popitem(last=False))
        self.slots[i] = entries
        return entries

    def _write(self, i: int, entries: dict) -> None:
        if i in self.dirty:
            self.dirty.discard(i)
            if self.alive is not None:
                entries = {k: v for k, v in entries.items() if self.alive(v)}
            self.state.updateValue((i,), (self.n, json.dumps(entries, separators=(",", ":"))))

    def _spot(self, key: str) -> int:
        h, level = zlib.crc32(key.encode()), 1 << (self.n.bit_length() - 1)
        i = h & (2 * level - 1)
        return i if i < self.n else i - level

    def get(self, key: str) -> list | None:
        return self._load(self._spot(key)).get(key)

    def put(self, key: str, entry: list) -> None:
        i = self._spot(key)
        slot = self._load(i)
        full = key not in slot and len(slot) >= self.most
        slot[key] = entry
        self.dirty.add(i)
        if full:
            self._split()

    def _split(self) -> None:
        old = self.n - (1 << (self.n.bit_length() - 1))
        entries, new = self._load(old), self.n
        self.n += 1
        moved = [k for k in entries if self._spot(k) == new]
        self.dirty |= {old, new, 0}
        rest = {k: entries.pop(k) for k in moved}
        self._load(new).update(rest)

    def items(self) -> Iterator[tuple[str, list]]:
        for i in range(self.n):
            yield from list(self._load(i).items())

    def flush(self) -> None:
        if self.dirty:
            self._load(0)
            self.dirty.add(0)
        for i, entries in self.slots.items():
            self._write(i, entries)


def slot_state(handle: StatefulProcessorHandle, name: str, ttl_ms: int | None = None):
    """The map state of :class:`Slots`."""
    slot = T.StructType([T.StructField("slot", T.IntegerType())])
    held = T.StructType([T.StructField("slots", T.IntegerType()), T.StructField("entries", T.StringType())])
    return handle.getMapState(name, slot, held, ttlDurationMs=ttl_ms)


def _values(record: str, columns: list[str], numbers: frozenset | set = frozenset()) -> dict:
    """The columns of a record as ``to_json`` has written it: nulls are left out, NaN and infinities are strings."""
    found = json.loads(record)
    return {c: float(found[c]) if c in numbers and found.get(c) is not None else found.get(c) for c in columns}


def _packed(df: DataFrame, *others) -> DataFrame:
    """``others`` and the whole row as one JSON string."""
    return df.select(*others, F.to_json(F.struct(*df.columns)).alias("_record"))


def combine_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Per Arrow batch and key only the smallest row by ``order`` (then by the other columns): a
    combiner before the shuffle of a stream, where a partial aggregate can't stand, so a hot key
    sends a row per batch of rows instead of all of them."""
    columns = df.columns
    by = [*order, *[c for c in columns if c not in keys and c not in order]]

    def run(frames):
        for frame in frames:
            several = frame.duplicated(keys, keep=False)  # only keys with several rows need the sort
            first = frame[several].sort_values(by, na_position="first", kind="stable").drop_duplicates(keys)
            yield frame[~several | frame.index.isin(first.index)]
    return df.mapInPandas(run, df.schema)


def _by_bucket(startups: DataFrame, keys: list[str], *others) -> DataFrame:
    """Combined startups as (bucket of the device, key, ts, record)."""
    rows = combine_first(startups, keys, ["ts"])
    bucket = F.pmod(F.xxhash64("mid"), F.lit(BUCKETS)).cast("int").alias("_bucket")
    key = F.to_json(F.struct(*keys)).alias("_key")
    return _packed(rows, bucket, key, F.col("ts").alias("_ts"), *others)


class _Starts:
    """Compares startups by ``ts``, then by the other columns, nulls first."""

    def __init__(self, columns: list[str]):
        self.order = ["ts", *[c for c in columns if c != "ts"]]

    def earlier(self, ts, record: str, than_ts, than: str) -> bool:
        if ts != than_ts:
            return _nulls_first([ts]) < _nulls_first([than_ts])
        return record != than and _nulls_first(_values(record, self.order).values()) < _nulls_first(_values(than, self.order).values())


class DeviceDays(StatefulProcessor):
    """Per (device, day) of a bucket: the first start of the first batch that sees the key. The key is forgotten
    ``ttl_ms`` after it was last written; each later start of the device on that day writes it again."""

    def __init__(self, columns: list[str], ttl_ms: int):
        self.starts, self.ttl_ms = _Starts(columns), ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = slot_state(handle, "seen", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()  # of the batch
        seen = Slots(self.state, alive=lambda e: e[0] > now)
        new: dict[str, tuple] = {}
        for r in rows:
            k, ts, record = r["_key"], r["_ts"], r["_record"]
            if k in new:
                if self.starts.earlier(ts, record, *new[k]):
                    new[k] = (ts, record)
                continue
            before = seen.get(k)
            if before is None or before[0] <= now:
                new[k] = (ts, record)
            seen.put(k, [now + self.ttl_ms])  # the time to live begins anew
        seen.flush()
        for _, record in new.values():
            yield Row(_record=record)

    def close(self) -> None:
        pass


def device_days(startups: DataFrame, ttl_ms: int = DAY_MS) -> DataFrame:
    """Streaming parsed startups -> the first start of every (mid, logDate), in append mode. State
    expires ``ttl_ms`` after the last write of a key (wall clock), so it holds the devices of about a day; a
    device that starts again for a day whose key has expired is new once more, as it would be in a set
    with an expiry."""
    use_rocksdb(startups.sparkSession)
    schema = startups.schema
    found = _by_bucket(startups, ["mid", "logDate"]).groupBy("_bucket").transformWithState(
        statefulProcessor=DeviceDays(startups.columns, ttl_ms), outputStructType="_record string", outputMode="Append", timeMode="ProcessingTime")
    return found.select(F.from_json("_record", schema).alias("_r")).select("_r.*")


class Earliest(StatefulProcessor):
    """Per key of a bucket: the earliest record ever seen (by ``ts``, then by the other columns), whatever the order of
    arrival. Emits it only when it changes, with the record before. With ``day_end``, the
    event-time column, a bucket (of one day) is forgotten when the watermark has passed its day."""

    def __init__(self, columns: list[str], day_end: str | None = None):
        self.starts, self.day_end = _Starts(columns), day_end

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = slot_state(handle, "best")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        best = Slots(self.state)
        timer = self.day_end is not None and best.empty
        changed: dict[str, str | None] = {}
        for r in rows:
            k, ts, record = r["_key"], r["_ts"], r["_record"]
            if timer:
                self.handle.registerTimer(int(r[self.day_end].timestamp() * 1000))
                timer = False
            stored = best.get(k)
            if stored is None or self.starts.earlier(ts, record, *stored):
                changed.setdefault(k, None if stored is None else stored[1])
                best.put(k, [ts, record])
        for k, old in changed.items():
            yield Row(_record=best.get(k)[1], _old=old)
        best.flush()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


DAY_END = "_day_end"


def earliest(startups: DataFrame, keys: list[str], retention_days: int | None = None) -> DataFrame:
    """Streaming parsed startups -> the earliest start of every key, in update mode, a row when it changes, with
    ``_was``: where the one before was counted.

    Without ``retention_days`` nothing is late and no key is forgotten. With it (``keys`` include the day) the
    watermark trails the end of the newest day by so many days: the keys of days before are evicted, and starts of
    such days are not taken any more (``numRowsDroppedByWatermark`` of the query's progress counts them)."""
    use_rocksdb(startups.sparkSession)
    schema, by, others = startups.schema, ["_bucket"], []
    if retention_days is not None:
        by, others = ["_bucket", "logDate"], ["logDate", F.timestamp_millis((F.floor(F.col("ts") / DAY_MS) + 1) * DAY_MS).alias(DAY_END)]
    rows = _by_bucket(startups, keys, *others)
    if retention_days is not None:
        rows = rows.withWatermark(DAY_END, f"{int(retention_days)} days")
    state = Earliest(startups.columns, None if retention_days is None else DAY_END)
    found = rows.groupBy(*by).transformWithState(statefulProcessor=state, outputStructType="_record string, _old string", outputMode="Update",
                                                 timeMode="None" if retention_days is None else "EventTime")
    return found.select(F.from_json("_record", schema).alias("_r"), F.from_json("_old", "logDate string, logHour string").alias("_was")).select("_r.*", "_was")


class User:
    """A user in a batch: the first order before it and now (key, id, create time) and its rank, whether that has come again
    or got a later time, and the versions before of the one or two orders that are not emitted yet."""

    def __init__(self, first: list | None):
        self.before = self.first = first
        self.top, self.touched, self.lost, self.came = None, False, False, {}


class FirstOrders(StatefulProcessor):
    """Per user of a bucket: the stored orders and which of them is the first (by create time, then id as a
    number, then id). Emits the rows of the order table that a batch changes, with the flag: orders that are
    new or come in another version, and orders whose flag turns because an earlier one has arrived or the
    first one has got a later time. An order that is delivered again as it was emits nothing. Of several
    versions in a batch the largest by ``operate_time``, then by the whole record, counts; of several
    batches the last. A row may be emitted again in a batch; the one with the highest ``_seq`` holds. ``_old``: the
    version before, of which the totals of its day are relieved; one that lay in another day is also emitted there, as ``_gone``.

    Entries: an order by user and id (record, create time, batch), a user's first order by the user (its key, id, create time)."""

    def __init__(self, columns: list[str], numbers: set[str], flag: str):
        self.columns, self.numbers, self.flag, self.seq = columns, numbers, flag, 0
        self.version = ["operate_time", *columns]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = slot_state(handle, "orders")

    @staticmethod
    def rank(time: str, order_id: str) -> tuple:
        whole = order_id.isascii() and order_id.strip().lstrip("+-").isdecimal()
        return time, whole, int(order_id) if whole else 0, order_id

    def row(self, key: str, is_first: bool, came: dict) -> Row:
        """The stored order; what it replaces is the version before if it has just come."""
        record = self.orders.get(key)[0]
        old = record if key not in came else came.pop(key)
        self.seq += 1
        return Row(**{"_record": record, self.flag: "1" if is_first else "0", "_old": old, "_gone": False, "_seq": self.seq})

    def left(self, old: dict) -> Row:
        """The place that an order has left."""
        self.seq += 1
        place = json.dumps({c: old[c] for c in ("id", "create_date")})
        return Row(**{"_record": place, self.flag: None, "_old": None, "_gone": True, "_seq": self.seq})

    def later(self, record: str, than: str) -> bool:
        a, b = (_values(r, self.columns, self.numbers) for r in (record, than))
        return _nulls_first(a[c] for c in self.version) > _nulls_first(b[c] for c in self.version)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()  # of the batch; the same when it is run again
        self.orders = orders = Slots(self.state)
        self.seq = 0
        users: dict[str, User] = {}
        for r in rows:
            k, order_id, time, record, old = r["_key"], r["_id"], r["_time"], r["_record"], None
            known = r["user_id"] is not None  # orders without a user are never a first order
            u = users.get(r["_user"]) if known else User(None)
            if u is None:
                u = users[r["_user"]] = User(orders.get(r["_user"]))
                u.top = None if u.first is None else self.rank(*u.first[:0:-1])
            have = orders.get(k)
            if have is not None:
                before_it, _, at = have
                if before_it == record or at == now and self.later(before_it, record):
                    continue
                old = before_it
                place = _values(old, ["id", "create_date"])
                if place["create_date"] != r["_date"]:
                    yield self.left(place)
            mine = self.rank(time, order_id)
            orders.put(k, [record, time, now])
            u.came.setdefault(k, old)
            if known and u.first is not None and k == u.first[0]:
                u.touched, u.lost, u.top, u.first = True, u.lost or mine > u.top, mine, [k, order_id, time]
            elif known and (u.top is None or mine < u.top):
                if u.first is not None:
                    yield self.row(u.first[0], False, u.came)
                u.first, u.top, u.touched = [k, order_id, time], mine, True
            else:
                yield self.row(k, False, u.came)
        lost = {name for name, u in users.items() if u.lost}
        if lost:  # any stored order may be the first now
            best: dict[str, tuple] = {}
            for k, entry in orders.items():
                owner = json.loads(k)
                if "id" in owner and (name := json.dumps({"user_id": owner.get("user_id")}, ensure_ascii=False, separators=(",", ":"))) in lost:
                    mine = self.rank(entry[1], owner["id"])
                    if name not in best or mine < best[name][0]:
                        best[name] = mine, [k, owner["id"], entry[1]]
            for name in lost:
                u = users[name]
                if best[name][1][0] != u.first[0]:
                    yield self.row(u.first[0], False, u.came)
                    u.first = best[name][1]
        for name, u in users.items():
            if u.first != u.before:
                orders.put(name, u.first)
            if u.touched or u.first[0] != u.before[0]:
                yield self.row(u.first[0], True, u.came)
        orders.flush()

    def close(self) -> None:
        pass


def first_orders(orders: DataFrame, flag: str = "is_first_order") -> DataFrame:
    """Streaming valid orders -> the changed rows of the order table with ``flag``, ``_was`` (what the version before
    contributed to its day), ``_gone`` and ``_seq``, in update mode."""
    use_rocksdb(orders.sparkSession)
    schema = orders.schema
    was = T.StructType([T.StructField(c, schema[c].dataType) for c in PARTS])
    numbers = {f.name for f in schema if isinstance(f.dataType, T.DoubleType)}
    # orders without a user go by their id
    bucket = F.pmod(F.xxhash64(F.coalesce("user_id", "id")), F.lit(BUCKETS)).cast("int").alias("_bucket")
    rows = _packed(orders, bucket, "user_id", F.to_json(F.struct("user_id")).alias("_user"), F.to_json(F.struct("user_id", "id")).alias("_key"),
                   F.col("id").alias("_id"), F.col("create_time").alias("_time"), F.col("create_date").alias("_date"))
    found = rows.groupBy("_bucket").transformWithState(
        statefulProcessor=FirstOrders(orders.columns, numbers, flag), outputStructType=f"_record string, {flag} string, _old string, _gone boolean, _seq bigint",
        outputMode="Update", timeMode="ProcessingTime")
    return found.select(F.from_json("_record", schema).alias("_r"), flag, F.from_json("_old", was).alias("_was"), "_gone", "_seq").select("_r.*", flag, "_was", "_gone", "_seq")
