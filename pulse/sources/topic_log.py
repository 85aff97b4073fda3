"""Topics as logs: a Python data source (``topic_log``) with offsets per partition.

A topic is a folder of partitions, a partition a sequence of Parquet segments whose names carry the offset of
their first message and their number of messages (``partition=2/00000000000000001200_400.parquet``), so offsets
are known from a listing. Messages are (key, value, timestamp); reading adds partition and offset.

* Streams start at the ``latest`` message (or the ``earliest``), go on by the offsets of their checkpoint, and take
  at most ``maxMessages`` messages a batch, dealt over the partitions by what they hold. A ``group`` (``default`` with a
  bound) keeps the end of its last planned batch next to the topic: a new query of the group goes on there, and the
  bound holds after a restart too. Queries that share a topic need groups of their own.
  With the bound an ``availableNow`` run is one batch (Spark asks a Python source for its end once); drain such a
  topic with a processing-time trigger (:func:`drain`).
* A range of offsets is cut into tasks of ``messagesPerTask`` messages, also inside a segment, so a large partition
  is read by several executors.
* Writes are committed per (``writer``, epoch): tasks stage their segments, the commit notes which offsets they get
  and then moves them. An epoch that is written again, after a failure before or in the commit, changes
  nothing, so downstream streams see no message twice. One job writes to a topic at a time.

The files are reached through pyarrow's file systems (a local path or a URI). The module is pickled by value:
executors need pyarrow only.
"""

from __future__ import annotations

import json
import re
import sys
import time
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter, DataSourceStreamReader, DataSourceWriter,
                                    InputPartition, WriterCommitMessage)
from pyspark.sql.types import StructType

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "key string, value string, timestamp timestamp, partition int, offset long"
SEGMENT = re.compile(r"partition=(\d+)/(\d{20})_(\d+)\.parquet$")
FLUSH_ROWS = 50_000      # that a task holds before it writes a segment
GROUP_ROWS = 10_000      # of a row group: what a task reads beyond its range at most
KEEP_EPOCHS = 100        # notes of past commits


class Folder:
    """Files below a path, on whatever file system it names."""

    def __init__(self, path: str):
        from pyarrow import fs
        self.fs, root = fs.FileSystem.from_uri(path)
        self.root = root.rstrip("/")

    def list(self, below: str, recursive: bool = False) -> list[str]:
        from pyarrow import fs
        found = self.fs.get_file_info(fs.FileSelector(f"{self.root}/{below}".rstrip("/"), allow_not_found=True, recursive=recursive))
        return [f.path[len(self.root) + 1:] for f in found if f.is_file]

    def exists(self, name: str) -> bool:
        return self.fs.get_file_info(f"{self.root}/{name}").is_file

    def read(self, name: str) -> bytes | None:
        if not self.exists(name):
            return None
        with self.fs.open_input_stream(f"{self.root}/{name}") as f:
            return f.read()

    def write(self, name: str, data: bytes) -> None:
        """The whole file or nothing: written under another name and moved."""
        part = f"{name.rpartition('/')[0]}/.{uuid.uuid4().hex}"
        self.fs.create_dir(f"{self.root}/{name}".rpartition("/")[0], recursive=True)
        with self.fs.open_output_stream(f"{self.root}/{part}") as f:
            f.write(data)
        self.fs.move(f"{self.root}/{part}", f"{self.root}/{name}")

    def move(self, a: str, b: str) -> None:
        self.fs.create_dir(f"{self.root}/{b}".rpartition("/")[0], recursive=True)
        self.fs.move(f"{self.root}/{a}", f"{self.root}/{b}")

    def delete(self, name: str) -> None:
        if self.exists(name):
            self.fs.delete_file(f"{self.root}/{name}")


def segments(folder: Folder) -> list[tuple[int, int, int, str]]:
    """(partition, first offset, messages, file) in order."""
    found = [(int(m[1]), int(m[2]), int(m[3]), f) for f in folder.list("", recursive=True)
             if not f.startswith("_") and (m := SEGMENT.search(f)) and f == m[0]]
    return sorted(found)


def ends(folder: Folder) -> dict[str, int]:
    """The offset after the last message of every partition."""
    out: dict[str, int] = {}
    for p, first, n, _ in segments(folder):
        out[str(p)] = max(out.get(str(p), 0), first + n)
    return out


def admitted(at: dict[str, int], end: dict[str, int], most: int) -> dict[str, int]:
    """How far a batch of ``most`` messages gets from ``at``, each partition by its share of what waits."""
    waiting = {p: max(0, n - at.get(p, 0)) for p, n in sorted(end.items())}
    total = sum(waiting.values())
    if total <= most:
        return {p: max(n, at.get(p, 0)) for p, n in end.items()}
    take = {p: n * most // total for p, n in waiting.items()}
    for p in sorted(waiting, key=lambda p: take[p] - waiting[p]):  # what rounding left, to the longest first
        more = min(most - sum(take.values()), waiting[p] - take[p])
        take[p] += more
    return {p: at.get(p, 0) + n for p, n in take.items()}


@dataclass
class Range(InputPartition):
    """Messages ``start`` to ``stop`` (not included) of one segment."""

    file: str
    partition: int
    first: int
    start: int
    stop: int


def ranges(folder: Folder, start: dict[str, int], end: dict[str, int], per_task: int) -> list[Range]:
    out = []
    for p, first, n, file in segments(folder):
        lo, hi = max(first, start.get(str(p), 0)), min(first + n, end.get(str(p), 0))
        out += [Range(file, p, first, a, min(a + per_task, hi)) for a in range(lo, hi, per_task)]
    return out


def messages(path: str, part: Range) -> Iterator:
    """The messages of a range as Arrow batches; only row groups that hold some of them are read."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    folder = Folder(path)
    with folder.fs.open_input_file(f"{folder.root}/{part.file}") as f:
        file, at = pq.ParquetFile(f), part.first
        for g in range(file.num_row_groups):
            n = file.metadata.row_group(g).num_rows
            lo, hi = max(part.start, at), min(part.stop, at + n)
            if lo < hi:
                rows = file.read_row_group(g, columns=["key", "value", "timestamp"]).slice(lo - at, hi - lo)
                rows = rows.append_column("partition", pa.array([part.partition] * len(rows), pa.int32()))
                rows = rows.append_column("offset", pa.array(range(lo, hi), pa.int64()))
                yield from rows.to_batches()
            at += n


class Options:
    def __init__(self, options: dict):
        self.path = options["path"]
        self.start = options.get("startingOffsets", "latest")
        self.most = int(options["maxMessages"]) if options.get("maxMessages") else None
        self.per_task = int(options.get("messagesPerTask", 100_000))
        self.group = options.get("group") or ("default" if self.most else None)
        self.partitions = int(options.get("partitions", 4))
        self.writer = options.get("writer", "default")
        self.epoch = options.get("epoch")


class StreamReader(DataSourceStreamReader):
    def __init__(self, options: Options):
        self.o, self.folder = options, Folder(options.path)
        self.note = f"_groups/{options.group}.json"
        noted = self.folder.read(self.note) if options.group else None
        self.at: dict | None = json.loads(noted) if noted else None  # where the next batch begins, if known

    def initialOffset(self) -> dict:
        if self.at is None:
            self.at = ends(self.folder) if self.o.start == "latest" else {}
        return self.at

    def latestOffset(self) -> dict:
        end = ends(self.folder)
        return end if self.o.most is None else admitted(self.initialOffset(), end, self.o.most)

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        self.at = end
        if self.o.group:
            self.folder.write(self.note, json.dumps(end).encode())
        return ranges(self.folder, start, end, self.o.per_task)

    def read(self, partition: Range) -> Iterator:
        return messages(self.o.path, partition)


class BatchReader(DataSourceReader):
    def __init__(self, options: Options):
        self.o = options

    def partitions(self) -> Sequence[InputPartition]:
        folder = Folder(self.o.path)
        return ranges(folder, {}, ends(folder), self.o.per_task)

    def read(self, partition: Range) -> Iterator:
        return messages(self.o.path, partition)


@dataclass
class Staged(WriterCommitMessage):
    """(topic folder, partition, staged file, messages) of a task."""

    files: list


class Log:
    """Staging and committing of segments."""

    def __init__(self, options: Options):
        self.o = options

    def stage(self, batches: Iterator) -> Staged:
        import pyarrow as pa
        import pyarrow.parquet as pq
        folder, waiting, held, files, seen = Folder(self.o.path), {}, 0, [], 0
        schema = pa.schema([("key", pa.string()), ("value", pa.string()), ("timestamp", pa.timestamp("us", "UTC"))])
        now = pa.scalar(time.time_ns() // 1000, schema.field("timestamp").type)

        def flush() -> None:
            for (topic, p), tables in waiting.items():
                name, table = f"_staging/{uuid.uuid4().hex}.parquet", pa.concat_tables(tables)
                folder.fs.create_dir(f"{folder.root}/_staging", recursive=True)
                with folder.fs.open_output_stream(f"{folder.root}/{name}") as f:
                    pq.write_table(table, f, row_group_size=GROUP_ROWS)
                files.append((topic, p, name, len(table)))
            waiting.clear()

        for batch in batches:
            names, n = batch.schema.names, len(batch)
            cols = {c: batch.column(c).cast(schema.field(c).type) if c in names else pa.nulls(n, schema.field(c).type) for c in schema.names}
            cols["timestamp"] = cols["timestamp"].fill_null(now)
            table = pa.table(cols, schema=schema)
            topics = [f"topic={t}/" for t in batch.column("topic").to_pylist()] if "topic" in names else [""] * n
            spots: dict[tuple, list[int]] = {}
            for k, (topic, key) in enumerate(zip(topics, table.column("key").to_pylist())):
                spots.setdefault((topic, (seen + k if key is None else zlib.crc32(key.encode())) % self.o.partitions), []).append(k)
            for spot, at in spots.items():
                waiting.setdefault(spot, []).append(table.take(pa.array(at)))
            seen, held = seen + n, held + n
            if held >= FLUSH_ROWS:
                flush()
                held = 0
        flush()
        return Staged(files)

    def commit(self, messages: list, epoch: str) -> None:
        folder, notes = Folder(self.o.path), f"_epochs/{self.o.writer}"
        staged = sorted(f for m in messages if m for f in m.files)
        plan = folder.read(f"{notes}/{epoch}.json")
        old = sorted(int(n) for f in folder.list(notes) if (n := f.rpartition("/")[2].removesuffix(".json")).isdecimal())
        if plan is None and epoch.isdecimal() and old and int(epoch) < old[-1]:
            plan = b"[]"  # committed so long ago that its note is gone
        if plan is None:
            at: dict[tuple, int] = {}
            moves = []
            for topic in {t for t, *_ in staged}:
                below = Folder(f"{self.o.path.rstrip('/')}/{topic}".rstrip("/"))
                at |= {(topic, int(p)): n for p, n in ends(below).items()}
            for topic, p, name, n in staged:
                first = at.get((topic, p), 0)
                moves.append((name, f"{topic}partition={p}/{first:020d}_{n}.parquet"))
                at[topic, p] = first + n
            folder.write(f"{notes}/{epoch}.json", json.dumps(moves).encode())
        else:
            moves = json.loads(plan)
        for a, b in moves:
            if not folder.exists(b):
                folder.move(a, b)
        for _, _, name, _ in staged:  # of an epoch that is written again
            folder.delete(name)
        for n in old[:-KEEP_EPOCHS]:
            folder.delete(f"{notes}/{n}.json")

    def drop(self, messages: list) -> None:
        folder = Folder(self.o.path)
        for m in messages:
            for _, _, name, _ in (m.files if m else ()):
                folder.delete(name)


class StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, options: Options):
        self.log = Log(options)

    def write(self, iterator: Iterator) -> Staged:
        return self.log.stage(iterator)

    def commit(self, messages: list, batchId: int) -> None:
        self.log.commit(messages, str(batchId))

    def abort(self, messages: list, batchId: int) -> None:
        self.log.drop(messages)


class BatchWriter(DataSourceArrowWriter):
    def __init__(self, options: Options):
        self.log, self.epoch = Log(options), options.epoch or uuid.uuid4().hex

    def write(self, iterator: Iterator) -> Staged:
        return self.log.stage(iterator)

    def commit(self, messages: list) -> None:
        self.log.commit(messages, self.epoch)

    def abort(self, messages: list) -> None:
        self.log.drop(messages)


class TopicLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "topic_log"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return BatchReader(Options(self.options))

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return StreamReader(Options(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("a topic is only appended to")
        return BatchWriter(Options(self.options))

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamArrowWriter:
        return StreamWriter(Options(self.options))


def register(spark) -> None:
    spark.dataSource.register(TopicLog)


def drain(query, timeout: float | None = None) -> None:
    """Lets a query take all that is in its topics, batch by bounded batch, and stops it."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()
