"""Vector code compression: product codes from codebooks learned by member-resident Lloyd rounds.

A vector is cut into equal parts; every part position has a codebook of up to 256 entries. The parts are the
members: they live in partitions by (position, entry, salt), the owners. Per round an owner assigns its
resident members to the new entries; members that keep their entry stay where they are, and only those that
changed it go through the shuffle to their new owner (the stayers and the movers are united partition by
partition). An entry's new value comes from its owners' sums. A round's members are checkpointed in the shared
folder, so a lost executor costs tasks of one round.

Bounds: the codebooks (256 entries of the dimension) are all that is broadcast or sent to the driver. The salt
spreads an entry, however many members it has, over a quarter as many owners as there are partitions; partitions
follow the size of the members (``MEMBER_BYTES``).

Defined results: vectors that are null, hold null or non-finite components, have fewer components than parts, or
another length than most vectors (ties: the longer) are dropped; with a length that the parts don't divide the
first parts are one component longer. Components are floor(1024 * x), held to +-2**24 (|x| up to 16,384), exact for up to
4,096 dimensions. Null and repeated vec_ids are rows like others (nulls come last, equal ids in the order of
their components, in the first codebook). Null labels are one label. An empty table gives no rows. Other
columns stay out of the plan."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, Accumulator, StorageLevel, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.llm.common import ensure_columns, map_arrow, shared_dir, ship, written

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
LIMIT = 1 << 24
MEMBER_BYTES = 64 << 20   # of a resident partition
BLOCK_BYTES = 16 << 10    # of the members that travel as one record
CHUNK = 16_384            # members that a task works on at once


def to_integers(df: DataFrame) -> DataFrame:
    """(vec_id, label, v array<int>) of the vectors without null or non-finite components."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten()  # without what null lists may hide
            ok = ~np.asarray(lists.is_null())
            sizes = np.where(ok, sizes, 0)
            x = flat.to_numpy(zero_copy_only=False).astype(np.float64)  # nulls become NaN
            row = np.repeat(np.arange(len(batch)), sizes)
            ok[row[~np.isfinite(x)]] = False
            with np.errstate(over="ignore", invalid="ignore"):
                v = np.clip(np.floor(x * SCALE), -LIMIT, LIMIT)
            keep = ok[row]
            offsets = np.concatenate(([0], np.cumsum(sizes[ok]))).astype(np.int32)
            which = pa.array(ok)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").filter(which), batch.column("label").filter(which),
                                              pa.ListArray.from_arrays(pa.array(offsets), pa.array(v[keep].astype(np.int32)))],
                                             ["vec_id", "label", "v"])

    rows = ensure_columns(df, {"vec_id": "long", "label": "string", "embedding": "array<double>"})
    return map_arrow(rows, run, "vec_id long, label string, v array<int>")


def matrix(lists: pa.Array, dim: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), dim)


def cuts(dim: int, parts: int) -> list[int]:
    """Where the parts begin, and the end of the last."""
    size, more = divmod(dim, parts)
    return [k * size + min(k, more) for k in range(parts + 1)]


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry (ties: the lower) and the squared distance, both exact."""
    to, dist = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    if not x.shape[1]:
        return to, dist
    peak = max(int(np.abs(x).max(initial=0)), int(np.abs(book).max(initial=0)))
    exact = 4 * x.shape[1] * peak * peak < 1 << 53  # doubles hold every sum
    step = 4096 if exact else max(1, (1 << 20) // book.size)
    b = book.astype(np.float64)
    norms = (b * b).sum(1)
    for lo in range(0, len(x), step):
        part = x[lo:lo + step]
        if exact:
            p = part.astype(np.float64)
            d = (p * p).sum(1)[:, None] - 2 * (p @ b.T) + norms
        else:
            d = ((part.astype(np.int64)[:, None, :] - book.astype(np.int64)) ** 2).sum(2)
        to[lo:lo + step] = at = d.argmin(1)
        dist[lo:lo + step] = d[np.arange(len(at)), at]
    return to, dist


def owner(key: tuple[int, int, int]) -> int:
    """The partition (modulo their number) where the members of (position, entry, salt) live."""
    h = (key[0] * ENTRIES + key[1] + 1) * 0x9E3779B97F4A7C15 + (key[2] + 1) * 0xC2B2AE3D27D4EB4F
    h = (h ^ (h >> 29)) * 0xBF58476D1CE4E5B9 & (1 << 64) - 1
    return h ^ (h >> 32)


def pack(pos: int, entry: np.ndarray, salt: np.ndarray, rows: np.ndarray) -> Iterator[tuple[tuple[int, int, int], bytes]]:
    """The members as records ((position, entry, salt), components one member after another)."""
    if not len(rows):
        return
    order = np.lexsort((salt, entry))
    entry, salt, rows = entry[order], salt[order], rows[order]
    most = max(1, BLOCK_BYTES // max(1, rows.itemsize * rows.shape[1]))
    starts = np.flatnonzero(np.concatenate(([True], (np.diff(entry) != 0) | (np.diff(salt) != 0))))
    for lo, hi in zip(starts, [*starts[1:], len(rows)]):
        for a in range(lo, hi, most):
            yield (pos, int(entry[lo]), int(salt[lo])), rows[a:min(hi, a + most)].tobytes()


def together(records: Iterator, edges: list[int], dtype: np.dtype) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """The members of many records at once: (position, their entries, their salts, their components), about
    ``CHUNK`` members at a time, so array work doesn't depend on how small the records are."""
    held: dict[int, list] = {}
    count = 0

    def hand_on() -> Iterator:
        for pos, own in held.items():
            x = np.frombuffer(b"".join(d for *_, d in own), dtype).reshape(-1, edges[pos + 1] - edges[pos])
            sizes = np.array([len(d) for *_, d in own]) // (dtype.itemsize * x.shape[1])
            yield pos, np.repeat([e for e, *_ in own], sizes), np.repeat([s for _, s, _ in own], sizes), x
        held.clear()

    for (pos, entry, salt), data in records:
        held.setdefault(pos, []).append((entry, salt, data))
        count += len(data) // (dtype.itemsize * (edges[pos + 1] - edges[pos]))
        if count >= CHUNK:
            yield from hand_on()
            count = 0
    yield from hand_on()


class Lloyd:
    """Codebooks of ``parts`` positions, learned from all rows of ``vectors`` (vec_id, label, v)."""

    def __init__(self, vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
                 partitions: int | None = None):
        self.spark: SparkSession = vectors.sparkSession
        self.parts, self.entries, self.rounds = parts, min(entries, ENTRIES), rounds
        sizes = vectors.groupBy(F.size("v").alias("n")).agg(
            F.count(F.lit(1)).alias("rows"), F.max(F.array_max(F.transform("v", lambda x: F.abs(x)))).alias("peak"))
        # one row: the most frequent length
        top = sizes.where(F.col("n") >= parts).orderBy(F.desc("rows"), F.desc("n")).limit(1).collect()
        self.dim, self.rows, self.peak = (top[0]["n"], top[0]["rows"], top[0]["peak"]) if top else (0, 0, 0)
        self.kept = vectors.where(F.size("v") == self.dim)
        self.cuts = cuts(self.dim, parts)
        self.dtype = np.dtype("<i2" if self.peak < 1 << 15 else "<i4")
        size = self.rows * self.dim * self.dtype.itemsize
        self.partitions = partitions or max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-size // MEMBER_BYTES))
        self.moved: list[int] = []
        self.books: list[np.ndarray] = []

    def fit(self) -> list[np.ndarray]:
        first = self.kept.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(self.entries).select("v").collect()
        start = np.array([r["v"] for r in first], np.int64).reshape(len(first), self.dim)
        self.books = [start[:, a:b].copy() for a, b in zip(self.cuts, self.cuts[1:])]
        if not len(first):
            return self.books
        ship(self.spark)
        if self.spark.sparkContext.getCheckpointDir() is None:
            self.spark.sparkContext.setCheckpointDir(shared_dir(self.spark, "members"))
        home = self.settle()
        for k in range(self.rounds):
            before, assigned = home, None
            if k:
                home, assigned, moved = self.migrate(home)
            self.update(home)  # the first job on these members, which also checkpoints them
            home.unpersist()
            if assigned is not None:
                assigned.unpersist()
                self.moved.append(moved.value)
                self.forget(before)
        if self.rounds:
            self.forget(home)
        return self.books

    def forget(self, members: RDD) -> None:
        """Deletes the checkpoint of members that a later round has replaced."""
        at = members.getCheckpointFile()
        if at:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(at)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def keep(self, members: RDD) -> RDD:
        """Members that the next job computes, keeps on the executors' disks and checkpoints from there."""
        members.persist(StorageLevel.DISK_ONLY)
        members.checkpoint()
        return members

    def settle(self) -> RDD:
        """The only shuffle of all members: each to the owner of its first entry."""
        salts, edges, dim, dtype = max(1, self.partitions // 4), self.cuts, self.dim, self.dtype
        books = self.spark.sparkContext.broadcast(self.books)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = TaskContext.get().partitionId() % salts  # the members of a scan task share a salt
            held, count = [], 0

            def records(x: np.ndarray) -> pa.RecordBatch:
                salt = np.full(len(x), own)
                out = [r for p, (a, b) in enumerate(zip(edges, edges[1:]))
                       for r in pack(p, nearest(x[:, a:b], books.value[p])[0], salt, x[:, a:b].astype(dtype))]
                return pa.RecordBatch.from_arrays(
                    [pa.array([r[0][k] for r in out], pa.int32()) for k in range(3)] + [pa.array([r[1] for r in out], pa.binary())],
                    ["pos", "entry", "salt", "data"])

            for batch in batches:
                held.append(matrix(batch.column("v"), dim))
                count += len(batch)
                if count >= CHUNK:
                    yield records(np.concatenate(held))
                    held, count = [], 0
            if count:
                yield records(np.concatenate(held))

        rows = map_arrow(self.kept.select("v"), run, "pos int, entry int, salt int, data binary")
        members = rows.rdd.map(lambda r: ((r[0], r[1], r[2]), bytes(r[3])), preservesPartitioning=True)
        return self.keep(members.partitionBy(self.partitions, owner))

    def migrate(self, home: RDD) -> tuple[RDD, RDD, Accumulator]:
        """Assigns the resident members; those of another entry now move to its owner, the others stay.
        Returns the members at their homes, the assigned ones (kept until a job has run) and how many moved."""
        edges, dtype = self.cuts, self.dtype
        books = self.spark.sparkContext.broadcast(self.books)
        moved = self.spark.sparkContext.accumulator(0)

        def assign(records: Iterator) -> Iterator:
            for pos, entry, salt, x in together(records, edges, dtype):
                to, _ = nearest(x, books.value[pos])
                stay = to == entry
                moved.add(int((~stay).sum()))
                for record in pack(pos, entry[stay], salt[stay], x[stay]):
                    yield True, record
                for record in pack(pos, to[~stay], salt[~stay], x[~stay]):
                    yield False, record

        done = home.mapPartitions(assign, preservesPartitioning=True).persist(StorageLevel.DISK_ONLY)
        stayers = done.filter(lambda r: r[0]).map(lambda r: r[1], preservesPartitioning=True)
        movers = done.filter(lambda r: not r[0]).map(lambda r: r[1]).partitionBy(self.partitions, owner)
        return self.keep(stayers.union(movers)), done, moved

    def update(self, home: RDD) -> None:
        """Every entry becomes the floor of its members' mean; an entry without members stays."""
        edges, dtype = self.cuts, self.dtype

        def sums(records: Iterator) -> Iterator:
            total: dict = {}
            for pos, entry, _, x in together(records, edges, dtype):
                order = np.argsort(entry, kind="stable")
                entry = entry[order]
                first = np.flatnonzero(np.concatenate(([True], entry[1:] != entry[:-1])))
                added = np.add.reduceat(x[order].astype(np.int64), first, axis=0)
                for e, n, s in zip(entry[first].tolist(), np.diff(np.append(first, len(entry))).tolist(), added):
                    have = total.get((pos, e), (0, 0))
                    total[pos, e] = have[0] + n, have[1] + s
            return iter(total.items())

        merged = home.mapPartitions(sums).reduceByKey(lambda a, b: (a[0] + b[0], a[1] + b[1]), min(self.partitions, self.parts * self.entries))
        for (pos, entry), (n, s) in merged.collect():  # at most one row per entry
            self.books[pos][entry] = s // n

    def digest(self) -> str:
        """Hash of all entries' components by part, entry and position."""
        text = ",".join(str(x) for book in self.books for x in book.ravel().tolist())
        return hashlib.sha256(text.encode()).hexdigest()

    def encode(self) -> DataFrame:
        """(vec_id, label, code, error) of every kept row, by the codebooks as they are: a pass without shuffle."""
        edges, dim = self.cuts, self.dim
        books = self.spark.sparkContext.broadcast(self.books)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = matrix(batch.column("v"), dim)
                got = [nearest(x[:, a:b], books.value[p]) for p, (a, b) in enumerate(zip(edges, edges[1:]))]
                codes = np.stack([g[0] for g in got], 1).astype(np.uint8).tobytes().hex()
                wide = 2 * len(got)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("label"),
                     pa.array([codes[k:k + wide] for k in range(0, len(codes), wide)], pa.string()), pa.array(sum(g[1] for g in got), pa.int64())],
                    ["vec_id", "label", "code", "error"])

        return map_arrow(self.kept, run, "vec_id long, label string, code string, error long")


def compress(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256): every kept vector's product code, its
    squared quantisation error, the error of all rows of its label, and the digest of the codebooks."""
    model = Lloyd(to_integers(embeddings), parts, entries, rounds)
    model.fit()
    coded = written(model.encode(), "codes")
    total = F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error")
    # both sides are written tables: small sums are broadcast by their size, a hot label is splittable otherwise
    sums = written(coded.groupBy(F.col("label").alias("_label")).agg(total), "label-errors")
    return (coded.join(sums, F.col("label").eqNullSafe(F.col("_label")), "left").drop("_label")
            .withColumn("codebooks_sha256", F.lit(model.digest())))
