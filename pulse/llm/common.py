"""Helpers shared by the corpus operators: the shared folder, written tables, components."""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# White space of the word pattern ``[^\x20\x09-\x0D]+`` (fixed values).
ASCII_SPACE = " \t\n\x0b\x0c\r"


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share.

    Without that setting a folder is used only on a local master (tests), where all
    tasks run on this machine; on any other master it is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        import tempfile
        root = "file://" + tempfile.mkdtemp(prefix="pulse-llm-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"


BATCH_ROWS = 2000
BATCH_BYTES = 4 << 20    # of an Arrow batch on its way to Python
TRIM_BYTES = 8 << 20     # of text after which a task hands freed memory back
# What a bitmap broadcast may hold at most: 8 MB, whatever the size of the tables.
BITMAP_BITS = 1 << 26


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts the lineage, survives lost
    executors, and gives the planner real sizes."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Deletes a table of :func:`written` that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ensure_columns(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """Only the columns an operator reads, cast to the given types; whatever else a table
    carries (also names an operator uses inside) stays out of the plan. The columns must exist."""
    return df.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in schema.items()])


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a long, b long)``: rows (node, component), where
    component is the smallest node reachable. Nodes without an edge do not appear.

    Alternating large-star and small-star rounds (each one groupBy-min and one join on the
    node); ends when a round changes nothing, after a number of rounds that grows with the logarithm of the longest path.
    No component is ever gathered in one place: a row is one edge. The neighbourhoods' minima are written before
    they are joined, so both sides of a join are plain shuffles and Spark can split a node with very many edges. Tables
    of earlier rounds are deleted. An empty table gives no rows."""
    spark = edges.sparkSession
    cur = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .distinct(), "edges")

    def minima(e: DataFrame) -> DataFrame:
        return written(e.groupBy("a").agg(F.min("b").alias("m")), "minima")

    def star(e: DataFrame, large: bool) -> tuple[DataFrame, DataFrame]:
        if large:  # every larger neighbour is tied to the smallest of the neighbourhood
            both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
            low = minima(both)
            own = low.select("a", F.least("a", "m").alias("m"))
            return (both.join(own, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                    .where("a <> b").distinct()), low
        low = minima(e)  # every node and its smaller neighbours
        far = e.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return far.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), low

    def sign(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    last = None
    while (now := sign(cur)) != last:
        last = now
        for large in (True, False):
            edges, low = star(cur, large)
            after = written(edges, "stars")
            dropped(cur)
            dropped(low)
            cur = after
    tops = cur.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return cur.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(tops)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers once per application (``addPyFile``), so that
    they import it as modules and keep their caches from task to task."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    import tempfile
    import zipfile
    from pathlib import Path
    package = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="pulse-py-")) / "pulse_package.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, str(f.relative_to(package.parent)))
    spark.sparkContext.addPyFile(str(target))
    _SHIPPED.add(app)


_WORKER: dict = {}


def worker_state(key, make):
    """What a task needs and later tasks of the same Python worker can use again (a vocabulary, a
    cache). A worker keeps one such thing: the next operator's takes the place of the last one's."""
    if key not in _WORKER:
        release()
        _WORKER[key] = make()
    return _WORKER[key]


def release() -> None:
    """Drops what earlier operators left in this Python worker and hands free memory back."""
    if _WORKER:
        _WORKER.clear()
    trim()


def trim() -> None:
    """Hands freed memory back to the system: allocators would keep it while the worker idles."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # glibc only
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def map_arrow(df: DataFrame, run, schema, state: bool = False) -> DataFrame:
    """``df.mapInArrow`` with this package present on the workers. Without ``state`` (an operator
    that uses :func:`worker_state`) a task first drops what other operators keep there; at its end every
    task hands freed memory back."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not state:
            release()
        yield from run(batches)
        trim()

    spark = df.sparkSession
    ship(spark)
    # whole texts: some MB a batch, in the JVM and in Python
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = spark.conf.get(key, None) or "0"
        if not now.isdecimal() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))
    return df.mapInArrow(task, schema)


def blocks(batches: Iterator[pa.RecordBatch], column: str, size: int = 2 << 20, keep_nulls: bool = False) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with about ``size`` bytes in ``column``: the memory of a
    task follows the size of a block, not the number of rows in an Arrow batch. A larger single
    value is a block of its own. Null values become empty unless ``keep_nulls``. What earlier blocks have
    left free is handed back every ``TRIM_BYTES``."""
    done = 0
    for batch in batches:
        texts = batch.column(column)
        kind = pa.large_binary() if pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type) else pa.large_string()
        texts = texts.cast(kind)
        filled = texts.fill_null(b"" if kind == pa.large_binary() else "")
        batch = batch.set_column(batch.schema.get_field_index(column), column, texts if keep_nulls else filled)
        ends = np.cumsum(pc.binary_length(filled).to_numpy(zero_copy_only=False))
        lo = 0
        while lo < len(batch):
            base = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, base + size, side="right")))
            yield batch.slice(lo, hi - lo)
            done += int(ends[hi - 1] - base)
            if done >= TRIM_BYTES:
                trim()
                done = 0
            lo = hi


def encode_words(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Codes of the words and the distinct words, in order of first appearance."""
    got = words.dictionary_encode()
    return got.indices.to_numpy(zero_copy_only=False).astype(np.int64), got.dictionary


def ragged(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs ``values[s:s + n]`` one after the other."""
    total = int(sizes.sum())
    if not total:
        return values[:0]
    at = np.repeat(starts - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes)
    return values[at + np.arange(total)]


def bitmap(keys: DataFrame) -> DataFrame:
    """Rows (bucket, bits) that say which values of ``k`` may occur: at most ``BITMAP_BITS`` bits."""
    return keys.select(F.pmod("k", F.lit(BITMAP_BITS)).alias("k")).groupBy(F.bitmap_bucket_number("k").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("k")).alias("bits"))


def may_hold(df: DataFrame, bits: DataFrame) -> DataFrame:
    """``df`` with ``_hit``: whether its ``_k`` may be among the keys of ``bits`` (broadcast, bounded by
    ``BITMAP_BITS``)."""
    place = F.pmod("_k", F.lit(BITMAP_BITS))
    own = bits.select(F.col("bucket").alias("_bucket"), F.col("bits").alias("_bits"))
    df = df.withColumn("_p", F.bitmap_bit_position(place))
    df = df.join(F.broadcast(own), F.bitmap_bucket_number(place) == F.col("_bucket"), "left")
    byte = F.conv(F.hex(F.substring("_bits", F.floor(F.col("_p") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.pmod(F.floor(byte / F.pow(F.lit(2), F.pmod("_p", F.lit(8)))), F.lit(2))
    return df.withColumn("_hit", F.coalesce(bit == 1, F.lit(False))).drop("_p", "_bits", "_bucket")


def with_key(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_t``, a hash of the text: (doc_id, _t) names a document also where doc_id is
    null or repeats. Rows equal in both are the same document."""
    return docs.withColumn("_t", F.xxhash64(F.col("text").cast("string")))


def without(docs: DataFrame, gone: DataFrame, single: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` whose (doc_id, _t) is not in ``gone``, and one row only of those in
    ``single``. Rows that the bitmap shows to be in neither are passed on where they are read; only the
    others are shuffled and compared exactly."""
    names = docs.columns
    listed = gone.select("doc_id", "_t") if single is None else gone.select("doc_id", "_t").unionByName(single.select("doc_id", "_t"))
    key = F.xxhash64("doc_id", "_t")
    row = with_key(docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col("doc_id").cast("long").alias("doc_id"), "text")).drop("text")
    marked = may_hold(row.withColumn("_k", key), bitmap(listed.select(key.alias("k"))))
    out = gone.select(F.col("doc_id").alias("_d"), F.col("_t").alias("_u"))
    hit = marked.where("_hit").join(out, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_t") == F.col("_u")), "left_anti")
    if single is not None:
        hit = hit.dropDuplicates(["doc_id", "_t"])
    return hit.select("_row").unionByName(marked.where("not _hit").select("_row")).select("_row.*")
