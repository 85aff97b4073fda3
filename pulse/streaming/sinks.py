"""Replay-safe keyed upserts into date-partitioned Parquet tables.

Layout: ``<table>/<day column>=<day>/batch=<id>/part-*.parquet``. A micro-batch
writes only its own ``batch=<id>`` folders with dynamic partition overwrite. Two kinds of tables:

* first write wins (devices of a day): what is new is decided by an anti join against the *other*
  batches of the same days;
* last write wins (orders): every batch stores its version of a record, and readers take the version of the
  latest batch (``read_latest``); ``batch=compact`` is older than any numbered batch. A record that moves to another
  day leaves a row with ``_gone`` in the old one, so a day is read without the others;
* totals: every batch stores what it adds to a (day, ...) total, or takes from it; readers sum a day's rows
  (``read_totals``).

Re-running a batch (after a failure between the write and the checkpoint commit)
therefore rewrites identical folders: the table does not change.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

BATCH_COL = "batch"
GONE = "_gone"  # of a record that has moved to another day
NO_DAY = "__HIVE_DEFAULT_PARTITION__"  # folder of the rows without a day


# What a table that nothing was written to yet raises; anything else is an error.
_NOT_WRITTEN = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _exists(spark: SparkSession, pattern: str) -> bool:
    """Whether a path, or any path of a glob, exists."""
    p = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p))


def _or_none(spark: SparkSession, pattern: str, base: str | None = None) -> DataFrame | None:
    """The Parquet files of a path or glob, or None if nothing was written yet."""
    if not _exists(spark, pattern):
        return None
    try:
        reader = spark.read if base is None else spark.read.option("basePath", base)
        return reader.parquet(pattern)
    except AnalysisException as e:
        if e.getCondition() in _NOT_WRITTEN:
            return None
        raise


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None before its first write."""
    return _or_none(spark, path)


def batch_days(df: DataFrame, day_col: str) -> list[str]:
    """Distinct days of one micro-batch (a handful of values, used as a partition filter)."""
    return sorted(r[0] for r in df.select(day_col).distinct().collect() if r[0] is not None)


def read_days(spark: SparkSession, path: str, day_col: str, days: Sequence[str]) -> DataFrame | None:
    """Only the folders of ``days``: a path glob, so the rest of the table is not even
    listed (the table keeps ``day_col`` and ``batch`` as columns via ``basePath``)."""
    if not days:
        return None
    pattern = f"{path.rstrip('/')}/{day_col}={{{','.join(days)}}}"
    return _or_none(spark, pattern, path)


def read_batch(spark: SparkSession, path: str, day_col: str, days: Sequence[str], batch_id: int, schema) -> DataFrame | None:
    """What batch ``batch_id``, whose rows are of ``days`` or have none, has stored, or None; only its own folders are listed."""
    pattern = f"{path.rstrip('/')}/{day_col}={{{','.join([*days, NO_DAY])}}}/{BATCH_COL}={batch_id}"
    if not _exists(spark, pattern):
        return None
    return spark.read.schema(schema).option("basePath", path).parquet(pattern).select(*schema.names)


def seen_keys(spark: SparkSession, path: str, keys: Sequence[str], day_col: str,
              days: Sequence[str], batch_id: int) -> DataFrame | None:
    """Keys already stored for ``days`` by batches other than ``batch_id``.

    Only those days' folders are listed and read, and only the key columns of their
    files; the batch predicate is a partition filter."""
    table = read_days(spark, path, day_col, days)
    if table is None:
        return None
    return table.where(F.col(BATCH_COL) != F.lit(str(batch_id))).select(*keys)


def write_batch(df: DataFrame, path: str, parts: str | Sequence[str] | None, batch_id: int,
                fmt: str = "parquet") -> None:
    """Write one batch's rows under ``[<parts>/]batch=<id>`` with dynamic partition
    overwrite: a re-run of the batch replaces exactly its own folders."""
    cols = [] if parts is None else ([parts] if isinstance(parts, str) else list(parts))
    (df.withColumn(BATCH_COL, F.lit(str(batch_id)))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*cols, BATCH_COL).format(fmt).save(path))


def together(df: DataFrame, col: str) -> DataFrame:
    """``df`` dealt by ``col``, so a batch writes a file or a few for each of its values instead of one for each value and
    task. Adaptive execution splits large values and joins small ones; without it ``df`` is left as it lies."""
    return df.hint("rebalance", F.col(col)) if df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true" else df


def latest(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key the row of the latest batch (a partial aggregate, safe for hot keys), without ``batch``.
    A table without batches has one row per key already. Rows that are gone are left out."""
    if BATCH_COL not in table.columns:
        return table
    cols = [c for c in table.columns if c not in (BATCH_COL, GONE)]
    rest = [c for c in table.columns if c not in keys and c != BATCH_COL]
    agg = table.groupBy(*keys).agg(F.max(F.struct(version().alias("_version"), *rest)).alias("_last"))
    if GONE in table.columns:
        agg = agg.where(~F.coalesce(F.col(f"_last.{GONE}"), F.lit(False)))
    return agg.select(*[F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in cols])


def version() -> Column:
    """The batch as a number; compacted rows are older than any batch."""
    return F.coalesce(F.col(BATCH_COL).try_cast("bigint"), F.lit(-1).cast("bigint"))


def read_latest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame | None:
    """A last-write-wins table: one row per key. A day column among ``keys`` can be filtered before
    the versions are compared: the predicate reaches the scan."""
    t = read_or_none(spark, path)
    return None if t is None else latest(t, keys)


def read_totals(spark: SparkSession, path: str, keys: Sequence[str], values: Sequence[str]) -> DataFrame | None:
    """The sums of ``values`` by ``keys`` over what the batches have added: a row per batch and key is
    read, whatever the number of records; a filter on a day among the keys prunes the scan."""
    t = read_or_none(spark, path)
    return None if t is None else t.groupBy(*keys).agg(*[F.sum(v).cast(t.schema[v].dataType).alias(v) for v in values])


def read_result(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored rows without the bookkeeping ``batch`` column."""
    t = read_or_none(spark, path)
    return None if t is None else t.drop(BATCH_COL)


def _delete(spark: SparkSession, path: str) -> None:
    """Removes a folder through Spark's own file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def compact_days(spark: SparkSession, path: str, day_col: str, days: Sequence[str],
                 keys: Sequence[str] | None = None) -> int:
    """Rewrite ``days`` from their many ``batch=<id>`` folders into ``batch=compact``; returns
    the number of rows. ``keys``: a last-write-wins table, of which the latest versions stay.

    For finished days only (older than anything a running job can still replay). The rows are
    staged next to the table (``<table>_staging``), on the same shared storage, and counted; only if
    all are there, one ``INSERT OVERWRITE`` of each day replaces its folders. The staging stays until
    the last day is done, so a failure in between loses nothing, and is deleted then."""
    import uuid
    current = read_days(spark, path, day_col, days)
    if current is None:
        return 0
    rows = current.drop(BATCH_COL) if keys is None else latest(current, list(dict.fromkeys([*keys, day_col])))
    rows = rows.select(*[F.lit(False).alias(c) if c == GONE and keys is not None else c for c in current.columns if c != BATCH_COL])
    staging = f"{path.rstrip('/')}_staging/{uuid.uuid4().hex[:12]}"
    expected = Observation("compact")
    rows.observe(expected, F.count(F.lit(1)).alias("n")).write.partitionBy(day_col).parquet(staging)
    schema = rows.schema
    staged = spark.read.schema(schema).parquet(staging)
    number = staged.count()
    if number != expected.get["n"]:
        raise RuntimeError(f"compaction of {path}: staged {number} of {expected.get['n']} rows")
    for day in days:
        part = staged.where(F.col(day_col) == day).drop(day_col)
        # static overwrite of the day's folder: every batch of the day is replaced
        part.withColumn(BATCH_COL, F.lit("compact")).write.mode("overwrite").option(
            "partitionOverwriteMode", "static").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").partitionBy(BATCH_COL).parquet(f"{path.rstrip('/')}/{day_col}={day}")
    _delete(spark, staging)
    return number


def compact_finished(spark: SparkSession, path: str, day_col: str, newest_open_day: str,
                     keys: Sequence[str] | None = None) -> list[str]:
    """Compact all days before ``newest_open_day`` that still have numbered batch folders,
    however far back; returns them. Only such folders are listed and read (a glob)."""
    pattern = f"{path.rstrip('/')}/{day_col}=*/{BATCH_COL}=[0-9]*"
    current = _or_none(spark, pattern, path)
    if current is None:
        return []
    open_days = sorted(r[0] for r in current.where(F.col(day_col) < F.lit(newest_open_day)).select(day_col).distinct().collect())
    if open_days:
        compact_days(spark, path, day_col, open_days, keys)
    return open_days
