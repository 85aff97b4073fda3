"""Topic and change-feed sources and sinks.

A topic is a stream of JSON strings in a ``value`` column. With the Kafka connector
on the classpath the same functions read/write Kafka (``fmt="kafka"``); without it a topic is a log in a
folder (``fmt="log"``, see ``topic_log``: offsets per partition, bounded batches, commits per epoch), or just
a folder of JSON-lines / Parquet files, one sub-folder per topic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulse.sources import topic_log

LINE_SCHEMA = T.StructType([T.StructField("key", T.StringType()),
                            T.StructField("value", T.StringType())])


def read_topic(spark: SparkSession, topic: str, fmt: str = "kafka", path: str | None = None,
               options: dict | None = None, max_per_trigger: int | None = None,
               min_partitions: int | None = None, schema: T.StructType | str | None = None) -> DataFrame:
    """Streaming DataFrame with ``key``/``value`` strings (and ``timestamp`` from Kafka).

    ``fmt="kafka"``: subscribes to ``topic``, starting at the latest offsets unless
    ``options`` say otherwise; ``max_per_trigger`` bounds a micro-batch
    (``maxOffsetsPerTrigger``); ``min_partitions`` splits the topic's partitions into
    at least that many tasks, so a topic with few partitions still spreads over the
    executors. ``fmt="log"``: the same offsets and bound (in messages) on a topic log; ``options`` are those of the
    ``topic_log`` source. File formats (``parquet``/``json``) read ``path/topic=<topic>`` with a
    fixed schema; the bound is ``maxFilesPerTrigger``.
    """
    opts = dict(options or {})
    if fmt == "kafka":
        opts.setdefault("subscribe", topic)
        opts.setdefault("startingOffsets", "latest")
        if max_per_trigger:
            opts.setdefault("maxOffsetsPerTrigger", str(max_per_trigger))
        if min_partitions:
            opts.setdefault("minPartitions", str(min_partitions))
        raw = spark.readStream.format("kafka").options(**opts).load()
        return raw.select(F.col("key").cast("string").alias("key"),
                          F.col("value").cast("string").alias("value"), "timestamp")
    if path is None:
        raise ValueError("file topics need a path")
    if fmt == "log":
        topic_log.register(spark)
        if max_per_trigger:
            opts.setdefault("maxMessages", str(max_per_trigger))
        if min_partitions:
            opts.setdefault("messagesPerTask", str(max(1, (max_per_trigger or 100_000) // min_partitions)))
        raw = spark.readStream.format("topic_log").options(**opts).load(f"{path.rstrip('/')}/topic={topic}")
        return raw.select("key", "value", "timestamp")
    if max_per_trigger:
        opts.setdefault("maxFilesPerTrigger", str(max_per_trigger))
    reader = spark.readStream.format(fmt).options(**opts)
    if fmt != "text":
        reader = reader.schema(schema or LINE_SCHEMA)
    return reader.load(f"{path.rstrip('/')}/topic={topic}")


def read_changes(spark: SparkSession, topic: str = "changes", fmt: str = "kafka",
                 path: str | None = None, options: dict | None = None,
                 max_per_trigger: int | None = 100) -> DataFrame:
    """Change-feed envelopes as JSON lines; see ``operators.ingest.parse_changes``.
    ``max_per_trigger`` bounds a micro-batch like the fetch size of a change client
    (messages of Kafka and of a topic log, files of a file topic)."""
    return read_topic(spark, topic, fmt, path, options, max_per_trigger)


def write_topic(df: DataFrame, topic: str | None = None, fmt: str = "kafka", path: str | None = None,
                options: dict | None = None, extra: tuple[str, ...] = (), epoch: int | None = None) -> None:
    """Append a batch's ``value`` (and ``key``) strings to a topic.

    With ``topic=None`` the frame's own ``topic`` column routes each row (one write
    for every topic). File topics land under ``path/topic=<t>/`` and may carry
    ``extra`` columns (such as an arrival time, which Kafka keeps as the record
    timestamp). ``fmt="log"`` appends to topic logs; with ``epoch`` (the batch id of a stream) a batch that is
    written again changes nothing."""
    cols = [c for c in ("key", "value", "topic") if c in df.columns]
    if fmt == "log":
        cols += ["timestamp"] if "timestamp" in df.columns else []
    elif fmt != "kafka":
        cols += [c for c in extra if c in df.columns]
    out = df.select(*cols)
    if topic is not None:
        out = out.withColumn("topic", F.lit(topic))
    if fmt == "kafka":
        out.write.format("kafka").options(**(options or {})).save()
        return
    if path is None:
        raise ValueError("file topics need a path")
    if fmt == "log":
        topic_log.register(df.sparkSession)
        opts = dict(options or {}) | ({} if epoch is None else {"epoch": str(epoch)})
        out.write.format("topic_log").mode("append").options(**opts).save(path)
        return
    out.write.mode("append").partitionBy("topic").format(fmt).save(path)


def record_json(df: DataFrame, key: str | None = None) -> DataFrame:
    """Each row as one JSON object string (``value``), nulls omitted."""
    cols = [F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value")]
    if key:
        cols.insert(0, F.col(key).cast("string").alias("key"))
    return df.select(*cols)
