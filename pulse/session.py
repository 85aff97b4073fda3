"""Session settings.

Only runtime-settable SQL confs are touched by ``configure`` so it can be applied
to a session somebody else built (the cluster's, or a test's).  Cluster sizing
(executors, memory, shuffle partitions for 100 TB) belongs to ``spark-submit``;
the values here are the correctness pins plus adaptive execution.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Settings every query relies on for deterministic, engine-independent results.
_RUNTIME_CONF = {
    # Dates and hours are cut from epoch millis; pin the zone so results do
    # not depend on the machine that runs the driver.
    "spark.sql.session.timeZone": "UTC",
    # Duplicate column names in a change-feed after-image: the last one wins.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # Adaptive execution: coalesce small shuffle partitions, split skewed join
    # partitions (a single device/user may hold a third of the rows), and turn
    # sort-merge joins into broadcast joins when a side turns out small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Partition values of the result tables are day strings and batch ids; keep
    # them strings instead of guessing dates/ints from the folder names.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings above to an existing session."""
    for key, value in _RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def get_session(master: str | None = None, app_name: str = "pulse",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or fetch) a session with the UI off and the runtime pins applied.

    ``master`` is only for local runs and tests; on a cluster leave it to
    ``spark-submit``.
    """
    builder = (SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.sql.execution.arrow.pyspark.enabled", "true")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def _checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster in ``spark.checkpoint.dir``.

    Only on a local master without one (tests) a private folder is created and registered with
    ``setCheckpointDir``, so later calls agree; any other master without one is refused, as each
    executor would write to its own disk."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="pulse-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


def shared_dir(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path below the shared checkpoint folder (new and unused if ``unique``)."""
    root = _checkpoint_root(spark)
    leaf = list(parts)
    if unique:
        leaf.append(uuid.uuid4().hex[:12])
    return "/".join([root, "pulse", *leaf])


def side_by_side(spark: SparkSession, *calls: Callable[[], object]) -> list:
    """The results of ``calls``, which don't need one another and run at the same time, each in a thread that submits
    its own jobs (a small job leaves most cores idle). All are ended when this returns or raises."""
    if len(calls) < 2:
        return [call() for call in calls]
    with ThreadPoolExecutor(len(calls)) as pool:
        return [done.result() for done in [pool.submit(inheritable_thread_target(spark)(call)) for call in calls]]


def sibling(spark: SparkSession) -> SparkSession:
    """A session with settings of its own, to begin with those of ``spark``, for a job beside others that changes some
    while it starts."""
    other = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key) and other.conf.get(key, None) != value:
            other.conf.set(key, value)
    return other
