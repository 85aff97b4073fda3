"""A key holding a third of all rows: results stay exact and the plan splits it."""

from contextlib import contextmanager

from pyspark.sql import functions as F

from pulse.operators import dedup

FORCE_SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.shuffle.partitions": "8",
}


@contextmanager
def conf(spark, settings):
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def hot_orders(spark, n=30_000):
    ids = spark.range(n)
    user = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 997).cast("string"))
    return ids.select(F.col("id").cast("string").alias("id"), user.alias("user_id"),
                      F.format_string("2024-01-%02d 10:00:00", (F.col("id") % 28 + 1).cast("int")).alias("create_time"))


def test_flag_first_with_hot_user_is_exact_and_skew_split(spark):
    with conf(spark, FORCE_SKEW):
        out = dedup.flag_first(hot_orders(spark), "user_id", ["create_time", *dedup.numeric_id("id")],
                               hot_rows=1_000)
        stats = out.groupBy("user_id").agg(F.sum(F.col("is_first_order").cast("int")).alias("firsts"),
                                           F.count(F.lit(1)).alias("n"))
        rows = {r.user_id: (r.firsts, r.n) for r in stats.collect()}
        # The hot user's rows reach the join in many partitions (one per salt).
        per_part = (dedup.flag_first(hot_orders(spark), "user_id", ["create_time", *dedup.numeric_id("id")],
                                     hot_rows=1_000)
                    .where(F.col("user_id") == "hot").withColumn("p", F.spark_partition_id())
                    .groupBy("p").count().collect())
    assert rows["hot"] == (1, 10_000)
    assert all(f == 1 for f, _ in rows.values())
    first_hot = out.where((F.col("user_id") == "hot") & (F.col("is_first_order") == "1")).first()
    assert first_hot.id == "0"
    assert len(per_part) >= 4 and max(r["count"] for r in per_part) < 10_000


def test_first_per_key_with_hot_device_is_exact(spark):
    n = 30_000
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 500).cast("string")).alias("mid"),
        F.lit("2024-01-15").alias("logDate"), (F.lit(10_000_000) - F.col("id")).alias("ts"))
    with conf(spark, FORCE_SKEW):
        got = dedup.first_per_key(rows, ["mid", "logDate"], ["ts"])
        hot = got.where(F.col("mid") == "hot").first()
        total = got.count()
    assert hot.ts == 10_000_000 - (n - 1 - (n - 1) % 3)
    assert total == 501


def test_drop_seen_with_hot_device_is_exact_and_spread(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 500).cast("string")).alias("mid"),
        F.lit("2024-01-15").alias("logDate"), F.col("id").alias("ts"))
    seen = spark.range(250).select((F.col("id") * 2).cast("string").alias("mid"), F.lit("2024-01-15").alias("logDate"))
    keys = ["mid", "logDate"]
    with conf(spark, FORCE_SKEW):
        out = dedup.drop_seen(rows, seen, keys, hot_rows=1_000)
        got = sorted((r.mid, r.ts) for r in out.collect())
        parts = out.where("mid = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    want = sorted((r.mid, r.ts) for r in rows.join(seen, keys, "left_anti").collect())
    assert got == want and sum(m == "hot" for m, _ in got) == 10_000
    assert len(parts) >= 4
    everything = seen.unionByName(spark.createDataFrame([("hot", "2024-01-15")], "mid string, logDate string"))
    assert dedup.drop_seen(rows, everything, keys, hot_rows=1_000).where("mid = 'hot'").count() == 0
