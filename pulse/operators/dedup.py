"""Keep-first-per-key, membership filters and first-order flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Per key, the row that is smallest by ``order``, then by all remaining columns
    (a total order, so ties are settled the same way on every run).

    Expressed as ``min(struct(order..., rest...))`` grouped by the keys: the
    aggregate runs partially before the shuffle, so a hot key (one device with a
    third of the rows) sends one row per map partition, never its whole group.
    """
    cols = df.columns
    rest = [c for c in cols if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in list(order) + rest])
    agg = df.groupBy(*keys).agg(F.min(packed).alias("_first"))
    return agg.select(*[F.col(f"_first.{c}").alias(c) if c not in keys else F.col(c)
                        for c in cols])


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Per key, the row that is largest by ``order``, then by all remaining columns: of
    several versions of a record in one batch the last. Partial aggregation as above."""
    cols = df.columns
    rest = [c for c in cols if c not in keys and c not in order]
    agg = df.groupBy(*keys).agg(F.max(F.struct(*list(order) + rest)).alias("_last"))
    return agg.select(*[F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in cols])


def first_per_key_rn(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Same contract as :func:`first_per_key` with ``row_number() = 1`` (cross-check form)."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in list(order) + rest])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


# At most so many keys count as hot, whatever the size of the input: what is broadcast is bounded.
HOT_KEYS = 10_000


def _hot_limit(counts: DataFrame, hot_rows: int) -> Column:
    """Rows above which a key is hot: ``hot_rows``, or total / ``HOT_KEYS`` if that is more, so there
    can't be more than ``HOT_KEYS`` hot keys."""
    return F.greatest(F.lit(hot_rows).cast("bigint"), counts.agg(F.coalesce(F.sum("_n"), F.lit(0)) / HOT_KEYS).scalar().cast("bigint"))


def drop_seen(batch: DataFrame, seen: DataFrame, keys: Sequence[str], hot_rows: int = 1_000_000) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``seen`` (left anti join).

    No broadcast hint: the seen-set grows with the active devices of a day, so the
    planner (and AQE at run time, from the real shuffle sizes) decides whether it is
    small enough to broadcast. A key with more than ``hot_rows`` rows in the batch is spread over
    salts, as many as its own count asks for, and its seen rows are repeated per salt; the list of hot
    keys is bounded (``HOT_KEYS``) and broadcast."""
    keys = list(keys)
    counts = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    limit = _hot_limit(counts, hot_rows)
    salts = F.broadcast(counts.where(F.col("_n") > limit).withColumn("_salts", F.ceil(F.col("_n") / limit)).select(*keys, "_salts"))
    row = F.xxhash64(*[F.col(c).cast("string") for c in batch.columns])
    left = (batch.join(salts, keys, "left")
            .withColumn("_salt", F.pmod(row, F.coalesce("_salts", F.lit(1).cast("bigint")))).drop("_salts"))
    right = (seen.select(*keys).distinct().join(salts, keys, "left")
             .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("_salts", F.lit(1).cast("bigint")) - 1))))
    # one struct as the key: rows that lie together by the plain key are dealt anew
    spot = F.struct(*keys, "_salt").alias("_spot")
    return left.withColumn("_spot", spot).join(right.select(spot), "_spot", "left_anti").select(*batch.columns)


# Bits of a seen-set bitmap: 8 MB at most, whatever the number of keys.
SEEN_BITS = 1 << 26


def seen_bits(rows: DataFrame, keys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, bucket, bits): a bitmap of the hashes of the keys of ``rows`` (one for each ``by``);
    several are merged by or."""
    k = F.pmod(F.xxhash64(*keys), F.lit(SEEN_BITS))
    return rows.select(*by, k.alias("_k")).groupBy(*by, F.bitmap_bucket_number("_k").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_k")).alias("bits"))


def merged_bits(bits: DataFrame) -> DataFrame:
    """The bitmaps of several batches as one: ``SEEN_BITS`` bits at most."""
    return bits.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def maybe_seen(batch: DataFrame, bits: DataFrame, keys: Sequence[str], flag: str = "_maybe") -> DataFrame:
    """``batch`` with ``flag``: false for keys that are surely not among those of ``bits`` (merged;
    bounded, so broadcast)."""
    k = F.pmod(F.xxhash64(*keys), F.lit(SEEN_BITS))
    marked = batch.withColumn("_k", k).join(F.broadcast(bits.select(F.col("bucket").alias("_bucket"), F.col("bits").alias("_bits"))),
                                            F.bitmap_bucket_number("_k") == F.col("_bucket"), "left")
    at = F.bitmap_bit_position("_k")
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.pmod(F.floor(byte / F.pow(F.lit(2), F.pmod(at, F.lit(8)))), F.lit(2)) == 1
    return marked.withColumn(flag, F.coalesce(hit, F.lit(False))).drop("_k", "_bucket", "_bits")


def drop_marked(marked: DataFrame, seen: DataFrame, keys: Sequence[str], flag: str = "_maybe") -> DataFrame:
    """The rows of :func:`maybe_seen` (a row per key) whose key is not in ``seen``: only rows that the bitmap
    can't clear are compared exactly, and of ``seen`` only their keys (the smaller side is broadcast by its size)."""
    doubtful = marked.where(flag).drop(flag)
    own = seen.select(*keys).join(doubtful.select(*keys), list(keys), "left_semi")
    return marked.where(~F.col(flag)).drop(flag).unionByName(doubtful.join(own, list(keys), "left_anti"))


def flag_first(orders: DataFrame, user: str = "user_id",
               order: Sequence[str | Column] = ("create_time", "id"),
               known_users: DataFrame | None = None, flag: str = "is_first_order",
               hot_rows: int = 1_000_000, id_col: str = "id", unique: bool = False, new: str | None = None) -> DataFrame:
    """``flag`` = "1" on a user's earliest order (by ``order``), "0" on the others. Orders without a
    user are "0". ``known_users`` (``user`` and, optionally, ``first_id``): users who have ordered
    before; only their order ``first_id``, delivered again, is "1".

    One partial aggregate per user gives the earliest order and the user's row count;
    it is joined back to the orders on (user, salt). Users with more than
    ``hot_rows`` orders are hot: their orders get a salt from a hash of the order's own sort key and their
    aggregate row is repeated per salt, ceil(count / hot_rows) times, so no join task gets more than
    about ``hot_rows`` orders of one user, whatever that user's count. Every
    other user keeps salt 0 and a single aggregate row. Only the list of hot users is broadcast, at most
    ``HOT_KEYS`` of them.

    ``unique``: no two orders share an id. The first orders are then joined back on (user, id), of which every order has
    its own: no user is hot, nothing is counted or salted. ``new``: a column that is true for the first order of
    a user who is not among ``known_users``.
    """
    key = F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(f"_o{i}")
                     for i, c in enumerate(order)])
    stats = (orders.where(F.col(user).isNotNull()).groupBy(user)
             .agg(F.min(F.struct(key.alias("k"), F.col(id_col).alias("i"))).alias("_m"), F.count(F.lit(1)).alias("_n"))
             .select(user, F.col("_m.k").alias("_first"), F.col("_m.i").alias("_first_id"), "_n"))
    counts = stats
    if known_users is not None:
        first_id = F.col("first_id") if "first_id" in known_users.columns else F.lit(None).cast(orders.schema[id_col].dataType)
        known = known_users.groupBy(user).agg(F.min(first_id).alias("_known"), F.lit(True).alias("_seen"))
        stats = (stats.join(known, user, "left").withColumn("_first", F.when(F.col("_seen").isNull(), F.col("_first")))
                 .withColumn("_first_id", F.when(F.col("_seen"), F.col("_known")).otherwise(F.col("_first_id"))))
    is_first = F.coalesce((F.col(id_col) == F.col("_first_id")) & (F.col("_first").isNull() | (key == F.col("_first"))), F.lit(False))
    found = [F.when(is_first, F.lit("1")).otherwise(F.lit("0")).alias(flag)]
    if new is not None:  # a known user's first order has no sort key here
        found.append((is_first & F.col("_first").isNotNull()).alias(new))
    if unique:
        firsts = stats.select(F.struct(user, F.col("_first_id").alias(id_col)).alias("_spot"), "_first", "_first_id")
        return orders.withColumn("_spot", F.struct(user, id_col)).join(firsts, "_spot", "left").select(*orders.columns, *found)
    limit = _hot_limit(counts, hot_rows)
    hot = F.broadcast(counts.where(F.col("_n") > limit).select(user, F.ceil(F.col("_n") / limit).alias("_salts")))
    one = F.lit(1).cast("bigint")
    spread = stats.withColumn("_salt", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.when(F.col("_n") > limit, F.ceil(F.col("_n") / limit)).otherwise(one) - 1)))
    salted = (orders.join(hot, user, "left")
              .withColumn("_salt", F.pmod(F.xxhash64(key), F.coalesce("_salts", one))))
    # one struct as the key: rows that lie together by the user are dealt anew
    firsts = spread.select(F.struct(user, "_salt").alias("_spot"), "_first", "_first_id")
    joined = salted.withColumn("_spot", F.struct(user, "_salt")).join(firsts, "_spot", "left")
    return joined.select(*orders.columns, *found)


def numeric_id(col: str = "id") -> list[Column]:
    """Order by an id that is a number in a string: numerically, then as text."""
    return [F.col(col).try_cast("bigint"), F.col(col)]
