"""Joins that hold when one key owns a large share of the rows."""

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
HOT_KEYS, HOT_TRACKED = 10_000, 100_000
NULL_PARTS = 4096


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the optimiser's own size estimate of a table is within spark.sql.autoBroadcastJoinThreshold.

    False where the estimate cannot be read (a remote session), which is the safe answer.
    """
    if not hasattr(df, "_jdf"):
        return False
    limit_bytes = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return limit_bytes >= 0 and size <= limit_bytes


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int) -> DataFrame:
    """(_key_hash, _rows): keys with more than ``hot_rows`` rows, as hashes, from a sketch of the most frequent ones.

    Each task keeps a bounded sketch and only sketches travel. At most ``HOT_KEYS`` keys come back, which bounds what is
    broadcast; a key counts up to rows / ``HOT_TRACKED`` too many.
    """
    hashes = df.select(F.xxhash64(*keys).alias("_hash"))
    top = hashes.agg(F.expr(f"approx_top_k(_hash, {HOT_KEYS}, {HOT_TRACKED})").alias("_top")).select(F.expr("inline(_top)"))
    return top.where(F.col("count") > hot_rows).select(F.col("item").alias("_key_hash"), F.col("count").alias("_rows"))


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    on: str | list[str],
    salt_by: str | list[str],
    how: str = "left",
    hot_rows: int = HOT_ROWS,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Join ``big`` to ``small``, which has at most one row per key, with no task bound to one hot key.

    When the estimate says ``small`` fits a broadcast, this is a plain join and Spark broadcasts it. So it is without
    ``keys_from``; adaptive execution then splits a skewed partition of ``big``. ``keys_from`` names a cheap base table
    with the keys of ``big``, for keys too hot to be left to that: those with more than ``hot_rows`` rows in it are cut
    into parts by a hash of ``salt_by`` (stable columns, so a recomputed task sends its rows to the same part), and their
    lookup row is copied once per part. ``big`` itself is read once. Rows without a key match nothing and are spread too.

    Hot keys are found by a sketch of the most frequent hashes, built in the scan of ``keys_from`` without shuffling keys
    (``hot_keys``). It may overstate a count, which only cuts a key into more parts, and a key that shares a hot key's hash
    is cut up as well, on both sides alike; results never depend on it.
    """
    keys = [on] if isinstance(on, str) else list(on)
    salts = [salt_by] if isinstance(salt_by, str) else list(salt_by)
    if how not in ("left", "inner"):
        raise ValueError(f"lookup_join supports left and inner, not {how!r}")
    if keys_from is None or fits_broadcast(small):
        return big.join(small, keys, how)
    key_hash = F.xxhash64(*keys).alias("_key_hash")
    hot = hot_keys(keys_from, keys, hot_rows).select("_key_hash", F.ceil(F.col("_rows") / F.lit(hot_rows)).cast("int").alias("_salt_parts"))
    parts = F.coalesce(F.col("_salt_parts"), F.lit(1))
    no_key = reduce(or_, [F.col(k).isNull() for k in keys])
    choices = F.when(no_key, F.lit(NULL_PARTS)).otherwise(parts)
    left = big.withColumn("_key_hash", key_hash).join(F.broadcast(hot), "_key_hash", "left").withColumn(
        "_salt", F.pmod(F.xxhash64(*[F.col(s) for s in salts]), choices.cast("bigint")).cast("int")
    )
    right = small.withColumn("_key_hash", key_hash).join(F.broadcast(hot), "_key_hash", "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), parts - 1))
    )
    gone = ["_salt_parts", "_key_hash"]
    return left.drop(*gone).join(right.drop(*gone), [*keys, "_salt"], how).drop("_salt")


def spread(scan: DataFrame, key: str) -> DataFrame:
    """Give a bare scan at least one task per core.

    A small table in one row group is one scan task, however dear the work behind it. A scan that already has as many
    splits as there are cores, as any large one has, is returned unchanged.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores, key)
