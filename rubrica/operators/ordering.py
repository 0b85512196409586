"""Global positions, positional splits, seeded shuffles and batches.

A window without a partition would pull every row into one task. Rows are cut into ranges of the order key instead, each
range is numbered by itself, and the running total of the range sizes (one row per range) is added. The range of a row
is a pure function of its key, so the numbers survive the loss of any executor without a checkpoint.
"""

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

SAMPLED_PER_RANGE = 100


def _range_count(df: DataFrame, n_ranges: int | None) -> int:
    """Several ranges per shuffle partition, so that hashing ranges to partitions evens out."""
    return n_ranges or 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _literal(value) -> Column:
    """A literal of a key value; rows (composite keys) field by field."""
    if isinstance(value, Row):
        return F.struct(*[_literal(v).alias(n) for n, v in value.asDict().items()])
    return F.lit(value)


def _range_bounds(df: DataFrame, key: str, n_ranges: int) -> list:
    """Up to ``n_ranges`` - 1 rising bounds from about 100 keys per range, taken by a hash of the key.

    The sample's size does not grow with the table, and it is the same on any partitioning. It only balances the ranges;
    no position depends on it.
    """
    keys = df.select(F.col(key).alias("k"))
    share = int(1e9 * min(1.0, SAMPLED_PER_RANGE * n_ranges / max(1, keys.count())))
    drawn = keys.where(F.pmod(F.xxhash64(F.lit(3), "k"), F.lit(10**9)) < share).where(F.col("k").isNotNull())
    found = [r.k for r in drawn.orderBy("k").collect()]
    picked = [found[len(found) * i // n_ranges] for i in range(1, n_ranges)] if found else []
    return [v for i, v in enumerate(picked) if not i or v != picked[i - 1]]


def _key_range(df: DataFrame, key: str, n_ranges: int) -> Column:
    """The range of a key of any type with an order: bounds are read once, then searched by halving."""
    if n_ranges < 2:
        return F.lit(0)
    bounds = _range_bounds(df, key, n_ranges)
    if not bounds:
        return F.lit(0)
    steps = len(bounds).bit_length()
    table = F.array(*map(_literal, bounds)).cast(f"array<{df.select(key).schema[0].dataType.simpleString()}>")
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))

    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        below = F.col(key) > F.element_at(table, middle + 1)
        return F.when(s["lo"] >= s["hi"], s).otherwise(
            F.struct(
                F.when(below, middle + 1).otherwise(s["lo"]).alias("lo"),
                F.when(below, s["hi"]).otherwise(middle).alias("hi"),
            )
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, halve)["lo"]


def _running_total(df: DataFrame, bucket: Column, order: list[str], weight: Column, name: str) -> DataFrame:
    """Add the total weight of all rows that come before a row. ``bucket`` must rise with ``order``."""
    ranged = df.withColumn("_range", bucket)
    totals = ranged.groupBy("_range").agg(F.sum(weight).alias("_weight"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_range", F.coalesce(F.sum("_weight").over(before), F.lit(0)).alias("_offset"))
    local = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    numbered = ranged.withColumn("_local", F.coalesce(F.sum(weight).over(local), F.lit(0)))
    position = (F.col("_offset") + F.col("_local")).cast("bigint")
    return (
        numbered.join(F.broadcast(offsets), "_range")
        .withColumn(name, position)
        .drop("_range", "_weight", "_offset", "_local")
    )


def with_position(
    df: DataFrame, key: str, name: str = "position", weight: Column | None = None, n_ranges: int | None = None
) -> DataFrame:
    """0-based position by a unique key, or the running total of ``weight`` before each row.

    The key is a column of any type with an order; a composite key is a struct column.
    """
    bucket = _key_range(df, key, _range_count(df, n_ranges))
    return _running_total(df, bucket, [key], F.lit(1) if weight is None else weight, name)


def shuffle_key(seed: str | int, *ids: str) -> Column:
    """A reproducible random sort key; equal on any partitioning."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(i).cast("string") for i in ids]))


def with_shuffled_position(
    df: DataFrame,
    seed: str | int,
    id_col: str,
    name: str = "position",
    weight: Column | None = None,
    n_ranges: int | None = None,
) -> DataFrame:
    """Position (or running weight) in a seeded shuffle. The hash is uniform, so its own prefix is the range."""
    n = _range_count(df, n_ranges)
    keyed = df.withColumn("_hash", shuffle_key(seed, id_col))
    prefix = F.conv(F.substring("_hash", 1, 6), 16, 10).cast("bigint")
    bucket = F.floor(prefix * n / F.lit(16**6)).cast("int")
    w = F.lit(1) if weight is None else weight
    return _running_total(keyed, bucket, ["_hash", id_col], w, name).drop("_hash")


def key_at(df: DataFrame, key: str, fraction: float, n_ranges: int | None = None):
    """The key at position floor(rows * fraction) of all rows in the order of the key; None past the last row.

    Distributed selection: rows are counted per key range, and only the range that holds the position is sorted. A range
    holds an even share of a hash sample's keys, so one that many rows share leaves its range to few others.
    """
    keys = df.select(F.col(key).alias("k"))
    bucket = _key_range(keys, "k", _range_count(df, n_ranges))
    counts = sorted((r.b, r.n) for r in keys.groupBy(bucket.alias("b")).agg(F.count("*").alias("n")).collect())
    before, target = 0, int(float(sum(n for _, n in counts)) * fraction)
    for number, size in counts:
        if before + size > target:
            ends = keys.where(bucket == number).agg(F.min("k").alias("low"), F.max("k").alias("high")).first()
            if ends.low == ends.high:
                return ends.low
            return keys.where(bucket == number).orderBy("k").offset(target - before).limit(1).first().k
        before += size
    return None


def split_positional(df: DataFrame, key: str, fraction: float = 0.6, name: str = "split") -> DataFrame:
    """Label the first ``int(n * fraction)`` rows by key "train" and the rest "validation".

    The key at the cut is found by selection, without sorting or numbering the keys; the wide table is then split by a
    comparison, without moving a row.
    """
    if not 0 <= fraction <= 1:
        raise ValueError(f"fraction must lie between 0 and 1, not {fraction}")
    if fraction == 1:
        return df.withColumn(name, F.lit("train"))
    cut = key_at(df, key, fraction)
    return df.withColumn(name, F.when(F.col(key) < _literal(cut), "train").otherwise("validation"))


def assign_batches(df: DataFrame, key: str, batch_size: int, seed: str | int | None = None) -> DataFrame:
    """``batch_id`` and ``slot`` of every row, in key order or in a seeded shuffle; the last batch may be short."""
    placed = with_position(df, key, "_position") if seed is None else with_shuffled_position(df, seed, key, "_position")
    return placed.withColumns(
        {
            "batch_id": F.floor(F.col("_position") / batch_size).cast("bigint"),
            "slot": F.col("_position") % batch_size,
        }
    ).drop("_position")
