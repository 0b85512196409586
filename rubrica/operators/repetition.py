"""Repetition of a text: how much of all its substrings is duplicated."""

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rubrica.operators.scratch import written

# Ship the helpers inside the task, so that workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: share of repeated substrings above which a text counts as repetitive.
REPETITIVE = 0.2

#: Characters from which on a text is ranked over all tasks.
ROWS_OVER = 1_000_000


def _ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dense ranks of the keys and their sort order."""
    order = np.argsort(keys)
    ordered = keys[order]
    ranks = np.zeros(keys.size, dtype=np.int64)
    ranks[order[1:]] = np.cumsum(ordered[1:] != ordered[:-1])
    return ranks, order


def _duplicate_share(text: str) -> float:
    """Sum of common prefixes of neighbouring sorted suffixes over the number of substrings.

    Suffixes are ranked by their first three characters, then by ever doubled prefixes until all ranks differ. The kept
    ranks give every common prefix by stepping from the widest to the narrowest.
    """
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64) + 1
    n = codes.size
    if n <= 1:
        return 0.0
    padded = np.concatenate([codes, [0, 0]])
    ranks, order = _ranked((padded[:-2] << 42) | (padded[1:-1] << 21) | padded[2:])
    width = 3
    levels = [(1, codes), (1, codes), (width, ranks)]
    while width < n and ranks[order[-1]] < n - 1:
        keys = ranks * (n + 1)
        keys[: n - width] += ranks[width:] + 1
        ranks, order = _ranked(keys)
        width *= 2
        levels.append((width, ranks))
    left, right = order[:-1].copy(), order[1:].copy()
    shared = np.zeros(n - 1, dtype=np.int64)
    for step, labels in reversed(levels):
        same = np.maximum(left, right) + step <= n
        same[same] = labels[left[same]] == labels[right[same]]
        shared[same] += step
        left[same] += step
        right[same] += step
    return float(2 * int(shared.sum()) / (n * (n + 1)))


def _share(text: Column) -> Column:
    """The share of one column by itself; only its texts go to Arrow. Its argument must be free of lambdas, which Spark may
    copy into expressions that no longer count as the same (see ``with_shares``)."""

    def batch(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else _duplicate_share(t)).astype("float64")

    return F.pandas_udf(batch, T.DoubleType())(text)


def with_shares(df: DataFrame, texts: dict[str, Column]) -> DataFrame:
    """Add the share of repeated substrings of each text under its name; NULL for a null text.

    One Arrow stage over the rows, for all texts at once. It is a step of the plan, not an expression, so what is computed
    before and after it is never merged with it. Nothing is shuffled.
    """
    kept, added = len(df.columns), list(texts)
    marked = df.select("*", *[c.alias(f"_text_{name}") for name, c in texts.items()])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shares = []
            for column in batch.columns[kept:]:
                found = [None if t is None else _duplicate_share(t) for t in column.to_pylist()]
                shares.append(pa.array(found, pa.float64()))
            names = [*batch.schema.names[:kept], *added]
            yield pa.RecordBatch.from_arrays([*batch.columns[:kept], *shares], names=names)

    schema = T.StructType([*df.schema.fields, *[T.StructField(name, T.DoubleType()) for name in texts]])
    return marked.mapInArrow(of, schema)


def _common_prefix(a: Column, b: Column) -> Column:
    """Characters that two different short texts have in common at their start."""
    same = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.coalesce(x == y, F.lit(False)))
    return F.array_position(same, F.lit(False)) - 1


def _suffix_heads(texts: DataFrame, width: int, block: int = 1024) -> DataFrame:
    """(key, pos, head): the first ``width`` characters of every suffix. The text is cut into overlapping blocks in one pass."""
    cut = rf"(?s)(?=(.{{1,{block + width - 1}}})).{{1,{block}}}"
    blocks = texts.select("key", F.posexplode(F.regexp_extract_all("text", F.lit(cut), F.lit(1))).alias("at", "part"))
    starts = F.sequence(F.lit(1), F.least(F.length("part"), F.lit(block)))
    rows = blocks.select("key", "at", "part", F.explode(starts).alias("i"))
    # the last block may have starts that the overlap of the one before it has as well; each start belongs to one block
    return rows.select("key", (F.col("at") * block + F.col("i") - 1).cast("long").alias("pos"), F.expr(f"substring(part, i, {width})").alias("head"))


def _shared(ranked: DataFrame) -> DataFrame:
    """Rows whose rank another suffix of the same text has as well."""
    many = ranked.groupBy("key", "rank").agg(F.count("*").alias("held")).where("held > 1").drop("held")
    return ranked.select("key", "pos", "rank").join(many, ["key", "rank"])


def _first_ranks(heads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ranks by head, and (key, shared) sums of the common prefixes of neighbours with different heads.

    A window covers the suffixes of one text that start with the same two characters; the totals of these groups give
    what comes before each.
    """
    heads = heads.withColumn("two", F.substring("head", 1, 2))
    groups = heads.groupBy("key", "two").agg(F.count("*").alias("held"))
    order = Window.partitionBy("key").orderBy("two")
    before = F.coalesce(F.sum("held").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    groups = written(groups.select("key", "two", before.alias("before"), F.lag("two").over(order).alias("last")), "repeat-groups")
    inside = Window.partitionBy("key", "two").orderBy("head")
    ranked = heads.select("*", (F.rank().over(inside) - 1).alias("place"), F.lag("head").over(inside).alias("previous"))
    edges = ranked.where("previous is not null and previous <> head").select("key", _common_prefix(F.col("previous"), F.col("head")).alias("shared"))
    between = groups.where("last is not null").select("key", _common_prefix(F.col("last"), F.col("two")).alias("shared"))
    ranks = ranked.join(groups.select("key", "two", "before"), ["key", "two"])
    sums = edges.union(between).groupBy("key").agg(F.sum("shared").alias("shared"))
    return ranks.select("key", "pos", (F.col("before") + F.col("place")).alias("rank")), sums


def repetition_by_rows(texts: DataFrame, width: int = 16) -> DataFrame:
    """(key, repetition) of texts given as (key, text) with unique keys: suffixes as rows, ranked by prefix doubling.

    All suffixes are ranked by their first ``width`` characters. Then only those that share a rank are ranked again, by
    the rank of what follows, at ever doubled widths, each rank being a window of its own. Neighbours that part at some
    width have that many characters in common and what the narrower ranks of the rest, from the widest down, still have.
    No text is held by a task; a window holds suffixes of one text with a common prefix. Null and empty texts and those of
    one character have a repetition of 0.
    """
    texts = written(texts.select("key", "text", F.coalesce(F.length("text"), F.lit(0)).alias("n")), "repeat-texts")
    heads = written(_suffix_heads(texts.where("n > 1"), width), "repeat-heads")
    ranks, sums = _first_ranks(heads)
    ranks = written(ranks, "repeat-ranks")
    same = written(_shared(ranks), "repeat-same")
    levels = []
    while same.limit(1).count():
        follow = ranks.select("key", (F.col("pos") - width).alias("pos"), F.col("rank").alias("next"))
        met = same.join(follow, ["key", "pos"], "left").withColumn("next", F.coalesce("next", F.lit(-1).cast("long")))
        inside = Window.partitionBy("key", "rank")
        placed = met.select(
            "key", "pos", (F.col("rank") + F.rank().over(inside.orderBy("next")) - 1).alias("rank"), "next",
            F.lag("pos").over(inside.orderBy("next", "pos")).alias("left"), F.lag("next").over(inside.orderBy("next", "pos")).alias("last"),
        )
        placed = written(placed, "repeat-placed")
        parted = placed.where("last <> next").select("key", "left", F.col("pos").alias("right"), F.lit(width).cast("long").alias("shared"))
        levels.append((width, same, parted))
        ranks = ranks.join(placed.select("key", "pos", F.col("rank").alias("new")), ["key", "pos"], "left")
        ranks = written(ranks.select("key", "pos", F.coalesce("new", "rank").alias("rank")), "repeat-ranks")
        same = written(_shared(placed), "repeat-same")
        width *= 2
    pairs = None
    for (_, _, parted), below in zip(reversed(levels), [*reversed(levels[:-1]), None], strict=True):
        pairs = parted if pairs is None else pairs.union(parted)
        if below is not None:
            step, members, _ = below
            for side in ("left", "right"):
                at = members.select("key", F.col("pos").alias(f"{side}_at"), F.col("rank").alias(f"{side}_rank"))
                pairs = pairs.withColumn(f"{side}_at", F.col(side) + F.col("shared")).join(at, ["key", f"{side}_at"], "left")
            equal = F.coalesce(F.col("left_rank") == F.col("right_rank"), F.lit(False))
            pairs = pairs.select("key", "left", "right", (F.col("shared") + F.when(equal, step).otherwise(0)).alias("shared"))
            pairs = written(pairs, "repeat-pairs")
    if pairs is not None:
        for side in ("left", "right"):
            at = heads.select("key", F.col("pos").alias(f"{side}_at"), F.col("head").alias(f"{side}_head"))
            pairs = pairs.withColumn(f"{side}_at", F.col(side) + F.col("shared")).join(at, ["key", f"{side}_at"], "left")
        rest = F.when(F.col("left_head").isNotNull() & F.col("right_head").isNotNull(), _common_prefix(F.col("left_head"), F.col("right_head")))
        pairs = pairs.select("key", (F.col("shared") + F.coalesce(rest, F.lit(0))).alias("shared"))
        sums = sums.union(pairs.groupBy("key").agg(F.sum("shared")))
    total = sums.groupBy("key").agg(F.sum("shared").alias("shared"))
    size = F.col("n").cast("double")
    share = F.coalesce(2 * F.col("shared") / (size * (size + 1)), F.lit(0.0))
    return texts.select("key", "n").join(total, "key", "left").select("key", F.when(F.col("n") > 1, share).otherwise(0.0).alias("repetition"))


def flag_repetition(df: DataFrame, text: str, longer_than: int = 0, rows_over: int = ROWS_OVER) -> DataFrame:
    """Add ``repetition`` and ``is_repetitive``; texts of at most ``longer_than`` characters are not examined.

    Texts of up to ``rows_over`` characters are ranked by themselves, in the task that holds them. Longer ones are ranked
    as rows over all tasks (:func:`repetition_by_rows`), each different text once, and joined back by a hash of 256 bits.
    """
    size = F.length(text)
    is_long = F.coalesce((size > longer_than) & (size > rows_over), F.lit(False))
    some_long = df.where(is_long).limit(1).count() > 0
    short = df.where(~is_long) if some_long else df
    share = _share(F.when(F.length(text) > longer_than, F.col(text)))
    short = short.withColumn("repetition", F.coalesce(F.nanvl(share, F.lit(0.0)), F.lit(0.0)))
    if some_long:
        keyed = df.where(is_long).withColumn("_long_key", F.sha2(F.col(text), 256))
        once = keyed.select(F.col("_long_key").alias("key"), F.col(text).alias("text")).dropDuplicates(["key"])
        by_rows = repetition_by_rows(once).withColumnRenamed("key", "_long_key")
        short = short.unionByName(keyed.join(by_rows, "_long_key").drop("_long_key"))
    return short.withColumn("is_repetitive", F.col("repetition") > REPETITIVE)
