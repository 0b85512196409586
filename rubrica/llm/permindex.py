"""Nearest neighbours by a permutation index: ordered nearest pivots, pivot inverted files, footrule rank, exact rerank."""

import math
import sys
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rubrica.llm.common import hash_sample, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PREFIX = 64
POSTED = 3
LEAST_CANDIDATES = 64
MOST_PIVOTS = 256
ROWS_PER_PART = 8192
QUERIES_PER_PART = 1024


def usable(vector: Column) -> Column:
    """Neither null, nor empty, nor zero, and without null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def choose_pivots(vectors: DataFrame, rows: int) -> np.ndarray:
    """Distinct vectors as pivots: a quarter of the table's rows, 16 at least and 256 at most.

    They come from a hash sample of about sixteen times that many rows, so the driver's share is bounded. A vector that
    many rows hold is one candidate.
    """
    count = min(MOST_PIVOTS, max(16, rows // 4))
    drawn = hash_sample(vectors, "id", 16 * count).groupBy("vector").agg(F.min("id").alias("id"))
    picked = drawn.orderBy(F.xxhash64(F.lit(3), "id"), "id").limit(count).select("vector").collect()
    return np.array([r.vector for r in picked], np.float64)


def distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Squared distances to each pivot, for ranking only."""
    return (pivots**2).sum(1)[None] - 2 * rows @ pivots.T


def nearest_pivots(vectors: DataFrame, pivots: np.ndarray, prefix: int) -> DataFrame:
    """(id, vector, places): the ``prefix`` nearest pivots of each vector, nearest first, ties by number."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                gaps = distances(np.stack(batch["vector"].to_numpy()).astype(np.float64), pivots)
                order = np.argsort(gaps, axis=1, kind="stable")[:, :prefix].astype(np.int16)
                yield pd.DataFrame({"id": batch["id"], "vector": batch["vector"], "places": list(order)})

    kind = vectors.schema["vector"].dataType.simpleString()
    return vectors.mapInPandas(of, f"id long, vector {kind}, places array<short>")


def footrule(queries: np.ndarray, rows: np.ndarray, pivots: int) -> Iterator[np.ndarray]:
    """Spearman's footrule distance of each query to all rows over their prefixes; an absent pivot stands just behind."""
    prefix = rows.shape[1]
    ranks = np.full((len(rows), pivots), prefix, np.int16)
    np.put_along_axis(ranks, rows.astype(np.int64), np.arange(prefix, dtype=np.int16)[None], axis=1)
    whole = prefix * (prefix + 1) // 2
    own = np.arange(prefix, dtype=np.int16)
    for query in queries:
        held = ranks[:, query.astype(np.int64)]
        yield np.abs(held - own).sum(1, dtype=np.int32) + whole - (prefix - held).sum(1, dtype=np.int32)


def search_part(queries: pd.DataFrame, rows: pd.DataFrame, pivots: int, share: float, k: int) -> pd.DataFrame:
    """Of one inverted file part, the ``k`` nearest rows of each query among the ``share`` of rows best by footrule.

    Equal footrule goes to the smaller id, so a part full of copies of the query keeps the smallest ids.
    """
    out: list[tuple] = []
    if len(queries) and len(rows):
        rows = rows.sort_values("id", kind="stable")
        ids = rows["id"].to_numpy()
        vectors = np.stack(rows["vector"].to_numpy()).astype(np.float64)
        repeated = len(np.unique(ids)) < len(ids)
        candidates = max(LEAST_CANDIDATES, math.ceil(share * len(rows)))
        ranked = footrule(np.stack(queries["places"].to_numpy()), np.stack(rows["places"].to_numpy()), pivots)
        for query_id, query, gap in zip(queries["id"], queries["vector"], ranked, strict=True):
            near = np.flatnonzero(ids != query_id)
            if len(near) > candidates:
                near = near[np.argsort(gap[near], kind="stable")[:candidates]]
            exact = np.sqrt(((vectors[near] - query.astype(np.float64)) ** 2).sum(1))
            best = np.lexsort((ids[near], exact))
            if repeated:  # the nearest vector of each id
                best = best[np.sort(np.unique(ids[near[best]], return_index=True)[1])]
            best = best[:k]
            out += zip([query_id] * len(best), ids[near[best]].tolist(), exact[best].tolist(), strict=True)
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])


def search(
    posted: DataFrame, asked: DataFrame, pivots: int, share: float, k: int
) -> DataFrame:
    """Join the inverted files (place, part) with the queries sent to them, block by block: (query_id, vec_id, score)."""

    def of(key: tuple, rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        queries = queries.rename(columns=lambda c: c.removeprefix("query_"))
        return search_part(queries, rows, pivots, share, k)

    keys = ["place", "part", "qpart"]
    return posted.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(
        of, "query_id long, vec_id long, score double"
    )


def parts(count: Column, size: int) -> Column:
    return F.ceil(count / F.lit(size)).cast("int")


def blocks(rows: DataFrame, queries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cut both sides of each place into parts of bounded size, by hash, and send each part to all of the other side."""
    sizes = rows.groupBy("place").agg(parts(F.count("*"), ROWS_PER_PART).alias("n"))
    wanted = queries.groupBy("place").agg(parts(F.count("*"), QUERIES_PER_PART).alias("q"))
    counts = F.broadcast(sizes.join(wanted, "place"))  # one row per pivot
    part, qpart = F.pmod(F.xxhash64("id", "place"), F.col("n")), F.pmod(F.xxhash64("query_id", "place"), F.col("q"))
    left = rows.join(counts, "place").withColumn("part", part.cast("int"))
    left = left.withColumn("qpart", F.explode(F.sequence(F.lit(0), F.col("q") - 1)))
    right = queries.join(counts, "place").withColumn("qpart", qpart.cast("int"))
    right = right.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    keys = ["place", "part", "qpart"]
    return left.select(*keys, "id", "places", "vector"), right.select(*keys, "query_id", "query_places", "query_vector")


def neighbours(
    embeddings: DataFrame, every: int = 100, k: int = 10, probes: float = 1 / 3, share: float = 0.2,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found of each row whose id is divisible by ``every``.

    Score is the Euclidean distance in double precision; ties go to the smaller id. A vector is posted in the inverted
    files of its 3 nearest pivots and a query reads those of the ``probes`` share of pivots nearest to it; both sides of a
    file are cut into parts of bounded size, so neither a vector that a third of the rows share nor a busy pivot makes a
    large task. In each part the ``share`` of rows best by footrule (64 at least) is measured exactly. A query that finds fewer than ``k`` rows this way
    is measured against all rows, in the same blocks.

    Vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do rows with a null id.
    Vectors of different lengths have no distance: each length is searched by itself. Rows that repeat an id and vector
    count once; of different vectors under one id the nearest counts, from the nearest query vector of an id. An empty table gives no rows. Other columns are not read.
    """
    vector = F.col(vector_col)
    if not str(embeddings.schema[vector_col].dataType.simpleString()) == "array<float>":
        vector = vector.cast("array<double>")
    clean = embeddings.select(F.col(id_col).cast("long").alias("id"), vector.alias("vector")).where(F.col("id").isNotNull() & usable(F.col("vector")))
    clean = written(clean.distinct(), "ann-vectors")
    sizes = clean.groupBy(F.size("vector").alias("d")).count().orderBy("d").collect()
    found = [nearest_of_size(clean.where(F.size("vector") == r.d), r["count"], every, k, probes, share) for r in sizes if r["count"] > 1]
    if not found:
        return clean.selectExpr("id as query_id", "1 as rank", "id as vec_id", "0D as score").limit(0)
    every_length = found[0] if len(found) == 1 else nearest_once(reduce(DataFrame.union, found))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = every_length.withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest_once(found: DataFrame) -> DataFrame:
    return found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))


def nearest_of_size(clean: DataFrame, rows: int, every: int, k: int, probes: float, share: float) -> DataFrame:
    """(query_id, vec_id, score) of the vectors of one length."""
    pivots = choose_pivots(clean, rows)
    prefix = min(PREFIX, len(pivots))
    index = written(nearest_pivots(clean, pivots, prefix), "ann-index")
    queries = index.where(F.pmod("id", F.lit(every)) == 0)
    at = lambda n: F.explode(F.slice("places", 1, min(n, prefix)).cast("array<int>")).alias("place")
    posted = index.select(at(POSTED), "id", "places", "vector")
    named = [F.col(c).alias(f"query_{c}") for c in ("id", "places", "vector")]
    asked = queries.select(at(math.ceil(probes * len(pivots))), *named)
    found = written(nearest_once(search(*blocks(posted, asked), len(pivots), share, k)), "ann-found")
    enough = found.groupBy("query_id").count().where(F.col("count") >= k).select("query_id")
    few = queries.select(F.lit(0).alias("place"), *named).join(enough, "query_id", "left_anti")
    if few.limit(1).count():
        rest = search(*blocks(index.withColumn("place", F.lit(0)), few), len(pivots), 1.0, k)
        found = nearest_once(found.union(rest))
    return found
