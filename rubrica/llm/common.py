"""What several operators of this package share: written steps, hash samples and connected components."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rubrica.operators.scratch import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows read back from Parquet in the shared folder, so that nothing behind them is computed twice."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """The fifth of the rows that no model of this package learns from. A row without an id is not held out."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def hash_sample(rows: DataFrame, key: str, limit: int) -> DataFrame:
    """About ``limit`` rows, chosen by a hash of their key: the same rows whatever the partitioning, all if fewer.

    The bound is on the expected count; no row is moved to draw the sample.
    """
    share = min(1.0, limit / max(1, rows.count()))
    return rows if share == 1.0 else rows.where(F.pmod(F.xxhash64(F.lit(7), key), F.lit(1_000_000)) < int(share * 1e6))


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) for every node of an undirected graph given as ``a``, ``b``; the root is the smallest node reached.

    Alternating large-star and small-star steps: each step links the neighbours of a node to the smallest of them, by
    aggregates and joins. Every round is written to the shared folder; the loop ends when a round changes nothing, after
    a number of rounds that grows with the logarithm of the largest component. Only counts reach the driver.
    """
    order = [F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")]
    links = written(edges.where("a <> b").select(*order).distinct(), f"{name}-links")
    before = None
    while True:
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == before or state[0] == 0:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large, f"{name}-large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = written(small.union(least.select("a", F.col("m").alias("b"))).distinct(), f"{name}-links")
