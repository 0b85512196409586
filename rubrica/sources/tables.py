"""Token tables stored by bucket, so that tables of the same tokens meet without a shuffle."""

from pyspark.sql import DataFrame, SparkSession

KEYS = ("seq_id", "pos")


def write_token_table(df: DataFrame, name: str, path: str, buckets: int, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Store token rows in ``buckets`` files by a hash of their keys, sorted inside, and return the stored table.

    Rows are dealt out by the same hash before they are written, so each bucket is one file of one task. Tables of the same
    number of buckets are joined on the keys without an exchange: the one shuffle is paid when a table is written, not by
    each loss, gradient or report that aligns it. The table is external: its files lie at ``path``, the session's catalog
    holds its name.
    """
    spread = df.repartition(buckets, *keys)
    spread.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    return read_token_table(df.sparkSession, name)


def read_token_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
