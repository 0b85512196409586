"""Where intermediate tables go."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder named by spark.checkpoint.dir; a local folder only for a local master."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared:
        return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{tempfile.mkdtemp(prefix='rubrica-')}/{name}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows read back from Parquet in the shared folder, so that nothing behind them is computed twice."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
