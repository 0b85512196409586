"""Scoring of a stream of completion files with the same stateless columns the batch jobs use."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rubrica.functions import grade
from rubrica.operators.grading import score


def completion_stream(spark: SparkSession, folder: str, schema: T.StructType, files_per_trigger: int = 1000) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .option("mode", "FAILFAST")
        .option("maxFilesPerTrigger", files_per_trigger)
        .json(folder)
    )


def score_stream(
    completions: DataFrame,
    sink: str,
    checkpoint: str,
    text: str = "generated_text",
    truths: Column | None = None,
    reward: grade.RewardFn = grade.r1_zero_reward,
) -> StreamingQuery:
    """Score what has arrived and stop; the checkpoint folder makes the next run go on from there."""
    truths = F.array(F.col("answer")) if truths is None else truths
    return (
        score(completions, text, reward, truths)
        .writeStream.format("json")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
