"""Metric reports. Means over no rows are NULL, where a loop over an empty list would fail."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rubrica import schemas
from rubrica.functions.grade import RewardFn, r1_zero_reward
from rubrica.operators import masked
from rubrica.operators.grading import score

METRICS = tuple(f.name for f in schemas.REWARD)


def metric_report(scored: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Sum and mean of each reward, and the row count."""
    sums = [F.sum(f"metrics.{m}").alias(f"sum_{m}") for m in METRICS]
    means = [F.avg(f"metrics.{m}").alias(f"avg_{m}") for m in METRICS]
    return scored.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *sums, *means)


def metric_means(df: DataFrame, *metrics: str) -> DataFrame:
    """Long form ``(metric, value)`` in metric order."""
    means = df.agg(*[F.avg(m).alias(m) for m in metrics])
    return means.unpivot([], list(metrics), "metric", "value").orderBy("metric")


def keep_rate(scored: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Rows a rejection filter keeps, and all rows."""
    return scored.groupBy(*by).agg(
        F.count_if(F.col("metrics.reward") == 1.0).alias("kept"), F.count(F.lit(1)).alias("total")
    )


def generation_report(generations: DataFrame, reward: Column, by: tuple[str, ...] = ()) -> DataFrame:
    """Average entropy, and average length of right and of wrong generations (0 for a class without rows)."""
    right, wrong = F.when(reward > 0, F.col("length")), F.when(~(reward > 0), F.col("length"))
    return generations.groupBy(*by).agg(
        F.avg("entropy").alias("average_entropy"),
        F.coalesce(F.avg(right), F.lit(0.0)).alias("average_correct_length"),
        F.coalesce(F.avg(wrong), F.lit(0.0)).alias("average_incorrect_length"),
    )


def generation_log(
    generations: DataFrame, tokens: DataFrame, key: str, text: str = "generated_text", answer: str = "answer",
    reward: RewardFn = r1_zero_reward,
) -> DataFrame:
    """One row per generation: its columns, ``metrics``, ``length`` and ``entropy`` (the mean over its unmasked tokens).

    ``tokens`` has a row per response token (key, entropy, mask). They are summed per key before they meet the texts, so no
    text travels with a token. A generation without tokens has length 0 and no entropy.
    """
    stats = masked.sequence_stats(tokens, F.col("entropy"), F.col("mask"), key)
    scored = score(generations, text, reward, F.array(answer))
    return scored.join(stats, key, "left").withColumn("length", F.coalesce("length", F.lit(0).cast("bigint")))


def win_rate(judged: DataFrame, winner: str, model: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Share of parsed comparisons the model won, with the number parsed and the number of all."""
    return judged.groupBy(*by).agg(
        F.avg((F.col(winner) == model).cast("double")).alias("win_rate"),
        F.count(winner).alias("parsed"),
        F.count(F.lit(1)).alias("total"),
    )


def choice_accuracy(answered: DataFrame, predicted: str, answer: str, subject: str = "subject") -> DataFrame:
    """Accuracy per subject, and overall in the row whose subject is NULL; unparsed counts as wrong."""
    right = F.coalesce(F.col(predicted) == F.col(answer), F.lit(False)).cast("double")
    return answered.rollup(subject).agg(F.avg(right).alias("accuracy"), F.count(F.lit(1)).alias("n"))
