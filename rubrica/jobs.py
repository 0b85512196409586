"""The end-to-end jobs: each reads files, writes JSON lines and returns its report as a DataFrame.

Model outputs are inputs here: completions and judge responses come keyed by ``item_id`` from wherever they were
generated. Reports are computed from the written files, so a job computes its rows once.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rubrica import schemas, templates
from rubrica.functions.grade import RewardFn, zero_reward
from rubrica.functions.prompts import chat_text, render, safety_judge_messages
from rubrica.operators import curate, grading, masked, ordering, report, rollouts, sequences
from rubrica.operators.scratch import written
from rubrica.sources import files

PROBLEMS = T.StructType([T.StructField("item_id", T.LongType()), *schemas.PROBLEM])
COMPLETIONS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("generated_text", T.StringType())])
SCORED = T.StructType([T.StructField("item_id", T.LongType()), *schemas.SCORED])
PREDICTIONS = T.StructType(
    [T.StructField("item_id", T.LongType()), T.StructField("prompts_final", T.StringType()), T.StructField("output", T.StringType())]
)
JUDGEMENTS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("model_response", T.StringType())])
JUDGED = T.StructType(
    [
        *PREDICTIONS,
        T.StructField("model_name_or_path", T.StringType()),
        T.StructField("model_prompt", T.StringType()),
        T.StructField("model_response", T.StringType()),
        T.StructField("metrics", T.StructType([T.StructField("safe", T.DoubleType())])),
    ]
)


ROLLOUTS = T.StructType(
    [
        T.StructField("item_id", T.LongType()),
        T.StructField("rollout", T.LongType()),
        T.StructField("prompt", T.StringType()),
        T.StructField("generated_text", T.StringType()),
        T.StructField("metrics", schemas.REWARD),
        T.StructField("raw_reward", T.DoubleType()),
        T.StructField("advantage", T.DoubleType()),
    ]
)
LOSSES = T.StructType(
    [T.StructField("batch_id", T.LongType()), T.StructField("loss", T.DoubleType()), T.StructField("tokens", T.LongType())]
)
TOKEN_LINES = T.StructType(
    [
        T.StructField("item_id", T.LongType()),
        T.StructField("prompt_ids", T.ArrayType(T.IntegerType())),
        T.StructField("output_ids", T.ArrayType(T.IntegerType())),
    ]
)
GENERATIONS = T.StructType([T.StructField("item_id", T.LongType()), *schemas.SCORED.fields[:3]])
LOGS = T.StructType(
    [*GENERATIONS, T.StructField("metrics", schemas.REWARD), T.StructField("length", T.LongType()), T.StructField("entropy", T.DoubleType())]
)


def render_problems(spark: SparkSession, problems: str, output: str, template: str = templates.R1_ZERO) -> None:
    """Prompts for the generator: JSON lines ``{item_id, prompt}`` in key order."""
    rows = files.read_jsonl(spark, problems, PROBLEMS)
    files.write_jsonl(rows.select("item_id", render(template, question=F.col("problem")).alias("prompt")), output, order_by="item_id")


def evaluate(
    spark: SparkSession,
    problems: str,
    completions: str,
    output: str,
    template: str = templates.R1_ZERO,
    mode: str = "r1_zero",
    reward: RewardFn | None = None,
) -> DataFrame:
    """Score one completion per problem and report sums and means; a problem without a completion scores zero.

    ``reward`` is any reward function of a response and its truths, such as one made by ``grade.from_python``; by default
    answers are graded by ``mode``.
    """
    items = files.read_jsonl(spark, problems, PROBLEMS).select(
        "item_id",
        render(template, question=F.col("problem")).alias("prompt"),
        F.col("solution").alias("answer"),
        F.array("solution").alias("truths"),
    )
    texts = files.read_jsonl(spark, completions, COMPLETIONS)
    if reward is None:
        scored = grading.grade_completions(texts, items, "item_id", mode=mode, how="left")
    else:
        rows = items.join(texts, "item_id", "left").withColumn("_served", F.col("generated_text").isNotNull())
        rows = rows.withColumn("generated_text", F.coalesce("generated_text", F.lit("")))
        rated = grading.score(rows, "generated_text", reward, F.col("truths"))
        scored = rated.withColumn("metrics", F.when(F.col("_served"), F.col("metrics")).otherwise(zero_reward()))
    files.write_jsonl(scored.select(SCORED.names), output, order_by="item_id")
    return report.metric_report(files.read_jsonl(spark, output, SCORED))


def build_sft(spark: SparkSession, scored: str, output: str) -> DataFrame:
    """Fine-tuning rows from fully rewarded completions; returns kept and total."""
    rows = files.read_jsonl(spark, scored, SCORED)
    files.write_jsonl(curate.rejection_filter(rows), output)
    return report.keep_rate(rows)


def build_rollouts(
    spark: SparkSession, problems: str, completions: str, output: str, group_size: int, normalize_by_std: bool = True,
    template: str = templates.R1_ZERO, mode: str = "r1_zero", eps: float = 1e-6,
) -> DataFrame:
    """Scored rollouts with group advantages from problems and their completions; returns the metric report.

    The output has a line per rollout: prompt, response, rewards, raw reward and advantage. A group that is not full has
    advantage 0, as an incomplete group trains nothing.
    """
    items = files.read_jsonl(spark, problems, PROBLEMS).select(
        "item_id",
        render(template, question=F.col("problem")).alias("prompt"),
        F.array("solution").alias("truths"),
    )
    texts = files.read_jsonl(spark, completions, schemas.COMPLETIONS)
    graded = grading.grade_completions(texts, items, "item_id", mode=mode, salt_by="rollout")
    # graded rows are written once; advantages need their group statistics and the rows themselves
    rated = written(graded.select("item_id", "rollout", "prompt", "generated_text", "metrics"), "rollouts")
    rated = rated.withColumn("raw_reward", F.col("metrics.reward"))
    advised = rollouts.group_advantages(
        rated, "item_id", "raw_reward", "rollout", eps=eps, normalize_by_std=normalize_by_std, group_size=group_size
    )
    files.write_jsonl(advised.select(ROLLOUTS.names), output)
    return report.metric_report(rated)


def policy_losses(
    spark: SparkSession, scored: str, policy: str, old: str, output: str, loss_type: str = "grpo_clip",
    accumulation: int = 1, cliprange: float = 0.2, batch_rollouts: int = 16,
) -> DataFrame:
    """One line per microbatch with its loss and number of response tokens, from scored rollouts and token log-probabilities.

    ``policy`` and ``old`` are Parquet token tables (item_id, rollout, pos, lp) of the policy and the one that sampled; the
    policy's also has ``mask``. Microbatches are runs of ``batch_rollouts`` rollouts in the order of item and number.
    """
    keys = ["item_id", "rollout"]
    place = F.struct(*keys)
    rows = files.read_jsonl(spark, scored, ROLLOUTS).select(*keys, "raw_reward", "advantage", place.alias("_place"))
    numbered = ordering.with_position(rows, "_place", "seq_id").drop("_place")
    numbered = written(numbered.withColumn("batch_id", rollouts.positional_group(F.col("seq_id"), batch_rollouts)), "rollout-order")
    scalars = numbered.select(*keys, "seq_id", "batch_id", "raw_reward", "advantage")
    tokens = files.read_parquet(spark, policy).join(scalars, keys)
    before = files.read_parquet(spark, old).select(*keys, "pos", F.col("lp").alias("lp_old"))
    aligned = tokens.join(before, [*keys, "pos"])
    losses = masked.grpo_loss(aligned, loss_type, accumulation, cliprange)
    sizes = aligned.groupBy("batch_id").agg(F.sum(F.col("mask").cast("bigint")).alias("tokens"))
    files.write_jsonl(losses.join(sizes, "batch_id"), output, order_by="batch_id")
    return files.read_jsonl(spark, output, LOSSES)


def build_sft_batches(spark: SparkSession, token_lines: str, output: str, batch_size: int, pad_id: int, seed: int | None = None) -> None:
    """Padded training batches from lines of token ids: inputs, labels and response masks, a line per example.

    Examples are put in order or in a seeded shuffle, dealt out into batches and padded to the longest of their batch.
    """
    rows = files.read_jsonl(spark, token_lines, TOKEN_LINES)
    batched = ordering.assign_batches(rows, "item_id", batch_size, seed)
    shaped = sequences.shape_sequences(batched, "prompt_ids", "output_ids", pad_id, "batch_id", "item_id")
    files.write_jsonl(shaped.select("batch_id", "slot", "item_id", "input_ids", "labels", "response_mask"), output)


def log_generations(spark: SparkSession, generations: str, tokens: str, output: str) -> DataFrame:
    """A line per generation with its rewards, length and entropy, and the averages over all of them.

    ``generations`` are lines {item_id, prompt, answer, generated_text}; ``tokens`` is a Parquet table of their response
    tokens (item_id, entropy, mask).
    """
    log = report.generation_log(files.read_jsonl(spark, generations, GENERATIONS), files.read_parquet(spark, tokens), "item_id")
    files.write_jsonl(log.select(LOGS.names), output, order_by="item_id")
    return report.generation_report(files.read_jsonl(spark, output, LOGS), F.col("metrics.reward"))


def split_dataset(spark: SparkSession, parquet: str, key: str, train: str, validation: str, fraction: float = 0.6) -> None:
    """The first part of a table by key as training lines, the rest as validation lines."""
    labelled = ordering.split_positional(files.read_parquet(spark, parquet), key, fraction, "_split")
    for name, path in (("train", train), ("validation", validation)):
        files.write_jsonl(labelled.where(F.col("_split") == name).drop("_split"), path)


def _judge_prompt() -> Column:
    return chat_text(safety_judge_messages(F.col("prompts_final"), F.col("output")))


def render_safety_prompts(spark: SparkSession, predictions: str, output: str) -> None:
    """Prompts for the judge model: JSON lines ``{item_id, model_prompt}``."""
    rows = files.read_jsonl(spark, predictions, PREDICTIONS)
    files.write_jsonl(rows.select("item_id", _judge_prompt().alias("model_prompt")), output, order_by="item_id")


def judge_safety(spark: SparkSession, predictions: str, judgements: str, output: str, judge: str) -> DataFrame:
    """Join predictions with the judge's responses, write them with their verdicts, and report the safe share."""
    rows, said = files.read_jsonl(spark, predictions, PREDICTIONS), files.read_jsonl(spark, judgements, JUDGEMENTS)
    curate.assert_complete(rows, said, "item_id")
    judged = grading.parse_judgements(curate.pair_by_key(rows, said, "item_id"), "model_response", "safety", "_safe")
    full = curate.augment(
        judged,
        model_name_or_path=F.lit(judge),
        model_prompt=_judge_prompt(),
        metrics=F.struct(F.col("_safe").alias("safe")),
    )
    files.write_jsonl(full.select(JUDGED.names), output, order_by="item_id")
    written = files.read_jsonl(spark, output, JUDGED)
    return report.metric_means(written.select("metrics.safe"), "safe")
