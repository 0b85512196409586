"""Rollout groups: fan-out, advantages, token alignment, preference pairs and their loss."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rubrica.functions.losses import dpo_loss
from rubrica.operators.skew import lookup_join


def rollout_grid(prompts: DataFrame, group_size: int) -> DataFrame:
    """One row per prompt and rollout number."""
    return prompts.withColumn("rollout", F.explode(F.sequence(F.lit(0), F.lit(group_size - 1))))


def positional_group(position: Column, group_size: int) -> Column:
    """Group id of data whose groups are runs of consecutive rows."""
    return F.floor(position / group_size).cast("bigint")


def fan_out(rollouts: DataFrame, prompts: DataFrame, on: str, salt_by: str | list[str]) -> DataFrame:
    """Attach the prompt's columns to each of its rollouts."""
    return lookup_join(rollouts, prompts, on, salt_by, how="inner", keys_from=rollouts)


def group_advantages(
    rollouts: DataFrame,
    group: str,
    reward: str,
    salt_by: str | list[str],
    eps: float = 1e-6,
    normalize_by_std: bool = False,
    group_size: int | None = None,
) -> DataFrame:
    """Add ``advantage``: reward minus group mean, over the sample deviation plus eps if asked.

    Group statistics are aggregated map-side and joined back, so a huge group is never one task's window. A group of one
    row has no deviation and gives NaN. With ``group_size``, groups that are not full get 0.
    """
    stats = rollouts.groupBy(group).agg(
        F.avg(reward).alias("_mean"), F.stddev_samp(reward).alias("_std"), F.count(F.lit(1)).alias("_count")
    )
    centred = F.col(reward) - F.col("_mean")
    if normalize_by_std:
        centred = centred / (F.coalesce(F.col("_std"), F.lit(float("nan"))) + F.lit(eps))
    if group_size is not None:
        centred = F.when(F.col("_count") < group_size, 0.0).otherwise(centred)
    return (
        lookup_join(rollouts, stats, group, salt_by, how="inner", keys_from=rollouts)
        .withColumn("advantage", centred)
        .drop("_mean", "_std", "_count")
    )


def align_log_probs(policy: DataFrame, old: DataFrame, seq: str = "seq_id", pos: str = "pos") -> DataFrame:
    """Policy token rows with ``lp_old`` of the same token."""
    return policy.join(old.select(seq, pos, F.col("lp").alias("lp_old")), [seq, pos])


def with_sequence_scalars(tokens: DataFrame, rollouts: DataFrame, seq: str = "seq_id", pos: str = "pos") -> DataFrame:
    """Spread per-sequence rewards or advantages over the tokens of the sequence."""
    return lookup_join(tokens, rollouts, seq, [pos], how="inner")


def preference_pairs(scored: DataFrame, prompt: str, item: str, reward: str, text: str) -> DataFrame:
    """One pair per prompt: its best and its worst response, ties to the lowest id; none when all rewards are equal.

    Picking the extremes is an aggregate with map-side combine; no pair of responses is ever enumerated.
    """
    best = F.struct((-F.col(reward)).alias("k"), F.col(item).alias("id"))
    worst = F.struct(F.col(reward).alias("k"), F.col(item).alias("id"))
    extremes = scored.groupBy(prompt).agg(
        F.min_by(F.col(text), best).alias("chosen"),
        F.min(best).alias("_best"),
        F.min_by(F.col(text), worst).alias("rejected"),
        F.min(worst).alias("_worst"),
    )
    return extremes.where(-F.col("_best.k") > F.col("_worst.k")).select(
        prompt,
        F.col("_best.id").alias("chosen_id"),
        F.col("_worst.id").alias("rejected_id"),
        "chosen",
        "rejected",
    )


def dpo_losses(tokens: DataFrame, beta: float, pair: str = "pair_id") -> DataFrame:
    """Preference loss of every pair from rows (pair, model policy|ref, side chosen|rejected, lp, mask)."""

    def log_prob(model: str, side: str) -> Column:
        wanted = (F.col("model") == model) & (F.col("side") == side)
        return F.sum(F.when(wanted, F.col("lp") * F.col("mask").cast("double")).otherwise(0.0)).alias(f"{model}_{side}")

    sums = tokens.groupBy(pair).agg(*[log_prob(m, s) for m in ("policy", "ref") for s in ("chosen", "rejected")])
    loss = dpo_loss(*[F.col(f"{m}_{s}") for s in ("chosen", "rejected") for m in ("policy", "ref")], beta=beta)
    return sums.select(pair, loss.alias("loss"))
