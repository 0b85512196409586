"""Masked reductions, batch losses and gradient tables over long-form token rows (seq_id, pos, ...)."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rubrica.functions.losses import policy_gradient_loss, policy_gradient_slope
from rubrica.operators.skew import lookup_join


def _axes(dim: int | None, seq: str, pos: str) -> list[str]:
    kept = {None: [], 0: [pos], 1: [seq], -1: [seq]}
    if dim not in kept:
        raise ValueError(f"dim must be one of {list(kept)}")
    return kept[dim]


def _masked(value: Column, mask: Column, nan_safe: bool) -> Column:
    """value * mask as a tensor product would give it (0 * NaN is NaN), or 0 under the mask when nan_safe."""
    if nan_safe:
        return F.when(mask.cast("boolean"), value).otherwise(0.0)
    return value * mask.cast("double")


def _ratio(total: Column, count: Column) -> Column:
    return F.when(count == 0, F.lit(float("nan"))).otherwise(total / F.nullif(count, F.lit(0)))


def masked_normalize(
    df: DataFrame,
    value: Column,
    mask: Column,
    constant: float | Column,
    dim: int | None = None,
    by: tuple[str, ...] = (),
    seq: str = "seq_id",
    pos: str = "pos",
    nan_safe: bool = False,
) -> DataFrame:
    """Sum of the unmasked values over a constant. A Column constant must not vary inside an output cell."""
    total = F.sum(_masked(value, mask, nan_safe))
    divisor = F.lit(float(constant)) if not isinstance(constant, Column) else F.max(constant)
    return df.groupBy(*by, *_axes(dim, seq, pos)).agg((total / divisor).alias("value"))


def masked_mean(
    df: DataFrame,
    value: Column,
    mask: Column,
    dim: int | None = None,
    by: tuple[str, ...] = (),
    seq: str = "seq_id",
    pos: str = "pos",
    nan_safe: bool = False,
) -> DataFrame:
    """Mean of the unmasked values; NaN for a cell without any."""
    total, count = F.sum(_masked(value, mask, nan_safe)), F.sum(mask.cast("bigint"))
    return df.groupBy(*by, *_axes(dim, seq, pos)).agg(_ratio(total, count).alias("value"))


def sequence_stats(tokens: DataFrame, entropy: Column, mask: Column, seq: str = "seq_id") -> DataFrame:
    """Response length and length-normalised entropy of every sequence."""
    length = F.sum(mask.cast("bigint"))
    return tokens.groupBy(seq).agg(
        length.alias("length"), _ratio(F.sum(_masked(entropy, mask, False)), length).alias("entropy")
    )


def sft_loss(
    tokens: DataFrame, accumulation: int, constant: float = 1.0, batch: str = "batch_id", seq: str = "seq_id"
) -> DataFrame:
    """One loss per microbatch from rows (batch, seq, lp, mask). Sequences are counted by their own partial sums."""
    per_seq = tokens.groupBy(batch, seq).agg(F.sum(_masked(F.col("lp"), F.col("mask"), False)).alias("_lp"))
    loss = -F.sum("_lp") / F.lit(float(constant)) / F.count(F.lit(1)) / F.lit(accumulation)
    return per_seq.groupBy(batch).agg(loss.alias("loss"))


def sft_grad(
    tokens: DataFrame,
    accumulation: int,
    constant: float = 1.0,
    batch: str = "batch_id",
    seq: str = "seq_id",
    pos: str = "pos",
) -> DataFrame:
    """d loss / d lp of every token row."""
    sizes = tokens.select(batch, seq).distinct().groupBy(batch).agg(F.count(F.lit(1)).alias("_size"))
    grad = -F.col("mask").cast("double") / (F.lit(float(constant)) * F.col("_size") * F.lit(accumulation))
    return lookup_join(tokens, sizes, batch, [seq, pos], how="inner").withColumn("grad", grad).drop("_size")


def _loss_arguments(loss_type: str, cliprange: float | None) -> dict:
    arguments = {
        "no_baseline": {"raw_reward": F.col("raw_reward")},
        "reinforce_with_baseline": {"advantage": F.col("advantage")},
        "grpo_clip": {"advantage": F.col("advantage"), "lp_old": F.col("lp_old"), "cliprange": cliprange},
    }
    return arguments.get(loss_type, {})


def token_losses(tokens: DataFrame, loss_type: str, cliprange: float | None = None) -> DataFrame:
    """Add ``loss`` to token rows that carry lp and what the loss type needs."""
    return tokens.withColumn(
        "loss", policy_gradient_loss(loss_type, F.col("lp"), **_loss_arguments(loss_type, cliprange))
    )


def grpo_loss(
    tokens: DataFrame,
    loss_type: str,
    accumulation: int,
    cliprange: float | None = None,
    batch: str = "batch_id",
) -> DataFrame:
    """One loss per microbatch: the mean over all its unmasked tokens, not a mean of sequence means."""
    scored = token_losses(tokens, loss_type, cliprange)
    means = masked_mean(scored, F.col("loss"), F.col("mask"), by=(batch,))
    return means.select(batch, (F.col("value") / F.lit(accumulation)).alias("loss"))


def grpo_grad(
    tokens: DataFrame,
    loss_type: str,
    accumulation: int,
    cliprange: float | None = None,
    batch: str = "batch_id",
    seq: str = "seq_id",
    pos: str = "pos",
    counts_from: DataFrame | None = None,
) -> DataFrame:
    """d loss / d lp of every token row; NaN in a batch whose mask is empty.

    ``counts_from`` names a base table with the batch and mask of the same tokens, so that the joins behind ``tokens``
    are not run again to count them.
    """
    counts = (tokens if counts_from is None else counts_from).groupBy(batch).agg(F.sum(F.col("mask").cast("bigint")).alias("_count"))
    slope = policy_gradient_slope(loss_type, F.col("lp"), **_loss_arguments(loss_type, cliprange))
    grad = _ratio(slope * F.col("mask").cast("double"), F.col("_count") * F.lit(accumulation))
    return lookup_join(tokens, counts, batch, [seq, pos], how="inner").withColumn("grad", grad).drop("_count")


def accumulate_grads(grads: DataFrame, seq: str = "seq_id", pos: str = "pos") -> DataFrame:
    """Sum the gradients of several microbatches per token."""
    return grads.groupBy(seq, pos).agg(F.sum("grad").alias("grad"))


def clip_fraction(tokens: DataFrame, clipped: Column, mask: Column, by: tuple[str, ...] = ()) -> DataFrame:
    """Share of unmasked tokens whose clipped objective was the lower one."""
    return masked_mean(tokens, clipped.cast("double"), mask, by=by).withColumnRenamed("value", "clip_fraction")
