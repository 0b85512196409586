"""Per-token policy losses and their closed-form derivatives with respect to the log-probability."""

from pyspark.sql import Column
from pyspark.sql import functions as F

LOSS_TYPES = ("no_baseline", "reinforce_with_baseline", "grpo_clip")


def pg_loss(advantage: Column, lp: Column) -> Column:
    return -lp * advantage


def ratio(lp: Column, lp_old: Column) -> Column:
    return F.exp(lp - lp_old)


def _clamped(r: Column, cliprange: float) -> Column:
    return F.least(F.greatest(r, F.lit(1.0 - cliprange)), F.lit(1.0 + cliprange))


def grpo_clip_loss(advantage: Column, lp: Column, lp_old: Column, cliprange: float) -> Column:
    """Negative minimum of the plain and the clipped objective; NaN stays NaN (Spark's least would hide it)."""
    plain = ratio(lp, lp_old) * advantage
    clipped = _clamped(ratio(lp, lp_old), cliprange) * advantage
    return F.when(F.isnan(plain), F.lit(float("nan"))).otherwise(-F.least(plain, clipped))


def is_clipped(advantage: Column, lp: Column, lp_old: Column, cliprange: float) -> Column:
    """True where the clipped objective is strictly the lower one."""
    r = ratio(lp, lp_old)
    return ~F.isnan(r * advantage) & (_clamped(r, cliprange) * advantage < r * advantage)


def _require(loss_type: str, **given) -> None:
    if loss_type not in LOSS_TYPES:
        raise ValueError(f"unknown loss_type {loss_type!r}; choose one of {LOSS_TYPES}")
    needed = {
        "no_baseline": ("raw_reward",),
        "reinforce_with_baseline": ("advantage",),
        "grpo_clip": ("advantage", "lp_old", "cliprange"),
    }[loss_type]
    missing = [name for name in needed if given[name] is None]
    if missing:
        raise ValueError(f"{loss_type} needs {', '.join(missing)}")


def policy_gradient_loss(
    loss_type: str,
    lp: Column,
    raw_reward: Column | None = None,
    advantage: Column | None = None,
    lp_old: Column | None = None,
    cliprange: float | None = None,
) -> Column:
    _require(loss_type, raw_reward=raw_reward, advantage=advantage, lp_old=lp_old, cliprange=cliprange)
    if loss_type == "no_baseline":
        return pg_loss(raw_reward, lp)
    if loss_type == "reinforce_with_baseline":
        return pg_loss(advantage, lp)
    return grpo_clip_loss(advantage, lp, lp_old, cliprange)


def policy_gradient_slope(
    loss_type: str,
    lp: Column,
    raw_reward: Column | None = None,
    advantage: Column | None = None,
    lp_old: Column | None = None,
    cliprange: float | None = None,
) -> Column:
    """d loss / d lp per token. A clipped token has slope zero."""
    _require(loss_type, raw_reward=raw_reward, advantage=advantage, lp_old=lp_old, cliprange=cliprange)
    if loss_type == "no_baseline":
        return -raw_reward
    if loss_type == "reinforce_with_baseline":
        return -advantage
    slope = -advantage * ratio(lp, lp_old)
    return F.when(is_clipped(advantage, lp, lp_old, cliprange), 0.0).otherwise(slope)


def dpo_loss(policy_chosen: Column, ref_chosen: Column, policy_rejected: Column, ref_rejected: Column, beta: float):
    """-log sigmoid of the scaled margin, in the form that does not overflow."""
    x = beta * ((policy_chosen - ref_chosen) - (policy_rejected - ref_rejected))
    return F.greatest(-x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))
