import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rubrica.functions import losses, numerics
from rubrica.operators import masked, rollouts

CLIP, STEPS = 0.1, 2


@pytest.fixture(scope="module")
def batch():
    rng = np.random.default_rng(3)
    shape = (4, 6)
    lp = -rng.exponential(1.0, shape)
    return {
        "lp": lp,
        "lp_old": lp + rng.normal(0, 0.15, shape),
        "mask": rng.random(shape) > 0.4,
        "advantage": rng.normal(0, 1, (4, 1)),
        "raw_reward": rng.random((4, 1)),
    }


def table(spark, b, lp=None):
    lp = b["lp"] if lp is None else lp
    rows = [
        (0, s, p, float(lp[s, p]), float(b["lp_old"][s, p]), bool(b["mask"][s, p]), float(b["advantage"][s, 0]), float(b["raw_reward"][s, 0]))
        for s in range(lp.shape[0])
        for p in range(lp.shape[1])
    ]
    return spark.createDataFrame(
        rows, "batch_id long, seq_id long, pos long, lp double, lp_old double, mask boolean, advantage double, raw_reward double"
    )


def numpy_loss(b, loss_type, lp):
    if loss_type == "no_baseline":
        per_token = -lp * b["raw_reward"]
    elif loss_type == "reinforce_with_baseline":
        per_token = -lp * b["advantage"]
    else:
        r = np.exp(lp - b["lp_old"])
        per_token = -np.minimum(r * b["advantage"], np.clip(r, 1 - CLIP, 1 + CLIP) * b["advantage"])
    return (per_token * b["mask"]).sum() / b["mask"].sum() / STEPS


def central_differences(f, lp, h=1e-6):
    grad = np.zeros_like(lp)
    for i in np.ndindex(lp.shape):
        up, down = lp.copy(), lp.copy()
        up[i] += h
        down[i] -= h
        grad[i] = (f(up) - f(down)) / (2 * h)
    return grad


@pytest.mark.parametrize("loss_type", losses.LOSS_TYPES)
def test_policy_loss_and_gradient(spark, batch, loss_type):
    tokens = table(spark, batch)
    loss = masked.grpo_loss(tokens, loss_type, STEPS, CLIP).collect()[0].loss
    assert loss == pytest.approx(numpy_loss(batch, loss_type, batch["lp"]), abs=1e-12)
    want = central_differences(lambda lp: numpy_loss(batch, loss_type, lp), batch["lp"])
    for r in masked.grpo_grad(tokens, loss_type, STEPS, CLIP).collect():
        assert r.grad == pytest.approx(want[r.seq_id, r.pos], abs=1e-7)


def test_sft_loss_and_gradient(spark, batch):
    tokens = table(spark, batch)
    f = lambda lp: -(lp * batch["mask"]).sum() / 42.0 / 4 / STEPS
    assert masked.sft_loss(tokens, STEPS, 42.0).collect()[0].loss == pytest.approx(f(batch["lp"]), abs=1e-12)
    want = central_differences(f, batch["lp"])
    grads = masked.sft_grad(tokens, STEPS, 42.0)
    for r in grads.collect():
        assert r.grad == pytest.approx(want[r.seq_id, r.pos], abs=1e-7)
    ten = grads
    for _ in range(9):
        ten = ten.unionByName(grads)
    for r in masked.accumulate_grads(ten).collect():
        assert r.grad == pytest.approx(10 * want[r.seq_id, r.pos], abs=1e-6)


@pytest.mark.parametrize("dim", [None, 0, 1, -1])
def test_masked_reductions(spark, batch, dim):
    tokens = table(spark, batch)
    axis = dim
    total = (batch["lp"] * batch["mask"]).sum(axis=axis)
    count = batch["mask"].sum(axis=axis)
    key = {None: None, 0: "pos", 1: "seq_id", -1: "seq_id"}[dim]
    at = lambda a, r: float(a) if key is None else float(a[r[key]])
    for r in masked.masked_normalize(tokens, F.col("lp"), F.col("mask"), 42.0, dim).collect():
        assert r.value == pytest.approx(at(total / 42.0, r))
    for r in masked.masked_mean(tokens, F.col("lp"), F.col("mask"), dim).collect():
        n = at(count, r)
        assert (math.isnan(r.value) and n == 0) or r.value == pytest.approx(at(total, r) / n)


def test_masked_edges(spark):
    rows = [(0, 0, float("nan"), False), (0, 1, 2.0, True), (1, 0, 5.0, False), (1, 1, 5.0, False)]
    df = spark.createDataFrame(rows, "seq_id long, pos long, x double, m boolean")
    value, mask = F.col("x"), F.col("m")
    by_seq = {r.seq_id: r.value for r in masked.masked_mean(df, value, mask, 1).collect()}
    assert math.isnan(by_seq[0]) and math.isnan(by_seq[1])
    safe = {r.seq_id: r.value for r in masked.masked_mean(df, value, mask, 1, nan_safe=True).collect()}
    assert safe[0] == 2.0 and math.isnan(safe[1])
    per_row = df.withColumn("c", F.lit(4.0))
    got = masked.masked_normalize(per_row, F.col("pos").cast("double"), mask, F.col("c"), 1).orderBy("seq_id").collect()
    assert [r.value for r in got] == [0.25, 0.0]
    with pytest.raises(ValueError):
        masked.masked_mean(df, value, mask, 2)


def test_clip_flags_and_nan(spark, batch):
    tokens = table(spark, batch)
    r = np.exp(batch["lp"] - batch["lp_old"])
    clipped = np.clip(r, 1 - CLIP, 1 + CLIP) * batch["advantage"] < r * batch["advantage"]
    flag = losses.is_clipped(F.col("advantage"), F.col("lp"), F.col("lp_old"), CLIP)
    share = masked.clip_fraction(tokens, flag, F.col("mask")).collect()[0].clip_fraction
    assert share == pytest.approx((clipped & batch["mask"]).sum() / batch["mask"].sum())
    df = spark.createDataFrame([(1.0, float("nan"), 0.0), (1.0, 0.0, float("nan"))], "a double, lp double, o double")
    got = df.select(losses.grpo_clip_loss(F.col("a"), F.col("lp"), F.col("o"), CLIP).alias("l")).collect()
    assert all(math.isnan(g.l) for g in got)


def test_loss_dispatch_refuses_missing_arguments():
    lp = None
    for kwargs in ({"loss_type": "no_baseline"}, {"loss_type": "reinforce_with_baseline"}, {"loss_type": "grpo_clip"}, {"loss_type": "x"}):
        with pytest.raises(ValueError):
            losses.policy_gradient_loss(lp=lp, **kwargs)
        with pytest.raises(ValueError):
            losses.policy_gradient_slope(lp=lp, **kwargs)


def test_dpo_loss(spark):
    rng = np.random.default_rng(1)
    rows, want = [], {}
    for pair in range(3):
        sums = {}
        for model in ("policy", "ref"):
            for side in ("chosen", "rejected"):
                lps, mask = -rng.exponential(1, 5) * (400 if pair == 2 else 1), rng.random(5) > 0.3
                sums[model, side] = float((lps * mask).sum())
                rows += [(pair, model, side, p, float(lps[p]), bool(mask[p])) for p in range(5)]
        x = 0.5 * ((sums["policy", "chosen"] - sums["ref", "chosen"]) - (sums["policy", "rejected"] - sums["ref", "rejected"]))
        want[pair] = float(np.logaddexp(0, -x))
    df = spark.createDataFrame(rows, "pair_id long, model string, side string, pos int, lp double, mask boolean")
    for r in rollouts.dpo_losses(df, 0.5).collect():
        assert r.loss == pytest.approx(want[r.pair_id], rel=1e-12)


def test_array_numerics(column):
    inf = float("inf")
    rng = np.random.default_rng(2)
    logits = [rng.normal(0, 5, 50).astype("float32").tolist() for _ in range(5)] + [[1000.0, 0.0], [0.0, -inf]]
    labels = [3, 0, 49, 7, 11, 0, 0]

    def log_softmax(x):
        x = np.array(x, dtype="float64")
        return x - x.max() - np.log(np.exp(x - x.max()).sum())

    got = column(numerics.entropy, logits, "array<float>")
    for x, g in zip(logits, got):
        lp = log_softmax(x)
        terms = np.where(np.exp(lp) > 0, np.exp(lp) * np.where(np.isfinite(lp), lp, 0), 0)
        assert g == pytest.approx(-terms.sum(), abs=1e-12)
    assert column(numerics.entropy, [[-inf, -inf]], "array<float>") == [0.0]
    pairs = list(zip(logits, labels))
    for (x, y), g in zip(pairs, column(numerics.label_log_prob, pairs, ["array<float>", "int"])):
        assert g == pytest.approx(log_softmax(x)[y], abs=1e-12)
    assert column(numerics.log_softmax, logits[:1], "array<float>")[0] == pytest.approx(log_softmax(logits[0]).tolist())


REWARDS = [0.3, 0.3, 0.9, 0.1, 0.5, 0.5, 0.5, 0.5, 1.0, 0.0]


@pytest.mark.parametrize("by_std", [False, True])
def test_group_advantages(spark, by_std):
    df = spark.createDataFrame(list(enumerate(REWARDS)), "i long, reward double").withColumn(
        "g", rollouts.positional_group(F.col("i"), 4)
    )
    got = rollouts.group_advantages(df, "g", "reward", "i", 1e-6, by_std, group_size=4).orderBy("i").collect()
    for g in range(2):
        part = np.array(REWARDS[4 * g : 4 * g + 4])
        want = (part - part.mean()) / (part.std(ddof=1) + 1e-6 if by_std else 1.0)
        assert [r.advantage for r in got[4 * g : 4 * g + 4]] == pytest.approx(want.tolist(), abs=1e-9)
    assert [r.advantage for r in got[8:]] == [0.0, 0.0]
    free = rollouts.group_advantages(df, "g", "reward", "i", normalize_by_std=by_std).groupBy("g").agg(F.sum("advantage").alias("s"))
    assert all(abs(r.s) < 1e-9 for r in free.collect())


def test_a_huge_group_is_split_and_gives_the_same_advantages(spark, monkeypatch):
    from rubrica.operators import skew

    df = spark.range(900).select("id", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 100).alias("g"), (F.col("id") % 7 / 7).alias("r"))
    plain = {r.id: r.advantage for r in rollouts.group_advantages(df, "g", "r", "id", normalize_by_std=True).collect()}
    monkeypatch.setattr(skew, "fits_broadcast", lambda _: False)
    monkeypatch.setattr(skew.lookup_join, "__defaults__", ("left", 50, None))
    split = {r.id: r.advantage for r in rollouts.group_advantages(df, "g", "r", "id", normalize_by_std=True).collect()}
    assert split.keys() == plain.keys() and all(split[i] == pytest.approx(plain[i], abs=1e-9) for i in plain)


def test_single_row_group_has_no_deviation(spark):
    df = spark.createDataFrame([(0, 0, 1.0)], "i long, g long, reward double")
    assert math.isnan(rollouts.group_advantages(df, "g", "reward", "i", normalize_by_std=True).collect()[0].advantage)


def test_preference_pairs(spark):
    rows = [(1, 1, 0.5, "a"), (1, 2, 0.9, "b"), (1, 3, 0.9, "c"), (1, 4, 0.5, "d"), (2, 5, 0.5, "e"), (2, 6, 0.5, "f"), (3, 7, 1.0, "g")]
    df = spark.createDataFrame(rows, "p long, i long, r double, t string")
    got = rollouts.preference_pairs(df, "p", "i", "r", "t").collect()
    assert [tuple(r) for r in got] == [(1, 2, 1, "b", "a")]


def test_grid_and_fan_out(spark):
    prompts = spark.createDataFrame([(1, "q1"), (2, "q2")], "p long, q string")
    grid = rollouts.rollout_grid(prompts.select("p"), 3)
    got = rollouts.fan_out(grid, prompts, "p", "rollout").orderBy("p", "rollout").collect()
    assert [(r.p, r.rollout, r.q) for r in got] == [(p, i, f"q{p}") for p in (1, 2) for i in range(3)]
