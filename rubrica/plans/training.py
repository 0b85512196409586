"""Rollouts, losses, gradients, sequences and order over the driver tables."""

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rubrica.functions import grade, losses, numerics
from rubrica.functions.prompts import chat_text, message, safety_judge_messages
from rubrica.operators import masked, ordering, report, rollouts, sequences
from rubrica.operators.scratch import scratch_path
from rubrica.operators.skew import spread
from rubrica.plans.derive import completions, sql_render, sql_text
from rubrica.plans.grading import sql_r1_zero
from rubrica.plans.registry import query, table
from rubrica.sources import tables
from rubrica import templates

CLIP = 0.02
STEPS = 4


def _r6(name: str) -> Column:
    return F.round(name, 6).alias(name)


# --- tokens: one row per element of an embedding ------------------------------------------------------------------

TOKENS_SQL = """
    SELECT vec_id AS seq_id, vec_id // 16 AS batch_id, pos - 1 AS pos, -abs(x) AS lp, -abs(x) + 0.3 * x AS lp_old,
           x > 0 AS mask, x AS value, label / 10.0::DOUBLE AS raw_reward
    FROM (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, unnest(range(1, len(embedding) + 1)) AS pos FROM embeddings)
"""
ADVANTAGE_SQL = """
    SELECT vec_id AS seq_id, label / 10.0::DOUBLE AS raw_reward, (label / 10.0::DOUBLE - avg(label / 10.0::DOUBLE) OVER g)
           / (stddev_samp(label / 10.0::DOUBLE) OVER g + 1e-6) AS advantage
    FROM embeddings WINDOW g AS (PARTITION BY vec_id // 8)
"""
SCORED_TOKENS_SQL = f"SELECT t.*, a.advantage FROM ({TOKENS_SQL}) t JOIN ({ADVANTAGE_SQL}) a USING (seq_id)"
RATIO_SQL = "exp(lp - lp_old)"
CLAMP_SQL = f"least(greatest({RATIO_SQL}, 1 - {CLIP}), 1 + {CLIP})"
CLIP_LOSS_SQL = f"-least({RATIO_SQL} * advantage, {CLAMP_SQL} * advantage)"
CLIPPED_SQL = f"({CLAMP_SQL} * advantage < {RATIO_SQL} * advantage)"


def _tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("pos", "x"))
    x = F.col("x").cast("double")
    return rows.select(
        F.col("vec_id").alias("seq_id"),
        F.floor(F.col("vec_id") / 16).alias("batch_id"),
        F.col("pos").cast("bigint").alias("pos"),
        (-F.abs(x)).alias("lp"),
        (x > 0).alias("mask"),
        x.alias("value"),
    )


def _old_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tokens(spark, sf_dir).select("seq_id", "pos", (F.col("lp") + 0.3 * F.col("value")).alias("lp"))


def _rollouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("seq_id"),
        rollouts.positional_group(F.col("vec_id"), 8).alias("group_id"),
        (F.col("label") / F.lit(10.0)).alias("raw_reward"),
    )
    scored = rollouts.group_advantages(rows, "group_id", "raw_reward", "seq_id", normalize_by_std=True)
    return scored.select("seq_id", "raw_reward", "advantage")


def _scored_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = rollouts.align_log_probs(_tokens(spark, sf_dir), _old_tokens(spark, sf_dir))
    return rollouts.with_sequence_scalars(aligned, _rollouts(spark, sf_dir))


def _reduction(kind: str, dim: int | None):
    keys = {None: [], 0: ["pos"], 1: ["seq_id"]}[dim]
    masked_sum = "sum(value * mask::INT)"
    formula = f"{masked_sum} / 42.0" if kind == "normalize" else f"{masked_sum} / sum(mask::INT)"
    picked, grouped = ", ".join(keys), f" GROUP BY {', '.join(keys)}" if keys else ""
    sql = f"SELECT {picked + ', ' if keys else ''}round({formula}, 6) AS value FROM ({TOKENS_SQL}){grouped}"

    @query(f"masked_{kind}_{'none' if dim is None else f'dim{dim}'}", sql)
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        tokens, value, mask = _tokens(spark, sf_dir), F.col("value"), F.col("mask")
        if kind == "normalize":
            reduced = masked.masked_normalize(tokens, value, mask, 42.0, dim)
        else:
            reduced = masked.masked_mean(tokens, value, mask, dim)
        return reduced.withColumn("value", F.round("value", 6))


for _kind in ("normalize", "mean"):
    for _dim in (None, 0, 1):
        _reduction(_kind, _dim)


@query(
    "sequence_stats",
    "SELECT seq_id, sum(mask::INT)::BIGINT AS length, round(sum(value * mask::INT) / sum(mask::INT), 6) AS entropy "
    f"FROM ({TOKENS_SQL}) GROUP BY seq_id",
)
def sequence_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = masked.sequence_stats(_tokens(spark, sf_dir), F.col("value"), F.col("mask"))
    return stats.select("seq_id", "length", _r6("entropy"))


@query(
    "generation_log",
    f"SELECT doc_id AS item_id, reward, coalesce(length, 0) AS length, round(entropy, 6) AS entropy FROM ({sql_r1_zero('doc_id')}) LEFT JOIN ("
    "SELECT seq_id AS doc_id, sum(mask::INT)::BIGINT AS length, sum(value * mask::INT) / sum(mask::INT) AS entropy "
    f"FROM ({TOKENS_SQL}) GROUP BY seq_id) USING (doc_id)",
)
def generation_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per generation: its reward, the number of its tokens and their mean entropy."""
    texts = completions(spark, sf_dir).select(F.col("doc_id").alias("item_id"), "generated_text", F.col("truth").alias("answer"))
    tokens = _tokens(spark, sf_dir).withColumnsRenamed({"seq_id": "item_id", "value": "entropy"})
    log = report.generation_log(texts, tokens, "item_id")
    return log.select("item_id", "metrics.reward", "length", _r6("entropy"))


@query(
    "sft_loss",
    f"SELECT batch_id, round(-sum(lp * mask::INT) / 42.0 / count(DISTINCT seq_id) / {STEPS}, 6) AS loss "
    f"FROM ({TOKENS_SQL}) GROUP BY batch_id",
)
def sft_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masked.sft_loss(_tokens(spark, sf_dir), STEPS, 42.0).select("batch_id", _r6("loss"))


@query(
    "sft_grad",
    f"SELECT t.seq_id, t.pos, round(-mask::INT / (42.0 * b * {STEPS}), 8) + 0.0 AS grad FROM ({TOKENS_SQL}) t JOIN "
    f"(SELECT batch_id, count(DISTINCT seq_id) AS b FROM ({TOKENS_SQL}) GROUP BY batch_id) USING (batch_id)",
)
def sft_grad(spark: SparkSession, sf_dir: str) -> DataFrame:
    grads = masked.sft_grad(_tokens(spark, sf_dir), STEPS, 42.0)
    return grads.select("seq_id", "pos", (F.round("grad", 8) + 0.0).alias("grad"))


@query(
    "advantage_mean",
    "SELECT event_id, round(value - avg(value) OVER (PARTITION BY user_id), 9) + 0.0 AS advantage FROM events",
)
def advantage_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    scored = rollouts.group_advantages(events, "user_id", "value", "event_id")
    return scored.select("event_id", (F.round("advantage", 9) + 0.0).alias("advantage"))


HASH_SQL = (
    "(list_reduce(list_transform(string_split(sha256(text), ''), lambda c: (strpos('0123456789abcdef', c) - 1)::BIGINT), "
    "lambda acc, d: (acc * 16 + d) % 10) / 10.0::DOUBLE)"
)


@query("hash_reward", f"SELECT conv_id, turn, {HASH_SQL} AS reward FROM conversations")
def hash_reward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", grade.hash_reward(F.col("text"))["reward"].alias("reward")
    )


def _assistant_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").where("role = 'assistant'").select(
        "conv_id", "turn", "text", grade.hash_reward(F.col("text"))["reward"].alias("reward")
    )


ASSISTANT_SQL = f"SELECT conv_id, turn, text, {HASH_SQL} AS reward FROM conversations WHERE role = 'assistant'"


@query(
    "advantage_std",
    "SELECT conv_id, turn, reward, CASE WHEN count(*) OVER g > 1 THEN round((reward - avg(reward) OVER g) / "
    f"(stddev_samp(reward) OVER g + 1e-6), 4) + 0.0 END AS advantage FROM ({ASSISTANT_SQL}) "
    "WINDOW g AS (PARTITION BY conv_id)",
)
def advantage_std(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = rollouts.group_advantages(
        _assistant_turns(spark, sf_dir), "conv_id", "reward", ["conv_id", "turn"], normalize_by_std=True
    )
    shown = F.when(~F.isnan("advantage"), F.round("advantage", 4) + 0.0)
    return scored.select("conv_id", "turn", "reward", shown.alias("advantage"))


@query(
    "advantage_tail",
    "SELECT event_id, CASE WHEN count(*) OVER g < 48 THEN 0.0 ELSE "
    "round(value - avg(value) OVER g, 6) + 0.0 END AS advantage FROM events WINDOW g AS (PARTITION BY event_id // 48)",
)
def advantage_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    group = rollouts.positional_group(F.col("event_id"), 48)
    events = table(spark, sf_dir, "events").select("event_id", "value", group.alias("group_id"))
    scored = rollouts.group_advantages(events, "group_id", "value", "event_id", group_size=48)
    return scored.select("event_id", (F.round("advantage", 6) + 0.0).alias("advantage"))


@query(
    "rollout_fanout",
    "SELECT c.conv_id, c.turn, r AS rollout, q.text AS question, sha256(c.text) AS response FROM conversations c "
    "JOIN (SELECT conv_id, min(text) AS text FROM conversations WHERE role = 'user' GROUP BY conv_id) q USING (conv_id), "
    "range(0, 3) rr(r) WHERE c.role = 'assistant'",
)
def rollout_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    prompts = conversations.where("role = 'user'").groupBy("conv_id").agg(F.min("text").alias("question"))
    responses = conversations.where("role = 'assistant'").select("conv_id", "turn", F.sha2("text", 256).alias("response"))
    grid = rollouts.rollout_grid(responses, 3)
    return rollouts.fan_out(grid, prompts, "conv_id", ["turn", "rollout"]).select(
        "conv_id", "turn", F.col("rollout").cast("bigint").alias("rollout"), "question", "response"
    )


def _loss_query(loss_type: str, sql_loss: str) -> None:
    @query(f"pg_loss_{loss_type}", f"SELECT seq_id, pos, round({sql_loss}, 6) + 0.0 AS loss FROM ({SCORED_TOKENS_SQL})")
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        scored = masked.token_losses(_scored_tokens(spark, sf_dir), loss_type, CLIP)
        return scored.select("seq_id", "pos", (F.round("loss", 6) + 0.0).alias("loss"))


_loss_query("no_baseline", "-lp * raw_reward")
_loss_query("reinforce_with_baseline", "-lp * advantage")
_loss_query("grpo_clip", CLIP_LOSS_SQL)


@query(
    "grpo_clip_loss",
    f"SELECT seq_id, round(sum({CLIP_LOSS_SQL}), 6) + 0.0 AS loss FROM ({SCORED_TOKENS_SQL}) GROUP BY seq_id",
)
def grpo_clip_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    loss = losses.grpo_clip_loss(F.col("advantage"), F.col("lp"), F.col("lp_old"), CLIP)
    totals = _scored_tokens(spark, sf_dir).groupBy("seq_id").agg(F.sum(loss).alias("loss"))
    return totals.select("seq_id", (F.round("loss", 6) + 0.0).alias("loss"))


def _bucketed(df: DataFrame, name: str, buckets: int = 8) -> DataFrame:
    unique = f"{name}_{uuid.uuid4().hex}"
    return tables.write_token_table(df, unique, scratch_path(df.sparkSession, unique), buckets)


@query(
    "align_bucketed",
    f"SELECT seq_id, pos, round({RATIO_SQL}, 6) AS ratio FROM ({TOKENS_SQL})",
)
def align_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Policy and old log-probabilities as bucketed tables, aligned without an exchange."""
    policy, old = _bucketed(_tokens(spark, sf_dir), "policy_tokens"), _bucketed(_old_tokens(spark, sf_dir), "old_tokens")
    aligned = rollouts.align_log_probs(policy, old)
    return aligned.select("seq_id", "pos", F.round(F.exp(F.col("lp") - F.col("lp_old")), 6).alias("ratio"))


@query(
    "grpo_loss",
    f"SELECT batch_id, round(sum({CLIP_LOSS_SQL} * mask::INT) / sum(mask::INT) / {STEPS}, 6) AS loss "
    f"FROM ({SCORED_TOKENS_SQL}) GROUP BY batch_id",
)
def grpo_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masked.grpo_loss(_scored_tokens(spark, sf_dir), "grpo_clip", STEPS, CLIP).select("batch_id", _r6("loss"))


@query(
    "grpo_grad",
    f"SELECT seq_id, pos, round(CASE WHEN {CLIPPED_SQL} THEN 0 ELSE -advantage * {RATIO_SQL} END * mask::INT / "
    f"(sum(mask::INT) OVER (PARTITION BY batch_id) * {STEPS}), 8) + 0.0 AS grad FROM ({SCORED_TOKENS_SQL})",
)
def grpo_grad(spark: SparkSession, sf_dir: str) -> DataFrame:
    grads = masked.grpo_grad(
        _scored_tokens(spark, sf_dir), "grpo_clip", STEPS, CLIP, counts_from=_tokens(spark, sf_dir)
    )
    return grads.select("seq_id", "pos", (F.round("grad", 8) + 0.0).alias("grad"))


@query(
    "accumulate_grads",
    f"SELECT t.seq_id, t.pos, round(-2 * mask::INT / (42.0 * b * {STEPS}), 8) + 0.0 AS grad FROM ({TOKENS_SQL}) t JOIN "
    f"(SELECT batch_id, count(DISTINCT seq_id) AS b FROM ({TOKENS_SQL}) GROUP BY batch_id) USING (batch_id)",
)
def accumulate_grads(spark: SparkSession, sf_dir: str) -> DataFrame:
    grads = masked.sft_grad(_tokens(spark, sf_dir), STEPS, 42.0)
    total = masked.accumulate_grads(grads.unionByName(grads))
    return total.select("seq_id", "pos", (F.round("grad", 8) + 0.0).alias("grad"))


@query(
    "clip_fraction",
    f"SELECT batch_id, round(sum({CLIPPED_SQL}::INT * mask::INT) / sum(mask::INT), 6) AS clip_fraction "
    f"FROM ({SCORED_TOKENS_SQL}) GROUP BY batch_id",
)
def clip_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    clipped = losses.is_clipped(F.col("advantage"), F.col("lp"), F.col("lp_old"), CLIP)
    shares = masked.clip_fraction(_scored_tokens(spark, sf_dir), clipped, F.col("mask"), by=("batch_id",))
    return shares.select("batch_id", _r6("clip_fraction"))


@query(
    "preference_pairs",
    f"""
    WITH s AS ({ASSISTANT_SQL}),
    r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY reward DESC, turn) AS up,
                 row_number() OVER (PARTITION BY conv_id ORDER BY reward, turn) AS down FROM s)
    SELECT b.conv_id, b.turn AS chosen_id, w.turn AS rejected_id, b.text AS chosen, w.text AS rejected
    FROM r b JOIN r w USING (conv_id) WHERE b.up = 1 AND w.down = 1 AND b.reward > w.reward
    """,
)
def preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollouts.preference_pairs(_assistant_turns(spark, sf_dir), "conv_id", "turn", "reward", "text")


@query(
    "dpo_loss",
    f"""
    WITH t AS ({TOKENS_SQL}),
    s AS (SELECT seq_id // 2 AS pair_id,
                 sum(CASE WHEN seq_id % 2 = 0 THEN lp * mask::INT ELSE 0 END) AS pc,
                 sum(CASE WHEN seq_id % 2 = 0 THEN lp_old * mask::INT ELSE 0 END) AS rc,
                 sum(CASE WHEN seq_id % 2 = 1 THEN lp * mask::INT ELSE 0 END) AS pr,
                 sum(CASE WHEN seq_id % 2 = 1 THEN lp_old * mask::INT ELSE 0 END) AS rr FROM t GROUP BY seq_id // 2)
    SELECT pair_id, round(ln(1 + exp(-0.5 * ((pc - rc) - (pr - rr)))), 6) AS loss FROM s
    """,
)
def dpo_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    side = F.when(F.col("seq_id") % 2 == 0, "chosen").otherwise("rejected")
    tokens = _tokens(spark, sf_dir)
    ref_lp = F.col("lp") + 0.3 * F.col("value")
    both = tokens.withColumn("model", F.lit("policy")).unionByName(
        tokens.withColumn("lp", ref_lp).withColumn("model", F.lit("ref"))
    )
    pairs = both.withColumns({"pair_id": F.floor(F.col("seq_id") / 2), "side": side})
    return rollouts.dpo_losses(pairs, 0.5).select("pair_id", _r6("loss"))


# --- array numerics -----------------------------------------------------------------------------------------------

LOGITS_SQL = """
    SELECT *, list_max(e) + ln(list_sum(list_transform(e, lambda v: exp(v - list_max(e))))) AS lse
    FROM (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings)
"""


@query(
    "token_entropy",
    f"SELECT vec_id, round(-list_sum(list_transform(e, lambda v: exp(v - lse) * (v - lse))), 6) AS entropy FROM ({LOGITS_SQL})",
)
def token_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.round(numerics.entropy(F.col("embedding")), 6).alias("entropy")
    )


@query("label_log_prob", f"SELECT vec_id, round(e[label + 1] - lse, 6) AS log_prob FROM ({LOGITS_SQL})")
def label_log_prob(spark: SparkSession, sf_dir: str) -> DataFrame:
    log_prob = numerics.label_log_prob(F.col("embedding"), F.col("label"))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(log_prob, 6).alias("log_prob"))


@query(
    "numeric_close",
    "SELECT l_orderkey, l_linenumber, abs(p - q) <= 1e-4 * greatest(abs(p), abs(q)) AS is_close FROM ("
    "SELECT l_orderkey, l_linenumber, l_extendedprice AS p, l_extendedprice * (1 + l_discount / 430) AS q FROM lineitem)",
)
def numeric_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice")
    close = grade.numeric_close(price, price * (1 + F.col("l_discount") / 430))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", close.alias("is_close"))


# --- sequences and order ------------------------------------------------------------------------------------------


def _code_points(text: str) -> Column:
    """Stand-in token ids: the characters' code points."""
    return F.transform(F.split(text, ""), lambda c: F.ascii(c))


def _digest(ids: str) -> Column:
    return F.md5(F.array_join(F.col(ids).cast("array<string>"), ",")).alias(ids)


@query(
    "shift_labels",
    "SELECT seq_id, pos, token_id, lead(token_id) OVER (PARTITION BY seq_id ORDER BY pos) AS label FROM ("
    "SELECT vec_id AS seq_id, unnest(range(0, len(embedding))) AS pos, "
    "floor(unnest(embedding)::DOUBLE * 1000)::BIGINT AS token_id FROM embeddings)",
)
def shift_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("seq_id"), F.posexplode("embedding").alias("pos", "x")
    )
    tokens = rows.select("seq_id", F.col("pos").cast("bigint").alias("pos"), F.floor(F.col("x").cast("double") * 1000).alias("token_id"))
    return sequences.shift_labels(tokens)


@query(
    "shape_sequences",
    """
    WITH pairs AS (SELECT u.conv_id, u.turn, u.conv_id // 8 AS batch_id,
                          list_transform(string_split(u.text, ''), lambda c: unicode(c)) AS p,
                          list_transform(string_split(a.text, ''), lambda c: unicode(c)) AS o
                   FROM conversations u JOIN conversations a ON u.conv_id = a.conv_id AND a.turn = u.turn + 1
                   WHERE u.role = 'user' AND a.role = 'assistant'),
    sized AS (SELECT *, len(p) AS np, len(p) + len(o) AS total,
                     max(len(p) + len(o)) OVER (PARTITION BY batch_id) - 1 AS width FROM pairs),
    padded AS (SELECT *, list_concat(list_concat(p, o), list_transform(range(width), lambda i: 0)) AS ids FROM sized)
    SELECT conv_id, turn, width::BIGINT AS width, md5(array_to_string(ids[1:width], ',')) AS input_ids,
           md5(array_to_string(ids[2:width + 1], ',')) AS labels,
           md5(array_to_string(list_transform(range(width),
               lambda i: CASE WHEN i >= np - 1 AND i < total - 1 THEN 1 ELSE 0 END), ',')) AS response_mask
    FROM padded
    """,
)
def shape_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spread(table(spark, sf_dir, "conversations"), "conv_id")
    users = turns.where("role = 'user'").select("conv_id", "turn", _code_points("text").alias("prompt_ids"))
    replies = turns.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), _code_points("text").alias("output_ids")
    )
    pairs = users.join(replies, ["conv_id", "turn"]).withColumn("batch_id", F.floor(F.col("conv_id") / 8))
    shaped = sequences.shape_sequences(pairs, "prompt_ids", "output_ids", 0, "batch_id", ["conv_id", "turn"])
    mask = F.md5(F.array_join(F.col("response_mask").cast("array<int>").cast("array<string>"), ","))
    return shaped.select(
        "conv_id", "turn", F.size("labels").cast("bigint").alias("width"), _digest("input_ids"), _digest("labels"),
        mask.alias("response_mask"),
    )


def _sql_pack(order: str) -> str:
    return f"""
    WITH docs AS (SELECT list_concat(list_concat([1], list_transform(string_split(text, ''), lambda c: unicode(c))), [2])
                         AS ids, {order} AS k, doc_id FROM documents),
    placed AS (SELECT ids, coalesce(sum(len(ids)) OVER (ORDER BY k, doc_id ROWS BETWEEN UNBOUNDED PRECEDING
                      AND 1 PRECEDING), 0)::BIGINT AS start FROM docs),
    stream AS (SELECT start + unnest(range(len(ids))) AS place, unnest(ids) AS id FROM placed),
    chunks AS (SELECT place // 128 AS chunk_id, list(id ORDER BY place) AS ids FROM stream GROUP BY place // 128),
    joined AS (SELECT a.chunk_id, a.ids, list_append(a.ids[2:], b.ids[1]) AS next FROM chunks a
               JOIN chunks b ON b.chunk_id = a.chunk_id + 1)
    SELECT chunk_id, md5(array_to_string(ids, ',')) AS input_ids, md5(array_to_string(next, ',')) AS labels FROM joined
    """


def _packed(spark: SparkSession, sf_dir: str, seed: str | None) -> DataFrame:
    scan = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    documents = scan.select("doc_id", _code_points("text").alias("ids"), F.length("text").alias("n"))
    packed = sequences.pack_sequences(
        documents, "doc_id", "ids", 128, prefix_ids=[1], suffix_ids=[2], seed=seed, length="n"
    )
    return packed.select(F.col("chunk_id").cast("bigint").alias("chunk_id"), _digest("input_ids"), _digest("labels"))


@query("pack_sequences", _sql_pack("doc_id"))
def pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _packed(spark, sf_dir, None)


@query("pack_shuffled", _sql_pack("md5('7|' || doc_id::VARCHAR)"))
def pack_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _packed(spark, sf_dir, "7")


@query(
    "assign_batches",
    "SELECT event_id, p // 32 AS batch_id, p % 32 AS slot FROM "
    "(SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS p FROM events)",
)
def assign_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.assign_batches(table(spark, sf_dir, "events").select("event_id"), "event_id", 32)


@query(
    "assign_batches_shuffled",
    "SELECT event_id, p // 32 AS batch_id, p % 32 AS slot FROM (SELECT event_id, "
    "row_number() OVER (ORDER BY md5('3|' || event_id::VARCHAR), event_id) - 1 AS p FROM events)",
)
def assign_batches_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.assign_batches(table(spark, sf_dir, "events").select("event_id"), "event_id", 32, seed=3)


@query(
    "split_positional",
    "SELECT doc_id, text, CASE WHEN row_number() OVER (ORDER BY doc_id) - 1 < floor((SELECT count(*) FROM documents) * "
    "0.6::DOUBLE) THEN 'train' ELSE 'validation' END AS split FROM documents",
)
def split_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.split_positional(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")


@query(
    "shuffle_seeded",
    "SELECT doc_id, row_number() OVER (ORDER BY md5('42|' || doc_id::VARCHAR), doc_id) - 1 AS position FROM documents",
)
def shuffle_seeded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.with_shuffled_position(table(spark, sf_dir, "documents").select("doc_id"), 42, "doc_id")


@query(
    "position_by_url",
    "SELECT page_id, row_number() OVER (ORDER BY url, page_id) - 1 AS position FROM pages",
)
def position_by_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = table(spark, sf_dir, "pages").select("page_id", F.struct("url", "page_id").alias("place"))
    return ordering.with_position(keyed, "place").select("page_id", "position")


@query(
    "split_by_text_key",
    "SELECT url_key, CASE WHEN row_number() OVER (ORDER BY url_key) <= floor(count(*) OVER () * 0.25) THEN 'train' ELSE 'validation' END "
    "AS split FROM (SELECT url || '#' || page_id AS url_key FROM pages)",
)
def split_by_text_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = table(spark, sf_dir, "pages").select(F.concat("url", F.lit("#"), F.col("page_id").cast("string")).alias("url_key"))
    return ordering.split_positional(keyed, "url_key", 0.25)


# --- chats ----------------------------------------------------------------------------------------------------------


@query(
    "chat_template",
    f"""
    SELECT conv_id, {sql_text(templates.CHAT_BEGIN)} || string_agg({sql_text(templates.CHAT_ROLE_OPEN)} || role ||
           {sql_text(templates.CHAT_ROLE_CLOSE)} || regexp_replace(regexp_replace(said, '^\\s+', ''), '\\s+$', '') || {sql_text(templates.CHAT_TURN_END)}, '' ORDER BY turn) ||
           {sql_text(templates.CHAT_ROLE_OPEN + 'assistant' + templates.CHAT_ROLE_CLOSE)} AS prompt
    FROM (SELECT *, chr(10) || chr(9) || ' ' || text || chr(10) || chr(10) AS said FROM conversations) GROUP BY conv_id
    """,
)
def chat_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    messages = F.transform(turns, lambda t: message(t["role"], F.concat(F.lit("\n\t "), t["text"], F.lit("\n\n"))))
    folded = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(messages.alias("messages"))
    return folded.select("conv_id", chat_text(F.col("messages")).alias("prompt"))


@query(
    "judge_messages",
    f"""
    SELECT u.conv_id, u.turn, {sql_text('system|' + templates.SAFETY_JUDGE_SYSTEM)} AS m1,
           'user|' || {sql_render(templates.SAFETY_JUDGE_USER, request='u.text', response='a.text')} AS m2
    FROM conversations u JOIN conversations a ON u.conv_id = a.conv_id AND a.turn = u.turn + 1
    WHERE u.role = 'user' AND a.role = 'assistant'
    """,
)
def judge_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    users = turns.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("prompts_final"))
    replies = turns.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("output"))
    messages = safety_judge_messages(F.col("prompts_final"), F.col("output"))
    flat = [F.concat_ws("|", messages[i]["role"], messages[i]["content"]).alias(f"m{i + 1}") for i in (0, 1)]
    return users.join(replies, ["conv_id", "turn"]).select("conv_id", "turn", *flat)
