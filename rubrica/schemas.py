"""Fixed schemas of the engine's tables (inference is never used for metrics)."""

from pyspark.sql import types as T

REWARD = T.StructType(
    [
        T.StructField("format_reward", T.DoubleType()),
        T.StructField("answer_reward", T.DoubleType()),
        T.StructField("reward", T.DoubleType()),
    ]
)

PROBLEM = T.StructType([T.StructField("problem", T.StringType()), T.StructField("solution", T.StringType())])

PROMPTS = T.StructType(
    [
        T.StructField("item_id", T.LongType()),
        T.StructField("question", T.StringType()),
        T.StructField("truths", T.ArrayType(T.StringType())),
    ]
)

COMPLETIONS = T.StructType(
    [
        T.StructField("item_id", T.LongType()),
        T.StructField("rollout", T.LongType()),
        T.StructField("generated_text", T.StringType()),
    ]
)

SCORED = T.StructType(
    [
        T.StructField("prompt", T.StringType()),
        T.StructField("answer", T.StringType()),
        T.StructField("generated_text", T.StringType()),
        T.StructField("metrics", REWARD),
    ]
)

SFT = T.StructType([T.StructField("prompt", T.StringType()), T.StructField("output", T.StringType())])

SAFETY_PROMPTS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("harm_area", T.StringType()),
        T.StructField("counter", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("prompts_final", T.StringType()),
    ]
)

MCQ_FILE = T.StructType([T.StructField(n, T.StringType()) for n in ("question", "a", "b", "c", "d", "answer")])

MCQ = T.StructType(
    [
        T.StructField("subject", T.StringType()),
        T.StructField("split", T.StringType()),
        T.StructField("question", T.StringType()),
        T.StructField("options", T.ArrayType(T.StringType())),
        T.StructField("answer", T.StringType()),
    ]
)
