"""Filtering, pairing and augmenting of scored tables."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rubrica.functions.extract import strip_think
from rubrica.operators.skew import lookup_join


def rejection_filter(scored: DataFrame, prompt: str = "prompt", text: str = "generated_text") -> DataFrame:
    """Fully rewarded completions as fine-tuning rows ``{prompt, output}``."""
    return scored.where(F.col("metrics.reward") == 1.0).select(
        F.col(prompt).alias("prompt"), strip_think(F.col(text)).alias("output")
    )


def augment(df: DataFrame, **fields: Column) -> DataFrame:
    """All input columns plus new ones; a new column replaces one of the same name."""
    return df.withColumns(fields)


def pair_by_key(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """One-to-one pairing by key; like zipping lists, what has no partner is dropped."""
    return left.join(right, on, "inner")


def unmatched(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Keys found on one side only, with the side; empty when the pairing is complete."""
    only_left = left.join(right, on, "left_anti").select(on, F.lit("left").alias("side"))
    only_right = right.join(left, on, "left_anti").select(on, F.lit("right").alias("side"))
    return only_left.unionByName(only_right)


def assert_complete(left: DataFrame, right: DataFrame, on: str) -> None:
    """Raise unless every key is on both sides. Runs one job that stops at the first few misses."""
    misses = unmatched(left, right, on).take(5)
    if misses:
        raise ValueError(f"unpaired keys, for example {[tuple(m) for m in misses]}")


def fewshot_blocks(exemplars: DataFrame, group: str, order: str, text: Column, k: int, separator: str = "\n\n") -> DataFrame:
    """The first k exemplar texts of each group folded to one ``block``.

    Spark limits each map task to its own first k rows per group before the shuffle (row_number() <= k), so a huge group
    sends k rows per task.
    """
    ranked = exemplars.select(group, F.col(order).alias("_order"), text.alias("_text")).withColumn(
        "_rank", F.row_number().over(Window.partitionBy(group).orderBy("_order"))
    )
    folded = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_rank", "_text"))), lambda e: e["_text"]), separator)
    return ranked.where(F.col("_rank") <= k).groupBy(group).agg(folded.alias("block"))


def fewshot_prompts(questions: DataFrame, blocks: DataFrame, group: str, question: str, salt_by: str, separator: str = "\n\n") -> DataFrame:
    """Add ``prompt``: the exemplar block of the question's group, if any, then the question."""
    prompt = F.concat(F.coalesce(F.concat(F.col("block"), F.lit(separator)), F.lit("")), F.col(question))
    return lookup_join(questions, blocks, group, salt_by, how="left", keys_from=questions).withColumn("prompt", prompt).drop("block")


def normalized_url(url: Column) -> Column:
    """Lower case without scheme, ``www.``, fragment and trailing slashes."""
    bare = F.regexp_replace(F.lower(F.trim(url)), r"\A[a-z][a-z0-9+.-]*://", "")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(bare, r"\Awww\.", ""), r"(?s)#.*\z", ""), r"(?<!/)/++\z", "")


def flag_contaminated(items: DataFrame, url: str, listed: DataFrame, listed_url: str, salt_by: str) -> DataFrame:
    """Add ``contaminated``: the item's URL is in the list. Filter on it to drop or to audit."""
    known = listed.select(normalized_url(F.col(listed_url)).alias("_url")).where(F.col("_url").isNotNull()).distinct()
    keyed = items.withColumn("_url", normalized_url(F.col(url)))
    joined = lookup_join(keyed, known.withColumn("contaminated", F.lit(True)), "_url", salt_by, how="left", keys_from=keyed)
    return joined.withColumn("contaminated", F.coalesce("contaminated", F.lit(False))).drop("_url")
