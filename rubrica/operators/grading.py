"""The table jobs: extract, normalise, grade, parse."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rubrica.functions import grade, verdicts
from rubrica.functions.extract import extract_answer, normalize_gap
from rubrica.functions.normalize import latex_unsupported, normalize
from rubrica.operators.repetition import REPETITIVE, with_shares
from rubrica.operators.skew import fits_broadcast, lookup_join

_PARTS = {"r1_zero": grade.r1_zero_parts, "question_only": grade.question_only_parts}
_ANSWER = {"r1_zero": grade.r1_zero_answer, "question_only": extract_answer}
_PARSERS = {
    "choice": verdicts.choice_letter,
    "number": verdicts.last_number,
    "safety": verdicts.safe_flag,
    "ranking": verdicts.ranking_winner,
}


def _mode(mode: str, table: dict):
    if mode not in table:
        raise ValueError(f"unknown mode {mode!r}; choose one of {sorted(table)}")
    return table[mode]


def extract_answers(completions: DataFrame, text: str, mode: str = "r1_zero") -> DataFrame:
    """Add ``answer``. Narrow."""
    return completions.withColumn("answer", _mode(mode, _ANSWER)(F.col(text)))


def normalize_answers(df: DataFrame, answer: str, form: str, distinct: bool = False, salt_by: str | None = None) -> DataFrame:
    """Add ``norm_answer`` and, for the plain form, ``latex_unsupported``.

    Narrow by default. ``distinct=True`` normalises every different answer once and joins back, which pays when few
    answers repeat very often; the join is salted by ``salt_by`` against one answer that holds most rows.
    """
    added = {"norm_answer": normalize(F.col(answer), form)}
    if form == "plain":
        added["latex_unsupported"] = latex_unsupported(F.col(answer))
    if not distinct:
        return df.withColumns(added)
    if salt_by is None:
        raise ValueError("distinct=True needs salt_by, a column that spreads the rows of one answer")
    once = df.select(answer).where(F.col(answer).isNotNull()).distinct().withColumns(added)
    return lookup_join(df, once, answer, salt_by, how="left", keys_from=df)


def prepare_prompts(prompts: DataFrame, truths: str = "truths") -> DataFrame:
    """Replace the truths by their normal forms, once per prompt, before any fan-out to rollouts."""
    return prompts.withColumn("truth_forms", grade.prepare_truths(F.col(truths))).drop(truths)


def grade_completions(
    completions: DataFrame,
    prompts: DataFrame,
    on: str,
    text: str = "generated_text",
    truths: str = "truths",
    mode: str = "r1_zero",
    how: str = "inner",
    salt_by: str | list[str] | None = None,
) -> DataFrame:
    """Join completions to prompts and add ``metrics``.

    Truths are normalised on the prompt side of the join and answers are cut out of the completions before it, so a plan
    that needs only the metrics shuffles answers, not texts. Answers are normalised as far as cheap checks leave them
    open. Prompts that do not fit a broadcast meet their completions by a join in which one with a large share of all
    completions is spread over tasks by ``salt_by``, the rollout number or else the text of the completion.
    ``how="left"`` also keeps prompts without a completion, with empty text and zero metrics.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    prepared = prepare_prompts(prompts, truths)
    parsed = completions.withColumn(text, normalize_gap(F.col(text))).withColumn("_parts", _mode(mode, _PARTS)(F.col(text)))
    if fits_broadcast(prepared):
        joined = parsed.join(prepared, on, "right" if how == "left" else "inner")
    else:
        joined = lookup_join(parsed, prepared, on, salt_by or text, how="inner", keys_from=completions)
        if how == "left":
            unserved = prepared.join(completions.select(on).distinct(), on, "left_anti")
            joined = joined.unionByName(unserved, allowMissingColumns=True)
    metrics = grade.parts_reward(F.col("_parts"), lambda a: grade.grade_prepared(a, F.col("truth_forms")))
    served = F.when(F.col("_parts").isNull(), grade.zero_reward()).otherwise(metrics)
    return joined.withColumns({"metrics": served, text: F.coalesce(F.col(text), F.lit(""))}).drop("_parts", "truth_forms")


def score(df: DataFrame, text: str, reward: grade.RewardFn, truths: Column) -> DataFrame:
    """Normalise the answer gap, then add ``metrics`` by any reward function, built in or the user's own."""
    return df.withColumn(text, normalize_gap(F.col(text))).withColumn("metrics", reward(F.col(text), truths))


def grade_answers(df: DataFrame, given: str, truth: str, flag: str | None = None) -> DataFrame:
    """Add ``correct`` for answer and truth columns and, under the name ``flag``, whether a verdict "wrong" rests on an
    expression that the test by value does not understand (``functions.grade.needs_algebra``)."""
    graded = df.withColumn("correct", grade.grade_any(F.col(given), F.array(truth)))
    if flag is None:
        return graded
    return graded.withColumn(flag, grade.needs_algebra(F.col(given), grade.truth_text(F.col(truth))))


def latex_equal_answers(df: DataFrame, given: str, truth: str, name: str = "latex_equal") -> DataFrame:
    """Add whether two answers are equal in the plain form, where an answer of over 128 characters that repeats itself is
    refused first, whatever it says."""
    long_part = lambda c: F.when(F.length(c) > 128, F.col(c))
    named = df.withColumns({"_given": F.col(given), "_truth": grade.truth_text(F.col(truth))})
    shares = with_shares(named, {"_given_share": long_part("_given"), "_truth_share": long_part("_truth")})
    repeats = [F.coalesce(F.col(c) > REPETITIVE, F.lit(False)) for c in ("_given_share", "_truth_share")]
    judged = shares.withColumn(name, grade.latex_equal(F.col("_given"), F.col("_truth"), *repeats))
    return judged.drop("_given", "_truth", "_given_share", "_truth_share")


def parse_judgements(df: DataFrame, text: str, kind: str, name: str) -> DataFrame:
    """Add the verdict, winner, letter or number of a judge's or model's output. Narrow."""
    return df.withColumn(name, _mode(kind, _PARSERS)(F.col(text)))
