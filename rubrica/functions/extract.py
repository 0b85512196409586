"""Answer extraction and clean-up of completions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from rubrica.functions.text import SPACE, has, let

BOXED = "\\boxed"
FBOX = "\\fbox"


def normalize_gap(c: Column) -> Column:
    """One space between the end of the reasoning and the start of the answer."""
    return F.regexp_replace(c, rf"</think>[{SPACE}]*<answer>", "</think> <answer>")


def strip_think(c: Column) -> Column:
    """Drop the leading run of ``<think>``, spaces and newlines; tabs and carriage returns stay.

    Possessive repeats keep the matcher's stack flat however long the run is.
    """
    return F.regexp_replace(c, r"\A(?:<think>|[ \n]++)++", "")


def has_answer_format(c: Column) -> Column:
    return has(c, "</think> <answer>") & has(c, "</answer>")


def tagged_answer(c: Column) -> Column:
    """The text after the last ``<answer>``, closing tags removed."""
    return F.replace(F.substring_index(c, "<answer>", -1), F.lit("</answer>"), F.lit(""))


def last_boxed(c: Column) -> Column:
    """From the last ``\\boxed`` (else the last ``\\fbox``) to its balancing brace; NULL if there is none.

    The tail is cut into runs that end with a brace, so the fold visits braces, not characters. A box ends at the first
    closing brace that brings the depth to exactly zero.
    """

    def balanced(tail: Column) -> Column:
        runs = F.split(tail, r"(?<=[{}])")
        start = F.struct(F.lit(0).alias("seen"), F.lit(0).alias("depth"), F.lit(0).alias("end"))

        def step(state: Column, run: Column) -> Column:
            opens, closes = F.endswith(run, F.lit("{")), F.endswith(run, F.lit("}"))
            depth = state["depth"] + F.when(opens, 1).when(closes, -1).otherwise(0)
            return F.when(state["end"] > 0, state).otherwise(
                F.struct(
                    (state["seen"] + 1).alias("seen"),
                    depth.alias("depth"),
                    F.when(closes & (depth == 0), state["seen"] + 1).otherwise(0).alias("end"),
                )
            )

        return let(
            runs,
            lambda r: let(
                F.aggregate(r, start, step)["end"],
                lambda end: F.when(end > 0, F.array_join(F.slice(r, F.lit(1), end), "")),
            ),
        )

    def tail_from(marker: str) -> Column:
        return F.concat(F.lit(marker), F.substring_index(c, marker, -1))

    return let(F.when(has(c, BOXED), tail_from(BOXED)).when(has(c, FBOX), tail_from(FBOX)), balanced)


def remove_boxed(c: Column) -> Column:
    """The inside of ``\\boxed{...}``; NULL for any other shape, so an ``\\fbox`` gives NULL."""
    inside = F.substring(c, F.lit(len(BOXED) + 2), F.length(c) - (len(BOXED) + 2))
    return F.when(F.startswith(c, F.lit(BOXED + "{")) & F.endswith(c, F.lit("}")), inside)


def boxed_answer(c: Column) -> Column:
    return let(last_boxed(c), remove_boxed)


def extract_answer(c: Column) -> Column:
    """The last boxed answer of a text that mentions ``\\boxed``, else NULL."""
    return F.when(has(c, BOXED), boxed_answer(c))
