"""Parsers of judge and multiple-choice outputs."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from rubrica.functions.text import let, strip

_RANKED = r"""\{\s*['"]model['"]\s*:\s*['"]([^'"]*)['"]\s*,\s*['"]rank['"]\s*:\s*([0-9]+)\s*\}"""


# What may stand between "the answer is" and its letter, and around a letter that stands alone.
_FILLER = r"(?:\s*+(?i:the\s++)?(?i:option|choice|letter)(?![\p{L}\p{N}_])\s*+:?+)?"
_OPENERS = r"(?:[\s*(\[{$\"'`]|\\(?:boxed|text|textbf|mathrm|mathbf)\s*\{)*+"
_CLOSERS = r"[\s*)\]}$\"'`.:]*+"
# A lower-case word right behind "A" makes it an article, unless the word goes on about the answer.
_GOES_ON = "because|since|as|so|for|and|but|which|due|given|based|by"
_LETTER = rf"([B-D]|A(?!\s++(?!(?:{_GOES_ON})(?![\p{{L}}]))\p{{Ll}}))(?![\p{{L}}\p{{N}}_])"
_SAID = rf"(?i:answer(?:\s++is\s*+:?+|\s*+:)){_FILLER}{_OPENERS}{_LETTER}"
_BOXED = r"\\boxed\s*\{\s*(?:\\(?:text|textbf|mathrm|mathbf)\s*\{)?[\s(]*+([A-D])[\s).]*+\}"
_ALONE = rf"\A(?:(?i:option|choice)(?![\p{{L}}\p{{N}}_]))?{_OPENERS}([A-D]){_CLOSERS}\z"


def choice_letter(c: Column) -> Column:
    """The option letter of "the answer is X" or "Answer: X", else of a boxed letter, else of an output that is a letter
    alone, else NULL.

    "Option", "choice" or "letter" may stand before it and brackets, quotes, dollar signs, bold marks and LaTeX wrappers
    around it. Of several phrases the first with a letter counts. An "A" before a lower-case word is taken as the article.
    """
    found = [F.regexp_extract(c, pattern, 1) for pattern in (_SAID, _BOXED, _ALONE)]
    return F.coalesce(*[F.nullif(f, F.lit("")) for f in found])


def last_number(c: Column) -> Column:
    """The last number of the text without its thousands commas, else NULL."""
    numbers = F.regexp_extract_all(c, F.lit(r"-?[0-9][0-9,]*(?:\.[0-9]+)?"), F.lit(0))
    return F.replace(F.try_element_at(numbers, F.lit(-1)), F.lit(","), F.lit(""))


def safe_flag(c: Column) -> Column:
    """0.0 when the judge said true (unsafe), 1.0 for anything else."""
    return F.when(F.startswith(F.lower(strip(c)), F.lit("true")), 0.0).otherwise(1.0)


def ranking_winner(c: Column) -> Column:
    """The model ranked 1 in a list of ``{'model': name, 'rank': n}``; NULL unless exactly one model has rank 1."""
    names = F.regexp_extract_all(c, F.lit(_RANKED), F.lit(1))
    ranks = F.regexp_extract_all(c, F.lit(_RANKED), F.lit(2))
    first = F.filter(F.arrays_zip(names.alias("name"), ranks.alias("rank")), lambda e: e["rank"] == "1")
    return let(first, lambda f: F.when(F.size(f) == 1, F.try_element_at(f, F.lit(1))["name"]))
