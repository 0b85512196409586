"""Small text helpers shared by the extraction, normalising and grading columns."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a Unicode str.strip() removes, and the class of non-word characters.
SPACE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
NON_WORD = r"[^\p{L}\p{N}_]"

# A run of white space is tried once, from its first character; otherwise a long run inside a text costs its square.
STRIPPED = rf"\A[{SPACE}]++|(?<![{SPACE}])[{SPACE}]++\z"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body``, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(c: Column) -> Column:
    """Remove leading and trailing Unicode white space (Spark's trim removes spaces only)."""
    return F.regexp_replace(c, STRIPPED, "")


def drop(c: Column, *needles: str) -> Column:
    for needle in needles:
        c = F.replace(c, F.lit(needle), F.lit(""))
    return c


def swap(c: Column, *pairs: tuple[str, str]) -> Column:
    for old, new in pairs:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def has(c: Column, needle: str) -> Column:
    return F.contains(c, F.lit(needle))


def occurrences(c: Column, needle: str) -> Column:
    """Non-overlapping occurrences of a literal."""
    return ((F.length(c) - F.length(drop(c, needle))) / len(needle)).cast("int")
