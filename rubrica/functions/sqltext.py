"""Building blocks for long expressions written as SQL text.

A normal form is a chain of some hundred steps. Built call by call through the Column API, such a chain costs seconds of
driver time per plan; as text it is parsed in one go. Helpers here take and return SQL text; ``column_function`` turns a
finished chain into an ordinary Column function.
"""

from collections.abc import Callable
from itertools import count

from pyspark.sql import Column
from pyspark.sql import functions as F

from rubrica.functions.text import STRIPPED

_names = count()


def text(value: str) -> str:
    """A string literal without escape processing."""
    if "'" in value:
        raise ValueError("quotes cannot be written in a raw literal")
    return f"r'{value}'"


def let(value: str, body: Callable[[str], str]) -> str:
    """Evaluate ``value`` once and use it under a name, however often the body mentions it."""
    name = f"v{next(_names)}"
    return f"element_at(transform(array({value}), {name} -> {body(name)}), 1)"


def fold(items: str, start: str, step: Callable[[str, str], str]) -> str:
    """Ordered fold of an array; ``step`` takes the running value and an item."""
    acc, item = f"a{next(_names)}", f"i{next(_names)}"
    return f"aggregate({items}, {start}, ({acc}, {item}) -> {step(acc, item)})"


def words(values: list[str], separator: str = "\t") -> str:
    """A literal array of strings."""
    return f"split({text(separator.join(values))}, {text(separator)})"


def sub(x: str, pattern: str, replacement: str) -> str:
    return f"regexp_replace({x}, {text(pattern)}, {text(replacement)})"


def matches(x: str, pattern: str) -> str:
    return f"({x} rlike {text(pattern)})"


def group(x: str, pattern: str, index: int) -> str:
    return f"regexp_extract({x}, {text(pattern)}, {index})"


def swap(x: str, *pairs: tuple[str, str]) -> str:
    for old, new in pairs:
        x = f"replace({x}, {text(old)}, {text(new)})"
    return x


def drop(x: str, *needles: str) -> str:
    return swap(x, *[(n, "") for n in needles])


def has(x: str, needle: str) -> str:
    return f"contains({x}, {text(needle)})"


def occurrences(x: str, needle: str) -> str:
    return f"((length({x}) - length({drop(x, needle)})) div {len(needle)})"


def strip(x: str) -> str:
    return sub(x, STRIPPED, "")


def column_function(build: Callable[[str], str]) -> Callable[[Column], Column]:
    """A Column function of one argument from a builder of SQL text."""

    def apply(c: Column) -> Column:
        name = f"v{next(_names)}"
        return F.element_at(F.call_function("transform", F.array(c), F.expr(f"{name} -> {build(name)}")), 1)

    apply.__doc__ = build.__doc__
    return apply


def column_predicate(build: Callable[[str, str], str]) -> Callable[[Column, Column], Column]:
    """A Column function of two text arguments from a builder of SQL text."""

    def apply(left: Column, right: Column) -> Column:
        name = f"v{next(_names)}"
        lambda_ = F.expr(f"{name} -> {build(f'{name}[0]', f'{name}[1]')}")
        return F.element_at(F.call_function("transform", F.array(F.array(left, right)), lambda_), 1)

    apply.__doc__ = build.__doc__
    return apply
