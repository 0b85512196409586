"""Graders and reward functions.

A reward function is ``RewardFn = Callable[[Column, Column], Column]``: response and truths in, reward struct out. The
truths column is ``ARRAY<STRING>`` and a response is right when any of them matches. Checks run from cheap to dear
inside ``when`` branches, so a response that equals its truth letter by letter is never normalised.
"""

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from rubrica import schemas
from rubrica.functions import normalize
from rubrica.functions.algebra import same_value
from rubrica.functions.extract import BOXED, extract_answer, has_answer_format, tagged_answer
from rubrica.functions.normalize import normalize_mathd, normalize_plain
from rubrica.functions.sqltext import (
    column_function,
    column_predicate,
    drop,
    matches,
    strip,
    text,
)
from rubrica.functions.sqltext import let as let_text
from rubrica.functions.text import has, let

RewardFn = Callable[[Column, Column], Column]

# Characters that open and close tuples and intervals.
TUPLE_CHARS = r"()\[\]"


def _is_fraction(x: str) -> str:
    return matches(x, r"\A-?[0-9]+[^\n]?/0*[1-9][0-9]*[^\n]?\n?\z")


def _letters(x: str) -> str:
    """Distinct letters of an expression, ``sqrt`` and ``frac`` not counted."""
    return f"size(array_distinct(regexp_extract_all({drop(x, 'sqrt', 'frac')}, {text(r'(\p{L})')}, 1)))"


def _may_evaluate(x: str) -> str:
    """At most two unknowns and no exponent that is bracketed, chained or longer than one digit."""
    return f"({_letters(x)} <= 2 AND NOT {matches(x, r'\^[{(]|\^[0-9]+\^|\^[0-9][0-9]+')})"


def _elements(x: str) -> str:
    """Elements of a bracketed list; any other text is its own only element and empty text has none."""

    def cut(t: str) -> str:
        bracketed = matches(t, rf"(?s)\A[{TUPLE_CHARS}][^{TUPLE_CHARS}]+[{TUPLE_CHARS}]\z")
        inside = f"transform(split(substring({t}, 2, length({t}) - 2), ','), e -> {strip('e')})"
        return f"CASE WHEN {t} = '' THEN CAST(array() AS array<string>) WHEN {bracketed} THEN {inside} ELSE array({t}) END"

    return let_text(normalize.without_number_commas(x), cut)


def _integerness_differs(a: str, b: str) -> str:
    return let_text(f"transform(array({a}, {b}), n -> {normalize.is_integer_text('n')})", lambda v: f"{v}[0] <> {v}[1]")


def _difference(truth: str, given: str) -> str:
    return f"concat('(', {truth}, ')-(', {given}, ')')"


def _element_equal(truth: str, given: str) -> str:
    """Equality of two tuple elements.

    Fractions and plainly written integers must be spelled alike and an integer only equals an integer. Of what is left, identical texts match and so
    do expressions of equal value (``functions.algebra``); one that is not understood does not (see ``needs_algebra``).
    """
    numbers = matches(f"concat({truth}, ' ', {given})", r"\A-?[1-9][0-9]*+ -?[1-9][0-9]*+\z")
    return (
        f"CASE WHEN {numbers} OR {_is_fraction(truth)} AND {_is_fraction(given)} THEN {truth} = {given} "
        f"WHEN {_integerness_differs(truth, given)} THEN false "
        f"WHEN {let_text(_difference(truth, given), _may_evaluate)} "
        f"THEN {truth} = {given} OR coalesce({same_value(truth, given)}, false) ELSE false END"
    )


def _element_needs_algebra(truth: str, given: str) -> str:
    return (
        f"CASE WHEN {_is_fraction(truth)} AND {_is_fraction(given)} THEN false "
        f"WHEN {_integerness_differs(truth, given)} THEN false "
        f"ELSE {let_text(_difference(truth, given), _may_evaluate)} AND {truth} <> {given} "
        f"AND {same_value(truth, given)} IS NULL END"
    )


def _pairwise(given: str, truth: str, test: Callable[[str, str], str], quantifier: str) -> str:
    """Quantify an element test over two plain-form answers of the same outer brackets and length, else false."""

    def compare(v: str) -> str:
        same_ends = f"left({truth}, 1) = left({given}, 1) AND right({truth}, 1) = right({given}, 1)"
        comparable = f"size({v}[0]) = size({v}[1]) AND (size({v}[0]) <= 1 OR ({same_ends}))"
        pairs = f"zip_with({v}[0], {v}[1], (t, g) -> {test('t', 'g')})"
        return f"if({comparable}, {quantifier}({pairs}, b -> b), false)"

    return let_text(f"transform(array({truth}, {given}), s -> {_elements('s')})", compare)


def _plain_equal(given: str, truth: str) -> str:
    return (
        f"coalesce(CASE WHEN {truth} = {given} THEN true WHEN {given} = '' THEN false "
        f"ELSE {_pairwise(given, truth, _element_equal, 'forall')} END, false)"
    )


def _algebra_open(given: str, truth: str) -> str:
    unresolved = _pairwise(given, truth, _element_needs_algebra, "exists")
    return f"coalesce(NOT {_plain_equal(given, truth)} AND {unresolved}, false)"


plain_forms_equal = column_predicate(_plain_equal)
is_fraction_text = column_function(_is_fraction)
letter_count = column_function(_letters)
may_evaluate = column_function(_may_evaluate)
split_tuple = column_function(_elements)


def needs_algebra(given: Column, truth: Column) -> Column:
    """True when the verdict "not equal" rests on an expression that the test by value does not understand."""
    return column_predicate(_algebra_open)(normalize_plain(given), normalize_plain(truth))


def grade_mathd(given: Column, truth: Column) -> Column:
    return F.equal_null(normalize_mathd(given), normalize_mathd(truth))


def grade_plain(given: Column, truth: Column) -> Column:
    return plain_forms_equal(normalize_plain(given), normalize_plain(truth))


def latex_equal(given: Column, truth: Column, given_repeats: Column, truth_repeats: Column) -> Column:
    """The slow grader's own checks: long repetitive answers fail, then plain forms decide.

    The two flags come from ``operators.repetition.flag_repetition`` and count only for answers of over 128 characters.
    """
    refused = ((F.length(given) > 128) & given_repeats) | ((F.length(truth) > 128) & truth_repeats)
    same = F.coalesce(normalize_plain(given) == normalize_plain(truth), F.lit(False))
    return F.when(refused, False).otherwise(same)


def _any_float(x: str) -> str:
    """as_float, and the spellings of infinity and NaN."""
    bare = f"lower({strip(x)})"
    special = f"if(contains({bare}, 'nan'), double('NaN'), if(startswith({bare}, '-'), double('-inf'), double('inf')))"
    return f"if({matches(bare, r'\A[+-]?(?:inf|infinity|nan)\z')}, {special}, {normalize.as_float(x)})"


def _value_equal(given: str, truth: str) -> str:
    floats = f"transform(array({given}, {truth}), f -> {_any_float('f')})"
    same_number = let_text(floats, lambda v: f"{v}[0] = {v}[1] AND NOT isnan({v}[0])")
    return f"CASE WHEN {given} <=> {truth} THEN true ELSE coalesce({same_number}, false) END"


def value_equal(given: Column, truth: Column) -> Column:
    """mathd forms are the same text or the same number (NaN equals nothing)."""
    return column_predicate(_value_equal)(normalize_mathd(given), normalize_mathd(truth))


def numeric_close(a: Column, b: Column, rel_tol: float = 1e-4) -> Column:
    """Relative closeness to the larger magnitude; infinities are close only to themselves, NaN to nothing."""
    finite = (F.abs(a) < float("inf")) & (F.abs(b) < float("inf"))
    near = finite & (F.abs(a - b) <= rel_tol * F.greatest(F.abs(a), F.abs(b)))
    return ~F.isnan(a) & ~F.isnan(b) & ((a == b) | near)


def truth_text(truth: Column) -> Column:
    """A ground truth that is itself a worked solution is reduced to its boxed answer (NULL when it has none)."""
    return F.when(has(truth, BOXED), extract_answer(truth)).otherwise(truth)


def _forms(text: Column) -> Column:
    return F.struct(text.alias("raw"), normalize_mathd(text).alias("mathd"), normalize_plain(text).alias("plain"))


def prepare_truths(truths: Column) -> Column:
    """Normal forms of every truth, computed once per prompt and then shared by all rollouts of the prompt."""
    return F.transform(truths, lambda truth: let(truth_text(truth), _forms))


def _matches_any(given: Column, forms: Column) -> Column:
    def match(f: Column) -> Column:
        return F.when(f["mathd"] == given["mathd"], True).otherwise(plain_forms_equal(given["plain"], f["plain"]))

    return F.coalesce(F.exists(forms, match), F.lit(False))


def grade_prepared(answer: Column, forms: Column) -> Column:
    """True when an answer matches any prepared truth: same text, else same mathd form, else equal plain forms."""
    same_text = F.array_contains(F.transform(forms, lambda f: f["raw"]), answer)
    return F.when(same_text, True).otherwise(let(_forms(answer), lambda given: _matches_any(given, forms)))


def grade_any(answer: Column, truths: Column) -> Column:
    """Any-of grading of a raw ``ARRAY<STRING>`` of truths; an empty list matches nothing."""

    def compare(texts: Column) -> Column:
        everything = F.transform(F.concat(F.array(answer), texts), _forms)
        return F.when(F.array_contains(texts, answer), True).otherwise(
            let(everything, lambda all_: _matches_any(all_[0], F.slice(all_, F.lit(2), F.size(texts))))
        )

    return let(F.transform(truths, truth_text), compare)


def reward(format_ok: Column, correct: Column) -> Column:
    right = F.when(format_ok & correct, 1.0).otherwise(0.0)
    return F.struct(
        F.when(format_ok, 1.0).otherwise(0.0).alias("format_reward"),
        right.alias("answer_reward"),
        right.alias("reward"),
    )


def zero_reward() -> Column:
    return F.struct(*[F.lit(0.0).alias(f.name) for f in schemas.REWARD])


def r1_zero_answer(response: Column) -> Column:
    """The tagged answer, unboxed when it mentions a box; NULL when unformatted or when the box does not close."""
    answer = let(tagged_answer(response), lambda a: F.when(has(a, BOXED), extract_answer(a)).otherwise(a))
    return F.when(has_answer_format(response), answer)


def r1_zero_parts(response: Column) -> Column:
    """``STRUCT<formatted, answer>`` of a response that must carry its answer in tags."""
    formatted = F.coalesce(has_answer_format(response), F.lit(False))
    return F.struct(formatted.alias("formatted"), r1_zero_answer(response).alias("answer"))


def question_only_parts(response: Column) -> Column:
    """``STRUCT<formatted, answer>`` of a response that must carry its answer in a box."""
    return let(
        extract_answer(response), lambda a: F.struct(a.isNotNull().alias("formatted"), a.alias("answer"))
    )


def parts_reward(parts: Column, is_correct: Callable[[Column], Column]) -> Column:
    """Reward of a parsed response; a response without an answer is never graded."""
    right = F.when(parts["answer"].isNull(), False).otherwise(is_correct(parts["answer"]))
    return let(right, lambda r: reward(parts["formatted"], r))


def r1_zero_reward(response: Column, truths: Column) -> Column:
    return let(r1_zero_parts(response), lambda p: parts_reward(p, lambda a: grade_any(a, truths)))


def question_only_reward(response: Column, truths: Column) -> Column:
    return let(question_only_parts(response), lambda p: parts_reward(p, lambda a: grade_any(a, truths)))


def hash_reward(response: Column) -> Column:
    """Reproducible stand-in reward: the last decimal digit of the SHA-256 number, over ten."""
    digits = F.split(F.sha2(response, 256), "")
    value = F.aggregate(digits, F.lit(0), lambda acc, d: (acc * 16 + F.conv(d, 16, 10).cast("int")) % 10)
    return let(
        value / F.lit(10.0),
        lambda r: F.struct(r.alias("format_reward"), r.alias("answer_reward"), r.alias("reward")),
    )


def from_python(fn: Callable[[str, list[str]], dict[str, float]]) -> RewardFn:
    """Wrap a user's Python reward function; rows travel in Arrow batches."""
    names = [f.name for f in schemas.REWARD]

    def score(response: pd.Series, truths: pd.Series) -> pd.DataFrame:
        rows = [fn(r, list(t)) for r, t in zip(response, truths, strict=True)]
        return pd.DataFrame(rows, columns=names).astype("float64")

    return F.pandas_udf(score, schemas.REWARD)
