"""Inputs the driver tables do not hold, derived row by row in Spark and in SQL.

Every document yields a completion whose reasoning is its whole text, an answer in one of many spellings and a truth.
``{a}`` and ``{b}`` are small numbers taken from the row; a truth uses ``{a}`` + 1 for one row in five, so that right and
wrong answers both occur in every spelling.
"""

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rubrica.functions.sqltext import text
from rubrica.operators.skew import spread
from rubrica.plans.registry import table

# (answer spelling, truth spelling)
SPELLINGS = [
    ("{a}", "{a}"),
    ("{a}.0", "{a}"),
    (r"\frac{{a}}{{b}}", r"\frac{{a}}{{b}}"),
    ("{a}/{b}", r"\frac{{a}}{{b}}"),
    (r"\frac{a}{b}", r"\dfrac{a}{b}"),
    ("{a} dollars", "{a}"),
    ("{a} miles", r"{a}\text{ miles}"),
    (r"\text{{a} apples}", "{a}"),
    (r"{a}\text{ cm}", "{a}"),
    ("x = {a}", "{a}"),
    (r"\sqrt{a}", r"\sqrt{{a}}"),
    (r"{a}\%", "{a}"),
    (r"\${a},000", "{a}000"),
    ("{a} {b}/9", "{a}+{b}/9"),
    ("({a}, {b})", "({a},{b})"),
    ("[{a},{b}.0)", "[{a},{b})"),
    ("{a} million", "{a}*10^6"),
    (r"{a}^\circ", "{a}"),
    (r"\left({a}, \frac{{b}}{2}\right)", r"({a}, \frac{b}2)"),
    (r"\boxed{{a}}", r"The sum is $\boxed{{a}}$."),
    (r"\frac", r"\frac{a}"),
    (".{b}", "0.{b}"),
    ("{a}e2", "{a}00"),
    ("{a} and {b}", "{a} or {b}"),
    (r"\dfrac{a}{{b}} \text{ m} or \text{ n}", "{a}"),
    (r"{a}\pi", "{a}pi"),
    ("1,23{b},567,890", "1234567890"),
    (r"{a}\text{ cm}^2", "{a}"),
    ("k={a}={b}", "{a}={b}"),
    ("{a} square units", "{a}"),
    ("{a}/{b}", "{b}/{a}"),
    ("({a}.50,{b})", "({a}+1/2,{b}.0)"),
    (r"\frac{\sqrt{{a}}}{{b}}", "sqrt({a})/{b}"),
    ("{a},{b}", "{b},{a}"),
    ("x+{a}", "{a}+x"),
    (r"\boxed{\frac{{a}}{{b}}}", r"\boxed{{a}/{b}}"),
    ("0.33333{a}3", "0.33333{a}30"),
    ("1234567{a}90.5", "1234567{a}90.50"),
    ("0.123456{b}8", "123456{b}8/10000000"),
    ("{a}_000_00{b}", "{a}0000{b}"),
    ("{a}.2{b}*10^12", "{a}2{b}*10^10"),
    (r"\left( 0.5, {a} \right)", r"(\frac{1}{2}, {a})"),
    (r"-\frac{3}{4}\,", "-0.75"),
    (r"x \leq {a}", "x ≤ {a}"),
    (r"{a} \pm \theta", "{a}±θ"),
    (r"\mathrm{even}\ {a}", "even{a}"),
]
GAPS = ["</think> <answer>", "</think>\n\n<answer>", "</think><answer>", "</think> \t <answer>", "</think> so <answer>"]
ENDINGS = ["</answer>", "</answer>", "</answer>", ""]


def sql_text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("'", "''") + "'"


def sql_render(template: str, literal: Callable[[str], str] = sql_text, **values: str) -> str:
    """The SQL counterpart of functions.prompts.render; values are SQL expressions of a string type."""
    pieces = re.split("(" + "|".join(re.escape("{%s}" % n) for n in values) + ")", template)
    terms = [values[p[1:-1]] if i % 2 else literal(p) for i, p in enumerate(pieces) if i % 2 or p]
    return "(" + " || ".join(terms or ["''"]) + ")"


def choose(number: str, options: list[str]) -> str:
    cases = " ".join(f"WHEN {i} THEN {option}" for i, option in enumerate(options))
    return f"(CASE {number} % {len(options)} {cases} END)"


def _spellings(string_type: str, literal: Callable[[str], str]) -> tuple[str, str]:
    """The given answer and the truth as SQL expressions, for either engine's literals and string type."""
    a = f"CAST(doc_id % 50 AS {string_type})"
    b = f"CAST(n_chars % 7 + 2 AS {string_type})"
    a_truth = f"CAST(doc_id % 50 + CASE WHEN n_chars % 5 = 0 THEN 1 ELSE 0 END AS {string_type})"
    given = choose("doc_id", [sql_render(g, literal, a=a, b=b) for g, _ in SPELLINGS])
    truth = choose("doc_id", [sql_render(t, literal, a=a_truth, b=b) for _, t in SPELLINGS])
    return given, truth


def answers(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """Columns doc_id, given, truth and those asked for."""
    columns = dict.fromkeys(["doc_id", "n_chars", *keep])
    documents = spread(table(spark, sf_dir, "documents").select(*columns), "doc_id")
    given, truth = _spellings("STRING", text)
    return documents.select("doc_id", *keep, F.expr(given).alias("given"), F.expr(truth).alias("truth"))


def sql_answers(*keep: str) -> str:
    given, truth = _spellings("VARCHAR", sql_text)
    columns = ", ".join(["doc_id", *keep, f"{given} AS given", f"{truth} AS truth"])
    return f"SELECT {columns} FROM documents"


def completions(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """answers() with the completion text around them."""
    gap = F.expr(choose("(doc_id div 7)", [text(g) for g in GAPS]))
    ending = F.expr(choose("(doc_id div 11)", [text(e) for e in ENDINGS]))
    rows = answers(spark, sf_dir, *dict.fromkeys(["text", *keep]))
    generated = F.concat(F.lit("<think> "), "text", gap, "given", ending)
    return rows.select("doc_id", *keep, "given", "truth", generated.alias("generated_text"))


def sql_completions(*keep: str) -> str:
    gap = choose("(doc_id // 7)", [sql_text(g) for g in GAPS])
    ending = choose("(doc_id // 11)", [sql_text(e) for e in ENDINGS])
    kept = "".join(f", {k}" for k in keep)
    return (
        f"SELECT doc_id{kept}, given, truth, '<think> ' || text || {gap} || given || {ending} AS generated_text "
        f"FROM ({sql_answers('text', *keep)})"
    )
