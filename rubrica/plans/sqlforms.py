"""SQL counterparts of the extraction, normal forms and graders, for the oracle queries.

Each helper takes a SELECT and returns a SELECT with one more column. Steps are nested sub-selects that rewrite column s.
"""

from rubrica.functions import normalize as N
from rubrica.plans.derive import sql_text

WORD_EDGE = r"[^\p{L}\p{N}_]"


def chain(source: str, *steps: str) -> str:
    for step in steps:
        source = f"{_fenced(source)} SELECT * REPLACE ({step} AS s) FROM prior"
    return source


def _fenced(source: str) -> str:
    """Materialise a step: merged into one expression, steps that use s several times would grow exponentially."""
    return f"WITH prior AS MATERIALIZED ({source})"


def add(source: str, **columns: str) -> str:
    listed = ", ".join(f"{expr} AS {name}" for name, expr in columns.items())
    return f"{_fenced(source)} SELECT *, {listed} FROM prior"


def finish(source: str, name: str, value: str, *scratch: str) -> str:
    return f"{_fenced(source)} SELECT * EXCLUDE ({', '.join(('s', *scratch))}), {value} AS {name} FROM prior"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '\A\s+|\s+\z', '', 'g')"


def sub(pattern: str, replacement: str, x: str = "s") -> str:
    return f"regexp_replace({x}, {sql_text(pattern)}, {sql_text(replacement)}, 'g')"


def swaps(pairs: list[tuple[str, str]], x: str = "s") -> str:
    for old, new in pairs:
        x = f"replace({x}, {sql_text(old)}, {sql_text(new)})"
    return x


def drops(needles: list[str], x: str = "s") -> str:
    return swaps([(n, "") for n in needles], x)


def count_of(needle: str, x: str = "s") -> str:
    return f"((length({x}) - length(replace({x}, {sql_text(needle)}, ''))) // {len(needle)})"


def _units() -> str:
    words = "[" + ", ".join(sql_text(u) for u in N.unit_words()) + "]"
    cut = rf"regexp_replace(t, '(^|{WORD_EDGE})' || u || '($|{WORD_EDGE})', '\1\2', 'g')"
    step = f"CASE WHEN contains(t, split_part(u, '.', 1)) AND {cut} <> '' THEN {cut} ELSE t END"
    any_unit = rf"(^|{WORD_EDGE})(" + "|".join(N.unit_words()) + rf")($|{WORD_EDGE})"
    return (
        f"CASE WHEN regexp_matches(s, {sql_text(any_unit)}) THEN list_reduce({words}, lambda t, u: {step}, s) ELSE s END"
    )


def mathd(source: str, column: str, name: str) -> str:
    begun = chain(
        add(source, s=strip(column)),
        rf"CASE WHEN regexp_matches(s, '\A\\text\{{[^\n]+\}}\z') "
        rf"THEN {strip(chr(39).join(['regexp_extract(s, ', r'\A\\text\{([^\n]+?)\}\z', ', 1)']))} ELSE s END",
    )
    text_unit = strip(sub(r"\\text\{[^\n]*?\}\z", ""))
    first_broken = r"\\frac([^{]?)(\\frac|\z)"
    steps = [
        swaps([("\n", ""), ("\\!", ""), ("\\\\", "\\")]),
        sub(r"\\begin\{array\}\{[^\n]*?\}", r"\\begin{pmatrix}"),
        swaps([("\\end{array}", "\\end{pmatrix}"), ("bmatrix", "pmatrix"), ("tfrac", "frac"), ("dfrac", "frac")]),
        swaps([("\\neq", "\\ne"), ("\\leq", "\\le"), ("\\geq", "\\ge"), ("\\left", ""), ("\\right", "")]),
        f"CASE WHEN {text_unit} <> '' THEN {text_unit} ELSE s END",
        _units(),
        _units(),
        drops(["^{\\circ}", "^\\circ", "\\$"]),
        f"CASE WHEN {count_of(chr(92) + 'text{ ')} <= 1 THEN split_part(s, '\\text{{ ', 1) END",
        drops(["\\%"]),
        swaps([(" .", " 0."), ("{.", "{0.")]),
        sub(r"\A\.", "0."),
        f"CASE WHEN {count_of('=')} = 1 AND length(split_part(s, '=', 1)) <= 2 THEN split_part(s, '=', 2) ELSE s END",
        rf"CASE WHEN NOT (contains(s, '\sqrt\sqrt') OR ends_with(s, '\sqrt')) THEN {sub(r'\\sqrt([^{])', r'\\sqrt{\1}')} END",
        drops([" "]),
        f"CASE WHEN NOT regexp_matches(s, {sql_text(first_broken)}) THEN "
        + sub(r"\\frac([^{])\{", r"\\frac{\1}{", sub(r"\\frac([^{])([^{])", r"\\frac{\1}{\2}"))
        + f" WHEN regexp_extract(s, {sql_text(first_broken)}, 1) <> '' THEN s END",
        r"CASE WHEN s = '0.5' THEN '\frac{1}{2}' ELSE s END",
        sub(r"\A(0|-?[1-9][0-9]*)/(0|-?[1-9][0-9]*)\z", r"\\frac{\1}{\2}"),
    ]
    return finish(chain(add(begun, o="s"), *steps), name, "coalesce(s, o)", "o")


def minerva(source: str, column: str, name: str) -> str:
    steps = [
        drops(N.MINERVA_REMOVALS, swaps(N.MINERVA_REWRITES)),
        sub(r"([^\n]*?)\$([^\n]*?)\$([^\n]*)", r"$\2$"),
        *[sub(rf"\\{m}\{{([^\n]*?)\}}", r"\1") for m in ("text", "textbf", "overline")],
        sub(r"\\boxed\{([^\n]*)\}", r"\1"),
        sub(r"frac([^{])([^\n])", r"frac{\1}{\2}"),
        sub(r"sqrt([^{])", r"sqrt{\1}"),
        drops(["$"]),
        r"CASE WHEN regexp_full_match(replace(s, ',', ''), '\p{Nd}+') THEN replace(s, ',', '') ELSE s END",
    ]
    return finish(chain(add(source, s=column), *steps), name, "s")


def number_commas(x: str) -> str:
    rounds = f"list_transform(range(length({x}) - length(replace({x}, ',', ''))), lambda i: '')"
    step = r"regexp_replace(t, '(\p{Nd}),(\p{Nd}{3})($|\P{Nd})', '\1\2\3', 'g')"
    return f"list_reduce({rounds}, lambda t, i: {step}, {x})"


FLOAT = r"[-+]?((\d+_)*\d+(\.((\d+_)*\d+)?)?|\.(\d+_)*\d+)([eE][-+]?(\d+_)*\d+)?"


def as_float(x: str) -> str:
    return rf"CASE WHEN regexp_full_match({x}, '\s*{FLOAT}\s*') THEN TRY_CAST(replace(trim({x}), '_', '') AS DOUBLE) END"


def is_integral(v: str) -> str:
    return f"coalesce(abs({v}) < 1e300 AND abs({v} - round({v})) <= 1e-7, false)"


def plain(source: str, column: str, name: str) -> str:
    text = r"\A\\text\{([^\n]+?)\}\n?\z"
    innermost = sub(r"\\sqrt\s*\{([^{}]*)\}", r"sqrt(\1)", sub(r"\\frac\s*\{([^{}]*)\}\s*\{([^{}]*)\}", r"\1/\2"))
    symbols = "s"
    for macro, word in (("pi", "pi"), ("infty", "inf"), ("cup", "U"), ("cdot", "*"), ("times", "*")):
        symbols = sub(rf"\\{macro}([^a-zA-Z]|\z)", rf"{word}\1", symbols)
    for mark, word in (("√", "sqrt"), ("π", "pi"), ("∞", "inf"), ("∪", "U"), ("·", "*"), ("×", "*")):
        symbols = f"replace({symbols}, '{mark}', '{word}')"
    marks = "s"
    for names, sign in (("leq le", "≤"), ("geq ge", "≥"), ("neq ne", "≠"), ("pm", "±"), ("theta", "θ"), ("alpha", "α")):
        for macro in names.split():
            marks = sub(rf"\\{macro}([^a-zA-Z]|\z)", rf"{sign}\1", marks)
    latex_steps = [
        sub(r"\\(left|right)", ""),
        sub(r"\\[,;:!]", ""),
        sub(r"\\(quad|qquad| )", " "),
        sub(r"\\(text|mathrm)\{([^{}]*)\}", r"\2"),
        swaps([("\\tfrac", "\\frac"), ("\\dfrac", "\\frac"), ("\\frac", " \\frac")]),
        sub(r"\\frac\s*([0-9a-zA-Z])\s*([0-9a-zA-Z])", r"\1/\2"),
        sub(r"\\frac\s*([0-9a-zA-Z])\s*\{", r"\\frac{\1}{"),
        sub(r"(\\frac\s*\{[^{}]*\})\s*([0-9a-zA-Z])", r"\1{\2}"),
        sub(r"\\sqrt\s*([0-9a-zA-Z])", r"sqrt(\1)"),
        innermost,
        innermost,
        innermost,
        symbols,
        marks,
        strip(sub(r"\\([{}])", r"\1")),
    ]
    steps = [
        f"CASE WHEN regexp_matches(s, {sql_text(text)}) THEN regexp_extract(s, {sql_text(text)}, 1) ELSE s END",
        swaps([("\\%", "%"), ("\\$", "$"), ("$", ""), ("%", ""), (" or ", " , "), (" and ", " , "), *N.SCALE_WORDS]),
        *[sub(rf"{unit}(es)?(s)? *(\^[0-9]+)?", "") for unit in N.PLAIN_UNITS],
        sub(r"\^ *\\circ", ""),
        "CASE WHEN starts_with(s, '{') AND ends_with(s, '}') AND length(s) > 1 THEN s[2:-2] ELSE s END",
        sub(r",\\! *", ""),
        f"CASE WHEN {is_integral(as_float('s'))} THEN CAST(CAST(round({as_float('s')}) AS HUGEINT) AS VARCHAR) ELSE s END",
        *[rf"CASE WHEN is_latex THEN {step} ELSE s END" for step in latex_steps],
        sub("- *", "-"),
        sub("([0-9]) +([0-9])", r"\1+\2"),
        f"lower({drops([' ', '{', '}'])})",
    ]
    head, tail = steps[: -len(latex_steps) - 3], steps[-len(latex_steps) - 3 :]
    latex = add(chain(add(source, s=column), *head), is_latex="contains(s, '\\')")
    spelled = add(chain(latex, *tail), v=as_float(number_commas("s")))
    whole = f"CAST(CAST(trunc({as_float(drops([',']))}) AS HUGEINT) AS VARCHAR)"
    return finish(spelled, name, f"CASE WHEN {is_integral('v')} THEN {whole} ELSE s END", "is_latex", "v")


def elements(x: str) -> str:
    clean = number_commas(x)
    inside = f"list_transform(string_split(({clean})[2:-2], ','), lambda e: {strip('e')})"
    return (
        f"CASE WHEN {x} = '' THEN [] "
        rf"WHEN regexp_full_match({clean}, '[()\[\]][^()\[\]]+[()\[\]]') THEN {inside} ELSE [{clean}] END"
    )


def _constant(x: str) -> str:
    """The value of a constant as DOUBLE; derived numbers that differ do so by far more than its precision."""
    pattern = sql_text(r"\A(?:(-?[0-9]+)\+)?(-?[0-9]*(?:\.[0-9]*)?)(?:/([0-9]+))?(?:\*10\^([0-9]+))?\z")
    group = lambda i, d: f"coalesce(TRY_CAST(nullif(regexp_extract({x}, {pattern}, {i}), '') AS DOUBLE), {d})"
    return (
        f"CASE WHEN regexp_matches({x}, {pattern}) AND regexp_extract({x}, {pattern}, 2) <> '' "
        f"THEN {group(1, 0)} + {group(2, 'NULL')} / nullif({group(3, 1)}, 0) * pow(10, {group(4, 0)}) END"
    )


def _element_equal(t: str, g: str) -> str:
    fraction = lambda x: rf"regexp_full_match({x}, '-?[0-9]+[^\n]?/0*[1-9][0-9]*[^\n]?')"
    integer = lambda x: is_integral("(" + as_float(number_commas(x)) + ")")
    joined = f"('(' || {t} || ')-(' || {g} || ')')"
    letters = rf"len(list_distinct(regexp_extract_all({drops(['sqrt', 'frac'], joined)}, '\p{{L}}')))"
    bad = rf"regexp_matches({joined}, '\^\{{|\^\(|\^[0-9]+\^|\^[0-9][0-9]+')"
    sum_ = lambda x: rf"regexp_full_match({x}, '[a-z0-9]+(\+[a-z0-9]+)+')"
    terms = lambda x: f"list_sort(string_split({x}, '+'))"
    same_sum = f"({sum_(t)} AND {sum_(g)} AND {terms(t)} = {terms(g)})"
    return (
        f"CASE WHEN {fraction(t)} AND {fraction(g)} THEN {t} = {g} WHEN {integer(t)} <> {integer(g)} THEN false "
        f"WHEN {letters} <= 2 AND NOT {bad} "
        f"THEN {t} = {g} OR {same_sum} OR coalesce(abs({_constant(t)} - {_constant(g)}) <= 1e-13 * abs({_constant(t)}), false) ELSE false END"
    )


def plain_equal(source: str, given: str, truth: str, name: str) -> str:
    """Equality of two plain forms, element by element."""
    split = add(source, ge=elements(given), te=elements(truth))
    pairs = f"list_transform(range(1, len(te) + 1), lambda i: {_element_equal('te[i]', 'ge[i]')})"
    ends = f"(len(te) <= 1 OR (left({given}, 1) = left({truth}, 1) AND right({given}, 1) = right({truth}, 1)))"
    verdict = (
        f"coalesce(CASE WHEN {given} = {truth} THEN true WHEN {given} = '' THEN false "
        f"WHEN len(ge) <> len(te) OR NOT {ends} THEN false ELSE list_bool_and({pairs}) END, false)"
    )
    return f"SELECT * EXCLUDE (ge, te), {verdict} AS {name} FROM ({split})"


def graded(source: str, given: str, truth: str, name: str = "correct") -> str:
    """mathd or plain equality, the truth reduced to its box when it mentions one (boxes here nest no deeper than two)."""
    boxed = f"CASE WHEN contains({truth}, '\\boxed') THEN {simple_box(truth)} ELSE {truth} END"
    text = add(source, tt=boxed)
    formed = plain(plain(mathd(mathd(text, given, "gm"), "tt", "tm"), given, "gp"), "tt", "tp")
    judged = plain_equal(formed, "gp", "tp", "pe")
    return f"SELECT * EXCLUDE (tt, gm, tm, gp, tp, pe), coalesce(gm = tm, false) OR pe AS {name} FROM ({judged})"


def simple_box(x: str) -> str:
    """The last boxed text with at most two levels of braces inside."""
    level0 = "[^{}]*"
    level1 = rf"{level0}(?:\{{{level0}\}}{level0})*"
    level2 = rf"{level0}(?:\{{{level1}\}}{level0})*"
    tail = f"'\\boxed' || list_extract(string_split({x}, '\\boxed'), -1)"
    return f"nullif(regexp_extract({tail}, {sql_text(r'\A\\boxed\{(' + level2 + r')\}')}, 1), '')"
