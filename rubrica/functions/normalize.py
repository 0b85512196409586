"""Three normal forms of a math answer, as SQL expressions.

``mathd`` strips units and rewrites short LaTeX, ``minerva`` is the published clean-up for quantitative answers, and
``plain`` reduces an answer to lower-case text in which integers have one spelling. NULL in gives NULL out. Inside the
``mathd`` chain NULL also stands for "this answer cannot be rewritten", which yields the trimmed answer itself.
"""

from pyspark.sql import Column

from rubrica.functions.sqltext import (
    column_function,
    drop,
    fold,
    group,
    has,
    let,
    matches,
    occurrences,
    strip,
    sub,
    swap,
    text,
    words,
)
from rubrica.functions.text import NON_WORD, SPACE

# Unit words of worded math problems, in the order they are removed. "." in a unit matches any character.
UNIT_WORDS = [
    "east", "degree", "mph", "kmph", "ft", "m sqaure", " m east", "sq m", "deg", "mile", "q .", "monkey", "prime",
    "ratio", "profit of rs", "rd", "o", "gm", "p . m", "lb", "tile", "per", "dm", "lt", "gain", "ab", "way", "west",
    "a .", "b .", "c .", "d .", "e .", "f .", "g .", "h .", "t", "a", "h", "no change", "men", "soldier", "pie", "bc",
    "excess", "st", "inches", "noon", "percent", "by", "gal", "kmh", "c", "acre", "rise", "a . m", "th", "π r 2", "sq",
    "mark", "l", "toy", "coin", "sq . m", "gallon", "° f", "profit", "minw", "yr", "women", "feet", "am", "pm", "hr",
    "cu cm", "square", "v â € ™", "are", "rupee", "rounds", "cubic", "cc", "mtr", "s", "ohm", "number", "kmph", "day",
    "hour", "minute", "min", "second", "man", "woman", "sec", "cube", "mt", "sq inch", "mp", "∏ cm ³", "hectare",
    "more", "sec", "unit", "cu . m", "cm 2", "rs .", "rs", "kg", "g", "month", "km", "m", "cm", "mm", "apple", "liter",
    "loss", "yard", "pure", "year", "increase", "decrease", "d", "less", "Surface", "litre", "pi sq m", "s .", "metre",
    "meter", "inch",
]

# Literal rewrites and removals of the minerva form, in order.
MINERVA_REWRITES = [
    ("an ", ""),
    ("a ", ""),
    (".$", "$"),
    ("\\$", ""),
    ("\\ ", ""),
    (" ", ""),
    ("mbox", "text"),
    (",\\text{and}", ","),
    ("\\text{and}", ","),
    ("\\text{m}", "\\text{}"),
]
MINERVA_REMOVALS = [
    "square", "ways", "integers", "dollars", "mph", "inches", "ft", "hours", "km", "units", "\\ldots", "sue", "points",
    "feet", "minutes", "digits", "cents", "degrees", "cm", "gm", "pounds", "meters", "meals", "edges", "students",
    "childrentickets", "multiples", "\\text{s}", "\\text{.}", "\\text{\ns}", "\\text{}^2", "\\text{}^3", "\\text{\n}",
    "\\text{}", "\\mathrm{th}", "^\\circ", "^{\\circ}", "\\;", ",\\!", "{,}", '"', "\\dots",
]

# Measurement units of the plain form, in order, and its scale words.
PLAIN_UNITS = [
    "degree", "cm", "centimeter", "meter", "mile", "second", "minute", "hour", "day", "week", "month", "year", "foot",
    "feet", "inch", "yard",
]
SCALE_WORDS = [("million", "*10^6"), ("billion", "*10^9"), ("trillion", "*10^12")]

# LaTeX marks without a plain spelling of their own, wrappers of text, and relations and signs.
LATEX_NOTHING = [r"\\(?:left|right|displaystyle|limits)(?![a-zA-Z])\.?", r"\\[,;:!]"]
LATEX_BLANKS = r"\\(?:q?quad(?![a-zA-Z])| )|~"
LATEX_WRAPPER = r"\\(?:text|textbf|textit|textrm|mathrm|mathbf|mathit|mathsf|mbox|operatorname)\s*\{"
LATEX_SIGNS = [("leq?", "≤"), ("geq?", "≥"), ("neq?", "≠"), ("lt", "<"), ("gt", ">"), ("pm", "±"), ("mp", "∓"), ("approx", "≈")]
LATEX_SIGNS += [("in", "∈"), ("cap", "∩"), ("to", "→"), ("ldots", "…"), ("cdots", "⋯"), ("div", "÷"), ("angle", "∠")]

# Greek letters by macro name, in alphabetical order of the names.
GREEK = {
    "alpha": "α", "beta": "β", "chi": "χ", "delta": "δ", "epsilon": "ϵ", "eta": "η", "gamma": "γ", "iota": "ι",
    "kappa": "κ", "lambda": "λ", "mu": "μ", "nu": "ν", "omega": "ω", "phi": "ϕ", "psi": "ψ", "rho": "ρ", "sigma": "σ",
    "tau": "τ", "theta": "θ", "upsilon": "υ", "varepsilon": "ε", "varphi": "φ", "xi": "ξ", "zeta": "ζ",
}

# LaTeX symbols, and the plain spelling of such characters.
LATEX_SYMBOLS = [("pi", "π"), ("infty", "∞"), ("cup", "∪"), ("cdot", "·"), ("times", "×")]
PLAIN_SYMBOLS = [("√", "sqrt"), ("π", "pi"), ("∞", "inf"), ("∪", "U"), ("·", "*"), ("×", "*")]

# Repeats are possessive: Java matches them in a loop, where a plain repeated group recurses once per part.
_DIGITS = r"[0-9]++(?:_[0-9]++)*+"
NUMBER = rf"[+-]?(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"


def unit_words() -> list[str]:
    """All units, then all their plurals."""
    return UNIT_WORDS + [u + "s" for u in UNIT_WORDS]


def any_unit_pattern() -> str:
    return rf"(?:\A|{NON_WORD})(?:{'|'.join(dict.fromkeys(unit_words()))})(?:\z|{NON_WORD})"


_PARTS = rf"[\p{{L}}\p{{N}}_]++|{NON_WORD}"


def _is_word(unit: str) -> bool:
    return all(c.isalnum() or c == "_" for c in unit)


def without_units(x: str) -> str:
    """Remove every unit in order, twice over; a removal that would leave nothing is skipped.

    A text without any unit is returned at once (one regex over all of them). Of any other the words are looked up in a map
    from units to their places in the list, so the fold visits only units that occur, in order; units with blanks, dots or
    signs are few and always visited, behind a substring test. A unit that is one word is cut out of the parts of the text;
    as a match takes the characters on its both sides with it, a second one right behind it stays for the next round.
    """
    units = unit_words()
    places: dict[str, list[int]] = {}
    for n, unit in enumerate(units):
        places.setdefault(unit, []).append(n)
    entries = [f"{u}={','.join(map(str, at))}" for u, at in places.items() if _is_word(u)]
    known = f"str_to_map({text(chr(9).join(entries))}, {text(chr(9))}, '=')"
    odd = f"array({', '.join(str(n) for n, u in enumerate(units) if not _is_word(u))})"
    parts = lambda t: f"regexp_extract_all({t}, {text(_PARTS)}, 0)"

    def without_word(running: str, unit: str) -> str:
        # free: what stands left of a word is not part of a match yet
        cut = (
            f"aggregate({parts(running)}, named_struct('out', '', 'free', true, 'cut', false), (s, p) -> "
            f"CASE WHEN p = {unit} AND s.free THEN named_struct('out', s.out, 'free', false, 'cut', true) "
            f"ELSE named_struct('out', concat(s.out, p), 'free', NOT s.cut, 'cut', false) END, s -> s.out)"
        )
        return let(cut, lambda t: f"if({t} <> '', {t}, {running})")

    def without_phrase(running: str, unit: str) -> str:
        pattern = f"concat({text(rf'(\A|{NON_WORD})')}, {unit}, {text(rf'(\z|{NON_WORD})')})"
        cut = let(f"regexp_replace({running}, {pattern}, '$1$2')", lambda t: f"if({t} <> '', {t}, {running})")
        return f"if(contains({running}, substring_index({unit}, '.', 1)), {cut}, {running})"

    def step(running: str, place: str) -> str:
        one = lambda u: f"if({u} rlike {text(r'^[\p{L}\p{N}_]+$')}, {without_word(running, u)}, {without_phrase(running, u)})"
        return let(f"element_at({words(units)}, {place} + 1)", one)

    def one_round(running: str, _: str) -> str:
        met = f"flatten(transform(array_distinct({parts(running)}), p -> coalesce(split(try_element_at({known}, p), ','), array())))"
        visited = f"array_sort(concat({odd}, transform({met}, n -> CAST(n AS int))))"
        return f"if({matches(running, any_unit_pattern())}, {fold(visited, running, step)}, {running})"

    return fold("array(1, 2)", x, one_round)


def _unwrapped(x: str, end: str = r"\z") -> str:
    """The inside of an answer that is one ``\\text{...}`` on one line; NULL otherwise."""
    pattern = r"\A\\text\{([^\n]+?)\}" + end
    return f"if({matches(x, pattern)}, {group(x, pattern, 1)}, NULL)"


def _without_text_unit(x: str) -> str:
    return let(strip(sub(x, r"\\text\{[^\n]*?\}\z", "")), lambda rest: f"if({rest} <> '', {rest}, {x})")


def _without_right_unit(x: str) -> str:
    marker = "\\text{ "
    return f"if({occurrences(x, marker)} <= 1, substring_index({x}, {text(marker)}, 1), NULL)"


def _without_short_prefix(x: str) -> str:
    is_short = f"{occurrences(x, '=')} = 1 AND length(substring_index({x}, '=', 1)) <= 2"
    return f"if({is_short}, substring_index({x}, '=', -1), {x})"


def _with_root_braces(x: str) -> str:
    """``\\sqrt3`` to ``\\sqrt{3}``; NULL when a root has no argument."""
    bare = matches(x, r"\\sqrt(?:\z|\\sqrt)")
    return f"if({bare}, NULL, {sub(x, r'\\sqrt([^{])', r'\\sqrt{$1}')})"


def _with_fraction_braces(x: str) -> str:
    """``\\frac12`` to ``\\frac{1}{2}`` and ``\\frac1{b}`` to ``\\frac{1}{b}``.

    The first fraction without both arguments decides: with no argument at all the result is NULL, with a single
    character the whole text stays as it is.
    """
    broken = r"\\frac([^{]?)(?:\z|(?=\\frac))"
    braced = sub(sub(x, r"\\frac([^{])([^{])", r"\\frac{$1}{$2}"), r"\\frac([^{])\{", r"\\frac{$1}{")
    return (
        f"CASE WHEN NOT {has(x, '\\frac')} THEN {x} WHEN NOT {matches(x, broken)} THEN {braced} "
        f"WHEN {group(x, broken, 1)} <> '' THEN {x} END"
    )


def _without_notation(x: str) -> str:
    x = swap(drop(x, "\n", "\\!"), ("\\\\", "\\"))
    x = sub(x, r"\\begin\{array\}\{[^\n]*?\}", r"\\begin{pmatrix}")
    x = swap(x, ("\\end{array}", "\\end{pmatrix}"), ("bmatrix", "pmatrix"), ("tfrac", "frac"), ("dfrac", "frac"))
    x = swap(x, ("\\neq", "\\ne"), ("\\leq", "\\le"), ("\\geq", "\\ge"))
    x = without_units(let(drop(x, "\\left", "\\right"), _without_text_unit))
    x = drop(let(drop(x, "^{\\circ}", "^\\circ", "\\$"), _without_right_unit), "\\%")
    x = sub(swap(x, (" .", " 0."), ("{.", "{0.")), r"\A\.", "0.")
    x = let(let(x, _without_short_prefix), _with_root_braces)
    x = let(drop(x, " "), _with_fraction_braces)
    x = sub(x, r"\A0\.5\z", r"\\frac{1}{2}")
    # a whole answer a/b of two plainly written integers
    return sub(x, r"\A(0|-?[1-9][0-9]*)/(0|-?[1-9][0-9]*)\z", r"\\frac{$1}{$2}")


def mathd(x: str) -> str:
    """Units and notation removed, short LaTeX written out; the trimmed answer where that fails."""
    unwrapped = let(strip(x), lambda t: f"coalesce({strip(_unwrapped(t))}, {t})")
    return let(unwrapped, lambda t: f"coalesce({_without_notation(t)}, {t})")


def minerva(x: str) -> str:
    """The published clean-up of quantitative answers."""
    x = fold(words(MINERVA_REMOVALS), swap(x, *MINERVA_REWRITES), lambda running, gone: f"replace({running}, {gone}, '')")
    # of a line with two dollar signs, what is between the first two; anchored, so other lines are passed over once
    x = sub(x, r"(?dm)^[^\n$]*+\$([^\n$]*+)\$[^\n]*", r"\$$1\$")
    for macro in ("text", "textbf", "overline"):
        x = sub(x, rf"\\{macro}\{{([^\n]*?)\}}", "$1")
    x = sub(x, r"\\boxed\{([^\n]*)\}", "$1")
    x = sub(sub(x, r"frac([^{])([^\n])", "frac{$1}{$2}"), r"sqrt([^{])", "sqrt{$1}")
    digits = r"\A,*[\p{Nd}²³¹⁰⁴-⁹₀-₉][\p{Nd}²³¹⁰⁴-⁹₀-₉,]*\z"
    return let(drop(x, "$"), lambda t: f"if({matches(t, digits)}, {drop(t, ',')}, {t})")


def without_number_commas(x: str) -> str:
    """Remove thousands commas until nothing changes.

    A match eats the character after its three digits, so of a row of commas the first pass takes every other one:
    ``1,234,567,890`` becomes ``1234,567890``. A comma left over is now followed by six digits and stays, except a last
    one, which the second pass takes. A third pass never finds anything.
    """
    one_pass = lambda t: sub(t, r"(\p{Nd}),(\p{Nd}{3})(\z|\P{Nd})", "$1$2$3")
    return one_pass(one_pass(x))


def as_float(x: str) -> str:
    """The value of a text that spells a finite or overflowing decimal number, else NULL."""
    number = rf"\A[{SPACE}]*{NUMBER}[{SPACE}]*\z"
    return f"if({matches(x, number)}, try_cast({drop(strip(x), '_')} AS double), NULL)"


def is_integral(v: str) -> str:
    """Within 1e-7 of an integer; NULL and infinities are not."""
    return f"coalesce(abs({v}) < double('inf') AND abs({v} - rint({v})) <= 1e-7D, false)"


def _times_power(limbs: str, shift: str) -> str:
    """Limbs of nine decimal digits, lowest first, times 2 ** shift for a shift of at most 29."""
    step = (
        f"named_struct('out', concat(s.out, array((l * shiftleft(1L, {shift}) + s.carry) % 1000000000L)), "
        f"'carry', (l * shiftleft(1L, {shift}) + s.carry) div 1000000000L)"
    )
    start = "named_struct('out', CAST(array() AS array<bigint>), 'carry', 0L)"
    return f"aggregate({limbs}, {start}, (s, l) -> {step}, s -> if(s.carry > 0, concat(s.out, array(s.carry)), s.out))"


def _wide_integer_text(v: str) -> str:
    """The digits of a finite double of at least 2 ** 55 in size: its 53 bits as limbs, doubled as often as its exponent says."""

    def digits(e: str) -> str:
        bits = f"CAST(abs({v}) / pow(2D, {e}) AS bigint)"
        limbs = f"array({bits} % 1000000000L, {bits} div 1000000000L)"
        shifts = f"concat(array_repeat(29, CAST({e} div 29 AS int)), array({e} % 29))"
        grown = fold(shifts, limbs, _times_power)
        spelled = "transform(reverse(g), (l, i) -> if(i = 0, CAST(l AS string), lpad(CAST(l AS string), 9, '0')))"
        whole = f"element_at(transform(array({grown}), g -> array_join({spelled}, '')), 1)"
        return f"concat(if({v} < 0, '-', ''), trim(LEADING '0' FROM {whole}))"

    # one less than the exponent of the lowest bit, in case the logarithm is rounded up
    return let(f"CAST(floor(log2(abs({v}))) AS int) - 53", digits)


def integer_text(v: str) -> str:
    """The decimal digits of a finite integral double of any size."""
    return f"if(abs({v}) < 9.0e18D, CAST(CAST({v} AS bigint) AS string), {_wide_integer_text(v)})"


def is_integer_text(x: str) -> str:
    return let(let(without_number_commas(x), as_float), is_integral)


def _without_groups(x: str) -> str:
    """Fractions and roots of any depth as ``a/b`` and ``sqrt(a)``, text wrappers and braces dropped, in one fold.

    The fold goes over tokens with a stack of open groups, each 4 * the token's number + a kind: 1 and 2 for the arguments of
    a fraction, 3 for a root, 0 for any other group. Closing the last group of a fraction or root notes what becomes of its
    tokens, as 8 * number + role; one that never closes stays as written. Roles then meet the tokens in the order of numbers.
    """
    fraction, root = r"\\frac\s*\{", r"\\sqrt\s*(?:\[[^\]]*\]\s*)?\{"
    pieces = [fraction, root, LATEX_WRAPPER, r"\{", r"\\[{}]", r"\}\s*\{", r"\}", r"[^\\{}]+", r"\\[a-zA-Z]*"]
    tokens = f"regexp_extract_all({x}, {text('(?s)' + '|'.join(pieces))}, 0)"
    is_group = lambda t: f"(right({t}, 1) IN ('{{', '}}') AND NOT (length({t}) = 2 AND left({t}, 1) = {text(chr(92))}))"
    begins = lambda t, macro: f"startswith({t}, {text(chr(92) + macro)})"
    macro, middle, opening_of_root, end_of_root, usual = range(5)

    def step(s: str, t: str) -> str:
        def state(groups: str, done: str = f"{s}.done") -> str:
            return f"named_struct('n', {s}.n + 1, 'open', {groups}, 'done', {done})"

        pushed = lambda groups, kind: f"concat({groups}, array(4 * {s}.n + {kind}))"
        role = lambda number, of: f"8 * ({number}) + {of}"
        top, below = f"{s}.open[size({s}.open) - 1]", f"{s}.open[size({s}.open) - 2]"
        kind = f"if(size({s}.open) = 0, -1, {top} & 3)"
        left = f"slice({s}.open, 1, size({s}.open) - CASE {kind} WHEN -1 THEN 0 WHEN 2 THEN 2 ELSE 1 END)"
        done = (
            f"CASE {kind} WHEN 2 THEN concat({s}.done, array({role(f'{below} div 4', macro)}, {role(f'{top} div 4', middle)})) "
            f"WHEN 3 THEN concat({s}.done, array({role(f'{top} div 4', opening_of_root)}, {role(f'{s}.n', end_of_root)})) ELSE {s}.done END"
        )
        opened = f"CASE WHEN {begins(t, 'frac')} THEN 1 WHEN {begins(t, 'sqrt')} THEN 3 ELSE 0 END"
        seam = f"if({kind} = 1, {pushed(f'{s}.open', 2)}, {pushed(left, 0)})"
        return (
            f"CASE WHEN NOT {is_group(t)} THEN {state(f'{s}.open')} WHEN {t} = '}}' THEN {state(left, done)} "
            f"WHEN left({t}, 1) = '}}' THEN {state(seam, done)} ELSE {state(pushed(f'{s}.open', opened))} END"
        )

    def spelled(t: str, role: str) -> str:
        blank = f"replace(replace({t}, '{{', ''), '}}', '')"
        kept = " ".join(f"WHEN {begins(t, m)} THEN {text(chr(92) + m)}" for m in ("frac", "sqrt"))
        return (
            f"CASE {role} WHEN {macro} THEN '' WHEN {middle} THEN '/' WHEN {opening_of_root} THEN 'sqrt(' "
            f"WHEN {end_of_root} THEN concat(')', {blank}) "
            f"ELSE CASE WHEN NOT {is_group(t)} THEN {t} {kept} WHEN {begins(t, '')} THEN '' ELSE {blank} END END"
        )

    def joined(v: str) -> str:
        none = "CAST(array() AS array<bigint>)"
        done = fold(v, f"named_struct('n', 0L, 'open', {none}, 'done', {none})", step) + ".done"
        # a role noted sorts before the usual one of the same token
        every = f"array_sort(concat({done}, transform({v}, (t, i) -> 8L * i + {usual})))"
        roles = let(every, lambda r: f"filter({r}, (e, k) -> k = 0 OR e div 8 <> {r}[greatest(k, 1) - 1] div 8)")
        return f"array_join(zip_with({v}, {roles}, (t, e) -> {spelled('t', 'pmod(e, 8)')}), '')"

    return f"if({matches(x, r'[{}]')}, {let(tokens, joined)}, {x})"


def latex_to_plain(x: str) -> str:
    """Fractions, roots and common symbols as plain text without braces; any other macro stays as written (see
    latex_unsupported)."""
    for pattern in LATEX_NOTHING:
        x = sub(x, pattern, "")
    x = sub(x, LATEX_BLANKS, " ")
    x = swap(x, ("\\tfrac", "\\frac"), ("\\dfrac", "\\frac"), ("\\frac", " \\frac"))
    x = sub(x, r"\\frac\s*([0-9a-zA-Z])\s*([0-9a-zA-Z])", "$1/$2")
    x = sub(x, r"\\frac\s*([0-9a-zA-Z])\s*\{", r"\\frac{$1}{")
    x = sub(x, r"(\\frac\s*\{[^{}]*\})\s*([0-9a-zA-Z])", "$1{$2}")
    x = sub(x, r"\\sqrt\s*([0-9a-zA-Z])", "sqrt($1)")
    x = let(x, _without_groups)

    def marks(t: str) -> str:
        for name, sign in [*LATEX_SIGNS, *GREEK.items()]:
            t = sub(t, rf"\\{name}(?![a-zA-Z])", sign)
        return sub(t, r"\\([{}])", "$1")

    # signs first and their words last, so that no macro runs into a word
    for name, sign in LATEX_SYMBOLS:
        x = sub(x, rf"\\{name}(?![a-zA-Z])", sign)
    return strip(swap(let(x, lambda t: f"if({has(t, '\\')}, {marks(t)}, {t})"), *PLAIN_SYMBOLS))


def _without_plain_units(x: str) -> str:
    """Remove every unit, its plural and its power, in order; a unit that does not occur costs a substring test."""

    def step(running: str, unit: str) -> str:
        cut = f"regexp_replace({running}, concat({unit}, {text(r'(?:es)?s? *(?:\^[0-9]+)?')}), '')"
        return f"if(contains({running}, {unit}), {cut}, {running})"

    return fold(words(PLAIN_UNITS), x, step)


def _whole_float(x: str) -> str:
    return let(as_float(x), lambda v: f"if({is_integral(v)}, {let(f'rint({v})', integer_text)}, {x})")


def _one_integer_spelling(x: str) -> str:
    """An integer, with or without thousands commas, in one spelling; the fraction left over is cut off."""
    cut = lambda v: f"({v} - {v} % 1D)"
    whole = let(let(let(drop(x, ","), as_float), cut), integer_text)
    may_be_number = matches(x, rf"\A[{SPACE}0-9+.,_eE-]+\z")
    return f"if({may_be_number} AND {is_integer_text(x)}, {whole}, {x})"


def plain(x: str) -> str:
    """Lower-case text without units, spaces and braces, LaTeX in plain letters, integers in one spelling."""
    x = let(x, lambda t: f"coalesce({_unwrapped(t, r'\n?\z')}, {t})")
    x = swap(x, ("\\%", "%"), ("\\$", "$"), ("$", ""), ("%", ""), (" or ", " , "), (" and ", " , "), *SCALE_WORDS)
    x = sub(_without_plain_units(x), r"\^ *\\circ", "")
    x = sub(sub(x, r"(?s)\A\{(.*)\}\z", "$1"), r",\\! *", "")
    x = let(let(x, _whole_float), lambda t: f"if({has(t, '\\')}, {latex_to_plain(t)}, {t})")
    x = sub(sub(x, "- *", "-"), "([0-9]) +([0-9])", "$1+$2")
    return let(f"lower({drop(x, ' ', '{', '}')})", _one_integer_spelling)


normalize_mathd = column_function(mathd)
normalize_minerva = column_function(minerva)
normalize_plain = column_function(plain)
remove_units = column_function(without_units)
strip_number_commas = column_function(without_number_commas)
latex_unsupported = column_function(
    lambda x: has(latex_to_plain(swap(drop(x, "\\%", "\\$", "^\\circ"), (",\\!", ""))), "\\")
)

FORMS = {"mathd": normalize_mathd, "minerva": normalize_minerva, "plain": normalize_plain}


def normalize(c: Column, form: str) -> Column:
    if form not in FORMS:
        raise ValueError(f"unknown form {form!r}; choose one of {sorted(FORMS)}")
    return FORMS[form](c)
