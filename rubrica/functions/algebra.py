"""Equality of two expressions by value, as SQL expressions: an operator-precedence fold and a randomised identity test.

Both sides are evaluated at fixed points of prime fields, every letter standing for a number of its own. Expressions that
agree at all points are equal as rational functions (two different ones of degree d agree at a point with a chance of d in
two thousand million); one point that differs settles the opposite. Numbers are read digit by digit into the field, so
their length does not matter.

Understood are decimals, letters, ``pi``, ``sqrt(...)``, brackets, + - * / ``**``, powers with a whole exponent from -9 to
9, and products without a sign (``2x(y+1)``). The primes are 3 modulo 4 and have the small primes as squares, so a root is
the one that is itself a square, and roots of constants multiply as real roots do. A point where a root does not exist or
a divisor is 0 says nothing; if no point says anything the answer is NULL, as for any text that is not understood.
"""

from rubrica.functions.sqltext import column_predicate, fold, let, matches, sub, text

# The four largest primes below 2^31 - 1 that are 7 modulo 8 and have all odd primes up to 41 as squares.
PRIMES = [2147481311, 2147366399, 2147260631, 2147161799]

#: Names of constants, functions and reserved words that a run of letters may spell; they are not products of letters.
NAMES = ["ln", "re", "im", "li", "ff", "rf", "oo", "zoo", "nan", "xi", "mu", "nu", "as", "if", "in", "is", "or"]

_END, _START = r"[0-9.)\p{L}]", r"[\p{L}(√]"
_TOKEN = r"[0-9]+\.?[0-9]*|\.[0-9]+|√\(|[-+*/~^()]|\p{L}"


def _marked(x: str) -> str:
    """``sqrt(`` as ``√(``, ``pi`` as ``π``, where they stand alone."""
    alone = r"(?<!\p{L}[0-9]{0,9})"
    return sub(sub(f"replace({x}, '**', '^')", rf"{alone}sqrt\(", "√("), rf"{alone}pi(?![\p{{L}}0-9])", "π")


def _understood(x: str) -> str:
    """A marked text of known characters: no function call, no reserved word, no number of an unusual spelling."""
    odd = (
        r"[^0-9\p{L}.+\-*/^()√]|sqrt|(?:(?!π)\p{L})[0-9]*\(|√(?!\()|\p{L}[0-9]*\.|\.[0-9]*\.|(?<![0-9])\.(?![0-9])"
        r"|(?<![0-9.])0[0-9xbo]|[0-9.][ej][+-]?[0-9]|[0-9.]j|\(\)"
        rf"|(?<!\p{{L}})(?:{'|'.join(NAMES)})(?!\p{{L}})"
    )
    return f"({x} <> '' AND NOT {matches(x, odd)})"


def _explicit(x: str) -> str:
    """Signs of products written out, a minus without a left side as ``~``, such a plus left out."""
    x = sub(x, rf"(?<={_END})(?={_START})", "*")
    x = sub(x, r"(?<=[)\p{L}])(?=[0-9])", "*")
    return sub(sub(x, rf"(?<!{_END})-", "~"), rf"(?<!{_END})\+", "")


def _postfix(x: str) -> str:
    """The tokens in postfix order, separated by blanks; NULL if brackets do not match.

    The fold keeps the signs that wait as text, so those of at least the next sign's rank are a trailing run of it.
    """
    spaced = lambda run: f"regexp_replace(reverse({run}), '(.)', ' $1')"

    def step(s: str, t: str) -> str:
        def popped(kinds: str, push: str, after: str = "") -> str:
            run = f"regexp_extract({s}.wait, {text(kinds + '*$')}, 0)"
            rest = f"substring({s}.wait, 1, length({s}.wait) - length({run}))"
            return f"named_struct('out', concat({s}.out, {spaced(run)}, {after or text('')}), 'wait', {push.format(rest=rest)})"

        opened = f"regexp_extract({s}.wait, {text(r'([(√])[-+*/~^]*$')}, 1)"
        root = f"CASE {opened} WHEN '(' THEN '' WHEN '√' THEN ' √' END"
        return (
            f"CASE WHEN {t} IN ('(', '√(', '~', '^') THEN named_struct('out', {s}.out, 'wait', concat({s}.wait, left({t}, 1))) "
            f"WHEN {t} IN ('+', '-') THEN {popped('[-+*/~^]', f'concat({{rest}}, {t})')} "
            f"WHEN {t} IN ('*', '/') THEN {popped('[*/~^]', f'concat({{rest}}, {t})')} "
            f"WHEN {t} = ')' THEN {popped('[-+*/~^]', 'left({rest}, length({rest}) - 1)', root)} "
            f"ELSE named_struct('out', concat({s}.out, ' ', {t}), 'wait', {s}.wait) END"
        )

    tokens = f"regexp_extract_all({x}, {text(_TOKEN)}, 0)"
    done = fold(tokens, "named_struct('out', '', 'wait', '')", step)
    closed = lambda s: f"if({matches(f'{s}.wait', '[(√]')}, NULL, substring(concat({s}.out, {spaced(f'{s}.wait')}), 2))"
    return let(done, closed)


def _power(base: str, exponent: str, p: str) -> str:
    """base ** exponent modulo p by squaring; both below 2^31. NULL if either is."""
    taken = f"if((shiftright(s.e, i) & 1) = 1, s.r * s.b % {p}, s.r)"
    step = f"named_struct('r', {taken}, 'b', s.b * s.b % {p}, 'e', s.e)"
    start = f"named_struct('r', 1L, 'b', {base}, 'e', {exponent})"
    return f"aggregate(sequence(0, 30), {start}, (s, i) -> {step}, s -> if(s.b IS NULL OR s.e IS NULL, NULL, s.r))"


def _residue(digits: str, p: str) -> str:
    """A run of digits of any length modulo p, nine at a time."""
    chunks = f"regexp_extract_all(lpad({digits}, 9 * CAST(ceil(length({digits}) / 9) AS int), '0'), '([0-9]{{9}})', 1)"
    return fold(chunks, "0L", lambda s, c: f"({s} * 1000000000L + CAST({c} AS bigint)) % {p}")


def _value(rpn: str, p: str) -> str:
    """The value of a postfix text in the field of p; NULL where it has none."""

    def operand(t: str) -> str:
        """Decimals are whole numbers over a power of ten."""
        whole = _residue(f"replace({t}, '.', '')", p)
        places = f"CAST(length({t}) - instr({t}, '.') AS bigint)"
        scaled = f"{whole} * {_power(_power('10L', places, p), f'{p} - 2', p)} % {p}"
        number = f"if(contains({t}, '.'), {scaled}, {whole})"
        return f"CASE WHEN {t} rlike '^[0-9.]' THEN {number} ELSE pmod(xxhash64({t}, {p}), {p}) END"

    def apply(t: str, below: str, top: str) -> str:
        whole = f"CASE WHEN {top} <= 9 THEN {top} WHEN {top} >= {p} - 9 AND {below} <> 0 THEN {top} - 1 END"
        base = f"if({t} = '^', {below}, if({t} = '/', nullif({top}, 0), {top}))"
        exponent = f"CASE {t} WHEN '^' THEN {whole} WHEN '/' THEN {p} - 2 ELSE ({p} + 1) div 4 END"
        raised = _power(base, exponent, p)
        root = f"if(r * r % {p} = {top}, r, NULL)"
        last = f"CASE {t} WHEN '^' THEN r WHEN '/' THEN {below} * r % {p} ELSE {root} END"
        return (
            f"CASE {t} WHEN '+' THEN ({below} + {top}) % {p} WHEN '-' THEN ({below} - {top} + {p}) % {p} "
            f"WHEN '*' THEN {below} * {top} % {p} WHEN '~' THEN ({p} - {top}) % {p} "
            f"ELSE element_at(transform(array({raised}), r -> {last}), 1) END"
        )

    def step(stack: str, t: str) -> str:
        arity = f"CASE WHEN {t} IN ('~', '√') THEN 1 ELSE 2 END"
        ends = f"array(try_element_at({stack}, -2), try_element_at({stack}, -1))"
        made = let(ends, lambda v: apply(t, f"{v}[0]", f"{v}[1]"))
        short = f"size({stack}) < {arity}"
        applied = f"concat(slice({stack}, 1, size({stack}) - {arity}), array({made}))"
        return (
            f"CASE WHEN NOT {t} rlike '^[-+*/~^√]$' THEN concat({stack}, array({operand(t)})) "
            f"WHEN {short} THEN array(CAST(NULL AS bigint), NULL) ELSE {applied} END"
        )

    done = fold(f"split({rpn}, ' ')", "CAST(array() AS array<bigint>)", step)
    return let(done, lambda s: f"if(size({s}) = 1, {s}[0], NULL)")


def same_value(a: str, b: str) -> str:
    """True or false by value; NULL when either side is not understood or no point decides."""

    def compare(v: str) -> str:
        at = lambda p: f"transform({v}, r -> {_value('r', p)})"
        verdict = let(at("CAST(p AS bigint)"), lambda w: f"{w}[0] = {w}[1]")
        # after a point that differs no other is evaluated
        primes = f"array({', '.join(map(str, PRIMES))})"
        decided = f"aggregate({primes}, CAST(NULL AS boolean), (s, p) -> if(s <=> false, s, coalesce({verdict}, s)))"
        return f"if({v}[0] IS NULL OR {v}[1] IS NULL, NULL, {decided})"

    marked = f"transform(array({a}, {b}), m -> {_marked('m')})"
    forms = lambda m: f"transform({m}, u -> if({_understood('u')}, {_postfix(_explicit('u'))}, NULL))"
    return let(let(marked, forms), compare)


expressions_equal = column_predicate(same_value)
