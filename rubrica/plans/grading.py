"""Extraction, normal forms, graders and reports over completions derived from documents."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rubrica import templates
from rubrica.functions import extract, grade, normalize, numerics, verdicts
from rubrica.functions.prompts import render
from rubrica.functions.sqltext import text
from rubrica.operators import curate, grading, repetition, report
from rubrica.operators.scratch import scratch_path
from rubrica.operators.skew import spread
from rubrica.plans import sqlforms as S
from rubrica.plans.derive import answers, choose, completions, sql_answers, sql_completions, sql_render, sql_text
from rubrica.plans.registry import query, table
from rubrica.sources import files

GAP_SQL = r"regexp_replace(generated_text, '</think>\s*<answer>', '</think> <answer>', 'g')"


def _metrics(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(*keep, "metrics.format_reward", "metrics.answer_reward", "metrics.reward")


# --- extraction -------------------------------------------------------------------------------------------------


@query(
    "normalize_gap",
    f"SELECT doc_id, {GAP_SQL} AS generated_text FROM ({sql_completions()})",
)
def normalize_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return completions(spark, sf_dir).select(
        "doc_id", extract.normalize_gap(F.col("generated_text")).alias("generated_text")
    )


@query(
    "strip_think",
    rf"SELECT doc_id, regexp_replace(generated_text, '\A(<think>|[ \n])+', '') AS output FROM ({sql_completions()})",
)
def strip_think(spark: SparkSession, sf_dir: str) -> DataFrame:
    return completions(spark, sf_dir).select("doc_id", extract.strip_think(F.col("generated_text")).alias("output"))


R1_ANSWER_SQL = (
    "CASE WHEN contains(t, '</think> <answer>') AND contains(t, '</answer>') THEN "
    "replace(list_extract(string_split(t, '<answer>'), -1), '</answer>', '') END"
)


@query(
    "extract_tagged",
    f"SELECT doc_id, {R1_ANSWER_SQL} AS answer FROM (SELECT doc_id, {GAP_SQL} AS t FROM ({sql_completions()}))",
)
def extract_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = extract.normalize_gap(F.col("generated_text"))
    tagged = F.when(extract.has_answer_format(text), extract.tagged_answer(text))
    return completions(spark, sf_dir).select("doc_id", tagged.alias("answer"))


TAGGED_SQL = f"SELECT doc_id, {R1_ANSWER_SQL} AS a FROM (SELECT doc_id, {GAP_SQL} AS t FROM ({sql_completions()}))"


@query("extract_answers", f"SELECT doc_id, CASE WHEN contains(a, '\\boxed') THEN {S.simple_box('a')} ELSE a END AS answer FROM ({TAGGED_SQL})")
def extract_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    completed = completions(spark, sf_dir).withColumn("generated_text", extract.normalize_gap(F.col("generated_text")))
    return grading.extract_answers(completed, "generated_text", "r1_zero").select("doc_id", "answer")


BOX_SHAPES = [
    r"So \boxed{{given}} then",
    r"\boxed{1} and \boxed{\text{{given}} {}}",
    r"only \fbox{{given}}",
    r"open \boxed{\frac{1}{2}",
    r"\boxed }{{given}}",
    r"none: {given}",
]


def _boxed(value: Column) -> Column:
    text = F.when(F.lit(False), F.lit(""))
    for i, shape in enumerate(BOX_SHAPES):
        text = text.when(F.col("doc_id") % len(BOX_SHAPES) == i, render(shape, given=value))
    return F.concat("text", F.lit(" "), text)


def _sql_boxed(value: str) -> str:
    cases = " ".join(f"WHEN {i} THEN {sql_render(s, given=value)}" for i, s in enumerate(BOX_SHAPES))
    return f"text || ' ' || (CASE doc_id % {len(BOX_SHAPES)} {cases} END)"


@query(
    "extract_boxed",
    f"SELECT doc_id, CASE WHEN contains(t, '\\boxed') THEN {S.simple_box('t')} END AS answer "
    f"FROM (SELECT doc_id, {_sql_boxed('given')} AS t FROM ({sql_answers('text')}))",
)
def extract_boxed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answers(spark, sf_dir, "text").select(
        "doc_id", extract.extract_answer(_boxed(F.col("given"))).alias("answer")
    )


LETTER_SQL = "substr('ABCDE', CAST(doc_id % 5 AS INTEGER) + 1, 1)"
# (starts with the text, before the letter, behind it, letters that count)
CHOICE_SHAPES = [
    (True, " The correct answer is ", "x", ""),
    (True, " The correct answer is ", ".", "ABCD"),
    (True, " So the answer is (", ").", "ABCD"),
    (True, "\nAnswer: ", "", "ABCD"),
    (False, "**", "**", "ABCD"),
    (False, "", ".", "ABCD"),
    (True, " ANSWER IS **", "** then 10000", "ABCD"),
    (True, " The answer is: ", "\nbecause", "ABCD"),
    (True, " The answer is option ", ".", "ABCD"),
    (True, " Thus the answer is the choice (", ")", "ABCD"),
    (True, " The answer is $", "$.", "ABCD"),
    (True, " The answer is ", " good idea", "BCD"),
    (True, " The answer is ", " because it is", "ABCD"),
    (True, " so \\boxed{", "} holds", "ABCD"),
    (True, " The final answer is $\\boxed{\\text{(", ")}}$", "ABCD"),
    (True, " answers ", " are many", ""),
]


def _shaped(literal: Callable[[str], str]) -> str:
    """The output of a row in either engine's SQL."""
    letter = LETTER_SQL.replace("'ABCDE'", literal("ABCDE"))
    newline = lambda t: " || chr(10) || ".join(literal(part) for part in t.split("\n"))
    return choose("doc_id", [f"({'text || ' if whole else ''}{newline(lead)} || {letter} || {newline(end)})" for whole, lead, end, _ in CHOICE_SHAPES])


CHOICE_SQL = _shaped(sql_text)
#: The letter, where the shape of the output lets it count.
CHOSEN_SQL = f"CASE WHEN contains({choose('doc_id', [sql_text(c) for *_, c in CHOICE_SHAPES])}, {LETTER_SQL}) THEN {LETTER_SQL} END"


def _choice_output() -> Column:
    return F.expr(_shaped(text))


@query(
    "parse_mcq",
    f"SELECT doc_id, {CHOICE_SQL} AS output, {CHOSEN_SQL} AS choice FROM documents",
)
def parse_mcq(spark: SparkSession, sf_dir: str) -> DataFrame:
    outputs = table(spark, sf_dir, "documents").select("doc_id", _choice_output().alias("output"))
    return grading.parse_judgements(outputs, "output", "choice", "choice").select("doc_id", "output", "choice")


@query(
    "mcq_accuracy",
    f"SELECT lang AS subject, avg(CASE WHEN choice = gold THEN 1.0 ELSE 0.0 END) AS accuracy, count(*) AS n FROM ("
    f"SELECT lang, {CHOSEN_SQL} AS choice, substr('ABCD', CAST(n_chars % 4 AS INTEGER) + 1, 1) AS gold FROM documents) "
    f"GROUP BY ROLLUP (lang)",
)
def mcq_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = F.substring(F.lit("ABCD"), (F.col("n_chars") % 4 + 1).cast("int"), F.lit(1))
    answered = table(spark, sf_dir, "documents").select(
        F.col("lang").alias("subject"), gold.alias("gold"), verdicts.choice_letter(_choice_output()).alias("choice")
    )
    return report.choice_accuracy(answered, "choice", "gold")


NUMBER_SQL = "CASE WHEN doc_id % 3 = 0 THEN text ELSE text || ' = ' || CAST(doc_id % 9 + 1 AS VARCHAR) || ',204.50 clips' END"


@query(
    "parse_last_number",
    "SELECT doc_id, replace(list_extract(regexp_extract_all(output, "
    rf"'-?[0-9][0-9,]*(?:\.[0-9]+)?'), -1), ',', '') AS number FROM (SELECT doc_id, {NUMBER_SQL} AS output FROM documents)",
)
def parse_last_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    tail = F.concat(F.lit(" = "), (F.col("doc_id") % 9 + 1).cast("string"), F.lit(",204.50 clips"))
    output = F.when(F.col("doc_id") % 3 == 0, F.col("text")).otherwise(F.concat("text", tail))
    documents = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    outputs = documents.select("doc_id", output.alias("output"))
    return grading.parse_judgements(outputs, "output", "number", "number").select("doc_id", "number")


VERDICT_SQL = "CASE WHEN toxic = 1 THEN '  TRUE.' WHEN quality = 1 THEN 'False' ELSE chr(10) || 'not true' END"


def _verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.when(F.col("toxic") == 1, "  TRUE.").when(F.col("quality") == 1, "False").otherwise("\nnot true")
    return table(spark, sf_dir, "labels").select("doc_id", said.alias("model_response"))


@query(
    "safety_verdict",
    rf"SELECT doc_id, CASE WHEN starts_with(lower(regexp_replace({VERDICT_SQL}, '\A\s+', '')), 'true') "
    "THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS safe FROM labels",
)
def safety_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = grading.parse_judgements(_verdicts(spark, sf_dir), "model_response", "safety", "safe")
    return judged.select("doc_id", "safe")


@query(
    "safe_rate",
    "SELECT 'safe' AS metric, avg(CASE WHEN toxic = 1 THEN 0.0 ELSE 1.0 END) AS value FROM labels",
)
def safe_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = grading.parse_judgements(_verdicts(spark, sf_dir), "model_response", "safety", "safe")
    return report.metric_means(judged, "safe")


@query(
    "augment_predictions",
    "SELECT l.doc_id, d.text AS output, 'judge-a' AS model_name_or_path, "
    f"{VERDICT_SQL} AS model_response, CASE WHEN toxic = 1 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS safe "
    "FROM labels l JOIN documents d USING (doc_id)",
)
def augment_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("output"), F.col("lang").alias("model_name_or_path"))
    judged = curate.pair_by_key(inputs, _verdicts(spark, sf_dir), "doc_id")
    metrics = F.struct(verdicts.safe_flag(F.col("model_response")).alias("safe"))
    return curate.augment(judged, model_name_or_path=F.lit("judge-a"), metrics=metrics).select(
        "doc_id", "output", "model_name_or_path", "model_response", F.col("metrics.safe").alias("safe")
    )


RANKING_SQL = (
    "CASE WHEN toxic = 1 THEN 'I prefer model_1' ELSE '[{''model'': ''model_1'', ''rank'': ' || "
    "CAST(2 - quality AS VARCHAR) || '}, {''model'': ''model_2'', ''rank'': ' || CAST(1 + quality AS VARCHAR) || '}]' END"
)
WINNER_SQL = "CASE WHEN toxic = 1 THEN NULL WHEN quality = 1 THEN 'model_1' ELSE 'model_2' END"


def _rankings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = F.concat(
        F.lit("[{'model': 'model_1', 'rank': "), (2 - F.col("quality")).cast("string"),
        F.lit("}, {'model': 'model_2', 'rank': "), (1 + F.col("quality")).cast("string"), F.lit("}]"),
    )
    said = F.when(F.col("toxic") == 1, "I prefer model_1").otherwise(ranks)
    rankings = table(spark, sf_dir, "labels").select("doc_id", "quality", said.alias("ranking"))
    return grading.parse_judgements(rankings, "ranking", "ranking", "winner")


@query("parse_ranking", f"SELECT doc_id, {RANKING_SQL} AS ranking, {WINNER_SQL} AS winner FROM labels")
def parse_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rankings(spark, sf_dir).select("doc_id", "ranking", "winner")


@query(
    "win_rate",
    "SELECT avg(CASE WHEN w = 'model_1' THEN 1.0 WHEN w = 'model_2' THEN 0.0 END) AS win_rate, count(w) AS parsed, "
    f"count(*) AS total FROM (SELECT {WINNER_SQL} AS w FROM labels)",
)
def win_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.win_rate(_rankings(spark, sf_dir), "winner", "model_1")


# --- normal forms -----------------------------------------------------------------------------------------------


def _both_sides(form: str):
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        given = grading.normalize_answers(answers(spark, sf_dir), "given", form).withColumnRenamed("norm_answer", "norm_given")
        return grading.normalize_answers(given.drop("latex_unsupported"), "truth", form).select(
            "doc_id", "given", "norm_given", "truth", F.col("norm_answer").alias("norm_truth")
        )

    return build


def _sql_both_sides(form) -> str:
    return f"SELECT doc_id, given, norm_given, truth, norm_truth FROM ({form(form(sql_answers(), 'given', 'norm_given'), 'truth', 'norm_truth')})"


query("normalize_mathd", _sql_both_sides(S.mathd))(_both_sides("mathd"))
query("normalize_minerva", _sql_both_sides(S.minerva))(_both_sides("minerva"))
query("normalize_sympy_form", _sql_both_sides(S.plain))(_both_sides("plain"))


@query(
    "strip_commas",
    "SELECT doc_id, stripped FROM (SELECT doc_id, "
    f"{S.number_commas('x')} AS stripped FROM (SELECT doc_id, given || ' of ' || "
    "CAST(1000 + n_chars AS VARCHAR) || ',' || CAST(100 + doc_id % 900 AS VARCHAR) || ',000 (1,2,345)' AS x "
    f"FROM ({sql_answers('n_chars')})))",
)
def strip_commas(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(
        "given", F.lit(" of "), (F.col("n_chars") + 1000).cast("string"), F.lit(","),
        (F.col("doc_id") % 900 + 100).cast("string"), F.lit(",000 (1,2,345)"),
    )
    return answers(spark, sf_dir, "n_chars").select("doc_id", normalize.strip_number_commas(text).alias("stripped"))


@query(
    "normalize_distinct",
    f"SELECT doc_id, given, norm_given FROM ({S.mathd(sql_answers(), 'given', 'norm_given')})",
)
def normalize_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    once = grading.normalize_answers(answers(spark, sf_dir), "given", "mathd", distinct=True, salt_by="doc_id")
    return once.select("doc_id", "given", F.col("norm_answer").alias("norm_given"))


# --- graders ----------------------------------------------------------------------------------------------------


@query(
    "grade_mathd",
    "SELECT doc_id, g IS NOT DISTINCT FROM t AS correct FROM "
    f"({S.mathd(S.mathd(sql_answers(), 'given', 'g'), 'truth', 't')})",
)
def grade_mathd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answers(spark, sf_dir).select("doc_id", grade.grade_mathd(F.col("given"), F.col("truth")).alias("correct"))


@query(
    "grade_sympy_form",
    "SELECT doc_id, correct FROM "
    f"({S.plain_equal(S.plain(S.plain(sql_answers(), 'given', 'g'), 'truth', 't'), 'g', 't', 'correct')})",
)
def grade_sympy_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answers(spark, sf_dir).select("doc_id", grade.grade_plain(F.col("given"), F.col("truth")).alias("correct"))


@query(
    "value_equal",
    f"SELECT doc_id, g = t OR coalesce({S.as_float('g')} = {S.as_float('t')}, false) AS correct FROM "
    f"({S.mathd(S.mathd(sql_answers(), 'given', 'g'), 'truth', 't')})",
)
def value_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answers(spark, sf_dir).select("doc_id", grade.value_equal(F.col("given"), F.col("truth")).alias("correct"))


@query(
    "grade_any",
    "SELECT doc_id, bool_or(correct) AS correct FROM ("
    + S.graded(
        f"SELECT doc_id, given, truth FROM ({sql_answers()}) UNION ALL "
        f"SELECT doc_id, given, truth || '.0' FROM ({sql_answers()})",
        "given",
        "truth",
    )
    + ") GROUP BY doc_id",
)
def grade_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    truths = F.array("truth", F.concat("truth", F.lit(".0")))
    return answers(spark, sf_dir).select("doc_id", grade.grade_any(F.col("given"), truths).alias("correct"))


# (given, truth, whether they are equal, not, or open to this engine); x and y are unknowns
ALGEBRA = [
    ("x+{a}", "{a}+x", "equal"),
    ("2(x+{a})", "2x+{h}", "equal"),
    ("(x+{a})(x-{a})", "x^2-{q}", "equal"),
    ("-x+{b}", "{b}-x", "equal"),
    ("1/(x-{b}y)", "-1/({b}y-x)", "equal"),
    ("{a}.5x", "{k}x/2", "equal"),
    (r"{b}\sqrt{2}", r"\sqrt{{d}}", "equal"),
    (r"\frac{x}{{b}}", "{b}^-1x", "equal"),
    ("x^2+{a}x", "x(x+{a})", "open"),
    ("{b}^x", "x^{b}", "open"),
    ("x+{a}y+z", "z+x+{a}y", "other"),
    ("x+{a}", "x-{a}-1", "other"),
]


def _algebra(string_type: str, literal: Callable[[str], str]) -> list[str]:
    """Columns of expressions over row numbers, in either engine's SQL; of every fifth row the truth is one more."""
    a, b = "(doc_id % 50)", "(n_chars % 7 + 2)"
    numbers = {"a": a, "b": b, "h": f"(2 * {a})", "k": f"(2 * {a} + 1)", "q": f"({a} * {a})", "d": f"(2 * {b} * {b})"}
    values = {n: f"CAST({v} AS {string_type})" for n, v in numbers.items()}
    pick = lambda i: choose("doc_id", [sql_render(t[i], literal, **values) for t in ALGEBRA])
    one_more = f"{literal('1+(')} || {pick(1)} || {literal(')')}"
    kind = choose("doc_id", [literal(t[2]) for t in ALGEBRA])
    truth = f"CASE WHEN n_chars % 5 = 0 THEN {one_more} ELSE {pick(1)} END"
    return ["doc_id", "n_chars", f"{pick(0)} AS given", f"{truth} AS truth", f"{kind} AS kind"]


@query(
    "grade_algebra",
    "SELECT doc_id, given, truth, kind = 'equal' AND n_chars % 5 <> 0 AS correct, kind = 'open' AS needs_algebra "
    f"FROM (SELECT {', '.join(_algebra('VARCHAR', sql_text))} FROM documents)",
)
def grade_algebra(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spread(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id")
    pairs = documents.selectExpr(*_algebra("STRING", text))
    return grading.grade_answers(pairs, "given", "truth", flag="needs_algebra").select("doc_id", "given", "truth", "correct", "needs_algebra")


@query("repetition_flag")
def repetition_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = repetition.flag_repetition(spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id"), "text")
    return flagged.select("doc_id", F.round("repetition", 9).alias("repetition"), "is_repetitive")


def sql_repetition(source: str, keys: str, column: str) -> str:
    """Share of repeated substrings of each text: sorted suffixes, and the common prefix of neighbours by halving steps."""
    steps = f"SELECT *, 0 AS common FROM (SELECT {keys}, {column} AS whole, s, lag(s) OVER (PARTITION BY {keys} ORDER BY s) AS b FROM " \
        f"(SELECT *, unnest(list_transform(range(1, length({column}) + 1), lambda i: substr({column}, i))) AS s FROM ({source})))"
    for size in (2048, 1024, 512, 256, 128, 64, 32, 16, 8, 4, 2, 1):
        same = f"length(s) >= common + {size} AND substr(s, common + 1, {size}) = substr(b, common + 1, {size})"
        steps = f"SELECT * EXCLUDE (common), common + CASE WHEN {same} THEN {size} ELSE 0 END AS common FROM ({steps})"
    share = "CASE WHEN any_value(length(whole)) < 2 THEN 0.0 ELSE 2.0 * sum(common) / (any_value(length(whole)) * (any_value(length(whole)) + 1.0)) END"
    return f"SELECT {keys}, {share} AS share FROM ({steps}) GROUP BY {keys}"


@query(
    "repetition_turns",
    "SELECT conv_id, turn, round(share, 9) AS repetition, share > 0.2 AS is_repetitive FROM "
    f"({sql_repetition('SELECT * FROM conversations', 'conv_id, turn', 'text')})",
)
def repetition_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spread(table(spark, sf_dir, "conversations").select("conv_id", "turn", "text"), "conv_id")
    return repetition.flag_repetition(turns, "text").select(
        "conv_id", "turn", F.round("repetition", 9).alias("repetition"), "is_repetitive"
    )


GATED_SQL = (
    "SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN text WHEN 1 THEN repeat(left(text, 3), 50) ELSE 'x = ' || turn END AS given, "
    "CASE turn % 3 WHEN 0 THEN ' ' || text WHEN 1 THEN repeat(left(text, 3), 50) ELSE turn || '.0' END AS truth FROM conversations"
)


@query(
    "latex_equal",
    "SELECT conv_id, turn, CASE WHEN length(given) > 128 AND (sg > 0.2 OR st > 0.2) THEN false ELSE gp = tp END AS latex_equal "
    f"FROM ({S.plain(S.plain(GATED_SQL, 'given', 'gp'), 'truth', 'tp')}) "
    f"JOIN (SELECT conv_id, turn, share AS sg FROM ({sql_repetition(GATED_SQL, 'conv_id, turn', 'given')})) USING (conv_id, turn) "
    f"JOIN (SELECT conv_id, turn, share AS st FROM ({sql_repetition(GATED_SQL, 'conv_id, turn', 'truth')})) USING (conv_id, turn)",
)
def latex_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spread(table(spark, sf_dir, "conversations").select("conv_id", "turn", "text"), "conv_id")
    kind, looped = F.col("turn") % 3, F.repeat(F.substring("text", 1, 3), F.lit(50))
    given = F.when(kind == 0, F.col("text")).when(kind == 1, looped).otherwise(F.concat(F.lit("x = "), F.col("turn")))
    truth = F.when(kind == 0, F.concat(F.lit(" "), F.col("text"))).when(kind == 1, looped).otherwise(F.concat(F.col("turn"), F.lit(".0")))
    pairs = turns.select("conv_id", "turn", given.alias("given"), truth.alias("truth"))
    return grading.latex_equal_answers(pairs, "given", "truth").select("conv_id", "turn", "latex_equal")


WORDY_SQL = (
    "SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN text ELSE given END AS given, "
    f"CASE WHEN doc_id % 8 = 0 THEN text ELSE truth END AS truth FROM ({sql_answers('text')})"
)


@query(
    "grade_slow",
    f"SELECT doc_id, true AS correct FROM ({WORDY_SQL}) WHERE given = truth UNION ALL SELECT doc_id, correct FROM "
    f"({S.graded(f'SELECT * FROM ({WORDY_SQL}) WHERE given <> truth', 'given', 'truth')})",
)
def grade_slow(spark: SparkSession, sf_dir: str) -> DataFrame:
    wordy = answers(spark, sf_dir, "text").withColumns(
        {
            "given": F.when(F.col("doc_id") % 4 == 0, F.col("text")).otherwise(F.col("given")),
            "truth": F.when(F.col("doc_id") % 8 == 0, F.col("text")).otherwise(F.col("truth")),
        }
    )
    return grading.grade_answers(wordy, "given", "truth").select("doc_id", "correct")


def _sql_rewards(source: str, answer: str, keep: str) -> str:
    """Rewards of a source with columns doc_id, truth, the kept ones and an answer expression."""
    graded = S.graded(f"SELECT *, {answer} AS answer FROM ({source})", "answer", "truth", "right_answer")
    right = "CASE WHEN formatted AND answer IS NOT NULL AND right_answer THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"
    return (
        f"SELECT {keep}, CASE WHEN formatted THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS format_reward, "
        f"{right} AS answer_reward, {right} AS reward FROM ({graded})"
    )


def sql_r1_zero(keep: str, *columns: str) -> str:
    text = f"SELECT * REPLACE ({GAP_SQL} AS generated_text) FROM ({sql_completions(*columns)})"
    tagged = f"SELECT *, {R1_ANSWER_SQL.replace('(t,', '(generated_text,')} AS tagged FROM ({text})"
    formatted = f"SELECT *, tagged IS NOT NULL AS formatted FROM ({tagged})"
    answer = f"CASE WHEN contains(tagged, '\\boxed') THEN {S.simple_box('tagged')} ELSE tagged END"
    return _sql_rewards(formatted, answer, keep)


def _length_reward(response: str, truths: list[str]) -> dict[str, float]:
    """A user's own reward: the response names a truth, and how short it is."""
    named = float(any(t in response for t in truths))
    return {"format_reward": 1.0, "answer_reward": named, "reward": named / (1 + len(response) // 1000)}


@query(
    "reward_user",
    "SELECT doc_id, 1.0::DOUBLE AS format_reward, contains(g, truth)::INTEGER::DOUBLE AS answer_reward, "
    "contains(g, truth)::INTEGER::DOUBLE / (1 + length(g) // 1000) AS reward "
    f"FROM (SELECT *, {GAP_SQL} AS g FROM ({sql_completions()}))",
)
def reward_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    reward = grade.from_python(_length_reward)
    return _metrics(grading.score(completions(spark, sf_dir), "generated_text", reward, F.array("truth")), "doc_id")


LATEX_SHAPES = [(r"\frac{{a}}{\sqrt{{b}}}", False), (r"\overline{{a}}", True), (r"{a}\times\pi", False), (r"\binom{{a}}{{b}}", True), ("{a}", False)]


def _latex(string_type: str, literal: Callable[[str], str]) -> str:
    values = {"a": f"CAST(doc_id % 50 AS {string_type})", "b": f"CAST(n_chars % 7 AS {string_type})"}
    return choose("doc_id", [sql_render(shape, literal, **values) for shape, _ in LATEX_SHAPES])


@query(
    "latex_unsupported",
    f"SELECT doc_id, {_latex('VARCHAR', sql_text)} AS given, {choose('doc_id', [str(open_).lower() for _, open_ in LATEX_SHAPES])} AS latex_unsupported FROM documents",
)
def latex_unsupported(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "documents").select("doc_id", F.expr(_latex("STRING", text)).alias("given"))
    return grading.normalize_answers(given, "given", "plain").select("doc_id", "given", "latex_unsupported")


@query("reward_r1_zero", sql_r1_zero("doc_id"))
def reward_r1_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = grading.score(completions(spark, sf_dir), "generated_text", grade.r1_zero_reward, F.array("truth"))
    return _metrics(scored, "doc_id")


@query(
    "reward_question_only",
    _sql_rewards(
        f"SELECT *, CASE WHEN contains(t, '\\boxed') THEN {S.simple_box('t')} END AS box, "
        f"coalesce(CASE WHEN contains(t, '\\boxed') THEN {S.simple_box('t')} END, NULL) IS NOT NULL AS formatted "
        f"FROM (SELECT doc_id, truth, {_sql_boxed('given')} AS t FROM ({sql_answers('text')}))",
        "box",
        "doc_id",
    ),
)
def reward_question_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    responses = answers(spark, sf_dir, "text").withColumn("response", _boxed(F.col("given")))
    metrics = grade.question_only_reward(F.col("response"), F.array("truth"))
    return _metrics(responses.withColumn("metrics", metrics), "doc_id")


def _prompts_and_completions(spark: SparkSession, sf_dir: str, *keep: str) -> tuple[DataFrame, DataFrame]:
    prompts = answers(spark, sf_dir, *keep).select("doc_id", *keep, F.array("truth").alias("truths"))
    return prompts, completions(spark, sf_dir).select("doc_id", "generated_text")


@query("score_join", sql_r1_zero("doc_id, lang, generated_text", "lang"))
def score_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompts, texts = _prompts_and_completions(spark, sf_dir, "lang")
    return _metrics(grading.grade_completions(texts, prompts, "doc_id"), "doc_id", "lang", "generated_text")


@query(
    "score_left_join",
    "SELECT a.doc_id, coalesce(s.generated_text, '') AS generated_text, coalesce(s.format_reward, 0) AS format_reward, "
    "coalesce(s.answer_reward, 0) AS answer_reward, coalesce(s.reward, 0) AS reward FROM documents a LEFT JOIN ("
    f"SELECT r.* FROM ({sql_r1_zero('doc_id, generated_text')}) r JOIN labels USING (doc_id)) s USING (doc_id)",
)
def score_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompts, texts = _prompts_and_completions(spark, sf_dir)
    served = texts.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    return _metrics(grading.grade_completions(served, prompts, "doc_id", how="left"), "doc_id", "generated_text")


@query(
    "metric_report",
    "SELECT lang, count(*) AS n, "
    + ", ".join(
        f"sum({m}) AS sum_{m}, avg({m}) AS avg_{m}" for m in ("format_reward", "answer_reward", "reward")
    )
    + f" FROM ({sql_r1_zero('lang', 'lang')}) GROUP BY lang",
)
def metric_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompts, texts = _prompts_and_completions(spark, sf_dir, "lang")
    return report.metric_report(grading.grade_completions(texts, prompts, "doc_id"), by=("lang",))


def _label_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose quality label stands in for a reward."""
    label = F.col("quality").cast("double")
    metrics = F.struct(F.lit(1.0).alias("format_reward"), label.alias("answer_reward"), label.alias("reward"))
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text", "n_chars")
    return documents.join(table(spark, sf_dir, "labels"), "doc_id").select(
        "doc_id", "lang", "n_chars", F.col("source").alias("prompt"),
        F.concat(F.lit("<think> \n"), "text").alias("generated_text"), metrics.alias("metrics"),
    )


@query(
    "rejection_filter",
    r"SELECT source AS prompt, regexp_replace('<think> ' || chr(10) || text, '\A(<think>|[ \n])+', '') AS output "
    "FROM documents JOIN labels USING (doc_id) WHERE quality = 1",
)
def rejection_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.rejection_filter(_label_scored(spark, sf_dir))


@query(
    "keep_rate",
    "SELECT lang, count(*) FILTER (quality = 1) AS kept, count(*) AS total FROM documents JOIN labels USING (doc_id) "
    "GROUP BY lang",
)
def keep_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.keep_rate(_label_scored(spark, sf_dir), by=("lang",))


@query(
    "generation_report",
    """
    WITH logits AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
    z AS (SELECT *, list_max(e) + ln(list_sum(list_transform(e, lambda v: exp(v - list_max(e))))) AS lse FROM logits),
    h AS (SELECT vec_id, label, -list_sum(list_transform(e, lambda v: exp(v - lse) * (v - lse))) AS entropy FROM z),
    g AS (SELECT d.lang, d.n_chars AS length, h.entropy, d.quality FROM h
          JOIN (SELECT * FROM documents JOIN labels USING (doc_id)) d ON h.vec_id = d.doc_id)
    SELECT lang, round(avg(entropy), 6) AS average_entropy,
           coalesce(avg(CASE WHEN quality > 0 THEN length END), 0) AS average_correct_length,
           coalesce(avg(CASE WHEN NOT quality > 0 THEN length END), 0) AS average_incorrect_length
    FROM g GROUP BY lang
    """,
)
def generation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    entropies = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("doc_id"), numerics.entropy(F.col("embedding")).alias("entropy")
    )
    logs = _label_scored(spark, sf_dir).join(entropies, "doc_id").withColumnRenamed("n_chars", "length")
    result = report.generation_report(logs, F.col("metrics.reward"), by=("lang",))
    return result.withColumn("average_entropy", F.round("average_entropy", 6))


# --- prompts ----------------------------------------------------------------------------------------------------


@query(
    "render_prompt",
    f"SELECT doc_id, {sql_render(templates.R1_ZERO, question='text')} AS r1_zero, "
    f"{sql_render(templates.QUESTION_ONLY, question='text')} AS question_only, "
    f"{sql_render(templates.INSTRUCTION_SFT, instruction='source', response='text')} AS instruction_sft, "
    f"{sql_render(templates.ZERO_SHOT_SYSTEM, instruction='text')} AS zero_shot FROM documents",
)
def render_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    text, source = F.col("text"), F.col("source")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        render(templates.R1_ZERO, question=text).alias("r1_zero"),
        render(templates.QUESTION_ONLY, question=text).alias("question_only"),
        render(templates.INSTRUCTION_SFT, instruction=source, response=text).alias("instruction_sft"),
        render(templates.ZERO_SHOT_SYSTEM, instruction=text).alias("zero_shot"),
    )


@query(
    "template_file",
    f"SELECT item_id, {sql_render(templates.R1_ZERO, question='text')} AS prompt FROM benchmark",
)
def template_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts by a template that is read from its file."""
    path = scratch_path(spark, "template")
    spark.createDataFrame([(templates.R1_ZERO,)], "value string").coalesce(1).write.option("lineSep", "\0").text(path)
    template = files.read_template(spark, path).removesuffix("\0")
    return table(spark, sf_dir, "benchmark").select("item_id", render(template, question=F.col("text")).alias("prompt"))


@query(
    "pairwise_prompt",
    f"SELECT doc_id, {sql_render(templates.PAIRWISE_JUDGE, instruction='source', output_1='text', output_2='lang')} "
    "AS prompt FROM documents",
)
def pairwise_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rubrica.functions.prompts import pairwise_judge_prompt

    prompt = pairwise_judge_prompt(F.col("source"), F.col("text"), F.col("lang"))
    return table(spark, sf_dir, "documents").select("doc_id", prompt.alias("prompt"))


@query(
    "fewshot_prompt",
    """
    WITH ranked AS (SELECT item_id % 7 AS subject, item_id, text,
                           row_number() OVER (PARTITION BY item_id % 7 ORDER BY item_id) AS rank FROM benchmark),
    blocks AS (SELECT subject, string_agg('Q: ' || text, chr(10) || chr(10) ORDER BY rank) AS block
               FROM ranked WHERE rank <= 3 GROUP BY subject)
    SELECT doc_id, coalesce(block || chr(10) || chr(10), '') || 'Q: ' || text AS prompt
    FROM documents LEFT JOIN blocks ON subject = doc_id % 9
    """,
)
def fewshot_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    exemplars = table(spark, sf_dir, "benchmark").withColumn("subject", F.col("item_id") % 7)
    questions = table(spark, sf_dir, "documents").select(
        "doc_id", (F.col("doc_id") % 9).alias("subject"), F.concat(F.lit("Q: "), "text").alias("question")
    )
    blocks = curate.fewshot_blocks(exemplars, "subject", "item_id", F.concat(F.lit("Q: "), "text"), k=3)
    return curate.fewshot_prompts(questions, blocks, "subject", "question", "doc_id").select("doc_id", "prompt")


@query(
    "url_decontam",
    r"""
    WITH p AS (SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim(url)),
                   '\A[a-z][a-z0-9+.-]*://', ''), '\Awww\.', ''), '#[^\n]*\z', ''), '/+\z', '') AS u FROM pages),
    listed AS (SELECT DISTINCT u FROM p JOIN labels ON page_id = doc_id WHERE toxic = 1)
    SELECT page_id, url, u IN (SELECT u FROM listed) AS contaminated FROM p
    """,
)
def url_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    toxic = table(spark, sf_dir, "labels").where("toxic = 1").select(F.col("doc_id").alias("page_id"))
    listed = pages.join(toxic, "page_id").select(F.concat(F.upper("url"), F.lit("/")).alias("listed_url"))
    path = scratch_path(spark, "urls")
    # a list file: one URL a line, with blank lines and blanks around
    listed.select(F.concat(F.lit("  "), "listed_url", F.lit("\n")).alias("value")).write.text(path)
    lines = files.read_lines(spark, path, "listed_url")
    return curate.flag_contaminated(pages, "url", lines, "listed_url", "page_id").select("page_id", "url", "contaminated")
