import pytest
from pyspark.sql import functions as F

from rubrica.functions import grade as G
from rubrica.operators import grading, repetition


def test_letters_and_gates(column):
    assert column(G.letter_count, ["x+y", "sqrt(2)", "abca", ""]) == [2, 0, 3, 0]
    assert column(G.may_evaluate, ["x^2", "x^12", "2^{3}", "x^(2)", "2^3^4", "abc"]) == [True] + [False] * 5
    assert column(G.is_fraction_text, ["1/2", "-1/2", "1/0", "1//2", "a/2"]) == [True, True, False, True, False]


def test_split_tuple(column):
    assert column(G.split_tuple, ["", "5", "(1, 2)", "[1,2)", "((1),2)", "1,2", "(1,000, 2)", "()"]) == [
        [], ["5"], ["1", "2"], ["1", "2"], ["((1),2)"], ["1,2"], ["1000", "2"], ["()"],
    ]


PLAIN = [
    ("1/2", "0.5", True), ("1/2", "2/4", False), ("1.0", "1", True), ("(1,0.5)", "(1,1/2)", True), ("(1,2)", "[1,2]", False),
    ("(1.0,2)", "(1,2)", True), ("x+1", "1+x", True), ("x", "x", True), ("7 3/4", "7.75", True), ("3*10^6", "3000000", False),
    ("2.5*10^3", "2500.5", False), ("-7+3/4", "-6.25", True), ("1/0", "5", False), ("", "5", False), ("", "", True),
    ("1,2", "2,1", False), ("(1,2,3)", "(1,2)", False), (".5", "0.50", True), ("0.333", "1/3", False), (None, None, False),
]


def test_plain_grader(column):
    got = column(G.grade_plain, [c[:2] for c in PLAIN])
    assert [(*c[:2], g) for c, g in zip(PLAIN, got)] == PLAIN


def test_algebra_flag(column):
    cases = [("x+1", "1+x", False), ("2^x", "x^2", True), ("x(x+1)", "x^2+x", True), ("1/2", "0.5", False), ("5", "6", False), ("abc", "abd", False), ("x", "x", False)]
    assert column(G.needs_algebra, [c[:2] for c in cases]) == [c[2] for c in cases]


def test_value_equal(column):
    cases = [("1e1", "10.0", True), ("nan", "nan", True), ("nan", "NaN", False), ("inf", "infinity", True),
             ("0.25", ".25", True), ("x", "y", False)]
    assert column(G.value_equal, [c[:2] for c in cases]) == [c[2] for c in cases]


def test_numeric_close(column):
    inf, nan = float("inf"), float("nan")
    cases = [(1.0, 1.00009, True), (1.0, 1.0002, False), (0.0, 1e-9, False), (0.0, 0.0, True), (inf, inf, True),
             (inf, 1.0, False), (nan, nan, False), (-inf, inf, False)]
    assert column(G.numeric_close, [c[:2] for c in cases], "double") == [c[2] for c in cases]


R1 = [
    ("<think>x</think> <answer>5</answer>", ["5"], (1.0, 1.0)),
    ("<think>x</think> <answer> 5.0 </answer>", ["5"], (1.0, 1.0)),
    ("x</think> <answer>\\boxed{7}</answer>", ["1", "\\boxed{7}"], (1.0, 1.0)),
    ("x</think> <answer>\\boxed{7</answer>", ["7"], (1.0, 0.0)),
    ("x</think> <answer>7</answer>", ["so \\boxed{7"], (1.0, 0.0)),
    ("x</think><answer>5</answer>", ["5"], (0.0, 0.0)),
    ("x</think> <answer>5", ["5"], (0.0, 0.0)),
    ("x</think> <answer>5</answer>", [], (1.0, 0.0)),
    ("x</think> <answer></answer>", ["5"], (1.0, 0.0)),
    ("</answer></think> <answer>\\frac12 miles", ["0.5"], (1.0, 1.0)),
]


def test_r1_zero_reward(column):
    got = column(G.r1_zero_reward, [c[:2] for c in R1], ["string", "array<string>"])
    assert [(g.format_reward, g.answer_reward, g.reward) for g in got] == [(f, r, r) for *_, (f, r) in R1]


def test_question_only_reward(column):
    cases = [("\\boxed{5}", ["5"]), ("\\boxed{5}", ["6"]), ("5", ["5"]), ("\\fbox{5}", ["5"]), ("\\boxed{", ["5"])]
    got = column(G.question_only_reward, cases, ["string", "array<string>"])
    assert [(g.format_reward, g.reward) for g in got] == [(1.0, 1.0), (1.0, 0.0), (0.0, 0.0), (0.0, 0.0), (0.0, 0.0)]


def test_hash_reward(column):
    import hashlib

    texts = [f"hmm {i}" for i in range(8)] + [""]
    want = [int(hashlib.sha256(t.encode()).hexdigest(), 16) % 10 / 10 for t in texts]
    assert [r.reward for r in column(G.hash_reward, texts)] == want


def test_grade_completions_agrees_with_the_row_wise_reward(spark):
    prompts = spark.createDataFrame([(i, c[1]) for i, c in enumerate(R1)] + [(99, ["1"])], "item_id long, truths array<string>")
    texts = spark.createDataFrame([(i, c[0]) for i, c in enumerate(R1)], "item_id long, generated_text string")
    loose = [(1.0, 1.0) if c[0].startswith("x</think><") else c[2] for c in R1]  # the job closes the gap first
    rows = grading.grade_completions(texts, prompts, "item_id").orderBy("item_id").collect()
    assert [(r.metrics.format_reward, r.metrics.reward) for r in rows] == loose
    kept = {r.item_id: r for r in grading.grade_completions(texts, prompts, "item_id", how="left").collect()}
    assert len(kept) == len(R1) + 1 and kept[99].generated_text == "" and kept[99].metrics.reward == 0.0
    assert [kept[i].metrics.reward for i in range(len(R1))] == [r for _, r in loose]


def test_many_completions_per_prompt(spark):
    prompts = spark.createDataFrame([(1, ["5"]), (2, ["7"]), (3, ["9"])], "item_id long, truths array<string>")
    rows = [(1, r, f"x</think> <answer>{r}.0</answer>") for r in range(60)] + [(2, 0, "x</think> <answer>7</answer>")]
    texts = spark.createDataFrame(rows, "item_id long, rollout long, generated_text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for salt_by in (None, "rollout"):
            scored = grading.grade_completions(texts, prompts, "item_id", how="left", salt_by=salt_by).collect()
            got = sorted((r.item_id, -1 if r.rollout is None else r.rollout, r.metrics.reward) for r in scored)
            assert got == [(1, r, float(r == 5)) for r in range(60)] + [(2, 0, 1.0), (3, -1, 0.0)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_metrics_alone_shuffle_no_texts(spark, tmp_path):
    texts = [(i, f"<think>{i}</think> <answer>{i}</answer>") for i in range(5)]
    spark.createDataFrame(texts, "item_id long, generated_text string").write.parquet(str(tmp_path / "c"))
    spark.createDataFrame([(i, [str(i)]) for i in range(5)], "item_id long, truths array<string>").write.parquet(str(tmp_path / "p"))
    completions, prompts = spark.read.parquet(str(tmp_path / "c")), spark.read.parquet(str(tmp_path / "p"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scored = grading.grade_completions(completions, prompts, "item_id").select("item_id", "metrics")
        plan = scored._jdf.queryExecution().executedPlan()
        assert "generated_text" not in plan.toString().split("Exchange")[0]
        assert all(r.metrics.reward == 1.0 for r in scored.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_python_reward_function(spark):
    fn = G.from_python(lambda response, truths: dict.fromkeys(("format_reward", "answer_reward", "reward"), float(response in truths)))
    df = spark.createDataFrame([("a", ["a", "b"]), ("c", ["a"])], "generated_text string, truths array<string>")
    rows = grading.score(df, "generated_text", fn, F.col("truths")).orderBy("generated_text").collect()
    assert [r.metrics.reward for r in rows] == [1.0, 0.0]


def test_distinct_normalisation_equals_the_narrow_one(spark):
    df = spark.createDataFrame([(i, ["10 miles", "\\frac12", None][i % 3]) for i in range(9)], "id long, a string")
    narrow = grading.normalize_answers(df, "a", "mathd")
    joined = grading.normalize_answers(df, "a", "mathd", distinct=True, salt_by="id").select(*narrow.columns)
    assert sorted(map(str, narrow.collect())) == sorted(map(str, joined.collect()))
    with pytest.raises(ValueError):
        grading.normalize_answers(df, "a", "mathd", distinct=True)


def test_slow_grader_refuses_long_repetition(spark):
    long = "ab" * 80
    df = spark.createDataFrame([("5", "5.0"), (long, long), ("x", "y"), (long + "1", long + "2"), ("\\boxed{5}", "so \\boxed{5}"), ("5", "so \\boxed{5}")], "g string, t string")
    got = [r.correct for r in grading.grade_answers(df, "g", "t").collect()]
    assert got == [True, True, False, False, False, True]
    gated = [r.latex_equal for r in grading.latex_equal_answers(df, "g", "t").collect()]
    assert gated == [True, False, False, False, False, True]
    flag = F.lit(True)
    refused = df.select(G.latex_equal(F.col("g"), F.col("t"), flag, flag).alias("r")).collect()
    assert [r.r for r in refused] == [True, False, False, False, False, False]


def brute_repetition(text):
    n = len(text)
    if n <= 1:
        return 0.0
    distinct = len({text[i:j] for i in range(n) for j in range(i + 1, n + 1)})
    return 1 - distinct / (n * (n + 1) / 2)


def test_repetition_equals_brute_force(spark):
    import random

    rng = random.Random(5)
    texts = ["", "a", "aa", "aaa", "aaaaa", "ab", "é😀é😀", "a" * 17]
    texts += ["".join(rng.choice("abc"[: rng.randint(1, 3)]) for _ in range(rng.randint(1, 60))) for _ in range(60)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(len(texts), None)], "i int, t string")
    rows = repetition.flag_repetition(df, "t").orderBy("i").collect()
    for text, row in zip(texts, rows):
        assert row.repetition == pytest.approx(brute_repetition(text), abs=1e-12), text
        assert row.is_repetitive == (brute_repetition(text) > 0.2)
    assert rows[-1].repetition == 0.0 and not rows[-1].is_repetitive
    gated = repetition.flag_repetition(df, "t", longer_than=30).orderBy("i").collect()
    assert all(g.repetition == (r.repetition if r.t and len(r.t) > 30 else 0.0) for g, r in zip(gated, rows))
