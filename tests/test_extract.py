from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rubrica.functions import extract, verdicts
from rubrica.functions.normalize import normalize_mathd, normalize_minerva
from rubrica.functions.text import strip

QUIET = {"deadline": None, "suppress_health_check": list(HealthCheck)}


def check(column, function, cases):
    assert column(function, [c[0] for c in cases]) == [c[1] for c in cases]


def test_gap_and_format(column):
    check(column, extract.normalize_gap, [
        ("a</think>\n\t <answer>b</think><answer>", "a</think> <answer>b</think> <answer>"),
        ("</think> so <answer>", "</think> so <answer>"),
        (None, None),
    ])
    check(column, extract.has_answer_format, [
        ("</think> <answer>1</answer>", True), ("</think>  <answer>1</answer>", False), ("</think> <answer>1", False),
    ])


def test_tagged_answer_is_the_last_one(column):
    check(column, extract.tagged_answer, [
        ("<answer>1</answer> <answer>2</answer> tail</answer>", "2 tail"),
        ("no tag</answer>", "no tag"),
    ])


def test_strip_think_stops_at_tabs(column):
    check(column, extract.strip_think, [
        ("<think> \n<think>x <think>", "x <think>"), ("\t<think>x", "\t<think>x"), (" \r\n", "\r\n"), ("", ""),
    ])


@settings(max_examples=30, **QUIET)
@given(st.lists(st.text(alphabet="<think> \n\tx", max_size=14), min_size=20, max_size=40))
def test_strip_think_equals_the_loop(column, texts):
    def loop(text):
        while text.startswith(("<think>", " ", "\n")):
            text = text[7:] if text.startswith("<think>") else text[1:]
        return text

    assert column(extract.strip_think, texts) == [loop(t) for t in texts]


def test_boxed_answers(column):
    check(column, extract.last_boxed, [
        (r"x \boxed{1} \boxed{\frac{1}{2}} y", r"\boxed{\frac{1}{2}}"),
        (r"\fbox{a}", r"\fbox{a}"), (r"\boxed}{}", None), (r"\boxed{a", None), ("none", None), (None, None),
        (r"\boxed {a}{b}", r"\boxed {a}"),
    ])
    check(column, extract.extract_answer, [
        (r"\boxed{a{b}c}d", "a{b}c"), (r"\boxed {a}", None), (r"\fbox{a}", None), (r"\boxed{}", ""), ("5", None),
        (r"\boxed{1} then \boxed", None),
    ])


@settings(max_examples=20, **QUIET)
@given(st.lists(st.text(alphabet="{}ab", max_size=12).map(lambda t: "\\boxed" + t), min_size=20, max_size=40))
def test_last_boxed_equals_a_scan(column, texts):
    def scan(text):
        depth = 0
        for i, ch in enumerate(text):
            depth += {"{": 1, "}": -1}.get(ch, 0)
            if ch == "}" and depth == 0:
                return text[: i + 1]
        return None

    assert column(extract.last_boxed, texts) == [scan(t) for t in texts]


def test_judgement_parsers(column):
    check(column, verdicts.choice_letter, [
        ("The correct answer is B. There is one.", "B"), ("The correct answer is 10000 things.", None),
        ("the CORRECT answer is (C)", "C"), ("The correct answer is Bob", None), ("B", "B"),
        ("So the answer is (B).", "B"), ("Answer: D", "D"), ("**C**", "C"), ("B.", "B"), ("Be careful", None),
        ("The answer is 10000", None), ("I answer is E", None), ("The answer is: B", "B"), ("answer is option B", "B"),
        ("The answer is $B$", "B"), (r"so \boxed{B}.", "B"), (r"The answer is \boxed{\text{C}}", "C"), ("The answer is A good idea", None),
        ("The answer is A because", "A"), ("The answer is A.", "A"), ("The answer is B good", "B"), ("Option C", "C"), ("(D)", "D"),
        ("The answer is the letter A", "A"), ("answers A", None), ("Answer : **A**", "A"), ("a good idea", None), ("The answer is A", "A"),
    ])
    check(column, verdicts.last_number, [
        ("sold 48/2 = 24 clips. sold 48+24 = 72 clips.", "72"), ("seventy-two clips", None),
        ("pay $1,234.50.", "1234.50"), ("it is -3", "-3"),
    ])
    check(column, verdicts.safe_flag, [(" \n True!", 0.0), ("FALSE", 1.0), ("", 1.0), ("untrue", 1.0)])
    good = "[{'model': 'model_2', 'rank': 2}, {\"model\": \"model_1\", \"rank\": 1}]"
    check(column, verdicts.ranking_winner, [
        (good, "model_1"), (good.replace("2}", "1}"), None), ("I like model_1", None),
    ])


def test_long_texts_take_linear_time(column):
    """Runs and tails of a million characters neither overflow the matcher's stack nor cost their square."""
    big = 1_000_000
    assert column(extract.strip_think, ["\n" * big + "<think>" * 1000 + "x"]) == ["x"]
    assert column(strip, ["a" + " " * big + "b "]) == ["a" + " " * big + "b"]
    assert column(extract.extract_answer, ["\\boxed{7} " + "y" * big]) == ["7"]
    assert column(extract.normalize_gap, ["</think>" + " " * big + "<answer>"]) == ["</think> <answer>"]
    assert column(verdicts.last_number, ["1," * (big // 2) + "x"]) == ["1" * (big // 2)]
    assert len(column(normalize_minerva, ["z" * big])[0]) == big
    assert len(column(normalize_mathd, ["z " * (big // 20)])[0]) == big // 20
