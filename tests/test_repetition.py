"""Repetition of texts as rows against sorted suffixes."""

import random

import pytest

from rubrica.operators import repetition as R



def plain_share(text):
    n = len(text or "")
    if n <= 1:
        return 0.0
    suffixes = sorted(text[i:] for i in range(n))
    total = 0
    for a, b in zip(suffixes, suffixes[1:]):
        total += next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return 2 * total / (n * (n + 1))


def sample_texts():
    draw = random.Random(1)
    base = "".join(draw.choice("abcdefgh ") for _ in range(1500))
    return [
        "", "a", "ab", "aa", None, "a" * 300, "abc" * 150, "日本語\U0001f600" * 40, "x" * 40 + "y" + "x" * 40,
        "".join(draw.choice("ab") for _ in range(700)), base + base[:700] + "q" + base[100:900], " \n".join(["some line of text"] * 30),
    ]


@pytest.mark.parametrize("width", [3, 16])
def test_rows_equal_sorted_suffixes(spark, width):
    texts = sample_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "key long, text string")
    got = {r.key: r.repetition for r in R.repetition_by_rows(df, width).collect()}
    assert got == pytest.approx({i: plain_share(t) for i, t in enumerate(texts)})


def test_long_and_short_texts_take_their_ways(spark):
    texts = sample_texts()
    df = spark.createDataFrame([(i, t, 1.5) for i, t in [*enumerate(texts), *enumerate(texts)]], "repetitions long, text string, key double")
    flagged = R.flag_repetition(df, "text", rows_over=200)
    assert flagged.columns == ["repetitions", "text", "key", "repetition", "is_repetitive"]
    rows = flagged.collect()
    assert len(rows) == 2 * len(texts)
    for r in rows:
        assert r.repetition == pytest.approx(plain_share(r.text)) and r.is_repetitive == (r.repetition > 0.2) and r.key == 1.5
    assert R.flag_repetition(df.limit(0), "text").count() == 0
