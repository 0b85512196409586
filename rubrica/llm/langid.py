"""Language spans: script ranges narrow the candidates, then Viterbi over word scores with a switching penalty."""

import re
import sys
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rubrica.llm.common import held_out

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORD = re.compile(r"[^\W\d_]+")
# Numbers that are neither digits nor letters (fractions, powers, Roman numerals) count as word characters to ``re``.
_NUMERALS = [c for c in map(chr, range(0x110000)) if unicodedata.category(c) in ("No", "Nl")]
# One set for each side of U+FFFF: only a set below it is searched at once, the other is for texts with such characters.
NUMERAL = re.compile("[" + "".join(c for c in _NUMERALS if c <= "\uffff") + "]")
HIGH = re.compile("[\U00010000-\U0010ffff]")
HIGH_NUMERAL = re.compile("[" + "".join(c for c in _NUMERALS if c > "\uffff") + "]")
CACHE = 200_000
GROUP_CHARS = 4_000_000
BARRED = -30.0

# First code point of each range and its script, in order; letters before the first range are Latin.
SCRIPTS = (
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0780, "other"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "other"),
    (0x0B80, "Tamil"), (0x0C00, "other"), (0x0E00, "Thai"), (0x0E80, "other"), (0x10A0, "Georgian"),
    (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "other"), (0x1E00, "Latin"), (0x1F00, "Greek"),
    (0x2000, "other"), (0x3040, "Kana"), (0x3100, "other"), (0x3400, "Han"), (0xA000, "other"),
    (0xAC00, "Hangul"), (0xD7B0, "other"), (0xF900, "Han"), (0xFB00, "Latin"), (0xFB13, "other"),
    (0xFF21, "Latin"), (0xFF66, "Kana"), (0xFFA0, "Hangul"), (0xFFE0, "other"), (0x20000, "Han"),
)
FIRSTS = [first for first, _ in SCRIPTS]


@dataclass
class Model:
    languages: list[str]
    grams: dict[str, np.ndarray]
    unseen: np.ndarray
    scripts: dict[str, np.ndarray]


def lettered(text: str | None) -> str:
    """The text with blanks in place of such numerals, so that its words are letters only; offsets stay."""
    text = NUMERAL.sub(" ", text or "")
    return HIGH_NUMERAL.sub(" ", text) if HIGH.search(text) else text


def script_of(word: str) -> str:
    return SCRIPTS[bisect_right(FIRSTS, ord(word[0])) - 1][1]


def grams_of(word: str) -> list[str]:
    """Character trigrams of a lower-cased word between boundary marks."""
    marked = f"^{word.lower()}$"
    return [marked[i : i + 3] for i in range(len(marked) - 2)]


def fit(docs: DataFrame, per_language: int = 2500, grams: int = 15_000) -> Model:
    """Trigram and script counts by language from documents outside the held-out fifth that have a language.

    About ``per_language`` documents of each language are taken by a hash of the id, whole; the bound is a parameter. Of each
    language the ``grams`` most frequent trigrams and all scripts reach the driver.
    """
    known = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = {r.lang: r["count"] for r in known.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], {}, np.zeros(0), {})
    draw = F.pmod(F.xxhash64(F.lit(7), F.col("doc_id")), F.lit(1_000_000))
    share = F.create_map(*[F.lit(v) for k in languages for v in (k, int(1e6 * min(1.0, per_language / sizes[k])))])
    sample = known.where(draw < share[F.col("lang")]).select("lang", "text")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                words.setdefault(lang, Counter()).update(WORD.findall(lettered(text)))
        for lang, seen in words.items():
            held: Counter = Counter()
            for word, n in seen.items():
                held["script " + script_of(word)] += n
                for gram in grams_of(word):
                    held[gram] += n
            if held:
                yield pd.DataFrame({"lang": lang, "gram": list(held), "n": list(held.values())})

    counts = sample.mapInPandas(count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    table: dict[str, np.ndarray] = {}
    order = Window.partitionBy("lang", F.startswith("gram", F.lit("script "))).orderBy(F.desc("n"), "gram")
    for r in counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= grams).collect():
        table.setdefault(r.gram, np.zeros(len(languages)))[languages.index(r.lang)] = r.n
    scripts = {g.removeprefix("script "): n for g, n in table.items() if g.startswith("script ")}
    plain = {g: n for g, n in table.items() if not g.startswith("script ")}
    totals = sum(plain.values(), np.zeros(len(languages))) + 0.5 * (len(plain) + 1)
    used = sum(scripts.values(), np.zeros(len(languages)))
    return Model(
        languages,
        {g: np.log((n + 0.5) / totals) for g, n in plain.items()},
        np.log(0.5 / totals),
        {s: n >= 0.01 * np.maximum(used, 1) for s, n in scripts.items() if (n >= 0.01 * np.maximum(used, 1)).any()},
    )


class Words(dict):
    """Word to row of a growing table of scores by language; ``trim`` forgets all words once there are too many."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model
        self.table = np.zeros((4096, len(model.languages)))
        self.rows = {g: i for i, g in enumerate(model.grams, 1)}
        self.logs = np.stack([model.unseen, *model.grams.values()])
        everyone = np.ones(len(model.languages), bool)
        self.candidates, self.everyone = model.scripts, everyone

    def learn(self, words: list[str]) -> None:
        """Score new words together: sums of their trigrams' log probabilities, relative to the best candidate. A script
        that no language uses says nothing; a language that does not use the word's script is barred."""
        grams = [grams_of(w) for w in words]
        counts = np.fromiter(map(len, grams), np.int64, len(grams))
        rows = np.fromiter((self.rows.get(g, 0) for own in grams for g in own), np.int64, int(counts.sum()))
        scores = np.add.reduceat(self.logs[rows], np.cumsum(counts) - counts, axis=0)
        scripts = [script_of(w) for w in words]
        allowed = np.stack([self.candidates.get(s, self.everyone) for s in scripts])
        used = np.array([s in self.candidates for s in scripts])
        best = np.where(allowed, scores, -np.inf).max(1, keepdims=True)
        scores = np.where(allowed, np.maximum(scores - best, BARRED), BARRED) * used[:, None]
        first = len(self)
        while first + len(words) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[first : first + len(words)] = scores
        self.update(zip(words, range(first, first + len(words)), strict=True))

    def trim(self) -> None:
        if len(self) > CACHE:
            self.clear()


def best_paths(scores: np.ndarray, starts: np.ndarray, lengths: np.ndarray, penalty: float) -> np.ndarray:
    """The language of each word on the best path of each text; all texts step together, longest first.

    Equal paths go to the language that is first by name.
    """
    states = np.min_scalar_type(max(1, scores.shape[1]))
    if not scores.size:
        return np.zeros(len(scores), states)
    order = np.argsort(-lengths, kind="stable")
    starts, falling = starts[order], -lengths[order]
    width = scores.shape[1]
    own = np.arange(width, dtype=states)
    best = np.zeros((len(starts), width))
    back = np.zeros((len(scores), width), states)
    steps = int(-falling[0]) if len(falling) else 0
    active = np.searchsorted(falling, -np.arange(steps), side="left")
    for t in range(steps):
        n = active[t]
        rows = starts[:n] + t
        held = best[:n]
        if t:
            switch = held.max(1, keepdims=True) - penalty
            stay = held >= switch
            back[rows] = np.where(stay, own, held.argmax(1).astype(states)[:, None])
            held = np.where(stay, held, switch)
        best[:n] = held + scores[rows]
    path = np.zeros(len(scores), states)
    state = best.argmax(1).astype(states)
    for t in range(steps - 1, -1, -1):
        n = active[t]
        rows = starts[:n] + t
        path[rows] = state[:n]
        state[:n] = back[rows, state[:n]]
    return path


def spans_of(text: str, path: np.ndarray, languages: list[str]) -> list[dict]:
    """Runs of words of one language, as code point offsets; the end is exclusive."""
    cuts = np.flatnonzero(np.diff(path)) + 1
    firsts, lasts = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(path)]]) - 1
    if len(firsts) == 1:
        first, end = WORD.search(text).start(), _last_letter(text) + 1
        return [{"start": first, "end": end, "lang": languages[path[0]]}]
    places = [m.span() for m in WORD.finditer(text)]
    return [
        {"start": places[i][0], "end": places[j][1], "lang": languages[path[i]]}
        for i, j in zip(firsts, lasts, strict=True)
    ]


def _last_letter(text: str) -> int:
    return next(i for i in range(len(text) - 1, -1, -1) if WORD.match(text[i]))


LABELS = "lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>"


def label(text: Column, model: Model, penalty: float = 8.0) -> Column:
    """Struct of the main language of each whole text, its share of the letters, and the language spans.

    ``und`` with score 0 and no spans for a null text, one without letters, or a model without languages.
    """

    def group(texts: list[str], words: Words | None) -> list[tuple]:
        if words is None:
            return [("und", 0.0, [])] * len(texts)
        words.trim()
        found = [WORD.findall(t) for t in texts]
        lengths = np.array([len(f) for f in found], np.int64)
        starts = np.cumsum(lengths) - lengths
        flat = list(chain.from_iterable(found))
        if new := list(set(flat) - words.keys()):
            words.learn(new)
        rows = np.fromiter(map(words.__getitem__, flat), np.int64, len(flat))
        letters = np.fromiter(map(len, flat), np.int64, len(flat))
        path = best_paths(words.table[rows], starts, lengths, penalty)
        results = []
        for i, text in enumerate(texts):
            own = slice(starts[i], starts[i] + lengths[i])
            if not lengths[i]:
                results.append(("und", 0.0, []))
                continue
            held = np.bincount(path[own], letters[own], len(model.languages))
            main = int(held.argmax())
            spans = spans_of(text, path[own], model.languages)
            results.append((model.languages[main], held[main] / held.sum(), spans))
        return results

    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        words = Words(model) if model.languages else None
        for batch in batches:
            texts = [lettered(t) for t in batch]
            order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
            results: list = [None] * len(texts)
            at = 0
            while at < len(order):
                end, size = at, 0
                while end < len(order) and (end == at or size + len(texts[order[end]]) <= GROUP_CHARS):
                    size += len(texts[order[end]])
                    end += 1
                for i, r in zip(order[at:end], group([texts[i] for i in order[at:end]], words), strict=True):
                    results[i] = r
                at = end
            yield pd.DataFrame(results, columns=["lang_pred", "score", "spans"])

    of.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(of, LABELS)(text)


def identify(docs: DataFrame, **settings) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, spans) for every row, row-local after a bounded training sample.

    Null and empty texts are ``und``; very long ones are read whole. Repeated rows repeat; a null id is not held out; an
    empty table gives no rows. Other columns are not read, and
    ``lang`` only to learn.
    """
    model = fit(docs, **settings)
    found = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), label(F.col("text"), model).alias("found"))
    return found.select("doc_id", "held_out", "found.*")
