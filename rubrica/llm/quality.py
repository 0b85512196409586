"""Text quality: random-indexing word vectors pooled per document, then a small calibrated network."""

import re
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rubrica.llm.common import held_out, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DIMENSIONS = 32
NONZERO = 4
WINDOW = 2
CACHE = 400_000
REPEATED = re.compile(r"(.)\1+")


@dataclass
class Model:
    rows: dict[str, int]
    vectors: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    hidden: np.ndarray
    output: np.ndarray
    temperature: float
    constant: float | None = None


def shape_of(word: str) -> str:
    """The character classes of a word with runs collapsed; rare words share a vector through it."""
    classes = ["A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word]
    shape = REPEATED.sub(r"\1", "".join(classes))
    return "\x00" + (shape if len(shape) <= 12 else "long")


def index_vector(key: str) -> np.ndarray:
    """A sparse ternary vector drawn by a hash of the key."""
    draw = np.random.default_rng(xxhash.xxh64_intdigest(key.encode("utf-8", "surrogatepass"), 7))
    vector = np.zeros(DIMENSIONS, np.int32)
    vector[draw.choice(DIMENSIONS, NONZERO, replace=False)] = draw.choice([-1, 1], NONZERO)
    return vector


class Rows(dict):
    """Word to vector row; words outside the vocabulary go through their shape, unknown shapes to row 0."""

    def __init__(self, rows: dict[str, int]):
        super().__init__(rows)
        self.rows = rows

    def __missing__(self, word: str) -> int:
        row = self.rows.get(shape_of(word), 0)
        if len(self) < CACHE:
            self[word] = row
        return row


def pooled(text: str, rows: Rows, vectors: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """Mean and second moment of the word vectors of a whole text, and a few shares; zeros for a text without words."""
    words = text.split()
    features = np.zeros(2 * DIMENSIONS + 6)
    n = len(words)
    if n:
        ids = np.fromiter(map(rows.__getitem__, words), np.int64, n)
        held, counts = np.unique(ids, return_counts=True)
        features[:DIMENSIONS] = counts @ vectors[held] / n
        features[DIMENSIONS : 2 * DIMENSIONS] = counts @ squares[held] / n
        features[2 * DIMENSIONS :] = (
            np.log1p(n), len(set(words)) / n, len(text) / n, counts.max() / n, text.count("\n") / n, held.size / n,
        )
    return features


def vocabulary(sample: DataFrame, words: int, shapes: int, least: int) -> dict[str, int]:
    """Rows of the most frequent words and shapes; row 0 is left for what is in neither."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch["text"].dropna():
                seen.update(text.split())
        classes: Counter = Counter()
        for word, n in seen.items():
            classes[shape_of(word)] += n
        for kind, counter in ((0, seen), (1, classes)):
            if counter:
                yield pd.DataFrame({"kind": kind, "word": list(counter), "n": list(counter.values())})

    counts = sample.mapInPandas(count, "kind int, word string, n long").groupBy("kind", "word").agg(F.sum("n").alias("n"))
    top = counts.where(f"kind = 1 or n >= {least}")
    kept = [
        r.word
        for kind, limit in ((0, words), (1, shapes))
        for r in top.where(f"kind = {kind}").orderBy(F.desc("n"), "word").limit(limit).select("word").collect()
    ]
    return {word: i + 1 for i, word in enumerate(kept)}


def word_vectors(sample: DataFrame, rows: dict[str, int], parts: int) -> np.ndarray:
    """Sum of the index vectors of the words within two places, over the whole sample, scaled to length 1.

    ``parts`` tasks each return one table of sums, whose size depends on the vocabulary alone.
    """
    index = np.zeros((len(rows) + 1, DIMENSIONS), np.int32)
    for word, i in rows.items():
        index[i] = index_vector(word)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lookup = Rows(rows)
        total = np.zeros_like(index)
        for batch in batches:
            for text in batch["text"].dropna():
                ids = np.fromiter(map(lookup.__getitem__, text.split()), np.int64)
                for step in range(1, WINDOW + 1):
                    np.add.at(total, ids[step:], index[ids[:-step]])
                    np.add.at(total, ids[:-step], index[ids[step:]])
        yield pd.DataFrame({"sums": [total.tobytes()]})

    total = index.astype(np.float64)
    for row in sample.select("text").coalesce(parts).mapInPandas(sums, "sums binary").toLocalIterator():
        total += np.frombuffer(row.sums, np.int32).reshape(index.shape)
    return (total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def forward(x: np.ndarray, hidden: np.ndarray, output: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    one = np.ones((len(x), 1))
    middle = np.tanh(np.hstack([x, one]) @ hidden)
    return middle, np.hstack([middle, one]) @ output


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def train_network(
    x: np.ndarray, y: np.ndarray, units: int = 24, epochs: int = 400, rate: float = 0.01, decay: float = 1e-3
) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights of a two-layer network by Adam on four fifths of the rows; the temperature that fits the last fifth best."""
    draw = np.random.default_rng(11)
    check = draw.permutation(len(x)) < len(x) // 5
    fit_x, fit_y = x[~check], y[~check]
    weights = [draw.normal(0, 0.1, (x.shape[1] + 1, units)), draw.normal(0, 0.1, units + 1)]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    one = np.ones((len(fit_x), 1))
    for epoch in range(1, epochs + 1):
        middle, z = forward(fit_x, *weights)
        error = (sigmoid(z) - fit_y) / len(fit_x)
        back = np.outer(error, weights[1][:-1]) * (1 - middle**2)
        slopes = [np.hstack([fit_x, one]).T @ back, np.hstack([middle, one]).T @ error]
        for i, slope in enumerate(slopes):
            slope = slope + decay * weights[i] / 10
            first[i] = 0.9 * first[i] + 0.1 * slope
            second[i] = 0.999 * second[i] + 0.001 * slope**2
            weights[i] -= rate * (first[i] / (1 - 0.9**epoch)) / (np.sqrt(second[i] / (1 - 0.999**epoch)) + 1e-8)
    rows, truth = (x[check], y[check]) if check.any() else (x, y)
    z = forward(rows, *weights)[1]

    def loss(t: float) -> float:
        p = np.clip(sigmoid(z / t), 1e-9, 1 - 1e-9)
        return float(-(truth * np.log(p) + (1 - truth) * np.log(1 - p)).mean())

    return weights[0], weights[1], min(np.geomspace(0.3, 5, 57), key=loss)


def fit(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", sample_rows: int = 5000, words: int = 20_000, parts: int = 8
) -> Model:
    """Fit on about ``sample_rows`` labelled documents outside the held-out fifth, chosen by a hash of the id.

    The same hash test cuts both tables before they meet, so only the sample is shuffled. The driver gets a vocabulary
    of at most ``words`` words and 500 shapes, ``parts`` tables of sums and one row of features per sampled document. A
    null label is no label. Without any labelled row every score is 0.5; with one class it is a smoothed share.
    """
    marked = labels.where(F.col(label_col).isNotNull() & ~held_out(F.col("doc_id")))
    share = int(1e6 * min(1.0, sample_rows / max(1, marked.count())))
    drawn = F.pmod(F.xxhash64(F.lit(7), F.col("doc_id")), F.lit(1_000_000)) < share
    truth = marked.where(drawn).groupBy("doc_id").agg((F.max(label_col) >= 1).cast("double").alias("y"))
    picked = docs.where(drawn).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    sample = written(picked.join(truth, "doc_id").select("text", "y"), "quality-sample")
    rows = vocabulary(sample, words, 500, 3)
    vectors = word_vectors(sample, rows, parts)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lookup, squares = Rows(rows), vectors**2
        for batch in batches:
            found = [pooled(t, lookup, vectors, squares).tobytes() for t in batch["text"]]
            yield pd.DataFrame({"x": found, "y": batch["y"]})

    got = sample.mapInPandas(features, "x binary, y double").orderBy("x", "y").collect()
    y = np.array([r.y for r in got])
    if not got or y.min() == y.max():
        constant = (y.sum() + 1) / (len(y) + 2)
        empty = np.zeros(0)
        return Model(rows, vectors, empty, empty, empty, empty, 1.0, float(constant))
    x = np.stack([np.frombuffer(r.x) for r in got])
    centre, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    return Model(rows, vectors, centre, scale, *train_network(np.clip((x - centre) / scale, -6, 6), y))


def score(text: Column, model: Model) -> Column:
    """Probability of label 1 for each whole text. A null text scores as an empty one."""

    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lookup, squares = Rows(model.rows), model.vectors**2
        for texts in batches:
            if model.constant is not None or not len(texts):
                yield pd.Series(np.full(len(texts), model.constant, np.float64))
                continue
            x = np.stack([pooled(t or "", lookup, model.vectors, squares) for t in texts])
            x = np.clip((x - model.centre) / model.scale, -6, 6)
            yield pd.Series(sigmoid(forward(x, model.hidden, model.output)[1] / model.temperature))

    of.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(of, "double")(text)


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **settings) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row; repeated rows repeat, an empty table gives none.

    Scoring is row-local: the text is read once and not shuffled. Other columns of either table are not read.
    """
    model = fit(docs, labels, **settings)
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **settings) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with all their columns. Row-local after the fit."""
    return docs.where(score(F.col("text"), fit(docs, labels, **settings)) >= threshold)
