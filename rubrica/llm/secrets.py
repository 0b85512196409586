"""Secrets in text: fixed patterns, and character Markov models of random strings against ordinary identifiers."""

import hashlib
import re
import sys
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rubrica.llm.common import hash_sample

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The base patterns, in the order in which equal starts are listed, each with its shortest length.
ASSIGN = re.compile(
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "random")

# The characters that the Markov models tell apart; one more class stands for the start.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{8,}")
START = len(ALPHABET)
CODE = np.full(128, START, np.int64)
CODE[[ord(c) for c in ALPHABET]] = np.arange(START)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, in order; offsets are code points.

    A run of the class is matched from its first character, so ``{24,}`` finds the same runs as a match of the whole run
    followed by a length test, without visiting every letter that is also a hex digit.
    """
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def free_tokens(text: str, taken: list[tuple[int, int, int]], least: int) -> Iterator[tuple[int, int]]:
    """What the spans in ``taken``, in order, leave of the runs of the alphabet, if at least ``least`` characters."""
    starts = [s for s, _, _ in taken]
    reach = list(accumulate((e for _, _, e in taken), max))
    for m in TOKEN.finditer(text):
        first = bisect_left(reach, m.start() + 1)
        at = m.start()
        for n in range(first, bisect_left(starts, m.end())):
            if starts[n] - at >= least:
                yield at, starts[n]
            at = max(at, reach[n])
        if m.end() - at >= least:
            yield at, m.end()


def transitions(token: str) -> tuple[np.ndarray, np.ndarray]:
    codes = CODE[np.frombuffer(token.encode("ascii"), np.uint8)]
    return np.concatenate([[START], codes[:-1]]), codes


def count_transitions(docs: DataFrame, text_col: str, sample_key: str, sample_rows: int) -> np.ndarray:
    """Transition counts of random strings (0) and ordinary identifiers (1), as a (2, 68, 67) array.

    Labels come from the fixed patterns: what they catch after its key word is random, other tokens are ordinary. The
    models learn from about ``sample_rows`` documents chosen by a hash of ``sample_key``; each task returns one table
    of counts, at most 2 * 68 * 67 rows.
    """
    shape = (2, START + 1, START)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(shape, np.int64)
        for batch in batches:
            for text in batch.iloc[:, 0].dropna():
                spans = base_spans(text)
                labelled = [(re.split(r"[:=\x20\"']", text[s:e])[-1], 0) for s, _, e in spans]
                labelled += [(text[s:e], 1) for s, e in free_tokens(text, spans, 8)]
                for token, label in labelled:
                    token = token.replace(".", "")
                    if token:
                        np.add.at(total[label], transitions(token), 1)
        cells = np.argwhere(total)
        yield pd.DataFrame({"cell": np.ravel_multi_index(cells.T, shape), "n": total[tuple(cells.T)]})

    sample = hash_sample(docs.select(sample_key, text_col), sample_key, sample_rows).select(text_col)
    counts = np.zeros(np.prod(shape))
    for cell, n in sample.mapInPandas(count, "cell long, n long").groupBy("cell").agg(F.sum("n")).collect():
        counts[cell] = n
    return counts.reshape(shape)


def log_ratio(counts: np.ndarray, smoothing: float = 0.5, backing: float = 10.0) -> np.ndarray:
    """log P(next | previous, random) - log P(next | previous, ordinary); zero without any labelled token.

    Rare transitions lean on how often the next character occurs at all in the same model. A transition that occurs once
    among ordinary tokens counts for nothing there, since a secret that no pattern marked is counted among them.
    """
    if not counts.any():
        return np.zeros(counts.shape[1:])
    counts = np.maximum(counts - np.array([0, 1])[:, None, None], 0)
    single = counts.sum(1, keepdims=True) + smoothing
    smooth = counts + backing * single / single.sum(-1, keepdims=True)
    logs = np.log(smooth / smooth.sum(-1, keepdims=True))
    return logs[0] - logs[1]


SPANS = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def secret_spans(text: Column, ratio: np.ndarray, least: int = 16, per_char: float = 0.7, total: float = 18.0) -> Column:
    """Struct of the counts, the digest of the fixed-pattern spans and all spans of each whole text.

    Added spans (``random``) are tokens of ``least`` or more characters outside the fixed-pattern spans, with both
    letters and digits, whose log-likelihood ratio is at least ``total`` and at least ``per_char`` for each character.
    A null text counts as empty: no spans, the digest of the empty string.
    """

    def show(spans: list[tuple[int, int, int]]) -> str:
        return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)

    def of(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            text = text or ""
            base = base_spans(text)
            added = []
            for s, e in free_tokens(text, base, least):
                token = text[s:e]
                if any(c.isdigit() for c in token) and any(c.isalpha() for c in token):
                    score = ratio[transitions(token)].sum()
                    if score >= total and score >= per_char * len(token):
                        added.append((s, 3, e))
            kinds = [sum(k == kind for _, k, _ in base) for kind in range(3)]
            shown = show(base)
            rows.append((*kinds, hashlib.sha256(shown.encode()).hexdigest(), show(sorted(base + added))))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in SPANS.split(", ")])

    return F.pandas_udf(of, SPANS)(text)


def scan_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = 20_000
) -> DataFrame:
    """One row per document: id, counts by fixed pattern, digest of their spans, and all spans.

    Row-local after a bounded training sample, so no text is shuffled. Repeated rows give repeated results; a null id
    stays null; an empty table trains on nothing and gives no rows. Other columns are not read.
    """
    ratio = log_ratio(count_transitions(docs, text_col, id_col, sample_rows))
    found = docs.select(F.col(id_col), secret_spans(F.col(text_col), ratio).alias("found"))
    return found.select(id_col, "found.*")
