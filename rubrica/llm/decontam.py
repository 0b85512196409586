"""Benchmark passages in documents, within an error budget: exact hits of pieces, verified by bit-parallel distance."""

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_CHARS = 4_000_000
LEAKS = "array<struct<item_id:long,distance:int,start:int,end:int>>"


def normal(text: str | None) -> str:
    """Lower case, white space runs as one blank, none at the ends."""
    return " ".join((text or "").lower().split())


@dataclass
class Item:
    item_id: int
    text: str
    budget: int
    masks: dict[str, int]
    reversed_masks: dict[str, int]
    whole_words: bool = False


def masks_of(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def pieces_of(length: int, count: int) -> list[tuple[int, int]]:
    """(start, end) of ``count`` pieces whose lengths differ by one at most."""
    return [(i * length // count, (i + 1) * length // count) for i in range(count)]


def nearest_end(masks: dict[str, int], size: int, text: str, anchored: bool = False) -> tuple[int, int]:
    """(distance, end) of the best match of a pattern inside a text by Myers' bit-parallel recurrence.

    The match may start anywhere, or only at the first character if ``anchored``. Of equal distances the first end wins.
    """
    full, top, step = (1 << size) - 1, 1 << (size - 1), int(anchored)
    plus, minus, score = full, 0, size
    best, end = size, 0
    for j, c in enumerate(text, 1):
        equal = masks.get(c, 0)
        across = equal | minus
        down = (((equal & plus) + plus) ^ plus) | equal
        up = minus | (full & ~(down | plus))
        low = plus & down
        if up & top:
            score += 1
        elif low & top:
            score -= 1
        up, low = (up << 1) | step, low << 1
        plus = (low | ~(across | up)) & full
        minus = up & across & full
        if score < best:
            best, end = score, j
    return best, end


def make_items(rows: list[tuple[int, str | None]], rate: float, min_chars: int) -> list[Item]:
    items = []
    for item_id, raw in rows:
        text = normal(raw)
        short = len(text) < min_chars
        if item_id is not None and text:
            items.append(Item(item_id, text, 0 if short else int(rate * len(text)), masks_of(text), masks_of(text[::-1]), short))
    return items


def make_automaton(items: list[Item]):
    posted: dict[str, list[tuple[int, int]]] = {}
    for n, item in enumerate(items):
        for start, end in pieces_of(len(item.text), item.budget + 1):
            posted.setdefault(item.text[start:end], []).append((n, 1 - end))
    automaton = ahocorasick.Automaton()
    for piece, holders in posted.items():
        automaton.add_word(piece, holders)
    automaton.make_automaton()
    return automaton


def stands_alone(text: str, start: int, end: int) -> bool:
    """No letter or digit goes on over either border of a place that has one there itself."""
    joined = lambda a, b: text[a].isalnum() and text[b].isalnum()
    return not (start > 0 and joined(start - 1, start)) and not (end < len(text) and joined(end - 1, end))


def leaks_in(raw: str | None, items: list[Item], automaton) -> list[dict]:
    """The best match of each item in one whole text, in order of item.

    If a passage is within the budget of ``e`` edits, one of the ``e + 1`` pieces of its item is untouched, so every
    match lies near a piece hit. Hits of an item whose windows overlap are verified together, each character once.
    """
    text = normal(raw)
    places: dict[int, list[int]] = {}
    for last, holders in automaton.iter(text):
        for n, shift in holders:
            places.setdefault(n, []).append(last + shift)
    found = []
    for n, starts in places.items():
        item = items[n]
        size, budget = len(item.text), item.budget
        if item.whole_words:
            at = next((s for s in sorted(starts) if stands_alone(text, s, s + size)), None)
            if at is not None:
                found.append({"item_id": item.item_id, "distance": 0, "start": at, "end": at + size})
            continue
        best = (budget + 1, 0, 0)
        windows: list[list[int]] = []
        for at in sorted(starts):
            low, high = max(0, at - budget), at + size + budget
            if windows and low <= windows[-1][1]:
                windows[-1][1] = high
            else:
                windows.append([low, high])
        for low, high in windows:
            distance, end = nearest_end(item.masks, size, text[low:high])
            if distance < best[0]:
                tail = text[max(0, low + end - size - budget) : low + end][::-1]
                width = nearest_end(item.reversed_masks, size, tail, anchored=True)[1]
                best = (distance, low + end - width, low + end)
        if best[0] <= budget:
            found.append({"item_id": item.item_id, "distance": best[0], "start": best[1], "end": best[2]})
    return sorted(found, key=lambda f: (f["item_id"], f["distance"], f["start"], f["end"]))


def leaks(text: Column, rows: list[tuple[int, str | None]], rate: float, min_chars: int) -> Column:
    """Matches of one block of items in each whole text; empty for a null text."""

    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        items = make_items(rows, rate, min_chars)
        automaton = make_automaton(items) if items else None
        for texts in batches:
            yield pd.Series([leaks_in(t, items, automaton) if items else [] for t in texts], dtype="object")

    of.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(of, LEAKS)(text)


def item_blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str | None]]]:
    """The stated query set in blocks of at most about ``block_chars`` characters, so that a task's automaton is bounded
    however large the benchmark is. Every block ends up in the plan, as one pass over the texts."""
    items = benchmark.where("text is not null").select("item_id", "text")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = total // block_chars + 1
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block) if blocks > 1 else items
        yield [(r.item_id, r.text) for r in part.orderBy("item_id", "text").collect()]


def with_leaks(docs: DataFrame, benchmark: DataFrame, column: str, rate: float = 0.06, min_chars: int = 16) -> DataFrame:
    """The rows with one more column: the matches (item, distance, start, end) of their whole text.

    Texts and items are compared in lower case with white space runs as one blank; offsets are code points of that form,
    the end exclusive. An item of ``n`` characters has a budget of ``floor(rate * n)`` edits; one shorter than
    ``min_chars`` is only found letter by letter, between word borders. Items without text match nothing. Very long texts
    are searched whole. Repeated items with one id each count as matches. Null
    texts, empty texts and an empty benchmark give empty arrays. Row-local: no text is shuffled.
    """
    text = F.col("text")
    found = [leaks(text, block, rate, min_chars) for block in item_blocks(benchmark) if block]
    return docs.withColumn(column, F.concat(*found) if found else F.array().cast(LEAKS))


def contaminated(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """(doc_id, item_id, distance, start, end), one row per document and item found in it; repeated rows repeat."""
    found = with_leaks(docs.select("doc_id", "text"), benchmark, "found", **settings)
    return found.select("doc_id", F.explode("found").alias("f")).select("doc_id", "f.*")
