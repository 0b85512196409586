"""Hard negatives, packing and ranked search against plain versions of the same rules."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from rubrica.llm import hardneg, packing, ranked
from rubrica.llm.queries import TOKENIZER_PATH

VECTORS = "vec_id long, embedding array<double>, label int, id string, uid int, rank int, vector string, score int"
TAIL = ("x", 1, 2, "y", 3)


def plain_negatives(rows, every=100, positives=5, k=5):
    """Every pair of rows scored in whole numbers."""
    held = {(i, label, tuple(v)) for i, v, label in rows if i is not None and v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v)}
    whole = [(i, label, [math.floor(256.0 * x) for x in v], v) for i, label, v in sorted(held)]
    out = []
    for a in whole:
        if a[0] % every:
            continue
        scored = [(-sum(x * y for x, y in zip(a[2], o[2], strict=False)), o[0], o) for o in whole if o is not a]
        same = sorted((s, i) for s, i, o in scored if o[1] == a[1])[:positives]
        other = sorted((s, i) for s, i, o in scored if o[1] != a[1])
        for s, i in same:
            inside = [(t, j) for t, j in other if 80 * -s <= 100 * -t <= 100 * -s][:k]
            out += [(a[0], i, n, j, -s, -t) for n, (t, j) in enumerate(inside, 1)]
    return Counter(out)


def mined(spark, rows, **options):
    df = spark.createDataFrame([(*r, *TAIL) for r in rows], VECTORS)
    return Counter(tuple(r) for r in hardneg.hard_negatives(df, **options).collect())


@pytest.mark.parametrize("parts", [{}, {"rows_per_part": 40, "anchors_per_part": 4}])
def test_hard_negatives_against_all_pairs(spark, parts):
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(4, 6))
    rows = []
    for i in range(260):
        label = int(draw.integers(4))
        rows.append((i * 5, (centres[label] + draw.normal(size=6) * draw.choice([0.0, 0.2, 1.0])).tolist(), label))
    want = plain_negatives(rows, every=50)
    assert mined(spark, rows, every=50, **parts) == want and len(want) > 50


def test_hard_negatives_odd_rows(spark):
    rows = [(i, [1.0, 0.5, i % 3 / 4], i % 2) for i in range(0, 60, 5)]
    rows += [(0, [1.0, 0.5, 0.0], 0), (0, [0.0, 2.0, 1.0], 1), (7, [1.0, 0.5, 0.0], 0), (8, [1.0, 0.5], 1)]
    rows += [(None, [1.0, 1.0, 1.0], 0), (100, None, 0), (200, [1.0, None, 1.0], 0), (300, [math.nan, 1.0, 1.0], 0)]
    rows += [(400, [math.inf, 0.0, 0.0], 1), (500, [1.0, 1.0, 1.0], None), (600, [], 0), (-100, [0.0, 0.0, 0.0], 1)]
    want = plain_negatives(rows)
    assert mined(spark, rows) == want and want
    assert mined(spark, rows, rows_per_part=3, anchors_per_part=1) == want
    assert not mined(spark, [])


def test_hard_negatives_of_large_components(spark):
    draw = random.Random(1)
    rows = [(i * 50, [draw.randrange(-(2**20), 2**20) + 0.0 for _ in range(3)], i % 2) for i in range(30)]
    assert mined(spark, rows) == plain_negatives(rows)
    rows = [(i * 50, [draw.choice([1e30, -1e30, 1e300, 2.0])], i % 2) for i in range(12)]
    assert all(abs(r[4]) <= hardneg.MOST for r in mined(spark, rows))


def test_tree_walk_scores_few_rows_of_near_anchors():
    draw = np.random.default_rng(0)
    points = np.floor(draw.normal(size=(400, 8)) * 256)
    anchors = points[0] + np.floor(draw.normal(size=(30, 8)))
    order, parents, edges = hardneg.spanning_tree(anchors)
    assert sorted(order) == list(range(30)) and len(parents) == len(edges) == 30
    turn = {at: n for n, at in enumerate(order)}
    tree = hardneg.pd.DataFrame({"parent": [turn[p] for p in parents], "edge": edges})
    anchors = anchors[order]
    best = lambda n, low, high: np.flatnonzero(high >= np.partition(low, -5)[-5])
    seen = 0
    for n, at, found in hardneg.walk(tree, anchors, points, best):
        exact = points @ anchors[n]
        assert (exact[at] == found).all() and set(np.argsort(-exact)[:5]) <= set(at)
        seen += len(at)
    assert seen < 0.3 * 30 * 400


# Packing


def packed(df, **options):
    rows = packing.pack_documents(df, TOKENIZER_PATH, **options).collect()
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r.offset)
        at = 0
        for r in pieces:
            assert r.offset == at and r.length > 0 and len(r.ids) == 4 * r.length
            at += r.length
        capacity = options.get("capacity", 1024)
        assert at == capacity or (at < capacity and at & (at - 1) == 0)
    return rows, sequences


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(TOKENIZER_PATH)


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


@pytest.mark.parametrize("options", [{}, {"capacity": 64, "block": 3}])
def test_packing_is_an_exact_round_trip(spark, odd_docs, tokenizer, options):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows, _ = packed(docs, **options)
    parts = defaultdict(list)
    for r in rows:
        parts[r.doc_id].append(r)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert set(parts) == set(texts)
    for doc_id, own in parts.items():
        want, at = ids_of(tokenizer, texts[doc_id]), 0
        for r in sorted(own, key=lambda r: r.start):
            ids = np.frombuffer(r.ids, "<u4").tolist()
            assert r.start == at and r.doc_tokens == len(want) and ids == want[at : at + r.length]
            assert zlib.crc32(np.array(ids, "<u4").tobytes()) == zlib.crc32(r.ids)
            at += r.length
        assert at == len(want)
    odd, _ = packed(odd_docs, **options)
    want = Counter(i for t in odd_docs.collect() for i in ids_of(tokenizer, t.text))
    assert Counter(i for r in odd for i in np.frombuffer(r.ids, "<u4").tolist()) == want
    assert sorted((r.doc_id or -1) for r in odd if r.start == 0) == sorted((r.doc_id or -1) for r in odd_docs.collect())


def test_packing_of_nothing(no_docs):
    assert packing.pack_documents(no_docs, TOKENIZER_PATH).count() == 0


def test_assignment_fills_every_sequence_and_balances_cost():
    draw = random.Random(2)
    lengths = [draw.randint(1, 1023) for _ in range(900)]
    rooms = [1024] * (sum(lengths) // 1024)
    placed, left = packing.assign(lengths, rooms)
    used = Counter()
    covered = defaultdict(list)
    for piece, at, taken, to in placed:
        used[to] += taken
        covered[piece].append((at, taken))
    for piece, at, size in left:
        covered[piece].append((at, size))
    assert set(used.values()) == {1024} and sum(size for *_, size in left) == sum(lengths) % 1024
    for piece, parts in covered.items():
        end = 0
        for at, size in sorted(parts):
            assert at == end
            end += size
        assert end == lengths[piece]
    assert len(placed) < len(lengths) + len(rooms)
    # while whole pieces fit, each goes to the cheapest sequence with room
    placed, _ = packing.assign([600, 500, 400, 300], [1024, 1024])
    assert placed == [(0, 0, 600, 0), (1, 0, 500, 1), (2, 0, 400, 1), (3, 0, 300, 0)]


def test_both_encoders_agree(tokenizer):
    draw = random.Random(4)
    words = ["word", "it's", "12", "...", "\n", "  ", "é", "\t x", "日本語", "\u00a0", "\x1c", "\u2003 ", "\r\n", "!", "\U0001f600", "'ll", "x" * 90]
    words += ["Ünïcode", "n\u0303", "ждать", "½", "²", "–", "“", "한국", "_", "A1b2"]
    texts = ["".join(draw.choice(words) + " " * draw.randrange(3) for _ in range(draw.randrange(60))) for _ in range(400)]
    stable = [w for w in words if packing.STABLE.fullmatch(w)]
    texts += ["".join(draw.choice(stable) + " " * draw.randrange(3) for _ in range(60)) for _ in range(400)]
    texts += ["", " ", "a <|endoftext|> b", "\n\n", " a", "a "]
    encode = packing.TextEncoder(TOKENIZER_PATH)
    assert encode.merger and len(stable) > 12
    for t in texts:
        assert encode(t).tolist() == tokenizer.encode(t, add_special_tokens=False).ids
    assert all(packing.STABLE.fullmatch(t) for t in texts[400:800])


def test_every_character_of_the_stable_set_is_cut_alike(tokenizer):
    encode = packing.TextEncoder(TOKENIZER_PATH)
    characters = [c for c in map(chr, range(0x10000)) if packing.STABLE.fullmatch(c)]
    for at in range(0, len(characters), 64):
        part = characters[at : at + 64]
        text = "".join(f"a{c}1{c} {c}{c}.{c}b" for c in part)
        assert encode(text).tolist() == encode.own(text).tolist()


# Ranked search


def plain_terms(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def plain_search(items, docs, k):
    counts = [(d, Counter(plain_terms(t))) for d, t in docs]
    live = sum(1 for _, c in counts if c)
    total = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    asked = defaultdict(set)
    for i, t in items:
        if i is not None:
            asked[i] |= set(plain_terms(t))
    out = []
    for i, terms in asked.items():
        scored = []
        for d, c in counts:
            n = sum(c.values())
            score = 0
            for t in terms & set(c):
                w = math.floor(1000 * math.log((2 * live + 2) / (2 * df[t] + 1)))
                m = 100 - 50 + (50 * n * live) // total
                score += w * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0 and d is not None:
                scored.append((-score, d))
        out += [(i, rank, d, -s) for rank, (s, d) in enumerate(sorted(scored)[:k], 1)]
    return Counter(out)


SMALL = {"shard_docs": 7, "bundle_items": 2, "shards_per_salt": 3}


@pytest.mark.parametrize("options", [{"k": 5}, {"k": 3, **SMALL}])
def test_search_against_plain_scores(spark, options):
    draw = random.Random(6)
    words = [f"w{i}" for i in range(300)] + ["Été", "10", "日本", "O'Neil"]
    weights = [1 / (i + 1) for i in range(len(words))]
    text = lambda n: " ".join(draw.choices(words, weights, k=n))
    docs = [(i, text(draw.choice([0, 1, 5, 40, 400]))) for i in range(120)]
    docs += [(200 + i, docs[5][1]) for i in range(40)] + [(3, docs[9][1]), (None, text(30)), (500, None), (501, "!! ??")]
    items = [(i, text(12)) for i in range(7)] + [(0, "w250 w251"), (8, None), (9, ""), (None, "w1"), (10, "absent words"), (11, docs[5][1])]
    found = ranked.search(
        spark.createDataFrame([(*i, 1, "t") for i in items], "item_id long, text string, doc_id int, term string"),
        spark.createDataFrame([(*d, 1, 2, "s") for d in docs], "doc_id long, text string, shard int, score int, term string"),
        **options,
    )
    want = plain_search(items, docs, options["k"])
    assert Counter(tuple(r) for r in found.collect()) == want and want


def test_search_odd(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "first line of THIS document"), (2, "日本語の文章です"), (3, "word7")], "item_id long, text string")
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert Counter(tuple(r) for r in ranked.search(items, odd_docs).collect()) == plain_search([tuple(r) for r in items.collect()], rows, 50)
    assert ranked.search(items, no_docs).count() == 0
    assert ranked.search(items.limit(0), odd_docs).count() == 0
