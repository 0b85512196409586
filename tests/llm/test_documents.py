"""Operators on single documents: secrets, language, quality, sampling, benchmark passages."""

import hashlib
import itertools
import math
import random
import re
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from rubrica.llm import decontam, langid, quality, sampling, secrets
from rubrica.llm.queries import MODEL_PATH, QUERIES

SF = "/root/testdata/sf0.001"


def sorted_ids(rows):
    return sorted((r["doc_id"] if r["doc_id"] is not None else -1) for r in rows)


# Secrets


def plain_spans(text):
    found = []
    for kind, (pattern, least, group) in enumerate([
        (r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 1),
        (r"AKIA[A-Z0-9]+", 20, 0),
        (r"[0-9a-f]+", 24, 0),
    ]):
        found += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if len(m[group]) >= least]
    return sorted(found)


@pytest.mark.parametrize(
    "text",
    [
        "password=abc", "Password = 'abcdef'", "toKen=abcdefgh", "API_KEY: \"a.b-c/d+e=f_\" apikey=123456",
        "AKIA" + "A" * 16, "AKIA" + "A" * 15, "xAKIAAKIA" + "Z9" * 12, "é" * 5 + "a" * 24, "f" * 23 + "G" + "0" * 30,
        "secret:" + " " * 300 + "abcdef", "tokentoken=abcdef=secret:ghijkl", "passwd" * 200,
    ],
)
def test_base_spans(text):
    assert secrets.base_spans(text) == plain_spans(text)


def test_secret_query_agrees_with_plain_matching(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op9_secrets"](spark, SF).collect():
        spans = plain_spans(texts[r.doc_id] or "")
        shown = ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in spans)
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == n for _, k, _ in spans) for n in range(3)]
        assert r.base_sha256 == hashlib.sha256(shown.encode()).hexdigest()
        assert set(shown.split(",")) <= set(r.spans.split(",")) or not shown


def test_markov_models_find_unmarked_keys(spark):
    draw = random.Random(5)
    key = lambda n: "".join(draw.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    rows = [(i, f"some ordinary_identifier_name and token={key(32)} with getElementById2 words {i}") for i in range(300)]
    hidden = key(40)
    rows.append((999, f"here lies {hidden} between parse_config_file_v2_from_directory words"))
    found = secrets.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).where("doc_id = 999").first()
    assert found.spans == f"random:10:{10 + len(hidden)}"


def test_secrets_odd_inputs(odd_docs, no_docs, odd_ids):
    rows = secrets.scan_secrets(odd_docs).collect()
    assert sorted_ids(rows) == odd_ids
    assert all(r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in rows)
    assert secrets.scan_secrets(no_docs).count() == 0


# Language


def test_best_paths_against_enumeration():
    draw = np.random.default_rng(3)
    lengths = np.array([1, 6, 0, 4, 5])
    starts = np.cumsum(lengths) - lengths
    scores = draw.normal(0, 2, (lengths.sum(), 3))
    path = langid.best_paths(scores, starts, lengths, 1.5)
    for start, length in zip(starts, lengths, strict=True):
        value = lambda p: sum(scores[start + i, s] for i, s in enumerate(p)) - 1.5 * sum(a != b for a, b in itertools.pairwise(p))  # noqa: E731, B023
        own = tuple(path[start : start + length])
        assert value(own) == pytest.approx(max(map(value, itertools.product(range(3), repeat=int(length)))))


def test_languages_held_out_and_mixed(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null")
    rows = found.collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.98
    texts = {r.lang: r.text for r in docs.where("length(text) > 600").groupBy("lang").agg({"text": "min"}).toDF("lang", "text").collect()}
    mixed = texts["de"][:500] + " " + texts["es"][:400]
    got = langid.identify(docs.union(docs.limit(1).selectExpr("-1L", f"'{mixed}'", "null", "null", "null"))).where("doc_id = -1").first()
    assert [s.lang for s in got.spans] == ["de", "es"] and abs(got.spans[1].start - 501) < 40
    assert got.lang_pred == "de" and 0.4 < got.score < 0.7


def test_languages_odd_inputs(odd_docs, no_docs, odd_ids):
    rows = langid.identify(odd_docs).collect()
    assert sorted_ids(rows) == odd_ids
    by_id = {r.doc_id: r for r in rows}
    assert (by_id[7].lang_pred, by_id[7].score, by_id[7].spans) == ("und", 0.0, [])
    assert by_id[2].lang_pred == "und" and by_id[3].lang_pred == "und"
    assert langid.identify(no_docs).count() == 0
    assert {r.lang_pred for r in langid.identify(odd_docs.withColumn("lang", odd_docs.lang.substr(9, 1)).replace("", None)).collect()} == {"und"}


# Quality


def test_quality_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.score_documents(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.9
    assert all(0 <= r.score <= 1 for r in rows)


def test_quality_odd_inputs(spark, odd_docs, no_docs, odd_ids):
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 0), (5, 1, None), (6, None, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    for marked in (labels, labels.limit(0), labels.where("quality = 1")):
        rows = quality.score_documents(odd_docs, marked).collect()
        assert sorted_ids(rows) == odd_ids and all(0 <= r.score <= 1 for r in rows)
    assert quality.score_documents(no_docs, labels).count() == 0


def test_temperature_mends_overconfidence():
    draw = np.random.default_rng(1)
    x = draw.normal(0, 1, (3000, 4))
    y = (draw.random(3000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    hidden, output, temperature = quality.train_network(x[:1500], y[:1500])
    p = quality.sigmoid(quality.forward(x[1500:], hidden, output)[1] / temperature)
    bins = np.digitize(p, [0.25, 0.5, 0.75])
    assert all(abs(p[bins == b].mean() - y[1500:][bins == b].mean()) < 0.1 for b in range(4))


# Sampling


def all_segmentations(lattices, text):
    """(ids, log probability) of every path of a short text's lattice."""
    log, to, piece, node = (lattices.arrays[k] for k in ("log", "to", "piece", "node"))
    paths = [((), 0.0)]
    for unit in sampling.units_of(text):
        grown = []
        stack = [(lattices.first[unit], (), 0.0)]
        while stack:
            at, ids_, total = stack.pop()
            for e in np.flatnonzero(node == at):
                step = (int(to[e]), (*ids_, int(piece[e])), total + float(log[e]))
                (grown if step[0] < 0 else stack).append(step)
        paths = [(a + b, x + y) for a, x in paths for _, b, y in grown]
    spell = sampling.Sampler(lattices.pieces, 1, 1).spelled
    return {tuple(spell(np.array(p)).tolist()): x for p, x in paths}


@pytest.fixture(scope="module")
def pieces():
    return sampling.load_pieces(MODEL_PATH)


def test_samples_follow_gumbel_top_k(pieces):
    sampler = sampling.Sampler(pieces, 3, 1)
    text = "a cat é͸"
    runs = sampler.run([(i, text) for i in range(4000)])
    law = all_segmentations(sampler.lattices, text)
    assert math.fsum(map(math.exp, law.values())) == pytest.approx(1)
    firsts: dict = {}
    seconds: dict = {}
    for run in runs:
        chosen = [tuple(s[0].tolist()) for s in run]
        assert len(set(chosen)) == 3
        assert all(law[c] == pytest.approx(s[1]) for c, s in zip(chosen, run, strict=True))
        assert run[0][2] >= run[1][2] >= run[2][2] and all(s[3] <= 0 for s in run)
        firsts[chosen[0]] = firsts.get(chosen[0], 0) + 1
        seconds[chosen[1]] = seconds.get(chosen[1], 0) + 1
    p = {k: math.exp(v) for k, v in law.items()}
    for k, q in sorted(p.items(), key=lambda i: -i[1])[:6]:
        second = sum(p[f] * q / (1 - p[f]) for f in p if f != k)
        assert abs(firsts.get(k, 0) / 4000 - q) < 4 * math.sqrt(q / 4000) + 2e-3
        assert abs(seconds.get(k, 0) / 4000 - second) < 4 * math.sqrt(second / 4000) + 2e-3
    # Inverse inclusion probabilities of all but the last sample estimate sums over all segmentations without bias.
    weights = [sum(math.exp(s[1] - s[3]) for s in run) for run in runs]
    assert abs(np.mean(weights) - 1) < 0.05


def test_far_places_are_opened_exactly(pieces, monkeypatch):
    monkeypatch.setattr(sampling, "HEAD", 1)
    test_samples_follow_gumbel_top_k(pieces)


def test_few_segmentations_and_same_numbers_in_any_batch(pieces):
    one = sampling.Sampler(pieces, 4, 1).run([(1, "͸"), (2, ""), (3, "some words here")])
    assert len(one[0]) < 4 and one[0][0][3] == 0.0 and len(one[1]) == 1 and len(one[1][0][0]) == 0
    alone = sampling.Sampler(pieces, 4, 1).run([(3, "some words here")])[0]
    assert [a[0].tolist() for a in alone] == [a[0].tolist() for a in one[2]]
    assert np.allclose([a[1:] for a in alone], [a[1:] for a in one[2]])


def test_largest_numbers_stay_in_their_node(pieces, monkeypatch):
    """A number next to 1 is lost in a sum with the node's number, and then leads to the next node's edges."""
    lattices = sampling.Lattices(pieces)
    lattices.add(sampling.units_of("some words here"))
    monkeypatch.setattr(sampling, "uniform", lambda keys: np.full(len(keys), 1 - 2.0**-53))
    starts = np.array([lattices.first[u] for u in sampling.units_of("some words here")])
    edges, counts = lattices.walk(starts, np.arange(3, dtype=np.uint64))
    ids = lattices.arrays["piece"][edges]
    assert len(ids) == counts.sum() and sampling.surfaces_of([ids], pieces) == ["some words here"]


def test_memory_of_a_group_of_new_words(pieces):
    text = " ".join(f"word{i}x" for i in range(sampling.GROUP_CHARS // 10))
    sampler = sampling.Sampler(pieces, 2, 1)
    tracemalloc.start()
    found = sampler.run([(1, text)])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found[0]) == 2 and peak < 100e6


def test_sampling_round_trip(spark, odd_docs, no_docs):
    rows = sampling.encode_documents(odd_docs, MODEL_PATH).collect()
    assert all(r.round_trip for r in rows if r["rank"]) and sum(r["rank"] is None for r in rows) == 2
    assert sampling.encode_documents(no_docs, MODEL_PATH).count() == 0
    pieces = sampling.load_pieces(MODEL_PATH)
    back = sampling.encode_documents(odd_docs, MODEL_PATH).select("doc_id", sampling.decoded(F.col("ids"), pieces).alias("text"))
    assert {(r.doc_id, r.text) for r in back.collect()} == {(r.doc_id, r.text) for r in odd_docs.collect()}
    found = QUERIES["op6_sentencepiece"](spark, SF)
    assert found.where("not round_trip").count() == 0
    assert found.select("doc_id", "ids").distinct().count() == found.count()


# Benchmark passages


def plain_distance(pattern, text):
    """Least edit distance of the pattern to any part of the text, by the full table."""
    row = np.zeros(len(text) + 1, int)
    for i, c in enumerate(pattern, 1):
        new = np.empty_like(row)
        new[0] = i
        for j, d in enumerate(text, 1):
            new[j] = min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1)
        row = new
    return int(row.min())


def test_myers_distance():
    draw = random.Random(2)
    for _ in range(150):
        pattern = "".join(draw.choice("abc") for _ in range(draw.randint(1, 80)))
        text = "".join(draw.choice("abc") for _ in range(draw.randint(0, 120)))
        assert decontam.nearest_end(decontam.masks_of(pattern), len(pattern), text)[0] == plain_distance(pattern, text)


def test_leaks_within_budget_are_all_found():
    draw = random.Random(4)
    word = lambda: "".join(draw.choice("etaoinsh") for _ in range(draw.randint(2, 7)))
    passages = [(i, " ".join(word() for _ in range(draw.randint(8, 30)))) for i in range(12)]
    items = decontam.make_items(passages, 0.1, 16)
    automaton = decontam.make_automaton(items)
    for trial in range(60):
        item = items[trial % len(items)]
        changed = list(item.text)
        for _ in range(draw.randint(0, item.budget + 3)):
            at = draw.randrange(1, len(changed) - 1)
            kind = draw.randrange(3)
            changed[at : at + (kind > 0)] = [draw.choice("xyz")] if kind < 2 else []
        text = " ".join([*(word() for _ in range(20)), "".join(changed), *(word() for _ in range(20))])
        plain = decontam.normal(text)
        got = {f["item_id"]: f for f in decontam.leaks_in(text, items, automaton)}
        for other in items:
            distance = plain_distance(other.text, plain)
            assert (other.item_id in got) == (distance <= other.budget)
            if other.item_id in got:
                span = plain[got[other.item_id]["start"] : got[other.item_id]["end"]]
                assert got[other.item_id]["distance"] == distance == plain_distance(other.text, span)


def test_leaks_odd_inputs(spark, odd_docs, no_docs, odd_ids):
    items = [(1, "This Text  is quite a long item."), (2, None), (3, ""), (None, "a text without an id that should"), (4, "first line of THIS document is"), (5, "x" * 40)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    marked = decontam.with_leaks(odd_docs, benchmark, "leaks_of")
    assert sorted_ids(marked.collect()) == odd_ids and marked.columns == [*odd_docs.columns, "leaks_of"]
    got = decontam.contaminated(odd_docs, benchmark).collect()
    assert sorted((r.doc_id, r.item_id, r.distance) for r in got) == [(1, 4, 0), (1, 4, 0), (6, 5, 0)]
    assert decontam.contaminated(no_docs, benchmark).count() == 0
    assert decontam.contaminated(odd_docs, benchmark.limit(0)).count() == 0


def test_items_in_blocks_match_as_one(spark, monkeypatch):
    docs, benchmark = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = sorted(decontam.contaminated(docs, benchmark).collect())
    blocks = list(decontam.item_blocks(benchmark, 2000))
    assert len(blocks) > 2 and sum(map(len, blocks)) == benchmark.count()
    monkeypatch.setattr(decontam, "item_blocks", lambda b: iter(blocks))
    assert sorted(decontam.contaminated(docs, benchmark).collect()) == whole and whole




def test_short_items_are_found_as_whole_words(spark):
    benchmark = spark.createDataFrame([(1, "Ten chars!"), (2, "cat"), (3, " "), (4, "")], "item_id long, text string")
    texts = ["say ten  CHARS! now", "concatenate", "a cat, sat", "catcat cat", "often chars!", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.distance, r.start, r.end) for r in decontam.contaminated(docs, benchmark).collect())
    assert got == [(0, 1, 0, 4, 14), (2, 2, 0, 2, 5), (3, 2, 0, 7, 10)]


def test_what_a_base_span_leaves_of_a_run_is_free():
    text = "x AKIA" + "Q" * 16 + "/" + "k" * 40 + " end"
    spans = secrets.base_spans(text)
    assert [text[a:b] for a, b in secrets.free_tokens(text, spans, 8)] == ["/" + "k" * 40]
    text = "abcdefgh-" + "0" * 30 + "+ijklmnop"
    assert [text[a:b] for a, b in secrets.free_tokens(text, secrets.base_spans(text), 8)] == ["abcdefgh-", "+ijklmnop"]
    assert list(secrets.free_tokens("plain-token here", [], 8)) == [(0, 11)]


def test_a_rare_language_keeps_its_grams_and_numerals_are_no_letters(spark):
    docs = [(i, f"common words of the usual kind number w{'abcdefghij'[i % 10]}{'klmnop'[i % 6]} and more of them", "en") for i in range(400)]
    docs += [(1000 + i, "редкие слова другого языка", "ru") for i in range(6)]
    docs += [(2000, "редкие слова", None), (2001, "½ ² ³ Ⅷ", None), (2002, "the usual words", None)]
    found = langid.identify(spark.createDataFrame(docs, "doc_id long, text string, lang string"), grams=40)
    got = {r.doc_id: (r.lang_pred, r.score) for r in found.collect()}
    assert got[2000][0] == "ru" and got[2001] == ("und", 0.0) and got[2002][0] == "en"


def test_more_languages_than_a_byte_counts():
    draw = np.random.default_rng(2)
    scores = draw.normal(size=(6, 300))
    scores[:, 299] += 50
    assert langid.best_paths(scores, np.array([0]), np.array([6]), 8.0).tolist() == [299] * 6
