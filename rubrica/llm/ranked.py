"""Ranked lexical search: bundles of items carry document accumulators through successive term owners."""

import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rubrica.llm.common import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: The same rule on UTF-8 bytes: ASCII letters and digits and all other characters stay, what separates becomes a blank.
KEPT = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

SIEVE_BITS = 21
SHARD_DOCS, SHARD_CHARS = 4096, 16_000_000
BUNDLE_ITEMS = 512
SHARDS_PER_SALT = 512
#: Share of the documents that a term of each owner but the last is in at most; owners of rarer terms come first.
OWNERS = (1 / 256, 1 / 16)

INDEX = pa.schema([
    ("shard", pa.int64()), ("term", pa.string()), ("docs", pa.list_(pa.int32())), ("tf", pa.list_(pa.int32())),
    ("n", pa.list_(pa.int32())), ("unnamed", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("live", pa.int64()), ("total", pa.int64()),
])


def item_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item_id, term): each term of an item once."""
    terms = F.regexp_extract_all(F.translate(F.col(text_col), UPPER, LOWER), F.lit(TERM), F.lit(0))
    named = items.where(F.col(item_col).isNotNull())
    return named.select(F.col(item_col).cast("long").alias("item_id"), F.explode(terms).alias("term")).distinct()


def sieve_of(terms: DataFrame) -> bytes:
    """A bit per hash of a wanted term, 256 KB whatever their number; what passes it wrongly is dropped by a join."""
    place = F.pmod(F.xxhash64("term"), F.lit(1 << SIEVE_BITS)) + 1
    rows = terms.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("m"))
    size = (1 << SIEVE_BITS) // 8
    out = bytearray(size)
    for row in rows.collect():
        at = (row.b - 1) * len(row.m)
        out[at : at + len(row.m)] = row.m
    return bytes(out)


def shard_rows(shard: int, docs: list[tuple[int | None, str | None]], sieve: bytes) -> list[tuple]:
    """The index rows of one shard: a posting list per wanted term, and one row on the shard without a term.

    Documents are numbered in the order of their ids, so equal scores are settled by number. Those without an id are
    counted, in the lists by ``unnamed`` and in the shard's totals, but not posted.
    """
    docs = sorted(docs, key=lambda d: (d[0] is None, d[0] or 0))
    mask = (1 << SIEVE_BITS) - 1
    posted: dict[bytes, tuple[list, list, list] | None] = {}
    unnamed: Counter = Counter()
    live = total = 0
    for number, (doc_id, text) in enumerate(docs):
        tokens = (text or "").encode("utf-8", "surrogatepass").translate(KEPT).split()
        count = len(tokens)
        live, total = live + (count > 0), total + count
        for term, tf in Counter(tokens).items():
            if term in posted:
                lists = posted[term]
            else:
                at = xxhash.xxh64_intdigest(term, 42) & mask
                lists = posted[term] = ([], [], []) if sieve[at >> 3] >> (at & 7) & 1 else None
            if lists is not None:
                if doc_id is None:
                    unnamed[term] += 1
                else:
                    lists[0].append(number)
                    lists[1].append(tf)
                    lists[2].append(count)
    ids = [d for d, _ in docs if d is not None]
    rows = [(shard, None, None, None, None, 0, ids, live, total)]
    rows += [(shard, t.decode("utf-8", "replace"), *p, unnamed[t], None, 0, 0) for t, p in posted.items() if p is not None]
    return rows


def make_index(docs: DataFrame, sieve: bytes, shard_docs: int) -> DataFrame:
    """Inverted lists of whole texts in shards of bounded size. Narrow: a shard never leaves its task."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        size = 0

        def flushed() -> pa.RecordBatch:
            rows = shard_rows(shard, held, sieve)
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), INDEX, strict=True)]
            return pa.RecordBatch.from_arrays(columns, schema=INDEX)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for row in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    held.append(row)
                    size += len(row[1] or "")
                    if len(held) >= shard_docs or size >= SHARD_CHARS:
                        yield flushed()
                        shard, held, size = shard + 1, [], 0
        if held:
            yield flushed()

    return docs.mapInArrow(
        of, "shard long, term string, docs array<int>, tf array<int>, n array<int>, unnamed long, doc_ids array<long>, live long, total long"
    )


def kept_places(scores: np.ndarray, rest: int, k: int, last: bool) -> np.ndarray:
    """Places of the scores above 0 that can still be among the ``k`` highest of the shard when ``rest`` more may come.

    After the last owner these are the ``k`` highest themselves, equal scores by place.
    """
    at = np.flatnonzero(scores)
    if len(at) <= k:
        return at
    held = scores[at]
    least = np.partition(held, len(held) - k)[len(held) - k]
    at = at[held + rest >= least]
    return at[np.lexsort((at, -scores[at]))[:k]] if last else at


def visit(bundles: pd.DataFrame, lists: pd.DataFrame, documents: int, tokens: int, k: int, last: bool) -> list[tuple]:
    """One owner's visit by the bundle of one shard: (item_id, docs, scores) with its terms' contributions added.

    ``lists`` has the owner's posting lists of the shard with the items that ask for each term, and the most that later
    owners may still add for each item.
    """
    size = 1 + max([0, *(int(d.max()) for d in [*bundles["docs"], *lists["docs"]] if len(d))])
    sums: dict[int, np.ndarray] = {}
    rest: dict[int, int] = {}
    for item, docs, scores in zip(bundles["item_id"], bundles["docs"], bundles["scores"], strict=True):
        sums[item] = np.zeros(size, np.int64)
        sums[item][docs] = scores
    for weight, docs, tf, n, items in zip(*(lists[c] for c in ("w", "docs", "tf", "n", "items")), strict=True):
        tf, n = tf.astype(np.int64), n.astype(np.int64)
        m = 100 - 50 + (50 * n * documents) // tokens
        added = weight * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
        for item in items:
            if item["item_id"] not in sums:
                sums[item["item_id"]] = np.zeros(size, np.int64)
            sums[item["item_id"]][docs] += added
            rest[item["item_id"]] = item["rest"]
    out = []
    for item, scores in sums.items():
        # a bundle without a term here keeps what it has; its bound is not at hand
        at = kept_places(scores, rest[item], k, last) if last or item in rest else np.flatnonzero(scores)
        if len(at):
            out.append((item, at, scores[at]))
    return out


def owner_of(df: Column, documents: int) -> Column:
    """The number of a term's owner: terms are dealt out by the share of documents they are in."""
    return sum(((df > share * documents).cast("int") for share in OWNERS), F.lit(0))


def weighted_terms(postings: DataFrame, documents: int, tokens: int) -> DataFrame:
    """(term, owner, w, most): weight and the most that a term can add to a document's score."""
    stats = postings.groupBy("term").agg(
        F.sum(F.size("docs") + F.col("unnamed")).alias("df"), F.max(F.array_max("tf")).alias("tf"), F.min(F.array_min("n")).alias("n")
    )
    weight = F.floor(1000 * F.log(F.lit(2.0 * documents + 2) / (2 * F.col("df") + 1)))
    most = f"w * ((1000000000L * tf) div (1000L * tf + 20L * (50L + (50L * n * {documents}L) div {tokens}L)))"
    found = stats.withColumn("w", weight).withColumn("owner", owner_of(F.col("df"), documents))
    return found.selectExpr("term", "owner", "w", f"coalesce({most}, 0L) as most")


def search(
    items: DataFrame, docs: DataFrame, k: int = 50, item_col: str = "item_id", item_text: str = "text", doc_col: str = "doc_id",
    doc_text: str = "text", shard_docs: int = SHARD_DOCS, bundle_items: int = BUNDLE_ITEMS, shards_per_salt: int = SHARDS_PER_SALT,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` highest-scoring documents of each item, all if fewer score above 0.

    Terms are dealt out to owners by document frequency. Documents are indexed in shards of bounded size. A bundle is a block
    of items with a sparse accumulator of documents for each; one per shard travels from owner to owner, the rarest terms
    first, and meets their posting lists by cogroup on (shard, block). The owner adds whole-number contributions. Between
    stages an accumulator is dropped only if the later owners' largest possible contributions cannot lift it to the ``k``-th
    score that its shard has already: its document could not be selected, so results are exact. Each shard hands on its
    ``k`` best, and the last step ranks these per item. So no term, document or item, however frequent, makes a task
    larger than a shard times a block; lists of a frequent term are salted by shard where they meet the items.

    A null or empty text, and one of separators only, holds no term: such a document is not counted, such an item finds
    nothing. Items with a null id are left out; rows that share an item id are one item with all their terms. Documents
    with a null id count in all statistics but are not returned. Rows that repeat a document are documents of their own and
    may each be returned. Equal scores go to the smaller id. Very long texts make a shard of their own. Empty tables give no
    rows. Other columns are not read.
    """
    terms = written(item_terms(items, item_col, item_text), "ranked-terms")
    texts = docs.select(F.col(doc_col).cast("long").alias("id"), F.col(doc_text).cast("string").alias("text"))
    index = written(make_index(texts, sieve_of(terms), shard_docs), "ranked-index")
    heads = index.where("term is null")
    documents, tokens, shards = heads.agg(F.coalesce(F.sum("live"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0)), F.count("*")).first()
    blocks = max(1, -(-terms.select("item_id").distinct().count() // bundle_items))
    salts = max(1, -(-shards // shards_per_salt))
    lists = index.where("term is not null").select("shard", "term", "docs", "tf", "n", "unnamed")
    weights = written(weighted_terms(lists, documents, max(1, tokens)), "ranked-weights")
    asked = terms.join(weights, "term")
    last = len(OWNERS)
    later = [F.sum(F.when(F.col("owner") > s, F.col("most")).otherwise(0)).alias(f"rest{s}") for s in range(last + 1)]
    asked = asked.join(asked.groupBy("item_id").agg(*later), "item_id")
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int").alias("block")
    asked = written(asked.select("*", block), "ranked-asked")
    salted = lists.where("size(docs) > 0").withColumn("salt", F.pmod(F.xxhash64("shard"), F.lit(salts)).cast("int"))
    bundles = None
    for stage in range(last + 1):
        who = F.collect_list(F.struct("item_id", F.col(f"rest{stage}").alias("rest"))).alias("items")
        owned = asked.where(F.col("owner") == stage).groupBy("term", "block", "w").agg(who)
        owned = owned.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        met = salted.join(owned, ["term", "salt"]).select("shard", "block", "w", "docs", "tf", "n", "items")
        bundles = carried(bundles, met, documents, max(1, tokens), k, stage == last)
    scored = bundles.join(heads.select("shard", "doc_ids"), "shard")
    scored = scored.select("item_id", F.explode(F.arrays_zip(F.expr("transform(docs, d -> doc_ids[d])").alias("doc_id"), F.col("scores").alias("score"))).alias("r"))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    ranked = scored.select("item_id", "r.doc_id", "r.score").where("score > 0").withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def carried(bundles: DataFrame | None, lists: DataFrame, documents: int, tokens: int, k: int, last: bool) -> DataFrame:
    """The bundles after one owner: (shard, block, item_id, docs, scores)."""
    schema = "shard long, block int, item_id long, docs array<int>, scores array<long>"
    if bundles is None:
        bundles = lists.sparkSession.createDataFrame([], schema)

    def of(key: tuple, held: pd.DataFrame, owned: pd.DataFrame) -> pd.DataFrame:
        rows = [(*key, *row) for row in visit(held, owned, documents, tokens, k, last)]
        return pd.DataFrame(rows, columns=["shard", "block", "item_id", "docs", "scores"])

    return bundles.groupBy("shard", "block").cogroup(lists.groupBy("shard", "block")).applyInPandas(of, schema)
