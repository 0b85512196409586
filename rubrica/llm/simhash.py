"""SimHash fingerprints and their near-duplicate components by pigeonring filtering."""

import sys

import numpy as np
import pandas as pd
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rubrica.llm.common import components, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BITS = 64
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
CHUNK = 1 << 16


def fingerprint_of(text: str | None, words: int = 3, seed: int = 42) -> int:
    """The fingerprint of one whole text as an unsigned 64-bit number; 0 for a null text or one without words."""
    tokens = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(words, len(tokens))
    starts, ends = starts[: len(tokens) - width + 1].tolist(), ends[width - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), CHUNK):
        part = zip(starts[at : at + CHUNK], ends[at : at + CHUNK], strict=True)
        hashes = np.array([digest(joined[i:j], seed) for i, j in part], np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(starts), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprint(text: Column, words: int = 3) -> Column:
    """The fingerprint of each whole text as a BIGINT of the same 64 bits."""

    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint_of(t, words) for t in texts], np.uint64).view(np.int64))

    return F.pandas_udf(of, "long")(text)


def segment_bounds(segments: int) -> list[tuple[int, int]]:
    """(first bit, width) of each segment; the wider ones come first."""
    wide = [BITS // segments + (i < BITS % segments) for i in range(segments)]
    return [(sum(wide[:i]), w) for i, w in enumerate(wide)]


def _segment(value: str, start: int, width: int) -> str:
    return f"(shiftrightunsigned({value}, {start}) & {(1 << width) - 1}L)"


def ring_links(nodes: DataFrame, budget: int = 2, dense: int = 16, name: str = "simhash") -> DataFrame:
    """Edges (a, b) between the distinct fingerprints ``fp`` that connect all those at ``budget`` or fewer differing bits.

    The bits are cut into 2 * budget + 1 segments on a ring. If two fingerprints differ in at most ``budget`` bits, then
    from some segment on every chain of ``l`` consecutive segments differs in at most ``l * budget / segments`` bits; the
    first two segments of that chain are therefore equal, and key the candidates. The longer chains are checked before
    the full distance.

    A key met by more than ``dense`` fingerprints is not joined with itself. Its fingerprints are linked through shared
    centres instead: two of them are within 2 bits exactly if some word is within 1 bit of both, so each is posted under
    the 65 words within 1 bit of it and the (at most 65) holders of a word are linked to the smallest. That is exact for
    a budget of 2, the only one taken, and linear in a dense group.
    """
    if budget != 2:
        raise ValueError("the shared-centre step is exact for 2 differing bits")
    bounds = segment_bounds(2 * budget + 1)
    m = len(bounds)
    keys = [
        f"struct({i} as turn, shiftleft({_segment('fp', *bounds[i])}, 16) | {_segment('fp', *bounds[(i + 1) % m])} as key)"
        for i in range(m)
    ]
    posted = nodes.select("fp", F.expr(f"explode(array({', '.join(keys)})) as k")).select("fp", "k.turn", "k.key")
    posted = written(posted, f"{name}-posted")
    sizes = posted.groupBy("turn", "key").agg(F.count("*").alias("n")).where("n > 1")
    shared = written(posted.join(sizes, ["turn", "key"]), f"{name}-shared")
    few = shared.where(F.col("n") <= dense)
    pairs = few.select("turn", "key", F.col("fp").alias("a")).join(
        few.select("turn", "key", F.col("fp").alias("b")), ["turn", "key"]
    )
    diff = "(a ^ b)"
    chains = []
    for i in range(m):
        ring = [f"bit_count({_segment(diff, *bounds[(i + j) % m])})" for j in range(m)]
        held = " and ".join(f"{' + '.join(ring[:n])} <= {n * budget // m}" for n in range(3, m))
        chains.append(f"(turn = {i} and {held})")
    sparse = pairs.where("a < b").where(" or ".join(chains)).where(f"bit_count({diff}) <= {budget}").select("a", "b")
    centres = "transform(sequence(0, 64), i -> if(i = 64, fp, fp ^ shiftleft(1L, i)))"
    holders = (
        shared.where(F.col("n") > dense)
        .select("fp")
        .distinct()
        .select("fp", F.expr(f"explode({centres})").alias("centre"))
        .groupBy("centre")
        .agg(F.sort_array(F.collect_list("fp")).alias("held"))
        .where("size(held) > 1")
    )
    thick = holders.select(F.element_at("held", 1).alias("b"), F.explode(F.slice("held", 2, BITS)).alias("a"))
    return sparse.select("a", "b").union(thick.select("a", "b")).distinct()


def linked(marked: DataFrame) -> DataFrame:
    """(fp, root) of every distinct fingerprint of ``marked``; the root is the smallest fingerprint of its component."""
    nodes = written(marked.select("fp").distinct(), "simhash-nodes")
    roots = components(ring_links(nodes), "simhash")
    return nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """One row per input row: (id, fp BIGINT, component_id).

    ``component_id`` is the smallest id reachable over links of 2 or fewer differing bits. A null text, an empty one and
    one without words have fingerprint 0 and link like any other. A null id is never the smallest unless its component
    has no other id. Repeated rows stay repeated. An empty table gives no rows. Other columns are not read.
    """
    marked = docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col), words).alias("fp"))
    marked = written(marked, "simhash-fingerprints")
    roots = written(linked(marked), "simhash-roots")
    held = marked.groupBy("fp").agg(F.min("id").alias("least")).join(roots, "fp")
    least = held.groupBy("root").agg(F.min("least").alias("component_id"))
    named = roots.join(least, "root").select("fp", "component_id")
    return marked.join(named, "fp", "left").select(F.col("id").alias(id_col), "fp", "component_id")


def keep_one(docs: DataFrame, words: int = 3) -> DataFrame:
    """The rows of ``docs`` that come first in their component: the smallest ``doc_id``, then by a hash of the text.

    Components are those of :func:`near_duplicates`: fingerprints of shingles of ``words`` words, linked at 2 or fewer
    differing bits. Null, empty and wordless texts share fingerprint 0 and are one group like any other. Null ids come
    last. All columns are kept. Rows that repeat an id and text are one; which of them stays, where other columns differ,
    is not defined. An empty table stays empty. Fingerprints and ids are shuffled to find the groups; the texts move once,
    to meet the first rows.
    """
    body = F.xxhash64("text")
    marked = docs.select(F.col("doc_id").alias("id"), body.alias("body"), fingerprint(F.col("text"), words).alias("fp"))
    marked = written(marked, "near-marked")
    place = F.struct(F.col("id").isNull().alias("last"), "id", "body")
    held = marked.groupBy("fp").agg(F.min(place).alias("first"))
    least = held.join(linked(marked), "fp").groupBy("root").agg(F.min("first").alias("first"))
    first = written(least.select(F.col("first.id").alias("first_id"), F.col("first.body").alias("first_body")), "near-first")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), body.alias("body"))
    met = rows.join(first, F.col("id").eqNullSafe(F.col("first_id")) & (F.col("body") == F.col("first_body")))
    repeated = marked.groupBy("id", "body").count().where("count > 1").limit(1).count()
    return (met.dropDuplicates(["id", "body"]) if repeated else met).select("row.*")
