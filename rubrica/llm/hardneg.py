"""Hard negatives by anchor spanning trees: a parent's scores bound its child's, only overlapping candidates are rescored."""

import math
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rubrica.llm.common import written
from rubrica.operators.ordering import with_position

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROWS_PER_PART = 8192
ANCHORS_PER_PART = 4096
#: Largest product of two norms at which every partial sum of a dot product is an exact double.
EXACT = 2.0**52
MOST = 2**63 - 1
SLACK = 1e-9

#: Positions of candidates still open for an anchor, given lower and upper bounds of all rows' scores.
Open = Callable[[int, np.ndarray, np.ndarray], np.ndarray]


def usable(vector: Column, scale: int) -> Column:
    """Not null, and of finite components that stay finite when scaled."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) * float(scale) < math.inf)), F.lit(False))


def integers(vectors: pd.Series, scale: int, width: int = 0) -> np.ndarray:
    """Rows of floor(scale * x) as doubles; a shorter vector is filled up with zeros."""
    rows = [np.asarray(v, np.float64) for v in vectors]
    width = max([width, *map(len, rows)])
    if any(len(r) != width for r in rows):
        rows = [np.concatenate([r, np.zeros(width - len(r))]) for r in rows]
    return np.floor(scale * np.stack(rows)) if rows else np.zeros((0, width))


def norms(rows: np.ndarray) -> np.ndarray:
    top = np.maximum(np.abs(rows).max(1, initial=0.0), 1.0)
    return top * np.sqrt(((rows / top[:, None]) ** 2).sum(1)) * (1 + SLACK)


def spanning_tree(points: np.ndarray) -> tuple[list[int], list[int], list[float]]:
    """Prim's minimum spanning tree: points in the order reached, the parent of each, and the length of the edge to it."""
    count = len(points)
    near, parent = np.full(count, np.inf), np.zeros(count, np.int64)
    near[0] = 0.0
    outside = np.ones(count, bool)
    order = []
    for _ in range(count):
        at = int(np.argmin(np.where(outside, near, np.inf))) if order else 0
        if not outside[at]:  # all that is left is infinitely far
            at = int(np.flatnonzero(outside)[0])
        order.append(at)
        outside[at] = False
        gaps = norms(points - points[at])
        closer = outside & (gaps < near)
        near[closer], parent[closer] = gaps[closer], at
    return order, parent[order].tolist(), near[order].tolist()


def with_trees(anchors: DataFrame, scale: int) -> DataFrame:
    """Replace the anchors of each part by the same anchors in tree order, with ``turn``, ``parent`` (a turn) and ``edge``."""

    def of(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["id", "uid"]).reset_index(drop=True)
        order, parents, edges = spanning_tree(integers(part["vector"], scale))
        turn = {at: n for n, at in enumerate(order)}
        out = part.iloc[order].reset_index(drop=True)
        return out.assign(turn=range(len(order)), parent=[turn[p] for p in parents], edge=edges)

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in anchors.schema)
    return anchors.groupBy("apart").applyInPandas(of, f"{kept}, turn int, parent int, edge double")


def walk(tree: pd.DataFrame, anchors: np.ndarray, rows: np.ndarray, still_open: Open) -> Iterator[tuple[int, np.ndarray, list]]:
    """(turn, positions, exact integer scores) of the rows that each anchor had to score.

    All rows are scored at the root. A child's score of a row lies within edge length times row norm of its parent's, and
    within the product of the norms; a row whose bounds leave nothing open keeps its bounds, the others are scored and
    their bounds closed. Of a node's children the one with the largest subtree comes last, so that only about log2 of the
    tree's size bounds are held at a time.
    """
    lengths, own = norms(rows), norms(anchors)
    exact = lengths.max(initial=0.0) * own.max(initial=0.0) <= EXACT
    whole = None if exact else np.array([[int(x) for x in r] for r in rows], object).reshape(rows.shape)
    sizes = np.ones(len(tree), np.int64)
    children: list[list[int]] = [[] for _ in range(len(tree))]
    parents, edges = tree["parent"].tolist(), tree["edge"].tolist()
    for n in range(len(tree) - 1, 0, -1):
        sizes[parents[n]] += sizes[n]
        children[parents[n]].append(n)

    def scores(n: int, at: np.ndarray) -> list:
        if exact:
            found = (rows @ anchors[n])[at] if 2 * len(at) > len(rows) else rows[at] @ anchors[n]
            return found.astype(np.int64)
        of = np.array([int(x) for x in anchors[n]], object)
        return np.array([max(-MOST, min(MOST, int((whole[i] * of).sum()))) for i in at], np.int64)

    stack: list[tuple] = [(0, None, None)]
    while stack:
        n, low, high = stack.pop()
        reach = own[n] * lengths
        blur = SLACK * reach + 1.0
        if low is None:
            low, high = -reach, reach
            at = np.arange(len(rows))
        else:
            gap = edges[n] * lengths * (1 + SLACK) + blur
            low, high = np.maximum(low - gap, -reach), np.minimum(high + gap, reach)
            at = still_open(n, low, high)
        found = scores(n, at)
        if exact:
            low[at], high[at] = found, found
        else:  # a clipped or rounded score bounds nothing by itself
            inside = np.abs(found) < MOST
            near = found[inside].astype(np.float64)
            low[at[inside]], high[at[inside]] = near - blur[at[inside]], near + blur[at[inside]]
        yield n, at, found
        stack += [(c, low, high) for c in sorted(children[n], key=lambda c: (-sizes[c], c))]


def first(scores: np.ndarray, ids: np.ndarray, uids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` highest scores, ties to the smaller id."""
    at = np.arange(len(scores))
    if len(at) > 4 * k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    return at[np.lexsort((uids[at], ids[at], -scores[at]))[:k]]


def sides(rows: pd.DataFrame, tree: pd.DataFrame, scale: int) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
    tree = tree.sort_values("turn").reset_index(drop=True)
    points = integers(rows["vector"], scale)
    anchors = integers(tree["vector"], scale, points.shape[1])
    return tree, anchors, integers(rows["vector"], scale, anchors.shape[1])


def find_positives(rows: pd.DataFrame, tree: pd.DataFrame, scale: int, k: int) -> pd.DataFrame:
    """Of one part of the rows, the ``k`` highest scores of each anchor's own label, itself left out."""
    out: list[tuple] = []
    if len(rows) and len(tree):
        tree, anchors, points = sides(rows, tree, scale)
        ids, uids, labels = (rows[c].to_numpy() for c in ("id", "uid", "label"))
        wanted, own_id, own_uid = (tree[c].to_numpy() for c in ("label", "id", "uid"))
        alike = lambda n: (labels == wanted[n]) & ((ids != own_id[n]) | (uids != own_uid[n]))

        def still_open(n: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
            same = np.flatnonzero(alike(n))
            if len(same) <= k:
                return same
            return same[high[same] >= np.partition(low[same], len(same) - k)[len(same) - k]]

        for n, at, found in walk(tree, anchors, points, still_open):
            held = np.flatnonzero(alike(n)[at])
            best = held[first(found[held], ids[at[held]], uids[at[held]], k)]
            out += [(own_id[n], own_uid[n], ids[at[i]], uids[at[i]], found[i]) for i in best]
    return pd.DataFrame(out, columns=["anchor_id", "anchor_uid", "positive_id", "positive_uid", "positive_score"])


def find_negatives(rows: pd.DataFrame, tree: pd.DataFrame, scale: int, k: int, low_share: int) -> pd.DataFrame:
    """Of one part of the rows, the ``k`` highest scores of another label inside the window of each positive."""
    out: list[tuple] = []
    if len(rows) and len(tree):
        tree, anchors, points = sides(rows, tree, scale)
        ids, uids, labels = (rows[c].to_numpy() for c in ("id", "uid", "label"))
        own_id, wanted = tree["id"].to_numpy(), tree["label"].to_numpy()
        windows = [sorted((p["score"], p["id"], p["uid"]) for p in w) if w is not None else [] for w in tree["windows"]]
        # share * score <= 100 * negative in whole numbers
        floors = [[-(-low_share * int(s) // 100) for s, _, _ in w] for w in windows]

        def still_open(n: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
            met = np.zeros(len(low), bool)
            for (most, _, _), least in zip(windows[n], floors[n], strict=True):
                if least <= most:
                    met |= (high >= least) & (low <= most)
            return np.flatnonzero(met & (labels != wanted[n]))

        for n, at, found in walk(tree, anchors, points, still_open):
            other = labels[at] != wanted[n]
            for (most, pid, puid), least in zip(windows[n], floors[n], strict=True):
                held = np.flatnonzero(other & (found >= least) & (found <= most))
                best = held[first(found[held], ids[at[held]], uids[at[held]], k)]
                out += [(own_id[n], tree["uid"][n], pid, puid, most, ids[at[i]], uids[at[i]], found[i]) for i in best]
    names = ["anchor_id", "anchor_uid", "positive_id", "positive_uid", "positive_score"]
    return pd.DataFrame(out, columns=[*names, "negative_id", "negative_uid", "negative_score"])


def in_blocks(rows: DataFrame, trees: DataFrame, row_parts: int, tree_parts: int, of: Callable, schema: str) -> DataFrame:
    """Join every part of the rows with every tree, one pair of parts a group."""
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.withColumn("apart", every(tree_parts)).groupBy("rpart", "apart")
    right = trees.withColumn("rpart", every(row_parts)).groupBy("rpart", "apart")
    return left.cogroup(right).applyInPandas(of, schema)


def best_of(found: DataFrame, group: list[str], prefix: str, k: int) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc(f"{prefix}_score"), f"{prefix}_id", f"{prefix}_uid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def sign_place(vector: Column, bits: int = 16) -> Column:
    """Signs of ``bits`` fixed random sums of the components, as one number: near vectors often share it."""
    # A component's sign in a sum is a bit of a hash of its place.
    total = lambda b: F.aggregate(
        F.zip_with(vector, F.sequence(F.lit(1), F.greatest(F.size(vector), F.lit(1))), lambda x, i: F.coalesce(x.cast("double"), F.lit(0.0)) * (1 - 2 * F.pmod(F.xxhash64(i, F.lit(b)), F.lit(2)))),
        F.lit(0.0), lambda s, x: s + x,
    )
    return sum((F.when(total(b) > 0, 1 << b).otherwise(0) for b in range(bits)), F.lit(0))


def hard_negatives(
    rows: DataFrame, every: int = 100, positives: int = 5, k: int = 5, low_share: int = 80, scale: int = 256,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    rows_per_part: int = ROWS_PER_PART, anchors_per_part: int = ANCHORS_PER_PART,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): hard negatives of each anchor's positives.

    Anchors are the rows whose id is divisible by ``every``. A score is the integer inner product of two rows after every
    component x became floor(scale * x). An anchor's positives are its ``positives`` highest scores of its own label; the
    negatives of one are the ``k`` highest scores of other labels from ``low_share`` hundredths of the positive's score up to
    that score. Ties go to the smaller id.

    Anchors are cut into parts of near ones, each with a minimum spanning tree, and rows into parts by hash; every pair of
    parts is one group of bounded size, whatever the labels and vectors are. In it the tree is walked twice over the job,
    for the positives and, when these are final, for the windows: bounds from the parent tell which rows must be scored.

    Rows with a null id, label or vector, or with a null or non-finite component, take no part; neither do components that
    overflow when scaled. An empty vector is all zeros, and a shorter vector is filled up with zeros. Rows alike in id,
    label and vector count once; rows that share only the id are each a row, and each an anchor if the id says so. Scores
    beyond 64 bits are held at its ends. An anchor without positives or without negatives gives no rows, as does an empty
    table. Other columns are not read.
    """
    vector = F.col(vector_col)
    if rows.schema[vector_col].dataType.simpleString() != "array<float>":
        vector = vector.cast("array<double>")
    clean = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), vector.alias("vector"))
    clean = clean.where(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector"), scale)).distinct()
    clean = written(clean.withColumn("uid", F.xxhash64("id", "label", "vector")), "hard-rows")
    is_anchor = F.pmod("id", F.lit(every)) == 0
    count, chosen = clean.agg(F.count("*"), F.count_if(is_anchor)).first()
    row_parts, tree_parts = max(1, -(-count // rows_per_part)), max(1, -(-chosen // anchors_per_part))
    anchors = clean.where(is_anchor)
    if tree_parts > 1:
        placed = anchors.withColumn("key", F.struct(sign_place(F.col("vector")), "id", "uid"))
        anchors = with_position(placed, "key").withColumn("apart", F.floor(F.col("position") / anchors_per_part).cast("int"))
        anchors = anchors.drop("key", "position")
    else:
        anchors = anchors.withColumn("apart", F.lit(0))
    trees = written(with_trees(anchors, scale), "hard-trees")
    parted = clean.withColumn("rpart", F.pmod(F.xxhash64("id", "uid"), F.lit(row_parts)).cast("int"))
    pair = ["anchor_id", "anchor_uid"]

    def near(_: tuple, part: pd.DataFrame, tree: pd.DataFrame) -> pd.DataFrame:
        return find_positives(part, tree, scale, positives)

    def hard(_: tuple, part: pd.DataFrame, tree: pd.DataFrame) -> pd.DataFrame:
        return find_negatives(part, tree, scale, k, low_share)

    schema = "anchor_id long, anchor_uid long, positive_id long, positive_uid long, positive_score long"
    found = in_blocks(parted, trees, row_parts, tree_parts, near, schema)
    held = written(best_of(found, pair, "positive", positives).drop("rank"), "hard-positives")
    window = F.struct(F.col("positive_score").alias("score"), F.col("positive_id").alias("id"), F.col("positive_uid").alias("uid"))
    windows = held.groupBy(F.col("anchor_id").alias("id"), F.col("anchor_uid").alias("uid")).agg(F.collect_list(window).alias("windows"))
    aimed = trees.join(windows, ["id", "uid"], "left")
    schema += ", negative_id long, negative_uid long, negative_score long"
    found = in_blocks(parted, aimed, row_parts, tree_parts, hard, schema)
    ranked = best_of(found, [*pair, "positive_id", "positive_uid"], "negative", k)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
