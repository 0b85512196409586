import hashlib
import random

import pytest
from pyspark.sql import functions as F

from rubrica.operators import ordering, sequences, skew


def ids(spark, values, partitions=3):
    return spark.createDataFrame([(v,) for v in values], "k long").repartition(partitions)


@pytest.fixture(scope="module")
def keys():
    rng = random.Random(4)
    dense = list(range(200))
    sparse = rng.sample(range(10**12), 200)
    return dense + [-s for s in sparse] + [10**15 + s for s in sparse]


@pytest.mark.parametrize("n_ranges", [1, 2, 7, 64])
def test_positions_are_the_sorted_ranks(spark, keys, n_ranges):
    got = {r.k: r.position for r in ordering.with_position(ids(spark, keys), "k", n_ranges=n_ranges).collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}


def test_running_weights(spark, keys):
    df = ids(spark, keys).withColumn("w", F.pmod("k", F.lit(5)))
    got = {r.k: r.start for r in ordering.with_position(df, "k", "start", F.col("w"), 8).collect()}
    total = 0
    for k in sorted(keys):
        assert got[k] == total
        total += k % 5


def test_positions_of_an_empty_and_a_single_row_table(spark):
    assert ordering.with_position(ids(spark, []), "k").collect() == []
    assert [r.position for r in ordering.with_position(ids(spark, [7]), "k").collect()] == [0]


def test_shuffle_is_the_same_on_any_partitioning(spark, keys):
    def place(partitions, n_ranges):
        df = ordering.with_shuffled_position(ids(spark, keys, partitions), "s", "k", n_ranges=n_ranges)
        return {r.k: r.position for r in df.collect()}

    want = sorted(keys, key=lambda k: hashlib.md5(f"s|{k}".encode()).hexdigest())
    assert place(1, 1) == place(5, 16) == {k: i for i, k in enumerate(want)}
    assert want != sorted(keys)


@pytest.mark.parametrize("n", [0, 1, 2, 5, 10, 601])
def test_positional_split(spark, n):
    df = ids(spark, [3 * i for i in range(n)]).withColumn("x", F.lit("row"))
    rows = ordering.split_positional(df, "k").collect()
    train = sorted(r.k for r in rows if r.split == "train")
    assert len(rows) == n and train == [3 * i for i in range(int(n * 0.6))]


@pytest.mark.parametrize("seed", [None, 1])
def test_batches(spark, seed):
    rows = ordering.assign_batches(ids(spark, range(75)), "k", 8, seed).collect()
    sizes = {}
    for r in rows:
        sizes.setdefault(r.batch_id, set()).add(r.slot)
    assert len(sizes) == 10 and [len(sizes[b]) for b in range(10)] == [8] * 9 + [3]


def brute_pack(docs, length, prefix, suffix):
    stream = [t for d in docs for t in [*prefix, *d, *suffix]]
    return [
        (c, stream[c * length : (c + 1) * length], stream[c * length + 1 : (c + 1) * length + 1])
        for c in range(max(len(stream) - 1, 0) // length)
    ]


@pytest.mark.parametrize("length", [1, 2, 5, 32])
@pytest.mark.parametrize("wrap", [((), ()), ((1,), (2,))])
def test_packing_equals_cutting_one_stream(spark, length, wrap):
    rng = random.Random(length)
    docs = [[rng.randint(10, 99) for _ in range(rng.choice([0, 1, 2, 5, 33, 64]))] for _ in range(25)]
    df = spark.createDataFrame(list(enumerate(docs)), "k long, ids array<int>").repartition(4)
    got = sequences.pack_sequences(df, "k", "ids", length, *wrap).orderBy("chunk_id").collect()
    assert [(r.chunk_id, r.input_ids, r.labels) for r in got] == brute_pack(docs, length, *wrap)
    mixed = sequences.pack_sequences(df, "k", "ids", length, *wrap, seed=9).orderBy("chunk_id").collect()
    order = sorted(range(25), key=lambda k: hashlib.md5(f"9|{k}".encode()).hexdigest())
    assert [(r.chunk_id, r.input_ids, r.labels) for r in mixed] == brute_pack([docs[k] for k in order], length, *wrap)


def test_shift_labels(spark):
    rows = [(s, p, 10 * s + p) for s in range(3) for p in range(s + 1)]
    df = spark.createDataFrame(rows, "seq_id long, pos long, token_id long")
    got = {(r.seq_id, r.pos): r.label for r in sequences.shift_labels(df).collect()}
    assert got == {(s, p): (t + 1 if p < s else None) for s, p, t in rows}
    wide = spark.createDataFrame([([1, 2, 3],), ([],)], "ids array<int>").select(sequences.shift_labels_wide(F.col("ids")).alias("l"))
    assert [r.l for r in wide.collect()] == [[2, 3], []]


def test_shape_sequences(spark):
    pairs = [(0, 0, [1, 2], [3]), (1, 0, [4], [5, 6, 7]), (2, 0, [8, 9], [10]), (3, 1, [1], [2])]
    df = spark.createDataFrame(pairs, "i long, b long, p array<int>, o array<int>")
    got = {r.i: r for r in sequences.shape_sequences(df, "p", "o", 0, "b", "i").collect()}
    for i, b, p, o in pairs:
        width = max(len(q) + len(r) for _, c, q, r in pairs if c == b) - 1
        full = p + o + [0] * width
        assert got[i].input_ids == full[:width] and got[i].labels == full[1 : width + 1]
        assert got[i].response_mask == [len(p) - 1 <= t < len(p) + len(o) - 1 for t in range(width)]


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_lookup_equals_the_plain_join(spark, no_broadcast, how):
    big = spark.createDataFrame([(i, 0 if i % 3 else i % 50) for i in range(900)], "i long, k long").union(
        spark.createDataFrame([(5000, None)], "i long, k long")
    )
    small = spark.createDataFrame([(k, f"v{k}") for k in range(0, 60, 2)], "k long, v string")
    salted = skew.lookup_join(big, small, "k", "i", how, hot_rows=40, keys_from=big)
    assert "_salt" in salted._jdf.queryExecution().toString() and salted.columns == ["k", "i", "v"]
    plain = big.join(small, "k", how)
    assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))


def test_salted_lookup_spreads_the_hot_key(spark, no_broadcast):
    big = spark.range(4000).withColumn("k", F.lit(1))
    small = spark.createDataFrame([(1, "x")], "k int, v string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = skew.lookup_join(big, small, "k", "id", "inner", hot_rows=100, keys_from=big)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 4000 and len(sizes) == 4 and max(sizes) < 2000


def test_lookup_uses_a_plain_join_for_a_small_table(spark):
    big, small = spark.range(10).withColumn("k", F.lit(1)), spark.range(2).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    plan = skew.lookup_join(big, small, "k", "id")._jdf.queryExecution().toString()
    assert "_salt" not in plan
    with pytest.raises(ValueError):
        skew.lookup_join(big, small, "k", "id", how="full")


@pytest.mark.parametrize(("name", "scans", "joins"), [("grpo_grad", 8, 4), ("grpo_loss", 6, 3), ("shape_sequences", 4, 3)])
def test_plans_do_not_multiply_without_broadcasts(spark, no_broadcast, name, scans, joins):
    import __spark_entry__ as contract

    plan = contract.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") <= scans and plan.count("SortMergeJoin") <= joins


def test_split_fractions_at_the_ends(spark):
    df = spark.range(10).select(F.col("id").alias("k"))
    split = lambda f: [r.split for r in ordering.split_positional(df, "k", f).orderBy("k").collect()]
    assert split(1.0) == ["train"] * 10 and split(0.0) == ["validation"] * 10 and split(0.6).count("train") == 6
    with pytest.raises(ValueError):
        ordering.split_positional(df, "k", 1.5)


def test_positions_by_text_and_composite_keys(spark):
    rows = [(f"k{i * 37 % 101:03d}", i % 3) for i in range(101)]
    df = spark.createDataFrame(rows, "t string, n int").withColumn("both", F.struct("n", "t"))
    by_text = {r.t: r.position for r in ordering.with_position(df, "t", n_ranges=7).collect()}
    assert by_text == {t: i for i, t in enumerate(sorted(t for t, _ in rows))}
    both = {(r.n, r.t): r.position for r in ordering.with_position(df, "both", n_ranges=7).collect()}
    assert both == {k: i for i, k in enumerate(sorted((n, t) for t, n in rows))}


def test_labels_over_block_borders_need_one_shuffle(spark, capsys):
    rows = [(s, p, 100 * (s or 9) + p) for s in (1, 2, None) for p in range(25) if (s, p) != (2, 7)] + [(1, None, 5)]
    df = spark.createDataFrame(rows, "seq_id long, pos long, token_id long")
    labelled = sequences.shift_labels(df, block=4)
    got = sorted(((r.seq_id or 0, -1 if r.pos is None else r.pos), r.label) for r in labelled.collect())
    held = {(s, p): t for s, p, t in rows if s is not None and p is not None}
    assert got == sorted(((s or 0, -1 if p is None else p), held.get((s, p + 1)) if p is not None else None) for s, p, _ in rows)
    sequences.shift_labels(df, block=4).explain()
    assert capsys.readouterr().out.count("Exchange") == 1


def test_selection_finds_the_key_at_any_cut(spark):
    keys = [i * i % 211 for i in range(300)] + [7] * 200
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for fraction in (0.0, 0.1, 0.33, 0.5, 0.77, 0.999):
        assert ordering.key_at(df, "k", fraction, 8) == sorted(keys)[int(500 * fraction)]
    assert ordering.key_at(df, "k", 1.0, 8) is None and ordering.key_at(df.limit(0), "k", 0.5) is None
