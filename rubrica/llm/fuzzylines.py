"""Fuzzy line dedup in DataFrame and SQL functions alone: MinHash bands, exact Jaccard, components, one line kept of each."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rubrica.llm.common import components, written

SHINGLE = 8
#: Lines are similar from this Jaccard similarity on: ``IN`` of ``OF``.
IN, OF = 4, 5
SIDE = 4
LANES = SIDE * SIDE
STAR_ROUNDS = 5
#: A band has leaders from so many of its largest components, and so many of each.
LED, LEADERS = 8, 4
FEW = 16
#: Shingles a row of the signatures' input takes: one look-up of its line and one update of each lane for all of them.
STEP = 4
SIEVE_BITS = 18
WORDS = 16
#: A round of leaders is followed by another one if it joined at least this share of the lines it compared.
WORTH = 0.02

#: Lane sets of the bands: the rows, columns and diagonals of a 4 x 4 square of lanes. Of pairs of lines at similarity
#: 0.8 they bring 98.0 % together, at 0.85 99.5 %, at 0.9 99.9 % (simulated).
BANDS = (
    [[SIDE * i + j for j in range(SIDE)] for i in range(SIDE)]
    + [[SIDE * i + j for i in range(SIDE)] for j in range(SIDE)]
    + [[SIDE * i + (d - i) % SIDE for i in range(SIDE)] for d in range(SIDE)]
)


def lane_mask(lane: int) -> int:
    """A fixed 64-bit mask for a lane, signed; the top bits differ between lanes, the rest is mixed."""
    mixed = (lane * 0x9E3779B97F4A7C15 + 0xD1B54A32D192ED03) ** 3 % 2**60
    mask = (lane << 60) | mixed
    return mask - 2**64 if mask >= 2**63 else mask


def shingles(code_points: str) -> str:
    """SQL for the hashes of the character shingles of a text given as UTF-32 bytes; a short text is one shingle."""
    width = 4 * SHINGLE
    last = f"4 * greatest(length({code_points}) div 4 - {SHINGLE}, 0) + 1"
    return f"transform(sequence(1, {last}, 4), i -> xxhash64(substring({code_points}, i, {width})))"


#: SQL for the shingles of the text in column ``{line}``, repeats included; the text is coded once.
SHINGLES = f"element_at(transform(array(encode({{line}}, 'UTF-32')), c -> {shingles('c')}), 1)"
SHINGLE_SET = f"array_distinct({SHINGLES})"
#: SQL: whether two shingle counts allow a similarity.
SIZES_FIT = f"{OF} * least(a_size, b_size) >= {IN} * greatest(a_size, b_size)"
#: SQL: whether two sketches do. Where their parities differ, one line at least has a shingle that the other has not, and
#: similar lines have at most a ninth of both counts of those.
ODD_FIT = f"{OF + IN} * ({' + '.join(f'bit_count(a_b{n} ^ b_b{n})' for n in range(WORDS))}) <= {OF - IN} * (a_size + b_size)"


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, body, pos, line) of every line that is not blank; ``body`` tells apart rows that share an id.

    Lines are compared in lower case, without blanks at the ends. Whole texts are hashed and put in lower case before they
    are cut: behind the cut Spark would do the first for every line and the second twice.
    """
    texts = docs.select("doc_id", F.xxhash64("text").alias("body"), F.lower("text").alias("low"))
    lines = texts.select("doc_id", "body", F.posexplode(F.split("low", "\n")).alias("pos", "raw")).where("trim(raw) <> ''")
    return lines.select("doc_id", "body", "pos", F.trim("raw").alias("line"))


def hashed(lines: DataFrame, *columns: str) -> DataFrame:
    """Two independent 64-bit hashes stand for a line."""
    return lines.select(*columns, F.xxhash64("line").alias("h"), F.xxhash64(F.lit(1), "line").alias("g"))


def signatures(lines: DataFrame) -> DataFrame:
    """(h, band keys) of each distinct line.

    Every ``STEP`` shingles are one row; their hashes meet each lane's mask, and the lane keeps the least. A row behind the
    last shingle repeats it, which changes no minimum. Map-side partial minima keep the shuffle to one row per distinct
    line and task. For any set of lines, each shingle is equally likely to be the least of a lane, so two lines agree in
    a lane with the probability of their Jaccard similarity.
    """
    coded = hashed(lines, F.expr("coalesce(encode(line, 'UTF-32'), X'')").alias("code"))
    last = f"greatest(length(code) div 4 - {SHINGLE}, 0)"
    steps = coded.select("h", "g", "code", F.explode(F.expr(f"sequence(0, {last}, {STEP})")).alias("i"))
    each = [F.expr(f"xxhash64(substring(code, 4 * least(i + {k}, {last}) + 1, {4 * SHINGLE}))").alias(f"s{k}") for k in range(STEP)]
    least = [F.least(*[F.expr(f"s{k} ^ ({lane_mask(n)}L)") for k in range(STEP)]) for n in range(LANES)]
    lanes = steps.select("h", "g", *each).groupBy("h", "g").agg(*[F.min(m).alias(f"m{n}") for n, m in enumerate(least)])
    keys = [F.xxhash64(F.lit(n), *[f"m{lane}" for lane in band]) for n, band in enumerate(BANDS)]
    return lanes.select("h", F.array(*keys).alias("keys"))


def sieved(rows: DataFrame, column: str, wanted: DataFrame, name: str) -> DataFrame:
    """Rows whose hash may be among the wanted ones: all that are, and few others while the wanted are not too many.

    The wanted hashes set bits in a table of 2^18 words, whose size is fixed, so it can be broadcast at any scale. What
    passes is still to be joined; with very many wanted hashes more rows pass, and the result stays the same.
    """
    return sieve(rows, column, wanted, name, "_")[0]


def sieve(rows: DataFrame, column: str, wanted: DataFrame, name: str, own: str) -> tuple[DataFrame, DataFrame]:
    """The rows that ``sieved`` returns, and all others; ``own`` begins names that no column of the rows has."""
    mixed = lambda c: F.xxhash64(F.lit(5), c)
    slot = lambda c: F.shiftrightunsigned(mixed(c), 64 - SIEVE_BITS).cast("int")
    bit = lambda c: F.expr(f"shiftleft(1L, CAST(xxhash64(5, {c}) & 63 AS INT))")
    at, bits = f"{own}slot", f"{own}bits"
    table = wanted.select(slot(column).alias(at), bit(column).alias("_bit")).groupBy(at).agg(F.bit_or("_bit").alias(bits))
    table = F.broadcast(written(table, name))
    met = rows.withColumn(at, slot(column)).join(table, at, "left")
    hit = F.col(bits).bitwiseAND(bit(column)) != 0
    return met.where(hit).drop(at, bits), met.where(~F.coalesce(hit, F.lit(False))).drop(at, bits)


def shared_bands(lines: DataFrame) -> DataFrame:
    """(key, h, n) of the band keys that ``n`` > 1 distinct lines have.

    Map-side partial counts keep a key that many lines share from meeting in one task; a key of two lines is known by its
    least and greatest line, and only members of larger ones are fetched by a join, which adaptive execution can split.
    """
    signed = written(signatures(lines), "lines-signatures")
    posted = signed.select("h", F.explode("keys").alias("key"))
    counts = posted.groupBy("key").agg(F.min("h").alias("x"), F.max("h").alias("y"), F.count("*").alias("n"))
    counts = written(counts.where("n > 1"), "lines-keys")
    pairs = counts.where("n = 2").select("key", F.explode(F.array("x", "y")).alias("h"), "n")
    large = counts.where("n > 2").select("key", "n")
    members = sieved(posted, "key", large, "lines-sieve").join(large, "key").select("key", "h", "n")
    return written(pairs.union(members).distinct(), "lines-bands")


def sketches(texts: DataFrame) -> DataFrame:
    """(h, size, b0, b1, ...): of each line, the number of its shingles and the parity of their number in 1024 places."""
    sets = texts.select("h", F.expr(SHINGLE_SET.format(line="line")).alias("set")).withColumn("size", F.size("set"))
    steps = sets.select("h", "set", "size", F.explode(F.expr(f"sequence(0, size - 1, {STEP})")).alias("i"))
    each = steps.select("h", "size", *[F.expr(f"get(set, i + {k})").alias(f"s{k}") for k in range(STEP)])
    place = [F.expr(f"(s{k} >> 6) & {WORDS - 1}").alias(f"w{k}") for k in range(STEP)]
    each = each.select("h", "size", *place, *[F.expr(f"shiftleft(1L, CAST(s{k} & 63 AS INT))").alias(f"v{k}") for k in range(STEP)])
    bit = lambda k, n: f"IF(w{k} = {n}, v{k}, 0L)"
    words = [F.bit_xor(F.expr(" ^ ".join(bit(k, n) for k in range(STEP)))).alias(f"b{n}") for n in range(WORDS)]
    return each.groupBy("h").agg(F.max("size").alias("size"), *words)


def similar(pairs: DataFrame, texts: DataFrame, sketched: DataFrame) -> DataFrame:
    """Edges (a, b) between the nodes of those pairs of hashes whose lines have a Jaccard similarity of 0.8 or more.

    The similarity is exact, over the sets of shingles. Lines that their shingle counts or sketches rule out are not compared.
    """
    known = lambda c: sketched.select(*[F.col(k).alias(f"{c}_{k}" if k != "h" else c) for k in sketched.columns])
    near = pairs.join(known("a"), "a").join(known("b"), "b").where(SIZES_FIT).where(ODD_FIT).select("a", "b", "a_size", "b_size")
    side = lambda c: texts.select(F.col("h").alias(c), F.col("node").alias(f"{c}_node"), F.col("line").alias(f"{c}_line"))
    both = near.join(side("a"), "a").join(side("b"), "b").where("a_node <> b_node")
    a, b = (SHINGLES.format(line=f"{c}_line") for c in "ab")
    both = both.where(f"{OF + IN} * size(array_intersect({a}, {b})) >= {IN} * (a_size + b_size)")
    return both.select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))


def leaders(members: DataFrame, turn: int) -> DataFrame:
    """(key, root, h): of each band, a few lines of each of its largest components, other ones each turn."""
    by = lambda *c: F.xxhash64(F.lit(turn), *c)
    some = F.array(*[F.min_by("h", by(F.lit(n), "h")) for n in range(LEADERS)])
    held = members.groupBy("key", "root").agg(F.count("*").alias("n"), some.alias("some"))
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("n"), by("root"), "root"))
    best = held.withColumn("place", place).where(F.col("place") <= LED)
    return best.select("key", "root", F.explode(F.array_distinct("some")).alias("h"))


def led_pairs(members: DataFrame, sketched: DataFrame, turn: int) -> DataFrame:
    """(a, b): the leaders of each band with those of its lines, of other components, that their sketches allow."""

    def side(rows: DataFrame, c: str) -> DataFrame:
        known = rows.select("key", "h", F.xxhash64("root").alias("root")).join(sketched, "h")
        return known.select("key", *[F.col(k).alias(f"{c}_{k}") for k in known.columns if k != "key"])

    met = side(leaders(members, turn), "a").join(side(members, "b"), "key").where("a_root <> b_root").where(SIZES_FIT).where(ODD_FIT)
    return met.select(F.least("a_h", "b_h").alias("a"), F.greatest("a_h", "b_h").alias("b")).distinct()


def member_shingles(members: DataFrame, texts: DataFrame) -> DataFrame:
    """(h, root, size, s): the shingles of each member's line.

    No set is empty. With a plain explode Spark would build the sets once more to filter out empty ones, and those of all
    texts where it can do so before the join.
    """
    lines = members.select("node", F.xxhash64("root").alias("root")).distinct().join(texts, "node")
    sets = lines.select("h", "root", F.expr(SHINGLE_SET.format(line="line")).alias("set"))
    return sets.select("h", "root", F.size("set").alias("size"), F.explode_outer("set").alias("s"))


def apart_pairs(members: DataFrame, texts: DataFrame, sketched: DataFrame) -> DataFrame:
    """(a, b): the pairs of lines of different components that can be similar at all.

    Two lines of similarity 0.8 share 8/9 of the shingles of the smaller and 4/5 of those of the larger. So, ordered from
    the rarest shingle on, the first ninth (and one more) of the smaller and the first fifth (and one more) of the larger
    meet, and behind the first place where they meet both must have what the two are to share. A line whose own wording
    makes up a ninth of it meets no larger line here.
    """
    each = written(member_shingles(members, texts), "lines-shingles")
    counts = each.groupBy("s").agg(F.count("*").alias("n"), F.min("root").alias("x"), F.max("root").alias("y"))
    at = (F.row_number().over(Window.partitionBy("h").orderBy("n", "s")) - 1).alias("at")
    ordered = each.join(counts, "s").select("h", "root", "size", "s", F.expr("x <> y").alias("apart"), at)
    front = ordered.where(f"at <= size - ceil({IN} * size / {OF})").where("apart").drop("apart")
    front = written(front, "lines-front").join(sketched.drop("size"), "h")
    side = lambda c: front.select("s", *[F.col(k).alias(f"{c}_{k}") for k in front.columns if k != "s"])
    smaller = side("a").where(f"a_at <= a_size - ceil({2 * IN} * a_size / {OF + IN})")
    met = smaller.join(side("b"), "s").where("(a_size < b_size or a_size = b_size and a_h < b_h) and a_root <> b_root")
    met = met.where(f"{OF + IN} * least(a_size - a_at, b_size - b_at) >= {IN} * (a_size + b_size)").where(SIZES_FIT).where(ODD_FIT)
    return met.select(F.least("a_h", "b_h").alias("a"), F.greatest("a_h", "b_h").alias("b")).distinct()


def joined(roots: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, root) after further edges: the components of the roots they link, and every node under its root's root."""
    known = roots.select("node", F.col("root").alias("_root"))
    ends = edges
    for c in "ab":
        ends = ends.join(known, F.col(c) == F.col("node"), "left").withColumn(c, F.coalesce("_root", c)).drop("node", "_root")
    moved = components(ends, "lines").select(F.col("node").alias("_root"), F.col("root").alias("_new"))
    old = roots.join(moved, F.col("root") == F.col("_root"), "left").select("node", F.coalesce("_new", "root").alias("root"))
    heads = moved.select(F.col("_root").alias("node"), F.col("_new").alias("root"))
    return written(old.union(heads).distinct(), "lines-roots")


def fuzzy_links(lines: DataFrame) -> DataFrame:
    """(node, root) of every line that is similar to another one, by exact components of the similarity graph.

    Candidates are lines that share a band. Bands of up to 16 lines are compared pair by pair. In a larger one a few
    lines of each of its largest components, other ones each round, are compared with those outside that component, for
    five rounds at most and while that joins lines; what then remains apart in it is compared across components, as far as
    its rarest shingles and sketches allow a similarity. So no link that could join two components is left out, while a
    band full of copies of one line costs a few comparisons a line.
    """
    bands = shared_bands(lines)
    wanted = bands.select("h").distinct()
    found = sieved(hashed(lines, "line"), "h", wanted, "lines-sieve").join(wanted, "h").dropDuplicates(["h", "g"])
    node = F.concat(F.lpad(F.hex("h"), 16, "0"), F.lpad(F.hex("g"), 16, "0"))
    texts = written(found.select("h", node.alias("node"), "line"), "lines-texts")
    few = bands.where(F.col("n") <= FEW)
    pairs = few.select("key", F.col("h").alias("a")).join(few.select("key", F.col("h").alias("b")), "key").where("a < b")
    pairs = pairs.select("a", "b")
    many = written(bands.where(F.col("n") > FEW).join(texts.select("h", "node"), "h").select("key", "h", "node"), "lines-many")
    sketched = written(sketches(texts), "lines-sketches")
    stars = STAR_ROUNDS
    if stars:
        pairs = pairs.union(led_pairs(many.withColumn("root", F.col("node")), sketched, 0))
    roots = components(written(similar(pairs.distinct(), texts, sketched), "lines-edges"), "lines")
    for turn in range(min(1, stars), STAR_ROUNDS + 1):
        members = many.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        apart = members.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("key")
        members = written(members.join(apart, "key"), "lines-apart")
        size = members.count()
        if not size:
            break
        if turn < stars:
            met = led_pairs(members, sketched, turn)
        else:
            met = apart_pairs(members, texts, sketched)
        edges = written(similar(met, texts, sketched), "lines-edges")
        found = edges.count()
        if found:
            roots = joined(roots, edges)
        if turn >= stars:
            break
        if found < WORTH * size:
            stars = turn + 1
    return roots


def duplicate_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, body, pos list) of the lines to drop: all but the first of each component, by id and place.

    Null ids come last. Equal rows have equal lines at equal places and share the decision.
    """
    lines = lines_of(docs)
    seen = written(hashed(lines, "doc_id", "body", "pos"), "lines-seen")
    roots = fuzzy_links(lines).select(
        F.conv(F.substring("node", 1, 16), 16, -10).cast("long").alias("h"),
        F.conv(F.substring("node", 17, 16), 16, -10).cast("long").alias("g"),
        F.conv(F.substring("root", 1, 16), 16, -10).cast("long").alias("rh"),
        F.conv(F.substring("root", 17, 16), 16, -10).cast("long").alias("rg"),
    )
    placed = seen.join(roots, ["h", "g"], "left").select(
        "doc_id", "body", "pos", F.coalesce("rh", "h").alias("rh"), F.coalesce("rg", "g").alias("rg")
    )
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "body", "pos")
    kept = placed.groupBy("rh", "rg").agg(F.min(place).alias("kept"), F.count("*").alias("n")).where("n > 1")
    dropped = placed.join(kept, ["rh", "rg"]).where(place != F.col("kept"))
    return dropped.groupBy("doc_id", "body").agg(F.collect_set("pos").alias("places"))


def dedup_lines(docs: DataFrame, length_col: str | None = "n_chars") -> DataFrame:
    """The rows of ``docs`` with their text short of every line that repeats an earlier one, exactly or nearly.

    Lines are compared in lower case without outer blanks, over all documents; two are similar if their sets of
    8-character shingles (the whole line, if shorter) have a Jaccard similarity of 0.8 or more, and one line stays of
    each component of similar lines: the one with the smallest ``doc_id``, then place. Blank lines always stay. No row
    goes: a text that loses all its lines becomes empty. Null and empty texts stay as they are; a null id counts as the
    largest; repeated rows stay and lose the same lines; an empty table stays empty. All columns are kept; if one is
    named ``length_col`` it gets the new length where the text changed.
    """
    own = "_" * (1 + max(len(c) for c in docs.columns))
    id_, body, places, new = (own + c for c in ("id", "body", "places", "new"))
    drops = duplicate_lines(docs).select(
        F.col("doc_id").alias(id_), F.col("body").alias(f"{body}2"), F.col("places").alias(places)
    )
    drops = written(drops, "lines-drops")
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(body) == F.col(f"{body}2"))
    wanted = drops.select(F.col(f"{body}2").alias(body))
    cut, whole = sieve(docs.withColumn(body, F.xxhash64("text")), body, wanted, "lines-sieve", own)
    joined = cut.join(drops.hint("shuffle_hash"), same, "left")
    left = F.expr(f"array_join(filter(split(text, '\n'), (x, i) -> NOT array_contains({places}, i)), '\n')")
    out = joined.withColumn(new, F.when(F.col(places).isNull(), F.col("text")).otherwise(left))
    shown = []
    for c in docs.columns:
        if c == "text":
            shown.append(F.col(new).alias(c))
        elif c == length_col:
            kind = docs.schema[c].dataType
            shown.append(F.when(F.col(places).isNull(), F.col(f"`{c}`")).otherwise(F.length(new).cast(kind)).alias(c))
        else:
            shown.append(F.col(f"`{c}`"))
    return out.select(*shown).union(whole.select(*[F.col(f"`{c}`") for c in docs.columns]))
