"""SentencePiece encoding by sampling: distinct segmentations by perturbed A-star search over the lattice, and decoding."""

import heapq
import math
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLANK = "▁"
#: Stands for a U+2581 of the text itself; UTF-8 texts hold no lone surrogate.
LITERAL = "\ud800"
UNIT = re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+")
GROUP_CHARS = 200_000
CACHE_NODES = 500_000
#: Places of a path whose leaving sets stand in the heap one by one; those further on are one set.
HEAD = 48
GOLD = np.uint64(0x9E3779B97F4A7C15)
SALT = np.uint64(0xD1B54A32D192ED03)


@dataclass
class Pieces:
    """The vocabulary as shipped to tasks.

    ``classes`` numbers the characters that occur in pieces (0: none). The pieces form a trie in an open-addressed table
    (``slots``: state * 2^16 + class, -1 if free; ``follow``: next state); ``ends`` holds the piece id of a state or -1. An
    edge for a character outside the vocabulary is its byte piece, or, if it has several bytes, carries ``size`` + its
    code point and is written out as bytes later.
    """

    size: int
    logs: np.ndarray
    byte_log: float
    bytes_from: int
    longest: int
    surface: list[bytes]
    classes: np.ndarray
    slots: np.ndarray
    follow: np.ndarray
    ends: np.ndarray


def slot_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys.astype(np.uint64) * GOLD) >> np.uint64(64 - bits)).astype(np.int64)


def make_trie(ids: dict[str, int], classes: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    steps: dict[int, int] = {}
    ends = [-1]
    for piece, piece_id in ids.items():
        state = 0
        for c in piece:
            key = state << 16 | classes[c]
            if key not in steps:
                steps[key] = len(ends)
                ends.append(-1)
            state = steps[key]
        ends[state] = piece_id
    bits = len(steps).bit_length() + 2
    slots, follow = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
    first = slot_of(np.fromiter(steps, np.int64, len(steps)), bits).tolist()
    for at, (key, state) in zip(first, steps.items(), strict=True):
        while slots[at] >= 0:
            at = (at + 1) & ((1 << bits) - 1)
        slots[at], follow[at] = key, state
    return slots, follow, np.array(ends, np.int32)


def load_pieces(model_path: str, zipf_shift: float = 10.0, sharpness: float = 1.0) -> Pieces:
    """Read a SentencePiece model with byte fallback.

    A BPE model stores the rank of a piece as its score, not a probability. Log probabilities are taken by Zipf's law:
    proportional to ``-sharpness * log(rank + zipf_shift)``; pieces outside the ranking get the last rank, and a byte is
    a hundred times less likely than that.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    size = model.get_piece_size()
    byte_ids = [i for i in range(size) if model.is_byte(i)]
    if len(byte_ids) != 256:
        raise ValueError(f"{model_path} has no byte fallback")
    ids: dict[str, int] = {}
    ranks, surface = np.full(size, float(size)), [b""] * size
    for i in range(size):
        if model.is_byte(i):
            surface[i] = bytes([i - byte_ids[0]])
        elif not (model.is_control(i) or model.is_unknown(i)):
            piece = model.id_to_piece(i)
            if BLANK in piece.lstrip(BLANK):
                raise ValueError(f"piece {i} crosses a word boundary")
            ids[piece] = i
            ranks[i] = min(-model.get_score(i), float(size))
            surface[i] = piece.replace(BLANK, " ").encode()
    logs = -sharpness * np.log(ranks + zipf_shift)
    scale = float(np.log(np.exp(logs[list(ids.values())]).sum()))
    byte_log = -sharpness * math.log(size + zipf_shift) - scale - math.log(100)
    logs[byte_ids] = byte_log + scale
    held = {c: n for n, c in enumerate(sorted({c for piece in ids for c in piece}), 1)}
    classes = np.zeros(0x110000, np.uint16)
    classes[[ord(c) for c in held]] = list(held.values())
    return Pieces(
        size, logs - scale, byte_log, byte_ids[0], max(map(len, ids)), surface, classes, *make_trie(ids, held)
    )


def units_of(raw: str) -> list[str]:
    """The text behind its dummy blank, cut into units: a run of blanks and what follows up to the next blank."""
    return UNIT.findall((" " + raw).replace(BLANK, LITERAL).replace(" ", BLANK)) if raw else []


def log_complement(log_p: np.ndarray) -> np.ndarray:
    """log(1 - p) from log p, minus infinity at p = 1."""
    with np.errstate(divide="ignore"):
        return np.log(-np.expm1(np.minimum(log_p, 0)))


def mixed(x: np.ndarray) -> np.ndarray:
    """The finishing steps of a 64-bit counter generator."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform(keys: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) by key: the same in any batch, task or retry."""
    return ((mixed(keys) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


class Lattices:
    """Edges of the lattices of all units met so far, by source node, with their conditional probabilities.

    No piece crosses from one unit (a run of blanks and the word behind it) to the next, so the lattice of a text is the
    chain of its units' lattices, and a unit's lattice with its backward sums is built once and shared. A node is a
    character of a unit; its edges lie together, from ``offset`` of the node to that of the next one, shortest piece
    first, and ``below`` is the probability of the edges before an edge.
    """

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.forget()

    def forget(self) -> None:
        self.first: dict[str, int] = {}
        self.nodes = self.edges = 0
        kinds = {"below": np.float64, "log": np.float64, **dict.fromkeys(("to", "piece", "node", "offset"), np.int32)}
        self.room = {k: np.zeros(1 << 16, kind) for k, kind in kinds.items()}
        self.arrays = {k: room[:0] for k, room in self.room.items()}

    def steps(self, states: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Trie states one character further, -1 where there is none."""
        p = self.pieces
        bits = len(p.slots).bit_length() - 1
        keys = states.astype(np.int64) << 16 | classes
        at = slot_of(keys, bits)
        held = p.slots[at]
        out = np.where(held == keys, p.follow[at], -1)
        open_ = np.flatnonzero((held != keys) & (held >= 0))
        while open_.size:
            at[open_] = (at[open_] + 1) & (len(p.slots) - 1)
            held = p.slots[at[open_]]
            hit = held == keys[open_]
            out[open_[hit]] = p.follow[at[open_[hit]]]
            open_ = open_[~hit & (held >= 0)]
        return out

    def found(self, codes: np.ndarray, left: np.ndarray) -> list[tuple[np.ndarray, int, np.ndarray]]:
        """(places, characters, piece ids) of the pieces from each place on, by their number of characters.

        ``left``: the characters up to the unit's end.
        """
        p = self.pieces
        classes = p.classes[codes]
        out = []
        where, states = np.arange(len(codes)), np.zeros(len(codes), np.int32)
        for width in range(1, p.longest + 1):
            if width > 1:
                inside = np.flatnonzero(left[where] >= width)
                where, states = where[inside], states[inside]
            states = self.steps(states, classes[where + (width - 1)])
            on = np.flatnonzero(states >= 0)
            where, states = where[on], states[on]
            ids = p.ends[states]
            ended = np.flatnonzero(ids >= 0)
            at, ids = where[ended], ids[ended]
            if width == 1:
                alone = np.ones(len(codes), bool)
                alone[at] = False
                alone = np.flatnonzero(alone)
                raw = codes[alone].astype(np.int32)
                at = np.concatenate([at, alone])
                ids = np.concatenate([ids, np.where(raw < 0x80, p.bytes_from, p.size).astype(np.int32) + raw])
            out.append((at, width, ids))
        return out

    def add(self, units: list[str]) -> None:
        """Build the lattices of new, distinct units, all in step.

        Nodes are numbered by what is left behind them, so that those of one step and their edges lie together.
        """
        p = self.pieces
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        codes = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), "<u4")
        firsts = np.cumsum(lengths) - lengths
        n = len(codes)
        left = np.repeat(firsts + lengths, lengths) - np.arange(n)
        by_left = np.argsort(left.astype(np.uint16) if n and left.max() < 1 << 16 else left, kind="stable")
        rank = np.full(n + 1, n)
        rank[by_left] = np.arange(n)
        found = self.found(codes, left)
        counts = np.zeros(n, np.int64)
        for at, _, _ in found:
            counts[at] += 1
        counts = counts[by_left]
        offsets = np.cumsum(counts) - counts
        total = int(counts.sum())
        target, piece = np.empty(total, np.int64), np.empty(total, np.int32)
        filled = offsets[rank[:-1]]
        for at, width, ids in found:
            edges = filled[at]
            target[edges] = np.where(left[at] == width, n, rank[at + width])
            piece[edges] = ids
            filled[at] = edges + 1
        known = piece < p.size
        weight = p.logs[np.where(known, piece, 0)]
        other = np.flatnonzero(~known)
        if other.size:
            code = piece[other] - p.size
            weight[other] = p.byte_log * (1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF))
        after = np.zeros(n + 1)
        log = np.empty(total)
        ends = np.cumsum(np.bincount(left)) if n else np.zeros(0, np.int64)
        begin, low = 0, 0
        for end in ends[1:].tolist():
            if end == begin:
                continue
            own = counts[begin:end]
            high = int(offsets[end]) if end < n else total
            heads = offsets[begin:end] - low
            values = weight[low:high] + after[target[low:high]]
            most = np.maximum.reduceat(values, heads)
            sums = np.add.reduceat(np.exp(values - np.repeat(most, own)), heads)
            after[begin:end] = sums = most + np.log(sums)
            np.minimum(values - np.repeat(sums, own), 0.0, out=log[low:high])
            begin, low = end, high
        log[offsets[counts == 1]] = 0.0
        below = np.zeros(total)
        share = np.exp(log)
        more = offsets[counts > 1]
        widths = counts[counts > 1]
        for turn in range(1, int(counts.max(initial=0))):
            if turn > 1:
                on = np.flatnonzero(widths > turn)
                more, widths = more[on], widths[on]
            here = more + turn
            below[here] = below[here - 1] + share[here - 1]
        to = np.where(target == n, -1, target + self.nodes)
        node = np.repeat(np.arange(self.nodes, self.nodes + n), counts)
        self.keep(self.edges, below=below, log=log, piece=piece, to=to, node=node)
        # The end of a node's edges is where the next one's begin, which the last node has too.
        self.keep(self.nodes, offset=np.append(offsets, total) + self.edges)
        self.first.update(zip(units, (rank[firsts] + self.nodes).tolist(), strict=True))
        self.edges += total
        self.nodes += n

    def keep(self, begin: int, **new: np.ndarray) -> None:
        """Put values behind those that are held."""
        for k, values in new.items():
            room, end = self.room[k], begin + len(values)
            if end > len(room):
                self.room[k] = grown = np.empty(max(end, 2 * len(room)), room.dtype)
                grown[:begin] = room[:begin]
                room = grown
            room[begin:end] = values
            self.arrays[k] = room[:end]

    def walk(self, starts: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact samples of the rest of many units at once: (edges, one unit after another; edges by unit)."""
        below, to, offset = (self.arrays[k] for k in ("below", "to", "offset"))
        at = starts
        active = np.arange(len(starts))
        counts = np.zeros(len(starts), np.int64)
        steps = []
        while active.size:
            keys = keys + GOLD
            drawn = uniform(keys)
            # From the longest piece, mostly the likeliest, down to the one whose share holds the number.
            edges = offset[at + 1].astype(np.int64) - 1
            over = np.flatnonzero(below[edges] > drawn)
            while over.size:
                lower = edges[over] - 1
                edges[over] = lower
                over = over[below[lower] > drawn[over]]
            steps.append((active, edges))
            counts[active] += 1
            following = to[edges].astype(np.int64)
            alive = np.flatnonzero(following >= 0)
            active, at, keys = active[alive], following[alive], keys[alive]
        offsets = np.cumsum(counts) - counts
        out = np.zeros(int(counts.sum()), np.int32)
        for n, (units, edges) in enumerate(steps):
            out[offsets[units] + n] = edges
        return out, counts

    def choose(self, node: int, refused: tuple[int, ...], key: np.uint64) -> int:
        """An edge of the node other than the refused ones, by conditional probability."""
        log = self.arrays["log"]
        low, high = self.arrays["offset"][node : node + 2].tolist()
        edges = np.array([e for e in range(low, high) if e not in refused])
        weights = np.cumsum(np.exp(log[edges] - log[edges].max()))
        return int(edges[np.searchsorted(weights, uniform(np.array([key]))[0] * weights[-1], side="right")])


def cut_gumbel(location: np.ndarray, limit: np.ndarray | float, keys: np.ndarray) -> np.ndarray:
    """Largest perturbed log probability of disjoint sets of segmentations with these log masses, given the limit that
    it cannot exceed: a Gumbel variable truncated at the limit."""
    return -np.logaddexp(-limit, np.log(-np.log(uniform(keys))) - location)


@dataclass
class Text:
    """Search state of one row: starts of its units, paths found, and a heap of sets of segmentations still open."""

    key: np.uint64
    starts: np.ndarray
    paths: list
    heap: list


class Sampler:
    """Gumbel top-k over many texts in step.

    Each open set of segmentations stands in a text's heap under the largest perturbed log probability inside it. The set
    on top is split: its best segmentation is drawn (an exact sample, whatever its value), and what leaves that path at
    each of its edges becomes a set of its own, whose value is a Gumbel variable cut at the value above. The values
    popped are the largest perturbed log probabilities of all segmentations in order, so no segmentation comes twice.
    """

    def __init__(self, pieces: Pieces, samples: int, seed: int):
        self.lattices, self.samples, self.seed = Lattices(pieces), samples, seed

    def row_key(self, key: object) -> np.uint64:
        return np.uint64(xxhash.xxh64_intdigest(repr(key).encode("utf-8", "surrogatepass"), self.seed))

    def keys_from(self, texts: list[Text], kind: int, turn: int, counts: np.ndarray, skips: np.ndarray | int = 0) -> np.ndarray:
        """For each text, the next ``counts`` of its keys for one use (``kind``) in one turn, behind the first ``skips``."""
        heads = np.fromiter((t.key for t in texts), np.uint64, len(texts)) ^ np.uint64(kind * 1_000_003 + turn)
        place = np.arange(int(counts.sum())) + np.repeat(skips - np.cumsum(counts) + counts, counts)
        return mixed(np.repeat(mixed(heads + SALT), counts) + place.astype(np.uint64) * SALT)

    def cut(self, texts: list[Text], kind: int, turn: int, location: np.ndarray, limit: np.ndarray | float) -> list[float]:
        """A Gumbel variable for each text, cut at its limit."""
        return cut_gumbel(location, limit, self.keys_from(texts, kind, turn, np.ones(len(texts), np.int64))).tolist()

    def run(self, rows: list[tuple[object, str]]) -> list[list[tuple[np.ndarray, float, float, float]]]:
        """Samples (piece ids, log probability, perturbed log probability, log inclusion probability) of each text."""
        if self.lattices.nodes > CACHE_NODES:
            self.lattices.forget()
        cut = [units_of(raw) for _, raw in rows]
        first = self.lattices.first
        if new := [u for u in dict.fromkeys(chain.from_iterable(cut)) if u not in first]:
            self.lattices.add(new)
        texts = [
            Text(self.row_key(key), np.fromiter(map(first.__getitem__, units), np.int64, len(units)), [], [])
            for (key, _), units in zip(rows, cut, strict=True)
        ]
        if not texts:
            return []
        log, node, to, piece = (self.lattices.arrays[k] for k in ("log", "node", "to", "piece"))
        empty = np.zeros(0, np.int64)
        for text, root in zip(texts, self.cut(texts, 1, 0, np.zeros(len(texts)), np.inf), strict=True):
            # value, tie-break, path it leaves, edge of that path at which it leaves, edges refused there, log mass before
            text.heap.append((-root, 0, empty, empty, 0, (), 0.0))
        for turn in range(self.samples):
            work, starts, begins = [], [], []
            for text in texts:
                if not text.heap or text.heap[0][0] == np.inf:
                    continue
                value, _, path, bounds, at, refused, mass = heapq.heappop(text.heap)
                if refused is None:
                    at, mass = self.open_tail(text, turn, -value, path, bounds, at, mass)
                    refused = (int(path[at]),)
                head, unit, held = path[:at], 0, empty
                if refused:
                    source = int(node[path[at]])
                    edge = self.lattices.choose(source, refused, self.keys_from([text], 2, turn, np.ones(1, np.int64))[0])
                    head = np.append(head, edge)
                    unit = int(np.searchsorted(bounds, at, side="right"))
                    held = bounds[:unit]
                    refused = (*refused, edge)
                rest = text.starts[unit:]
                if refused:
                    rest = rest[1:] if to[edge] < 0 else np.concatenate([[to[edge]], rest[1:]])
                    held = np.append(held, len(head)) if to[edge] < 0 else held
                work.append((text, -value, head, held, at, refused, mass, len(rest)))
                starts.append(rest)
                begins.append(unit)
            if not work:
                break
            lengths = np.array([w[-1] for w in work])
            keys = self.keys_from([w[0] for w in work], 3, turn, lengths, np.array(begins))
            edges, counts = self.lattices.walk(np.concatenate(starts), keys)
            units_at = np.concatenate([[0], np.cumsum(lengths)])
            places = np.cumsum(counts)
            edges_at = np.concatenate([[0], places])[units_at].tolist()
            units_at = units_at.tolist()
            paths, fresh, places_of, tails, again = [], [], [], [], []
            for n, (text, value, head, held, at, refused, mass, _) in enumerate(work):
                path = edges[edges_at[n] : edges_at[n + 1]]
                ends = places[units_at[n] : units_at[n + 1]] - (edges_at[n] - len(head))
                if len(head):
                    path, ends = np.concatenate([head, path]), np.concatenate([held, ends])
                steps = log[path]
                text.paths.append((path, float(steps.sum()), value))
                # Sets that leave the new path behind its own part of the tree, and the set left at the node of the cut.
                begin = at + bool(refused)
                near = steps[at : begin + HEAD]
                before = np.concatenate([[0.0], near]).cumsum()
                before += mass
                paths.append((text, path, ends))
                places_of.append(begin)
                fresh.append((steps[begin : begin + HEAD], before[begin - at : -1]))
                if begin + HEAD < len(path):
                    tails.append((n, begin + HEAD, float(before[-1]), steps[begin + HEAD :].sum()))
                if refused:
                    gone = math.fsum(math.exp(log[e]) for e in refused)
                    if gone < 1 - 1e-12:
                        again.append((n, at, refused, mass, math.log1p(-gone)))
            limits = np.array([w[1] for w in work])
            self.push(paths, turn, limits, np.array(places_of), fresh)
            if tails:
                far = np.array([t[2] for t in tails]) + log_complement(np.array([t[3] for t in tails]))
                far = self.cut([work[t[0]][0] for t in tails], 6, turn, far, limits[[t[0] for t in tails]])
                for (n, begin, mass, _), value in zip(tails, far, strict=True):
                    text, path, bounds = paths[n]
                    text.heap.append((-value, turn * 4 + 3, path, bounds, begin, None, mass))
            if again:
                left = np.array([mass + rest for _, _, _, mass, rest in again])
                left = self.cut([work[a[0]][0] for a in again], 5, turn, left, limits[[a[0] for a in again]])
                for (n, at, refused, mass, _), value in zip(again, left, strict=True):
                    text, path, bounds = paths[n]
                    text.heap.append((-value, turn * 4 + 2, path, bounds, at, refused, mass))
            for text, _, _ in paths:
                text.heap = [HeapEntry(e) for e in text.heap]
                heapq.heapify(text.heap)
        return self.finish(texts, piece)

    def push(
        self, paths: list[tuple[Text, np.ndarray, np.ndarray]], turn: int, limits: np.ndarray, begins: np.ndarray,
        sets: list[tuple[np.ndarray, np.ndarray]],
    ) -> None:
        """Put the sets that leave each path at its begin and the places after it into the heap of its text, the best few.

        ``sets``: of each path, the steps at those places and the log mass before them.
        """
        lengths = np.array([len(steps) for steps, _ in sets])
        steps, before = (np.concatenate([s[k] for s in sets]) for k in (0, 1))
        keys = self.keys_from([text for text, _, _ in paths], 4, turn, lengths, begins)
        values = cut_gumbel(before + log_complement(steps), np.repeat(limits, lengths), keys)
        keep = self.samples - turn
        end = 0
        for (text, path, bounds), begin, (steps, before) in zip(paths, begins.tolist(), sets, strict=True):
            own = values[end : end + len(steps)]
            end += len(steps)
            best = np.argpartition(-own, keep)[:keep] if len(own) > keep else np.arange(len(own))
            for i in best.tolist():
                at = begin + i
                text.heap.append((-float(own[i]), turn * 4 + 1, path, bounds, at, (int(path[at]),), float(before[i])))

    def open_tail(
        self, text: Text, turn: int, value: float, path: np.ndarray, bounds: np.ndarray, at: int, mass: float
    ) -> tuple[int, float]:
        """Split the set that leaves a path at ``at`` or later: the place that holds its value, and the mass before it.

        The place is drawn by mass; the sets of the other places are cut at the value.
        """
        steps = self.lattices.arrays["log"][path[at:]]
        before = mass + np.concatenate([[0.0], np.cumsum(steps)[:-1]])
        masses = before + log_complement(steps)
        weights = np.cumsum(np.exp(masses - masses.max()))
        chosen = int(np.searchsorted(weights, uniform(self.keys_from([text], 7, turn, np.ones(1, np.int64)))[0] * weights[-1], side="right"))
        sets = [(steps[:chosen], before[:chosen]), (steps[chosen + 1 :], before[chosen + 1 :])]
        self.push([(text, path, bounds)] * 2, turn, np.full(2, value), np.array([at, at + chosen + 1]), sets)
        return at + chosen, float(before[chosen])

    def finish(self, texts: list[Text], piece: np.ndarray) -> list[list[tuple[np.ndarray, float, float, float]]]:
        """Inclusion: the chance that a segmentation's perturbed value beats the best one left out."""
        lefts = [-text.heap[0][0] if text.heap else -np.inf for text in texts]
        margins = np.array([log_p - left for text, left in zip(texts, lefts, strict=True) for _, log_p, _ in text.paths])
        above = iter(np.minimum(np.where(margins < -30, margins, log_complement(-np.exp(np.minimum(margins, 700.0)))), 0.0).tolist())
        return [[(self.spelled(piece[path]), log_p, value, next(above)) for path, log_p, value in text.paths] for text in texts]

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        """Piece ids with the edges of unknown characters written out as byte pieces."""
        p = self.lattices.pieces
        unknown = np.flatnonzero(ids >= p.size)
        if not unknown.size:
            return ids.astype(np.int32)
        parts, at = [], 0
        for i in unknown.tolist():
            c = chr(int(ids[i]) - p.size)
            raw = (BLANK if c == LITERAL else c).encode("utf-8", "surrogatepass")
            parts += [ids[at:i], np.frombuffer(raw, np.uint8).astype(np.int32) + p.bytes_from]
            at = i + 1
        return np.concatenate([*parts, ids[at:]]).astype(np.int32)


class HeapEntry(tuple):
    """Ordered by value, then by when it was made, then by place."""

    def __new__(cls, entry: tuple):
        return super().__new__(cls, entry)

    def __lt__(self, other: tuple) -> bool:
        return (self[0], self[1], self[4]) < (other[0], other[1], other[4])


SAMPLES = "array<struct<ids:array<int>,log_prob:double,perturbed:double,log_inclusion:double,round_trip:boolean>>"
SAMPLE_FIELDS = [
    pa.field("ids", pa.list_(pa.int32())), pa.field("log_prob", pa.float64()),
    pa.field("perturbed", pa.float64()), pa.field("log_inclusion", pa.float64()), pa.field("round_trip", pa.bool_()),
]


def surfaces_of(ids: list[np.ndarray], pieces: Pieces) -> list[str]:
    """The texts that lists of piece ids stand for."""
    spelled = pa.array(pieces.surface, pa.large_binary()).take(pa.array(np.concatenate([np.zeros(0, np.int32), *ids])))
    _, offsets, raw = spelled.buffers()
    at = np.frombuffer(offsets, np.int64)[np.cumsum([0, *map(len, ids)])].tolist()
    raw = memoryview(raw) if raw else b""
    texts = (bytes(raw[begin:end]) for begin, end in zip(at, at[1:], strict=False))
    return [str(t[1:] if t[:1] == b" " else t, "utf-8", "replace") for t in texts]


def as_array(results: list[list[tuple] | None]) -> pa.Array:
    flat = [s for r in results for s in r or ()]
    ids = [s[0] for s in flat]
    offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
    values = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32))
    columns = [pa.array(np.array([s[k] for s in flat], np.float64)) for k in (1, 2, 3)]
    columns.append(pa.array([s[4] for s in flat], pa.bool_()))
    rows = pa.StructArray.from_arrays([pa.ListArray.from_arrays(offsets, values), *columns], fields=SAMPLE_FIELDS)
    counts = np.concatenate([[0], np.cumsum([len(r or ()) for r in results])]).astype(np.int32)
    mask = pa.array([r is None for r in results])
    return pa.ListArray.from_arrays(pa.array(counts), rows, mask=mask)


def sampled(key: Column, text: Column, pieces: Pieces, samples: int = 2, seed: int = 1) -> Column:
    """The ``samples`` distinct segmentations of each whole text with the largest perturbed log probabilities, best first.

    All if the text has fewer; one empty segmentation for an empty text; null for a null text. Numbers come from the row
    key, the seed and the place alone, so a repeated row (key and text) gives the same samples on any cluster; rows with
    a null key share one.
    """

    def of(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        sampler = Sampler(pieces, samples, seed)
        for keys, texts in batches:
            at = 0
            while at < len(texts):
                rows: list[tuple] = []
                size = 0
                while at < len(texts) and size < GROUP_CHARS:
                    rows.append((keys[at].as_py(), texts[at].as_py()))
                    size += len(rows[-1][1] or "")
                    at += 1
                found = iter(sampler.run([r for r in rows if r[1] is not None]))
                results: list[list[tuple] | None] = [None if text is None else next(found) for _, text in rows]
                back = iter(surfaces_of([s[0] for own in results for s in own or ()], pieces))
                results = [own and [(*s, next(back) == text) for s in own] for own, (_, text) in zip(results, rows, strict=True)]
                yield as_array(results)

    of.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return F.arrow_udf(of, SAMPLES)(key, text)


def decoded(ids: Column, pieces: Pieces) -> Column:
    """The text of a list of piece ids; exactly the encoded text. Null for null."""

    def of(rows: pa.Array) -> pa.Array:
        ids = [r.values.to_numpy(zero_copy_only=False) for r in rows if r.is_valid]
        back = iter(surfaces_of(ids, pieces))
        return pa.array([next(back) if r.is_valid else None for r in rows], pa.string())

    of.__annotations__ = {"rows": pa.Array, "return": pa.Array}
    return F.arrow_udf(of, "string")(ids)


def encode_documents(docs: DataFrame, model_path: str, samples: int = 2, seed: int = 1) -> DataFrame:
    """(doc_id, rank, ids, log_prob, perturbed, log_inclusion, round_trip): one row per document and sample.

    Ranks count from 1; ``round_trip`` says whether the ids decode to the text again. A null text gives one row of nulls; an empty table gives no rows. Row-local: no shuffle. The
    vocabulary, fixed in size, travels with the task. Other columns are not read.
    """
    pieces = load_pieces(model_path)
    drawn = docs.select("doc_id", sampled(F.col("doc_id"), F.col("text"), pieces, samples, seed).alias("samples"))
    rows = drawn.select("doc_id", F.posexplode_outer("samples").alias("at", "s"))
    return rows.select("doc_id", (F.col("at") + 1).alias("rank"), "s.*")
