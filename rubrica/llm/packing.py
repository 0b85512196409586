"""Token sequences of one length: descending documents go to the sequence of least cost that still has room."""

import heapq
import json
import os
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CAPACITY = 1024
#: Sequences packed at a time.
BLOCK = 512
ROWS_OUT = 2048
#: Width of the model whose cost is estimated: a token costs 1 for its matrices, and len / (6 * width) for attention.
WIDTH = 4096

# Fixed value: the pattern that cuts texts of byte-level vocabularies before their merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: ASCII; Latin with accents and marks, Greek, Cyrillic; dashes and quotes; kana, Han, Hangul.
STABLE = re.compile("[ -~\n\t\r¡-\u03ff\u0400-\u04ff\u2010-\u2027\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3]*")

PIECES = pa.schema([
    ("id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
])

#: A piece before it is placed: token ids, row number of its document in the block, start in the document.
Piece = tuple[np.ndarray, int, int]


def cost(length: int | np.ndarray, width: int = WIDTH):
    """Estimated cost of a piece that attends to itself only: linear in its tokens plus quadratic for the attention."""
    return length + length * length / (6 * width)


def powers(total: int) -> list[int]:
    """The powers of two that sum up to ``total``, largest first."""
    return [1 << b for b in range(total.bit_length() - 1, -1, -1) if total >> b & 1]


def assign(lengths: list[int], rooms: list[int], width: int = WIDTH) -> tuple[list[tuple[int, int, int, int]], list[tuple[int, int, int]]]:
    """Place pieces into sequences of ``rooms`` tokens: (piece, from, length, sequence), and (piece, from, length) left over.

    Longest first, each to the sequence of least cost among those with room for the whole piece. A piece that fits none is
    cut: the largest room left takes its head, and the rest takes its turn by its own length. As long as tokens are left,
    every sequence ends up full.
    """
    free, spent = np.array(rooms, np.int64), np.zeros(len(rooms))
    queue = [(-n, i, 0) for i, n in enumerate(lengths)]
    heapq.heapify(queue)
    placed, left = [], []
    while queue:
        size, piece, at = heapq.heappop(queue)
        size = -size
        fits = free >= size
        if fits.any():
            to, taken = int(np.argmin(np.where(fits, spent, np.inf))), size
        else:
            to = int(np.argmax(free)) if len(free) else -1
            taken = int(free[to]) if to >= 0 else 0
            if not taken:
                left.append((piece, at, size))
                continue
            heapq.heappush(queue, (taken - size, piece, at + taken))
        placed.append((piece, at, taken, to))
        free[to] -= taken
        spent[to] += cost(taken, width)
    return placed, left


def byte_merger(settings: dict):
    """tiktoken on the vocabulary of a tokenizer file; None where it may not agree with the file's own rule.

    It must be a byte-level BPE with the usual pattern, one token a merge and ids that rise with the order of the merges.
    tiktoken joins the pair whose token has the lowest id, the file's rule the pair of the first merge. Up to the rank of a
    token the parts inside its place are joined as they are in the token alone, so both take the same pair.
    """
    import tiktoken

    model, rule = settings["model"], settings["pre_tokenizer"] or {}
    usual = rule.get("type") == "ByteLevel" and not rule.get("add_prefix_space") and rule.get("use_regex", True)
    vocab, merges = model.get("vocab", {}), [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", [])]
    special = {t["content"] for t in settings["added_tokens"]}
    made = [vocab.get(a + b, -1) for a, b in merges]
    rising = bool(made) and made[0] >= 0 and all(a < b for a, b in zip(made, made[1:]))
    other = settings["normalizer"] or model.get("dropout") or model.get("ignore_merges")
    if other or not (usual and rising) or len(made) + 256 != len(set(vocab) - special):
        return None
    # the printable characters that a byte-level vocabulary writes for the 256 bytes, by rule
    direct = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in direct} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in direct)}
    ranks = {bytes(byte[c] for c in token): n for token, n in vocab.items() if token not in special}
    return tiktoken.Encoding("of the file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class TextEncoder:
    """Token ids of whole texts: those of the tokenizer file, by the faster of two ways that agree.

    A text of characters whose classes are the same in every version of the Unicode tables, and that spells no special
    token, is encoded by :func:`byte_merger`; any other by the file's own library.
    """

    def __init__(self, tokenizer_path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        settings = json.loads(self.tokenizer.to_str())
        self.special = [t["content"] for t in settings["added_tokens"]]
        self.merger = byte_merger(settings)

    def own(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def __call__(self, text: str) -> np.ndarray:
        if not self.merger or not STABLE.fullmatch(text) or any(s in text for s in self.special):
            return self.own(text)
        return self.merger.encode_to_numpy(text).astype("<u4")


class Packer:
    """Packs the documents of one partition, a block of sequences at a time; keeps at most a block and one document."""

    def __init__(self, partition: int, capacity: int, block: int):
        self.capacity, self.block = capacity, block
        self.next_id = partition << 40
        self.docs: list[tuple] = []
        self.tails: list[Piece] = []
        self.held = 0
        self.out: list[tuple] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        """Whole sequences are cut off at once; the tail waits for its block."""
        whole = len(ids) // self.capacity * self.capacity
        for start in range(0, whole, self.capacity):
            self.emit(doc_id, start, ids[start : start + self.capacity], len(ids), self.next_id, 0)
            self.next_id += 1
        if whole < len(ids):
            self.docs.append((doc_id, len(ids)))
            self.tails.append((ids[whole:].copy(), len(self.docs) - 1, whole))
            self.held += len(ids) - whole
        if self.held >= self.block * self.capacity:
            self.pack([self.capacity] * (self.held // self.capacity))

    def finish(self) -> None:
        """The last block; what does not fill a whole sequence goes to sequences of powers of two, which need no padding."""
        self.pack([self.capacity] * (self.held // self.capacity) + powers(self.held % self.capacity))

    def emit(self, doc_id: int | None, start: int, ids: np.ndarray, size: int, sequence: int, offset: int) -> None:
        self.out.append((doc_id, start, len(ids), ids.tobytes(), size, sequence, offset))

    def pack(self, rooms: list[int]) -> None:
        placed, left = assign([len(t[0]) for t in self.tails], rooms)
        filled = [0] * len(rooms)
        for piece, at, taken, to in placed:
            ids, doc, start = self.tails[piece]
            doc_id, size = self.docs[doc]
            self.emit(doc_id, start + at, ids[at : at + taken], size, self.next_id + to, filled[to])
            filled[to] += taken
        self.next_id += len(rooms)
        rest = [(self.tails[p], at, size) for p, at, size in left]
        self.docs, docs = [], self.docs
        self.tails = []
        for (ids, doc, start), at, size in rest:
            self.docs.append(docs[doc])
            self.tails.append((ids[at : at + size], len(self.docs) - 1, start + at))
        self.held = sum(size for *_, size in left)

    def batches(self, least: int) -> Iterator[pa.RecordBatch]:
        while len(self.out) > least:
            rows, self.out = self.out[:ROWS_OUT], self.out[ROWS_OUT:]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), PIECES, strict=True)], schema=PIECES)


def pack_documents(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0, block: int = BLOCK,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per piece: (doc_id, start, length, ids, doc_tokens, sequence_id, offset); ids are little-endian unsigned 32-bit.

    A document is the ids of its whole text, without special tokens, and ``end_id``. Full sequences are cut from its front;
    tails are packed in blocks of about ``block`` sequences inside each partition of the scan, longest first, each to the
    sequence of least estimated cost that still has room. A block makes as many sequences as it can fill and hands the rest
    on, so only the last block of a partition has sequences shorter than ``capacity``, and these have lengths of powers of
    two: nothing is padded. Nothing is shuffled, so no source, document or group of copies weighs on one task, and memory
    is a block of ids and one batch of texts.

    A null or empty text is the end id alone. A null id is carried along. Repeated rows are documents of their own. A very
    long text is encoded whole like any other (:class:`TextEncoder`). Equal lengths go in the order of the scan, equal costs
    to the lower sequence. ``sequence_id`` counts up from a number per partition: unique, not gapless. An empty table gives
    no rows. Other columns are not read.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task is the unit of parallel work
        encode, end = TextEncoder(tokenizer_path), np.uint32(end_id)
        packer = Packer(TaskContext.get().partitionId(), capacity, block)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                for doc_id, text in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                    packer.add(doc_id, np.append(encode(text or ""), end))
                    yield from packer.batches(ROWS_OUT)
        packer.finish()
        yield from packer.batches(0)

    found = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        of, "id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    )
    return found.withColumnRenamed("id", id_col)
