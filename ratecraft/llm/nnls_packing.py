"""Packing token sequences by non-negative least squares over length combinations (operator 12).

Documents become token ids (an end id closes each) and the ids are packed into windows of ``window``
tokens. No shuffle takes part: a task tokenises its documents and packs them in shards of about
``SHARD_TOKENS`` tokens, so memory is bounded and the plan stays one narrow stage at any input size.
In a shard:

1. What fills whole windows of a document is cut off; the rests (shorter than a window) give a
   histogram over lengths.
2. ``combinations`` enumerates the shallow combinations of lengths at hand that fill a window exactly:
   all of two lengths with at most ``DEPTH`` parts, all of three different lengths, of which those that can be repeated most
   are kept (a number proportional to the lengths at hand).
3. ``solve`` finds repeat counts x >= 0 with the least squared difference between A x and the
   histogram (accelerated projected gradient steps with a diagonal majoriser).
4. Counts are rounded and, most repeated first, cut to what the histogram still holds.
5. Residuals are packed greedily: the longest rest that fits, until none fits; then the shortest left
   is cut to fill the window, its remainder going back to the stock.
6. What is left at a shard's end (less than a window) is cut into lengths that are powers of two,
   which need no padding. So no sequence has padding.

A sequence id is the task's partition number above a counter, so a task run again after a lost
executor gives the same ids.

Defined cases: null and empty texts are the end id alone; the special string of the vocabulary is
one id wherever it stands; repeated rows and rows without an id are packed each; very long texts are tokenised in parts cut
before a single space between ASCII letters, where every pre-token ends. An empty table gives no pieces.
Only the columns named are read, so other columns cannot clash.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecraft.llm.pair_bpe import PATTERN, load_vocabulary

SHARD_TOKENS = 8_000_000  # packed together; one longer document is taken whole
PART_CHARS = 1 << 18      # text given to the encoder at once
DEPTH = 4                 # parts of a combination of two lengths
KEPT_PER_LENGTH = 4       # combinations of three lengths kept for each length at hand
STEPS = 300

PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def text_parts(text: str, size: int = PART_CHARS) -> Iterator[str]:
    """The text in parts of about ``size`` characters, cut only before a space between two ASCII
    letters: byte-level vocabularies end a pre-token there, so ids are those of the whole."""
    cut, at = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])"), 0
    while len(text) - at > size:
        found = cut.search(text, at + size)
        if not found:
            break
        yield text[at:found.start()]
        at = found.start()
    yield text[at:]


def combinations(histogram: np.ndarray, window: int, depth: int = DEPTH, kept: int = KEPT_PER_LENGTH) -> np.ndarray:
    """Rows of at most ``max(depth, 3)`` lengths (0: none) that add up to the window, all of them
    lengths with a positive count in ``histogram``."""
    have = histogram > 0
    lengths = np.flatnonzero(have)
    lengths = lengths[(lengths > 0) & (lengths < window)]
    wide, rows = max(depth, 3), []
    for i in range(1, depth + 1):  # i of one length, j of a longer or equal one
        for j in range(0, depth + 1 - i):
            a = lengths[lengths * i < window] if j else lengths[lengths * i == window]
            b = (window - a * i) // j if j else np.zeros_like(a)
            ok = (a * i + b * j == window) & (have[b] | (j == 0)) & ((b > a) | (j == 0))
            out = np.zeros((int(ok.sum()), wide), np.int64)
            out[:, :i], out[:, i:i + j] = a[ok, None], b[ok, None]
            rows.append(out)
    threes, worth = [], []
    for a in lengths[lengths * 3 < window]:
        b = lengths[(lengths > a) & (2 * lengths < window - a)]
        c = window - a - b
        ok = have[c]
        if ok.any():
            out = np.zeros((int(ok.sum()), wide), np.int64)
            out[:, 0], out[:, 1], out[:, 2] = a, b[ok], c[ok]
            threes.append(out)
            worth.append(np.minimum(np.minimum(histogram[a], histogram[b[ok]]), histogram[c[ok]]))
    if threes:
        threes, worth = np.concatenate(threes), np.concatenate(worth)
        rows.append(threes[np.argsort(-worth, kind="stable")[:kept * len(lengths)]])
    return np.concatenate(rows) if rows else np.zeros((0, wide), np.int64)


def solve(columns: np.ndarray, histogram: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """x >= 0 of least ||A x - histogram||, column j of A counting the lengths in ``columns[j]``."""
    if not len(columns):
        return np.zeros(0)
    goal, parts, flat = histogram.astype(float), (columns > 0).astype(float), columns.ravel()
    goal[0] = 0

    def times(x: np.ndarray) -> np.ndarray:
        return np.bincount(flat, (x[:, None] * parts).ravel(), len(goal))

    def transposed(r: np.ndarray) -> np.ndarray:
        return (r[columns] * parts).sum(1)

    major = transposed(times(np.ones(len(columns))))  # A'A <= diag(A'A 1), A being non-negative
    x = y = np.zeros(len(columns))
    pace = 1.0
    for _ in range(steps):
        new = np.maximum(y - transposed(times(y) - goal) / major, 0)
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        y, moved = new + (pace - 1) / faster * (new - x), np.abs(new - x).max()
        x, pace = new, faster
        if moved < 1e-3:
            break
    return x


class Stock:
    """Rests by length; takes the longest that fits in constant time with a bit set of lengths."""

    def __init__(self, window: int):
        self.piles: list[list] = [[] for _ in range(window + 1)]
        self.bits = 0

    def put(self, length: int, rest: tuple) -> None:
        self.piles[length].append(rest)
        self.bits |= 1 << length

    def take(self, length: int) -> tuple:
        rest = self.piles[length].pop()
        if not self.piles[length]:
            self.bits &= ~(1 << length)
        return rest

    def longest(self, limit: int) -> int:
        return (self.bits & ((1 << (limit + 1)) - 1)).bit_length() - 1

    def shortest(self) -> int:
        return (self.bits & -self.bits).bit_length() - 1


def pack_lengths(sizes: list[int], window: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length) that hold every token of documents of these sizes."""
    sequences, stock, counts = [], Stock(window), np.zeros(window + 1, np.int64)
    for doc, size in enumerate(sizes):
        whole = size - size % window
        sequences += [[(doc, start, window)] for start in range(0, whole, window)]
        if size > whole:
            stock.put(size - whole, (doc, whole))
            counts[size - whole] += 1
    columns = combinations(counts, window)
    repeats = np.rint(solve(columns, counts)).astype(int)
    for j in np.argsort(-repeats, kind="stable"):
        if repeats[j] < 1:
            break
        lengths, need = np.unique(columns[j][columns[j] > 0], return_counts=True)
        for _ in range(min(repeats[j], *(counts[lengths] // need))):
            sequences.append([(*stock.take(n), n) for n in columns[j].tolist() if n])
            counts[lengths] -= need
    last: list[tuple[int, int, int]] = []
    while stock.bits:
        left, last = window, []
        while left and stock.bits:
            length = stock.longest(left)
            if length > 0:
                last.append((*stock.take(length), length))
                left -= length
            else:
                length = stock.shortest()
                doc, start = stock.take(length)
                last.append((doc, start, left))
                stock.put(length - left, (doc, start + left))
                left = 0
        if not left:
            sequences.append(last)
            last = []
    # less than a window: cut into lengths that are powers of two
    total = sum(length for *_, length in last)
    for power in (1 << b for b in range(total.bit_length() - 1, -1, -1) if total >> b & 1):
        part, left = [], power
        while left:
            doc, start, length = last.pop(0)
            used = min(length, left)
            part.append((doc, start, used))
            left -= used
            if used < length:
                last.insert(0, (doc, start + used, length - used))
        sequences.append(part)
    return sequences


class Coder:
    """text -> ids of a byte-level vocabulary, as the tokenizers library gives them by default.

    ``vocabulary`` is pair_bpe's plain data. Where its ids grow with the merge order, which makes the id of
    a merged token its rank, and it cuts texts as this family does, tiktoken's encoder finds the same ids several times faster; texts that its
    pattern matcher gives up on (very long runs of white space) and other vocabularies go to the
    tokenizers library, made from the file's text ``spec`` when first needed.
    """

    def __init__(self, vocabulary: dict, spec: str):
        import tiktoken
        self.spec, self.library, self.quick = spec, None, None
        merged, special, rules = [new for *_, new in vocabulary["merges"]], vocabulary["special"], json.loads(spec)
        cutter = rules.get("pre_tokenizer") or {}
        same_cuts = cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True) and not cutter.get("add_prefix_space")
        if same_cuts and not rules.get("normalizer") and all(a < b for a, b in zip(merged, merged[1:])):
            ranks = {piece: i for i, piece in enumerate(vocabulary["pieces"]) if i not in special.values()}
            self.quick = tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def __call__(self, text: str) -> np.ndarray:
        if self.quick is not None:
            try:
                return self.quick.encode_to_numpy(text, allowed_special="all")
            except ValueError:  # the matcher's stack is full
                pass
        if self.library is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
            from tokenizers import Tokenizer
            self.library = Tokenizer.from_str(self.spec)
            self.library.no_truncation()
            self.library.no_padding()
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")


def _pack_task(batches: Iterable[pa.RecordBatch], vocabulary: dict, spec: str, window: int, end_id: int,
               shard_tokens: int) -> Iterator[pa.RecordBatch]:
    code = Coder(vocabulary, spec)
    next_id = TaskContext.get().partitionId() << 33
    docs: list = []
    ids: list[np.ndarray] = []

    def packed() -> Iterator[pa.RecordBatch]:
        nonlocal next_id
        rows, held = [], 0
        for sequence in pack_lengths([len(x) for x in ids], window):
            offset = 0
            for doc, start, length in sequence:
                rows.append((docs[doc], start, length, len(ids[doc]), next_id, offset, ids[doc][start:start + length].tobytes()))
                offset += length
                held += length
            next_id += 1
            if held > 1 << 20:
                yield batch_of(rows)
                rows, held = [], 0
        if rows:
            yield batch_of(rows)

    def batch_of(rows: list) -> pa.RecordBatch:
        *numbers, pieces = zip(*rows)
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in numbers), pa.array(pieces, pa.binary())],
                                          names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    end, held = np.array([end_id], "<u4"), 0
    for batch in batches:
        names = batch.column(0).to_pylist()
        for name, text in zip(names, batch.column(1)):
            coded = np.concatenate([*map(code, text_parts(text.as_py() or "")), end]).astype("<u4")
            docs.append(name)
            ids.append(coded)
            held += len(coded)
            if held >= shard_tokens:
                yield from packed()
                docs.clear()
                ids.clear()
                held = 0
    yield from packed()


def pack(docs: DataFrame, vocabulary_path: str, window: int = 2048, end_id: int = 1, doc_id: str = "doc_id",
         text: str = "text", shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row per piece: doc_id, start (the document's ids before it), length, doc_tokens (with the end
    id), sequence_id, offset in the sequence, ids (little-endian unsigned 32-bit)."""
    with open(vocabulary_path, encoding="utf-8") as f:
        shipped = docs.sparkSession.sparkContext.broadcast((load_vocabulary(vocabulary_path), f.read()))
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")) \
        .mapInArrow(lambda it: _pack_task(it, *shipped.value, window, end_id, shard_tokens), PIECES)
