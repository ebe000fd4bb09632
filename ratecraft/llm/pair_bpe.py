"""Byte-pair encoding by a pair occurrence index, and decoding (operator 6).

A task cuts its texts into pre-tokens and encodes the distinct ones it has not met before together:
their bytes lie one after the other in one list of symbols with links to the neighbours, an index
maps every mergeable pair to all its positions, and a heap yields the active pairs in ascending
rank. A pair's merge is applied at all its positions, left to right; each application takes the
neighbouring pairs out (they are found stale when their turn comes) and enters the new ones. A
pre-token's merges do not depend on other pre-tokens, so this equals merging each by itself.

Encoded pre-tokens stay in a table per task that is emptied beyond ``CACHE_WORDS``; memory is
bounded by that, the longest text and the Arrow batch. Vocabulary files are read from the path
given, on the driver, and travel to the tasks once per application.

Defined cases: a null or empty text has no ids and decodes to the empty text; the special string
of the vocabulary is one id wherever it stands, as in the tokenizers library's default. Repeated rows
are encoded each. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHE_WORDS = 300_000
CHUNK_BYTES = 4 << 20  # text taken into one index

# Fixed value: the pre-token pattern of this family of byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ASCII_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it is visible
    Latin-1, else the next free character from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


def load_vocabulary(path: str) -> dict:
    """What encoding and decoding need of a tokenizers file: plain data, to be shipped to tasks."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab, symbols = spec["model"]["vocab"], byte_symbols()
    byte_of = {c: b for b, c in enumerate(symbols)}
    pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    pieces = {i: bytes(byte_of[c] for c in t) for t, i in vocab.items()} | {i: t.encode() for t, i in special.items()}
    return {"bytes": [vocab[c] for c in symbols],
            "merges": [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs],
            "special": special, "pieces": [pieces.get(i, b"") for i in range(max(pieces) + 1)]}


class PairIndex:
    """Encodes pre-tokens, many at a time, with one pair index."""

    def __init__(self, vocabulary: dict):
        self.byte_ids = vocabulary["bytes"]
        self.merges = {(a << 20) | b: (rank, new) for rank, (a, b, new) in enumerate(vocabulary["merges"])}

    def encode(self, words: list[bytes]) -> list[list[int]]:
        symbol: list[int] = []
        starts = []
        for word in words:  # -1 parts the words
            starts.append(len(symbol))
            symbol.extend(map(self.byte_ids.__getitem__, word))
            symbol.append(-1)
        after = list(range(1, len(symbol) + 1))
        before = list(range(-1, len(symbol) - 1))
        merges, index, heap = self.merges, {}, []

        def enter(pair: int, at: int) -> None:
            if pair in index:
                index[pair].append(at)
            elif pair in merges:
                index[pair] = [at]
                heapq.heappush(heap, (merges[pair][0], pair))

        for at in range(len(symbol) - 1):
            if symbol[at] >= 0 <= symbol[at + 1]:
                enter((symbol[at] << 20) | symbol[at + 1], at)
        while heap:
            pair = heapq.heappop(heap)[1]
            new, left, right = merges[pair][1], pair >> 20, pair & 0xFFFFF
            for at in sorted(index.pop(pair)):
                if symbol[at] != left:
                    continue
                gone = after[at]
                if symbol[gone] != right:
                    continue
                nxt, prev = after[gone], before[at]
                symbol[at], symbol[gone] = new, -2
                after[at] = nxt
                before[nxt] = at  # a word's end marker always follows
                if symbol[nxt] >= 0:
                    enter((new << 20) | symbol[nxt], at)
                if prev >= 0 and symbol[prev] >= 0:
                    enter((symbol[prev] << 20) | new, prev)
        out = []
        for at in starts:
            ids = []
            while symbol[at] >= 0:
                ids.append(symbol[at])
                at = after[at]
            out.append(ids)
        return out


def _cutter(special: Iterable[str]) -> Callable[[str], list]:
    """text -> pre-tokens in order; the special strings stay whole."""
    import re

    import regex
    ascii_words, words = re.compile(ASCII_PATTERN, re.ASCII).findall, regex.compile(PATTERN).findall
    find = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
    plain = re.compile(r"[\x1c-\x1f]").search  # white space to Python, not to the pattern

    def of(text: str) -> list[str]:
        return ascii_words(text) if text.isascii() and not plain(text) else words(text)

    def cut(text: str) -> list[str]:
        if find is None or not find.search(text):
            return of(text)
        out: list[str] = []
        for k, part in enumerate(find.split(text)):
            out += [part] if k % 2 else of(part)
        return out

    return cut


def encode_batches(batches: Iterable[pa.RecordBatch], vocabulary: dict) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) -> (doc_id, ids): ids as little-endian 32-bit bytes per document."""
    index, cut, special = PairIndex(vocabulary), _cutter(vocabulary["special"]), vocabulary["special"]
    fixed = {s: np.array([i], "<u4").tobytes() for s, i in special.items()}
    known: dict[str, bytes] = dict(fixed)
    for batch in batches:
        texts, begun = batch.column(1), 0
        while begun < len(texts):
            cuts, size, end = [], 0, begun
            while end < len(texts) and (size < CHUNK_BYTES or end == begun):
                text = texts[end].as_py() or ""
                cuts.append(cut(text))
                size, end = size + len(text), end + 1
            new = list({w for words in cuts for w in words if w not in known})
            for word, ids in zip(new, index.encode([w.encode() for w in new])):
                known[word] = np.array(ids, "<u4").tobytes()
            ids = [b"".join(map(known.__getitem__, words)) for words in cuts]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(begun, end - begun), pa.array(ids, pa.binary())],
                                             names=["doc_id", "ids"])
            begun = end
            if len(known) > CACHE_WORDS:
                known = dict(fixed)


def decode_batches(batches: Iterable[pa.RecordBatch], vocabulary: dict) -> Iterator[pa.RecordBatch]:
    """(doc_id, ids) -> (doc_id, ids, text): bytes of the ids; what is not UTF-8 is replaced."""
    piece = vocabulary["pieces"].__getitem__
    for batch in batches:
        texts = [b"".join(map(piece, np.frombuffer(ids.as_py(), "<u4").tolist())).decode("utf-8", "replace")
                 for ids in batch.column(1)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])


def _as_lists(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        flat = [np.frombuffer(x.as_py(), "<i4") for x in batch.column(1)]
        ends = np.cumsum([0, *map(len, flat)]).astype(np.int32)
        values = pa.array(np.concatenate(flat) if flat else np.zeros(0, np.int32), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.ListArray.from_arrays(pa.array(ends), values), *batch.columns[2:]], names=batch.schema.names)


def _as_bytes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = [np.array(x.as_py() or [], "<u4").tobytes() for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])


def _slim(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def _shipped(docs: DataFrame, vocabulary_path: str):
    return docs.sparkSession.sparkContext.broadcast(load_vocabulary(vocabulary_path))


def encode(docs: DataFrame, vocabulary_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (array of int)."""
    v = _shipped(docs, vocabulary_path)
    return _slim(docs, doc_id, text).mapInArrow(
        lambda it: _as_lists(encode_batches(it, v.value)), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, vocabulary_path: str) -> DataFrame:
    """doc_id, ids, text of an ``encode`` result (null ids: the empty text)."""
    v = _shipped(encoded, vocabulary_path)
    return encoded.select("doc_id", "ids").mapInArrow(
        lambda it: _as_lists(decode_batches(_as_bytes(it), v.value)), "doc_id long, ids array<int>, text string")


def _digest_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()),
             pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
             pa.array([hashlib.sha256(x.encode()).hexdigest() for x in texts], pa.string())],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def round_trip_digests(docs: DataFrame, vocabulary_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encoded, decoded and digested in one pass, so
    ids and texts need not travel between Python and the JVM in between."""
    v = _shipped(docs, vocabulary_path)
    return _slim(docs, doc_id, text).mapInArrow(
        lambda it: _digest_batches(decode_batches(encode_batches(it, v.value), v.value)),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
