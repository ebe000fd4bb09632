"""Ranked lexical search: exact inner-product search in sparse ball trees (operator 11).

The k best documents of each query item. A term's weight in an item is w, a document's weight of the
term is x = (10^9 tf) div (1000 tf + 8 m), m = 100 - 90 + (90 n N) div L; the score is the integer sum of
w x over the item's distinct terms (terms: runs of letters, digits and non-ASCII characters, A-Z
lower-cased; N documents with a term, L all their terms, n one document's, df documents holding a term,
w = floor(1000 ln((2N + 2) / (2 df + 1)))).

Steps, for each block of items (at most ``BLOCK_BYTES`` of item text; blocks are dealt by a hash):

1. One pass over the whole texts keeps each document's n and its counts of the block's terms, written
   as Parquet; N, L and the df of the block's terms are grouped sums over that table.
2. Each task takes its documents in chunks of bounded size, scales x by sqrt(w) and builds a balanced
   ball tree: a node has a centroid and a radius that covers its documents. By the Cauchy-Schwarz
   inequality no document of a node scores above q.c + |q| r, q being cut to the terms that occur in the node. All rounding errors of c, r and that
   bound are covered (all quantities are non-negative, so errors are relative and bounded by the
   number of terms). Nodes are visited best bound first and the search ends when the best bound left is
   below the k-th score found by this task so far; equal bounds are still visited, so ties are exact.
3. Leaves are scored with 64-bit integers from postings sorted by (leaf, term). A task emits at most k
   rows per item; a ranking with a group limit before its shuffle merges the tasks.

Defined cases: null and empty texts have no terms and are never returned; an item without a known term
or without a document scoring above 0 has no rows. Equal scores go by ascending doc_id, a null doc_id
after all others. Every document row counts as a document of its own, also when repeated; an item row
repeated with the same text is answered once, two texts under one item_id each. Empty tables give no
rows. Only the columns named are read, so other columns cannot clash.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratecraft.llm.common import materialise

BLOCK_BYTES = 1 << 20    # item text answered in one pass over the documents
CHUNK_DOCS = 16_384      # documents in one tree
CHUNK_COUNTS = 2_000_000  # (document, term) counts in one tree; one longer document is taken whole
LEAF_DOCS = 512

# Bytes of terms keep their value (A-Z lower-cased), all others become a space.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text in order, with repeats."""
    return text.translate(_TERM_BYTES).split() if text else []


def _count_terms(batches: Iterable[pa.RecordBatch], known: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text bytes) -> (doc_id, n, terms, counts): the known terms of each document."""
    for batch in batches:
        sizes, terms, counts, ends = [], [], [], [0]
        for text in batch.column(1).to_pylist():
            words = terms_of(text)
            found = Counter(filter(known.__contains__, words))
            terms.extend(map(known.__getitem__, found))
            counts.extend(found.values())
            ends.append(len(terms))
            sizes.append(len(words))
        ends = pa.array(ends, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())),
             pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64()))], names=["doc_id", "n", "terms", "counts"])


def _holding(batches: Iterable[pa.RecordBatch], n_terms: int) -> Iterator[pa.RecordBatch]:
    """A task's partial document frequencies: (term, df)."""
    total = np.zeros(n_terms, np.int64)
    for batch in batches:
        total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=n_terms)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["term", "df"])


class Best:
    """The k best (score, doc_id) met so far."""

    def __init__(self, k: int):
        self.k, self.rows, self.least = k, [], 1

    def add(self, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        take = np.flatnonzero(scores >= self.least)
        if len(take) > self.k:
            take = take[np.lexsort((ids[take], no_id[take], -scores[take]))[:self.k]]
        if len(take):
            new = zip((-scores[take]).tolist(), no_id[take].tolist(), ids[take].tolist())
            self.rows = sorted([*self.rows, *new])[:self.k]
            if len(self.rows) == self.k:
                self.least = max(-self.rows[-1][0], 1)


class BallTree:
    """A balanced ball tree over sparse rows (CSR: ``ends``, ``terms``, integer ``x``); ``w`` is
    the integer weight of each term. Node i has the children 2i + 1 and 2i + 2."""

    def __init__(self, ends: np.ndarray, terms: np.ndarray, x: np.ndarray, w: np.ndarray, leaf_docs: int = LEAF_DOCS):
        docs, self.n_terms = len(ends) - 1, len(w)
        row = np.repeat(np.arange(docs), np.diff(ends))
        value = x * np.sqrt(w)[terms]
        self.slack = (self.n_terms + 64) * 2.0 ** -51  # relative error of any sum of products here
        square = np.bincount(row, value * value, docs)
        self.depth = max(0, math.ceil(math.log2(max(docs, 1) / leaf_docs)))
        label, centres, radii = np.zeros(docs, np.int64), [], []

        def dot(dense: np.ndarray) -> np.ndarray:
            return np.bincount(row, value * dense[label[row], terms], docs)

        def farthest(distance: np.ndarray, nodes: int) -> np.ndarray:
            """One document per node at the greatest distance."""
            order = np.lexsort((distance, label))
            return order[np.searchsorted(label[order], np.arange(nodes), "right") - 1]

        def dense(chosen: np.ndarray) -> np.ndarray:
            out = np.zeros((len(chosen), self.n_terms))
            for k, d in enumerate(chosen):
                out[k, terms[ends[d]:ends[d + 1]]] = value[ends[d]:ends[d + 1]]
            return out

        for level in range(self.depth + 1):
            nodes = 1 << level
            size = np.bincount(label, minlength=nodes)
            centre = np.bincount(label[row] * self.n_terms + terms, value, nodes * self.n_terms).reshape(nodes, -1) \
                / np.maximum(size, 1)[:, None]
            across, own = dot(centre), (centre * centre).sum(1)[label]
            apart = np.maximum(square - 2 * across + own, 0) + self.slack * (square + 2 * across + own)
            radius = np.zeros(nodes)
            np.maximum.at(radius, label, apart)
            centres.append(centre)
            radii.append(np.sqrt(radius) * (1 + self.slack))
            if level < self.depth:
                far = dense(farthest(apart, nodes))
                other = dense(farthest(square - 2 * dot(far) + (far * far).sum(1)[label], nodes))
                order = np.lexsort((dot(far - other), label))
                first = np.searchsorted(label[order], np.arange(nodes))
                place = np.arange(docs) - first[label[order]]
                label[order] = 2 * label[order] + (place >= (size[label[order]] + 1) // 2)
        self.centres = np.concatenate(centres).T.copy()  # by term, then node
        self.radii = np.concatenate(radii)
        leaves = 1 << self.depth
        self.docs = np.argsort(label, kind="stable")
        self.first = np.searchsorted(label[self.docs], np.arange(leaves + 1))
        place = np.empty(docs, np.int64)
        place[self.docs] = np.arange(docs)
        key = label[row] * self.n_terms + terms
        order = np.argsort(key, kind="stable")
        self.keys, self.x = key[order], x[order]
        self.place = (place[row] - self.first[label[row]])[order]
        self.scored = 0  # leaves scored, for measurements

    def bounds(self, terms: np.ndarray, w: np.ndarray) -> np.ndarray:
        """For every node a number that no document's score in it exceeds."""
        centres = self.centres[terms]
        # terms that no document of a node holds (their centre is 0) add nothing to any score there
        norm = np.sqrt(w @ (centres > 0))
        return (np.sqrt(w) @ centres + norm * self.radii) * (1 + 4 * self.slack)

    def search(self, terms: np.ndarray, w: np.ndarray, best: Best, ids: np.ndarray, no_id: np.ndarray) -> None:
        if not len(terms):
            return
        bound = self.bounds(terms, w).tolist()
        inner, todo = (1 << self.depth) - 1, [(-bound[0], 0)]
        while todo:
            upper, node = heapq.heappop(todo)
            if -upper < best.least:
                return
            if node < inner:
                for child in (2 * node + 1, 2 * node + 2):
                    if bound[child] >= best.least:
                        heapq.heappush(todo, (-bound[child], child))
                continue
            self.scored += 1
            leaf = node - inner
            docs = self.docs[self.first[leaf]:self.first[leaf + 1]]
            score = np.zeros(len(docs), np.int64)
            key = leaf * self.n_terms + terms
            for a, b, weight in zip(np.searchsorted(self.keys, key), np.searchsorted(self.keys, key, "right"), w):
                if b > a:
                    score[self.place[a:b]] += weight * self.x[a:b]
            best.add(score, ids[docs], no_id[docs])


def _search_task(batches: Iterable[pa.RecordBatch], block: dict, k: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, n, terms, counts) -> a task's best (q, doc_id, score) for every item of the block."""
    w, n_docs, n_all = block["w"], block["N"], block["L"]
    best = [Best(k) for _ in block["items"]]
    queries = [(t[w[t] > 0], w[t[w[t] > 0]]) for t in block["items"]]

    def search(parts: list[pa.RecordBatch]) -> None:
        ids = np.concatenate([p.column(0).fill_null(0).to_numpy() for p in parts])
        no_id = np.concatenate([p.column(0).is_null().to_numpy(zero_copy_only=False) for p in parts])
        n = np.concatenate([p.column(1).to_numpy() for p in parts])
        ends = np.cumsum(np.concatenate([[0], *[p.column(2).value_lengths().to_numpy() for p in parts]]))
        terms = np.concatenate([p.column(2).flatten().to_numpy() for p in parts]).astype(np.int64)
        tf = np.concatenate([p.column(3).flatten().to_numpy() for p in parts])
        m = 100 - 90 + 90 * n * n_docs // n_all
        x = 1_000_000_000 * tf // (1000 * tf + 8 * np.repeat(m, np.diff(ends)))
        tree = BallTree(ends, terms, x, w)
        for (t, weight), found in zip(queries, best):
            tree.search(t, weight, found, ids, no_id)

    parts, docs, counts = [], 0, 0
    for batch in batches:
        at = 0
        while at < len(batch):
            sizes = np.cumsum(batch.column(2).slice(at).value_lengths().to_numpy())
            take = min(int(np.searchsorted(sizes, CHUNK_COUNTS - counts, "right")), CHUNK_DOCS - docs, len(sizes))
            if not take and not docs:
                take = 1
            if take:
                parts.append(batch.slice(at, take))
                docs, counts, at = docs + take, counts + int(sizes[take - 1]), at + take
            if at < len(batch):
                search(parts)
                parts, docs, counts = [], 0, 0
    if parts:
        search(parts)
    rows = [(q, None if no_id else doc, -score) for q, b in enumerate(best) for score, no_id, doc in b.rows]
    q, doc, score = zip(*rows) if rows else ((), (), ())
    yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(doc, pa.int64()), pa.array(score, pa.int64())],
                                     names=["q", "doc_id", "score"])


def _search_block(docs: DataFrame, items: list, k: int) -> DataFrame:
    """(q, rank, doc_id, score) for the items (id, text bytes), q being an item's place."""
    spark = docs.sparkSession
    terms = [sorted(set(terms_of(text))) for _, text in items]
    known = {t: i for i, t in enumerate(sorted(set().union(*terms)))}
    shipped = spark.sparkContext.broadcast(known)  # at most one block's terms
    vectors = materialise(docs.mapInArrow(lambda it: _count_terms(it, shipped.value),
                                          "doc_id long, n long, terms array<int>, counts array<long>").where("n > 0"), "vectors")
    n_docs, n_all = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    n_terms = len(known)
    held = dict(vectors.select("terms").mapInArrow(lambda it: _holding(it, n_terms), "term int, df long")
                .groupBy("term").agg(F.sum("df")).collect())  # one row per term of the block
    w = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1))) if t in held else 0 for t in range(n_terms)]
    block = spark.sparkContext.broadcast({
        "items": [np.array([known[t] for t in ts if known[t] in held], np.int64) for ts in terms],
        "w": np.array(w, np.int64), "N": n_docs, "L": n_all})
    found = vectors.mapInArrow(lambda it: _search_task(it, block.value, k), "q int, doc_id long, score long")
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of every item."""
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text"))
    items = items.select(F.col(item_id).alias("item_id"), F.col(item_text).cast("string").alias("text")) \
        .where(F.length("text") > 0).distinct()
    count, size = items.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    blocks = max(1, min(count, math.ceil((size or 0) / block_bytes)))
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    out = []
    for b in range(blocks):
        rows = dealt.where(F.col("block") == b).select("item_id", F.col("text").cast("binary")).collect()
        if not rows:
            continue
        names = spark.createDataFrame([(q, r[0]) for q, r in enumerate(rows)],
                                      f"q int, item_id {items.schema['item_id'].dataType.simpleString()}")
        out.append(_search_block(docs, rows, k).join(names, "q").select("item_id", "rank", "doc_id", "score"))
    if not out:
        return items.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
    return reduce(DataFrame.unionByName, out)
