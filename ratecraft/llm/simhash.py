"""SimHash near-duplicates by multi-index hashing (operator 7).

``fingerprints`` hashes every w-word shingle of a whole text (repeats count) with XXH64 and keeps,
per bit, the majority. ``near_links`` finds all pairs of different fingerprints at most 4 bits
apart: the 64 bits are three segments of 22, 22 and 20 bits; if neither of the first two differs
in at most one bit, these two hold all four differences and the third is equal. So it is enough
to probe, with each fingerprint, the segment tables at all keys within one bit of its first and of
its second segment and at its own third segment, and to verify the whole distance of what they
hold. ``near_duplicate_groups`` joins the links up to groups.

Equal fingerprints are one entry throughout, so exact copies, however many, cost one entry, and
every fingerprint makes a fixed number of probe rows. Links are kept between different
fingerprints only.

Defined cases: a null or word-free text has fingerprint zero and links like any other; a text of
fewer words than a shingle is one shingle. Rows are never merged: repeated rows each get a row in
the result. Documents without an id take part; if a group has no id at all its component is null.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratecraft.llm.common import materialise, smallest_reachable, spare_names

SEGMENTS = ((0, 22, 1), (22, 22, 1), (44, 20, 0))  # first bit, bits, radius of the ball
MAX_BITS = 4
FLUSH = 1 << 17  # shingles hashed between two additions to the bit counts


def _count_bits(hashes: list[int], ends: list[int], counts: np.ndarray) -> None:
    """Adds the bits of hashes[ends[i-1]:ends[i]] to counts[i]."""
    if not hashes:
        return
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    starts = np.array([0, *ends[:-1]])
    full = np.flatnonzero(np.diff([*starts, len(hashes)]) > 0)
    counts[full] += np.add.reduceat(bits, starts[full], axis=0, dtype=np.int64)


def _fingerprint_batches(batches: Iterable[pa.RecordBatch], width: int, seed: int) -> Iterator[pa.RecordBatch]:
    import xxhash
    digest = xxhash.xxh64_intdigest
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        counts, totals = np.zeros((len(texts), 64), np.int64), np.zeros(len(texts), np.int64)
        hashes: list[int] = []
        ends: list[int] = []
        begun = 0  # first document whose hashes are in `hashes`
        for i, text in enumerate(texts):
            words = (text.as_py() or b"").lower().split()
            if len(words) >= width:
                shingles = map(b" ".join, zip(*(words[k:] for k in range(width))))
                hashes.extend(map(digest, shingles, repeat(seed)))
                totals[i] = len(words) - width + 1
            elif words:
                hashes.append(digest(b" ".join(words), seed))
                totals[i] = 1
            ends.append(len(hashes))
            if len(hashes) >= FLUSH:
                _count_bits(hashes, ends, counts[begun:i + 1])
                hashes, ends, begun = [], [], i + 1
        _count_bits(hashes, ends, counts[begun:])
        majority = (2 * counts > totals[:, None]).astype(np.uint8)
        prints = np.packbits(majority, axis=1, bitorder="little").view("<i8").ravel()
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.int64())], names=["doc_id", "bits"])


def fingerprints(docs: DataFrame, width: int = 4, seed: int = 42, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, bits: the 64-bit fingerprint as a long, one row per row of ``docs``."""
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return slim.mapInArrow(lambda it: _fingerprint_batches(it, width, seed), "doc_id long, bits long")


def hex16(bits: Column) -> Column:
    return F.lpad(F.lower(F.hex(bits)), 16, "0")


def _segment(bits: Column, first: int, size: int) -> Column:
    return F.shiftrightunsigned(bits, first).bitwiseAND(F.lit((1 << size) - 1))


def near_links(prints: DataFrame) -> DataFrame:
    """(a, b), a < b: all pairs of the different fingerprints ``prints.bits`` at most 4 bits apart."""
    table, probes = [], []
    for no, (first, size, radius) in enumerate(SEGMENTS):
        key = _segment(F.col("bits"), first, size)
        tag = F.lit(no << 32)
        table.append(key.bitwiseOR(tag))
        probes.append(key.bitwiseOR(tag))
        probes += [key.bitwiseXOR(F.lit(1 << i)).bitwiseOR(tag) for i in range(size)] if radius else []
    held = prints.select(F.col("bits").alias("b"), F.explode(F.array(*table)).alias("key"))
    asked = prints.select(F.col("bits").alias("a"), F.explode(F.array(*probes)).alias("key"))
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS)
    return asked.join(held, "key").where(near).select("a", "b").distinct()


def near_duplicate_groups(docs: DataFrame, width: int = 4, seed: int = 42,
                          doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, bits, component_id (smallest doc_id that links reach),
    n_links (different fingerprints its own links to)."""
    marked = materialise(fingerprints(docs, width, seed, doc_id, text), "fingerprints")
    prints = materialise(marked.groupBy("bits").agg(F.min("doc_id").alias("least")), "prints")
    links = materialise(near_links(prints), "links")
    roots = smallest_reachable(links)
    degree = links.select(F.col("a").alias("bits")).union(links.select("b")).groupBy("bits").agg(F.count(F.lit(1)).alias("n_links"))
    grouped = prints.join(roots.withColumnRenamed("node", "bits"), "bits", "left") \
        .select("bits", "least", F.coalesce("root", "bits").alias("root"))
    least = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    # only fingerprints in a group of several need the lookup
    linked = roots.select(F.col("node").alias("bits"), "root").join(least, "root").join(degree, "bits", "left")
    groups = prints.join(linked, "bits", "left").select(
        "bits", F.coalesce("component_id", "least").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return marked.join(groups, "bits").select("doc_id", "bits", "component_id", "n_links")


def keep_one_per_group(docs: DataFrame, groups: DataFrame, doc_id: str = "doc_id", text: str = "text",
                       width: int = 4, seed: int = 42) -> DataFrame:
    """The rows of ``docs`` whose id stands for its group (one row of each id); rows of a group
    without any id are kept. ``width`` and ``seed`` are those of ``groups``."""
    chosen = groups.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias(doc_id)).distinct()
    named = docs.join(chosen, doc_id, "left_semi")
    repeated = groups.where(F.col("doc_id") == F.col("component_id")).groupBy("doc_id").count().where("count > 1")
    if not repeated.isEmpty():
        named = named.dropDuplicates([doc_id])
    nameless = docs.where(F.col(doc_id).isNull())
    if not nameless.isEmpty():  # a text tells these rows' groups
        text_hash = F.xxhash64(F.col(text).cast("string"))
        [spare] = spare_names(docs, "led_hash")
        prints = fingerprints(nameless.select(text_hash.alias(spare), F.col(text)), width, seed, spare, text)
        led = groups.where(F.col("doc_id").isNull() & F.col("component_id").isNotNull()).select("bits").distinct()
        gone = prints.join(led, "bits", "left_semi").select(F.col("doc_id").alias(spare)).distinct()
        nameless = nameless.join(gone, text_hash == F.col(spare), "left_anti")
    return named.unionByName(nameless)
