"""Pairwise-complete correlations as mergeable co-moment blocks.

For left columns A and right columns B a block holds six |A| x |B| matrices: for the rows where both are
known the count, both means, both sums of squared deviations and the sum of their products. A task takes them from
matrix products over its Arrow batches; blocks of batches and tasks merge by the pairwise update of means
and deviations, which does not cancel. Wide tables need no expression per pair: the plan is the same for 3
and for 200 columns.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratecraft.operators.blocks import arrow_schema, blocks_batch, merge_tree

HELD_BYTES = 64 << 20  # blocks a task holds before it emits them


def block_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """[6, |A|, |B|] of the rows of ``a`` [n, |A|] and ``b`` [n, |B|]; NaN is missing."""
    def centred(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        known = np.isfinite(x)
        first = x[known.argmax(0), np.arange(x.shape[1])]
        shift = np.where(np.isfinite(first), first, 0.0)  # a constant column becomes exactly 0
        x0 = np.where(known, x - shift, 0.0)
        mean = x0.sum(0) / np.maximum(known.sum(0), 1)
        return known.astype(float), np.where(known, x0 - mean, 0.0), shift + mean

    ka, xa, sa = centred(a)
    kb, xb, sb = centred(b)
    n = ka.T @ kb
    some = np.maximum(n, 1)
    ma, mb = xa.T @ kb / some, ka.T @ xb / some
    return np.stack([n, sa[:, None] + ma, sb[None, :] + mb, np.maximum((xa * xa).T @ kb - ma * ma * n, 0),
                     np.maximum(ka.T @ (xb * xb) - mb * mb * n, 0), xa.T @ xb - ma * mb * n])


def merged(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """The block of the rows of both, each [6 * |A| * |B|] or [6, |A|, |B|]."""
    x, y = one.reshape(6, -1), two.reshape(6, -1)
    n = x[0] + y[0]
    share = np.divide(y[0], n, out=np.zeros_like(n), where=n > 0)
    da, db = np.where((x[0] > 0) & (y[0] > 0), y[1:3] - x[1:3], 0.0)
    mean = np.where(x[0] > 0, x[1:3] + np.stack([da, db]) * share, y[1:3])
    apart = x[0] * share
    return np.stack([n, *mean, x[3] + y[3] + da * da * apart, x[4] + y[4] + db * db * apart,
                     x[5] + y[5] + da * db * apart]).reshape(one.shape)


def correlations(df: DataFrame, left: Sequence[Column], right: Sequence[Column], group: Column | None = None) -> DataFrame:
    """(g, i, j, corr): Pearson correlation of ``left[i]`` with ``right[j]`` (doubles, NULL or NaN missing) over the
    rows where both are known, per value of ``group``. NULL where a side is constant there or no row has both."""
    ni, nj = len(left), len(right)
    g = F.lit(0) if group is None else group
    rows = df.select(g.alias("g"), F.array(*left).alias("a"), F.array(*right).alias("b"))
    kind = rows.schema["g"].dataType.simpleString()
    schema = arrow_schema(f"g {kind}, part int, block binary")
    most = max(1, HELD_BYTES // (48 * ni * nj))

    def reduce(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            n = len(batch)
            if not n:
                continue
            values = [c.flatten().fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(n, -1) for c in batch.columns[1:]]
            codes = batch.column(0).dictionary_encode()
            names, places = codes.dictionary.to_pylist(), codes.indices.to_numpy(zero_copy_only=False)
            order = np.argsort(places, kind="stable")
            for rows_of in np.split(order, np.flatnonzero(np.diff(places[order])) + 1):
                name = names[places[rows_of[0]]]
                one = block_of(values[0][rows_of], values[1][rows_of])
                held[name] = merged(held[name], one) if name in held else one
                if len(held) > most:
                    yield blocks_batch(list(held.items()), schema)
                    held = {}
        if held:
            yield blocks_batch(list(held.items()), schema)

    out = arrow_schema(f"g {kind}, i int, j int, corr double")

    def finish(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, block in zip(batch.column(0).to_pylist(), batch.column(1)):
                n, _, _, va, vb, c = np.frombuffer(block.as_py()).reshape(6, ni, nj)
                scale = np.sqrt(va) * np.sqrt(vb)
                known = (n > 0) & (scale > 0)
                corr = np.divide(c, scale, out=np.zeros_like(c), where=known).ravel()
                i, j = np.divmod(np.arange(ni * nj), nj)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(corr), out.field(0).type), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                     pa.array(corr, mask=~known.ravel())], schema=out)

    partials = rows.where(F.col("g").isNotNull()).mapInArrow(reduce, f"g {kind}, part int, block binary")
    if group is None:  # the block of no rows, so that an empty frame has its cells too
        none = df.sparkSession.createDataFrame([(0, 0, bytes(48 * ni * nj))], "g int, part int, block binary")
        partials = partials.unionByName(none)
    return merge_tree(partials, ["g"], merged).mapInArrow(finish, f"g {kind}, i int, j int, corr double")


__all__ = ["correlations", "block_of", "merged"]
