"""Weighted normal equations as mergeable blocks, for interval ensembles and leave-fold-out linear fits (M3, M7).

One pass over the rows keeps, per (group, replicate), the sums X'WX, X'Wy, y'Wy, y'W1 and 1'W1 of every
target as one block of doubles. A task emits one binary block per (group, replicate) it met. Blocks are
added up as a tree: first within a bounded number of merge tasks per key, then per key. X'X is computed
once for targets that miss the same rows (all of them, when no target has gaps). What is fitted from
the blocks is solved on executors, one key's block at a time; the driver receives coefficients or scores only.

* ``bootstrap_weights``: Poisson(1) weights by inversion of a 52-bit uniform from md5 of (keys, seed,
  replicate), so any engine can repeat them. The table ends where the distribution function is 1 in doubles.
  Rows come with their name only (keys and seed); ``pair_bits`` hashes a batch of names for all replicates at once.
* ``cv_linear``: rows carry their fold as group; the training block of a fold is the sum of the other
  folds' blocks. Scaler moments, mean fills and every ridge candidate come from the training
  block, and the hold-out error from the fold's own block, so no second pass over the rows is made and
  nothing of a fold reaches its own fit.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratecraft.errors import ValidationError
from ratecraft.operators.blocks import arrow_schema, blocks_batch, merge_tree
from ratecraft.operators.features import FeatureSpec, kfold_assign


def poisson_table() -> np.ndarray:
    """Distribution function of Poisson(1) at 0, 1, 2 ... until it is 1 in doubles."""
    out, total, term, k = [], 0.0, math.exp(-1.0), 0
    while total + term > total:
        total += term
        out.append(min(total, 1.0))
        k += 1
        term /= k
    return np.array(out)


def bootstrap_bits(keys: Sequence[str], replicates: int, seed: int) -> Column:
    """Binary column: 8 bytes per replicate, two replicates from one md5 of (keys, seed, pair)."""
    name = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    pairs = [F.unhex(F.md5(F.concat_ws("|", name, F.lit(str(seed)), F.lit(str(p))))) for p in range((replicates + 1) // 2)]
    return F.concat(*pairs) if len(pairs) > 1 else pairs[0]


def bootstrap_names(keys: Sequence[str], seed: int) -> Column:
    """The text that ``bootstrap_bits`` hashes, but for the number of the pair at its end."""
    return F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys], F.lit(str(seed)), F.lit(""))


_MD5_SHIFTS = [s for four in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for s in four * 4]
_MD5_WORDS = [[k, (5 * k + 1) % 16, (3 * k + 5) % 16, 7 * k % 16][k // 16] % 16 for k in range(64)]
_MD5_SINES = [np.uint32(int(abs(math.sin(k + 1)) * 2 ** 32)) for k in range(64)]
_MD5_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)


def _md5_block(state: list[np.ndarray], words: np.ndarray) -> list[np.ndarray]:
    """The md5 states of many messages after one more block, ``words`` [16, message]."""
    a, b, c, d = (v.copy() for v in state)
    f, g = np.empty_like(a), np.empty_like(a)
    for k in range(64):
        if k < 16:
            np.bitwise_xor(c, d, out=f); np.bitwise_and(f, b, out=f); np.bitwise_xor(f, d, out=f)  # noqa: E702
        elif k < 32:
            np.bitwise_xor(b, c, out=f); np.bitwise_and(f, d, out=f); np.bitwise_xor(f, c, out=f)  # noqa: E702
        elif k < 48:
            np.bitwise_xor(b, c, out=f); np.bitwise_xor(f, d, out=f)  # noqa: E702
        else:
            np.bitwise_not(d, out=f); np.bitwise_or(f, b, out=f); np.bitwise_xor(f, c, out=f)  # noqa: E702
        f += a
        f += words[_MD5_WORDS[k]]
        f += _MD5_SINES[k]
        np.left_shift(f, np.uint32(_MD5_SHIFTS[k]), out=g)
        np.right_shift(f, np.uint32(32 - _MD5_SHIFTS[k]), out=f)
        f |= g
        f += b
        a, b, c, d, f = d, f, b, c, a
    return [v + s for v, s in zip((a, b, c, d), state)]


def pair_bits(names: pa.Array, replicates: int) -> np.ndarray:
    """[row, replicate] 64-bit words: those of ``bootstrap_bits`` for rows of these ``bootstrap_names``."""
    raw = [v.encode() for v in names.to_pylist()]
    lengths = np.array([len(v) for v in raw], np.int64)
    ends = [str(p).encode() for p in range((replicates + 1) // 2)]
    out = np.empty((len(raw), 2 * len(ends)), np.uint64)
    for digits in sorted({len(e) for e in ends}):
        some = [p for p, e in enumerate(ends) if len(e) == digits]
        sizes = lengths + digits
        width = (sizes + 72) // 64 * 64  # the message, a one bit and its own length, in whole blocks
        for w in np.unique(width).tolist():
            at = np.flatnonzero(width == w)
            plain = np.frombuffer(b"".join(raw[i].ljust(w, b"\0") for i in at), np.uint8).reshape(len(at), w).copy()
            rows, size = np.arange(len(at)), sizes[at]
            plain[rows, size] = 0x80
            plain[:, -8:] = (8 * size).astype("<u8").view(np.uint8).reshape(-1, 8)
            step = max(1, (1 << 16) // len(at))
            for first in range(0, len(some), step):
                part = some[first:first + step]
                text = np.repeat(plain[None], len(part), 0)
                for i, p in enumerate(part):
                    for k, byte in enumerate(ends[p]):
                        text[i, rows, size - digits + k] = byte
                words = np.ascontiguousarray(text.reshape(-1, w).view("<u4").T)
                state = [np.full(words.shape[1], v, np.uint32) for v in _MD5_START]
                for block in range(0, len(words), 16):
                    state = _md5_block(state, words[block:block + 16])
                big = np.stack(state, 1).astype("<u4").view(">u8").reshape(len(part), len(at), 2)  # digest bytes as two words
                for i, p in enumerate(part):
                    out[at, 2 * p], out[at, 2 * p + 1] = big[i, :, 0], big[i, :, 1]
    return out[:, :replicates]


def bootstrap_weights(bits: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Weights from the 64-bit words of ``bootstrap_bits``: the first 52 bits are the uniform.

    Its first 16 bits settle the weight unless a step of ``table`` lies among the uniforms that begin so."""
    starts = np.arange((1 << 16) + 1) / 2.0 ** 16
    least, most = np.searchsorted(table, starts[:-1], "right"), np.searchsorted(table, starts[1:], "left")
    first = (bits >> np.uint64(48)).astype(np.intp)
    out = least.astype(float)[first]
    open_ = (most > least)[first]
    out[open_] = np.searchsorted(table, (bits[open_] >> np.uint64(12)).astype(float) / 2.0 ** 52, "right")
    return out


BLOCK_CELLS = 1 << 20  # products of a task's rows held at once


class Blocks:
    """Layout of a block: per target X'WX (q x q), X'Wy (q), y'Wy, y'W1, 1'W1."""

    def __init__(self, q: int, targets: int):
        self.q, self.targets, self.size = q, targets, q * q + q + 3

    def of(self, x: np.ndarray, y: np.ndarray, w: np.ndarray | None) -> np.ndarray:
        """[replicate, target, size]: the blocks of rows ``x`` [n, q], ``y`` [n, targets] (NaN: not a row of that
        target) for every column of the weights ``w`` [n, replicates] (None: one replicate of weight 1).

        A row's products are formed once for all replicates and targets; the weighted sums are one matrix product."""
        w = np.ones((len(x), 1)) if w is None else w
        upper, known = np.triu_indices(self.q), {}
        out = np.zeros((w.shape[1], self.targets, self.size))
        step = max(1, BLOCK_CELLS // len(upper[0]))
        for t in range(self.targets):
            rows = np.isfinite(y[:, t])
            key = rows.tobytes()
            xr, wr, yr = x[rows], w[rows], y[rows, t]
            if key not in known:
                half = sum((wr[at:at + step].T @ (xr[at:at + step, upper[0]] * xr[at:at + step, upper[1]])
                            for at in range(0, len(xr), step)), np.zeros((w.shape[1], len(upper[0]))))
                gram = np.empty((w.shape[1], self.q, self.q))
                gram[:, upper[0], upper[1]] = gram[:, upper[1], upper[0]] = half
                known[key] = gram.reshape(len(gram), -1)
            sides = np.column_stack([xr * yr[:, None], yr * yr, yr, np.ones(len(yr))])
            out[:, t] = np.concatenate([known[key], wr.T @ sides], 1)
        return out

    def parts(self, block: np.ndarray, t: int) -> tuple:
        """(X'WX, X'Wy, y'Wy, y'W1, 1'W1) of target ``t``."""
        b, q = block.reshape(self.targets, self.size)[t], self.q
        return b[:q * q].reshape(q, q), b[q * q:q * q + q], b[-3], b[-2], b[-1]


def _block_task(batches: Iterable[pa.RecordBatch], blocks: Blocks, replicates: int, table: np.ndarray,
                schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """(_g, _x, _y[, _name]) -> a task's (g, b, part, block)."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        n = len(batch)
        if not n:
            continue
        group = batch.column(0).to_numpy(zero_copy_only=False)
        x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
        y = batch.column(2).flatten().fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(n, -1).astype(float)
        w = None
        if replicates:
            w = bootstrap_weights(pair_bits(batch.column(3), replicates), table)
        sound = np.isfinite(x).all(1)
        for g in np.unique(group[sound]):
            rows = sound & (group == g)
            one = blocks.of(x[rows], y[rows], None if w is None else w[rows])
            total[int(g)] = total[int(g)] + one if int(g) in total else one
    if total:
        yield blocks_batch([(g, b, v) for g, many in total.items() for b, v in enumerate(many)], schema)


PARTIALS = "g int, b int, part int, block binary"


def merged_blocks(rows: DataFrame, blocks: Blocks, replicates: int = 0) -> DataFrame:
    """One (g, b, block) row per group and replicate of ``rows`` (_g, _x, _y[, _name])."""
    table, schema = poisson_table(), arrow_schema(PARTIALS)
    partials = rows.mapInArrow(lambda it: _block_task(it, blocks, replicates, table, schema), PARTIALS)
    return merge_tree(partials, ["g", "b"], np.add)


def solved(blocks_frame: DataFrame, blocks: Blocks, solve: Callable, schema: str) -> DataFrame:
    """``solve(g, b, block) -> rows`` on executors for every block."""
    names = [f.strip().split()[0] for f in schema.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [r for g, b, v in zip(*(c.to_pylist() for c in batch.columns)) for r in solve(g, b, np.frombuffer(v))]
            if rows:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=arrow)

    arrow = arrow_schema(schema)
    return blocks_frame.mapInArrow(run, schema)


def ridge(gram: np.ndarray, right: np.ndarray, weight: float, reg: float) -> np.ndarray:
    """Least squares with ``reg * weight`` on all coefficients but the first; least norm where undetermined."""
    penalty = np.eye(len(gram)) * reg * weight
    penalty[0, 0] = 0.0
    return np.linalg.lstsq(gram + penalty, right, rcond=None)[0]


# -- leave-fold-out linear fits ---------------------------------------------------------

CV_SCHEMA = "fold int, target string, reg double, n_train long, n_valid long, intercept double, coefficients array<double>, mse double, r2 double"


def _design(gram: np.ndarray, numerics: int, shift: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(A, mean, sd): A maps block columns (1, shifted values with 0 in gaps, gap flags, levels) to
    (1, z-scores with gaps at the mean, levels), all moments taken from ``gram``."""
    p, q = numerics, len(gram)
    n = gram[0, 0]
    gaps = gram[0, 1 + p:1 + 2 * p]
    mean = np.divide(gram[0, 1:1 + p], n - gaps, out=np.zeros(p), where=n > gaps)
    square = np.diag(gram)[1:1 + p] + mean * mean * gaps
    variance = np.maximum(square / n - mean * mean, 0) if n else np.zeros(p)
    sd = np.sqrt(np.where(variance > 1e-14 * np.maximum(square / max(n, 1), 1e-300), variance, 0))
    a = np.zeros((1 + p + q - 1 - 2 * p, q))
    a[0, 0] = 1.0
    for j in range(p):
        if sd[j] > 0:
            a[1 + j, 1 + j], a[1 + j, 1 + p + j], a[1 + j, 0] = 1 / sd[j], mean[j] / sd[j], -mean[j] / sd[j]
    for k in range(q - 1 - 2 * p):
        a[1 + p + k, 1 + 2 * p + k] = 1.0
    return a, mean + shift, sd


def cv_linear(df: DataFrame, spec: FeatureSpec, targets: Sequence[str], keys: Sequence[str], folds: int = 3,
              regs: Sequence[float] = (0.0,), seed: int = 42) -> DataFrame:
    """M3 for linear models: (fold, target, reg, n_train, n_valid, intercept, coefficients, mse, r2) of all
    folds, targets and ridge candidates from one pass.

    Numerics are z-scored and their gaps filled with the mean, both of the training rows; categories are one-hot over
    the levels of ``df`` (a level without training rows has no effect). ``reg`` is the penalty on squared
    coefficients of the scaled features, per row. Coefficients are those of the z-scores and
    levels. Rows without a target are left out for that target. R² is NULL where the fold's target is constant or
    the fold empty.
    """
    num, cat, targets, regs = list(spec.num), list(spec.cat), list(targets), [float(r) for r in regs]
    if not keys:
        raise ValidationError("keys of the folds are required")
    if not num and not cat:
        raise ValidationError("no usable feature column")

    def value(c: str) -> Column:
        v = F.col(c).cast("double")
        return F.when(~F.isnan(v), v)

    def level(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit("nan"))

    slim = kfold_assign(df.select(*dict.fromkeys([*num, *cat, *targets, *keys])), keys, folds, seed, col="_fold")
    one = slim.agg(*[F.avg(value(c)).alias(f"a{i}") for i, c in enumerate(num)],
                   *[F.array_sort(F.collect_set(level(c))).alias(f"l{i}") for i, c in enumerate(cat)]).first()
    shift = np.array([one[f"a{i}"] or 0.0 for i in range(len(num))])  # keeps the sums of squares small
    levels = [(c, v) for i, c in enumerate(cat) for v in one[f"l{i}"]]
    x = F.array(F.lit(1.0), *[F.coalesce(value(c) - F.lit(float(s)), F.lit(0.0)) for c, s in zip(num, shift)],
                *[value(c).isNull().cast("double") for c in num], *[(level(c) == F.lit(v)).cast("double") for c, v in levels])
    rows = slim.select(F.col("_fold").alias("_g"), x.alias("_x"), F.array(*[value(t) for t in targets]).alias("_y"))
    blocks = Blocks(1 + 2 * len(num) + len(levels), len(targets))
    merged = merged_blocks(rows, blocks)
    # folds x folds small rows: each fold's block goes to its own hold-out and to the training of the others
    spread = merged.select(F.explode(F.sequence(F.lit(0), F.lit(folds - 1))).alias("fold"), "g", "block") \
        .select("fold", (F.col("fold") == F.col("g")).alias("own"), "block").repartition(min(folds, 200), "fold")
    p = len(num)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        train: dict[int, np.ndarray] = {}
        valid: dict[int, np.ndarray] = {}
        for batch in batches:
            for fold, own, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                side, b = valid if own else train, np.frombuffer(block.as_py())
                side[fold] = side[fold] + b if fold in side else b
        out = []
        for fold in sorted(train):
            for t, name in enumerate(targets):
                gram, right, *_, n = blocks.parts(train[fold], t)
                a, _, _ = _design(gram, p, shift)
                for reg in regs:
                    beta = ridge(a @ gram @ a.T, a @ right, n, reg)
                    mse = r2 = None
                    n_valid = 0.0
                    if fold in valid:
                        g, r, yy, y1, n_valid = blocks.parts(valid[fold], t)
                        b = a.T @ beta
                        left = max(float(yy - 2 * b @ r + b @ g @ b), 0.0)
                        if n_valid > 0:
                            mse, spread_ = left / n_valid, yy - y1 * y1 / n_valid
                            r2 = 1 - left / spread_ if spread_ > 1e-12 * yy else None
                    out.append({"fold": fold, "target": name, "reg": reg, "n_train": int(n), "n_valid": int(n_valid),
                                "intercept": float(beta[0]), "coefficients": beta[1:].tolist(), "mse": mse, "r2": r2})
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    arrow = arrow_schema(CV_SCHEMA)
    return spread.mapInArrow(score, CV_SCHEMA)


__all__ = ["Blocks", "merged_blocks", "solved", "ridge", "cv_linear", "bootstrap_bits", "bootstrap_names", "pair_bits", "bootstrap_weights", "poisson_table"]
