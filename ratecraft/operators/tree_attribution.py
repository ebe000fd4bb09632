"""Exact attribution of boosted-tree predictions by their paths (X2, tree form).

The game explained is the path-dependent one: for a coalition S of features, a tree's value at a row
follows the row at splits on features in S and averages both children, weighted by the training rows
they covered, at all other splits. A feature's Shapley value in that game is found leaf by leaf. On the
path to a leaf with value v let feature j have z_j, the product of the cover shares at its splits, and
o_j, 1 if the row passes all of them and else 0. Then

    phi_j += v (o_j - z_j) * integral over t in [0, 1] of  prod_{i != j} (z_i (1 - t) + o_i t)

since t^k (1 - t)^(m-1-k) integrates to the Shapley weight k! (m-1-k)! / m!. The integrand is a
polynomial of degree below the number m of features on the path, so Gauss-Legendre points, half as
many as m, give the integral exactly: the cost per leaf is quadratic in the depth, without coalitions,
background rows or a fan-out. sum(phi) + base = prediction, base being the cover-weighted mean.

All o_j of a few neighbouring leaves follow from the outcomes of the splits on their paths, so the values of a group
of leaves with at most ``GROUP_SPLITS`` splits are computed once per outcome in a task and then looked up: a row
costs one comparison per split and one look-up per group and feature. There are 2^splits outcomes, whatever the rows.

The node table of a fitted model comes from the model's own saved form (one row per node; a model's
size is set by its parameters); rows are explained in Arrow batches where they lie, without a shuffle.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecraft.errors import MissingColumnsError, ValidationError
from ratecraft.operators.features import feature_names
from ratecraft.session import scratch_dir

BLOCK_CELLS = 1 << 20  # rows x leaves x path features evaluated at once in a task
GROUP_SPLITS = 16  # splits of a group of leaves; a task keeps at most 2^16 outcomes of a group


@dataclass
class Node:
    value: float
    cover: float
    feature: int = -1
    left: int = -1
    right: int = -1
    threshold: float = 0.0          # continuous split: left when x <= threshold
    left_levels: frozenset | None = None  # categorical split: left when x is one of these


def node_tables(model) -> list[tuple[float, list[Node]]]:
    """(weight, nodes) of each tree of a fitted tree ensemble; node 0 is the root.

    Read from the model as it is saved, below the session's checkpoint folder."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    path = scratch_dir(spark, f"trees-{uuid.uuid4().hex}")
    model.write().overwrite().save(path)
    rows = spark.read.parquet(os.path.join(path, "data")).select("treeID", "nodeData.*").orderBy("treeID", "id").collect()
    trees: dict[int, list[Node]] = {}
    for r in rows:
        node = Node(float(r["prediction"]), float(r["rawCount"]))
        if r["leftChild"] >= 0:
            split = r["split"]
            node.feature, node.left, node.right = split["featureIndex"], r["leftChild"], r["rightChild"]
            if split["numCategories"] < 0:
                node.threshold = float(split["leftCategoriesOrThreshold"][0])
            else:
                node.left_levels = frozenset(split["leftCategoriesOrThreshold"])
        trees.setdefault(r["treeID"], []).append(node)
    return [(float(w), trees[t]) for t, w in enumerate(model.treeWeights)]


class LeafGroup:
    """Neighbouring leaves of a tree, the splits on their paths, and the values of the outcomes met so far."""

    def __init__(self, first: int, last: int):
        self.first, self.last = first, last
        self.splits: dict[tuple, int] = {}
        self.row_of: np.ndarray | None = None

    def add(self, splits: Iterable[tuple]) -> None:
        self.last += 1
        for s in splits:
            self.splits.setdefault(s, len(self.splits))

    def looked_up(self, columns: np.ndarray, compute) -> tuple[np.ndarray, list[int], np.ndarray]:
        """(row of the table per row, features, table [feature, row]); ``compute(rows)`` gives the values of new outcomes."""
        if self.row_of is None:
            self.row_of = np.full(1 << len(self.splits), -1, np.int32)
            self.features = sorted({f for f, _ in self.splits})
            self.phi = np.zeros((len(self.features), 0))
        code = np.zeros(columns.shape[1], np.int32)
        for (f, rule), bit in self.splits.items():
            left = np.isin(columns[f], list(rule)) if isinstance(rule, frozenset) else columns[f] <= rule
            code |= left.astype(np.int32) << np.int32(bit)
        rows = self.row_of[code]
        unmet = np.flatnonzero(rows < 0)
        if len(unmet):
            new, at = np.unique(code[unmet], return_index=True)
            self.row_of[new] = self.phi.shape[1] + np.arange(len(new), dtype=np.int32)
            self.phi = np.concatenate([self.phi, compute(unmet[at])[:, self.features].T], 1)
            rows = self.row_of[code]
        return rows, self.features, self.phi


class PathTable:
    """The leaves of an ensemble as arrays: per leaf a value and per path feature its cover
    share and the interval (or level set) that leads to the leaf."""

    def __init__(self, trees: Sequence[tuple[float, list[Node]]], n_features: int):
        leaves, groups = [], []
        for weight, nodes in trees:
            todo = [(0, {}, ())]
            groups.append(LeafGroup(len(leaves), len(leaves)))
            while todo:
                at, path, splits = todo.pop()
                node = nodes[at]
                if node.feature < 0:
                    if groups[-1].last > groups[-1].first and len(groups[-1].splits.keys() | set(splits)) > GROUP_SPLITS:
                        groups.append(LeafGroup(len(leaves), len(leaves)))
                    groups[-1].add(splits)
                    leaves.append((weight * node.value, path))
                    continue
                splits += ((node.feature, node.threshold if node.left_levels is None else node.left_levels),)
                for child, is_left in ((node.left, True), (node.right, False)):
                    share, low, high, levels = path.get(node.feature, (1.0, -np.inf, np.inf, None))
                    share *= nodes[child].cover / (nodes[node.left].cover + nodes[node.right].cover)
                    if node.left_levels is not None:
                        levels = (*(levels or ()), (node.left_levels, is_left))
                    elif is_left:
                        high = min(high, node.threshold)
                    else:
                        low = max(low, node.threshold)
                    todo.append((child, path | {node.feature: (share, low, high, levels)}, splits))
        self.groups = groups
        self.n_features = n_features
        self.width = max((len(p) for _, p in leaves), default=0)
        shape = (len(leaves), max(self.width, 1))
        self.value = np.array([v for v, _ in leaves])
        self.feature, self.share = np.zeros(shape, np.int64), np.ones(shape)
        self.low, self.high = np.full(shape, -np.inf), np.full(shape, np.inf)
        self.used = np.zeros(shape, bool)
        self.levels: list[tuple[int, int, tuple]] = []
        for i, (_, path) in enumerate(leaves):
            for j, (f, (share, low, high, levels)) in enumerate(path.items()):
                self.feature[i, j], self.share[i, j], self.low[i, j], self.high[i, j] = f, share, low, high
                self.used[i, j] = True
                if levels:
                    self.levels.append((i, j, levels))
        points, weights = np.polynomial.legendre.leggauss((self.width + 1) // 2 or 1)
        self.points, self.weights = (points + 1) / 2, weights / 2
        self.base = float(self.value @ np.where(self.used, self.share, 1.0).prod(1))
        to_feature = np.zeros((shape[0] * shape[1], n_features))
        to_feature[np.arange(len(to_feature)), self.feature.ravel()] = self.used.ravel()
        self.to_feature = to_feature

    def passes(self, x: np.ndarray, first: int = 0, last: int | None = None) -> np.ndarray:
        """[row, leaf, path feature]: 1.0 where the row takes all the feature's splits to the leaf; leaves ``first`` to ``last``."""
        feature, low, high, used = (a[first:last] for a in (self.feature, self.low, self.high, self.used))
        v = x[:, feature]
        ok = ((v <= high) | np.isposinf(high)) & (~(v <= low) | np.isneginf(low))
        for i, j, levels in self.levels:
            if first <= i < first + len(feature):
                for left, is_left in levels:
                    ok[:, i - first, j] &= np.isin(v[:, i - first, j], list(left)) == is_left
        return np.where(used, ok, True).astype(float)

    def by_paths(self, x: np.ndarray, first: int, last: int) -> np.ndarray:
        """[row, feature]: what the leaves ``first`` to ``last`` add to the Shapley values of the rows of ``x``."""
        out = np.zeros((len(x), self.n_features))
        value, share = self.value[first:last], self.share[first:last]
        to_feature = self.to_feature[first * share.shape[1]:last * share.shape[1]]
        step = max(1, BLOCK_CELLS // share.size)
        for at in range(0, len(x), step):
            o = self.passes(x[at:at + step], first, last)
            total = np.zeros_like(o)
            for t, w in zip(self.points, self.weights):
                term = share * (1 - t) + o * t  # positive: every fitted node covers a row; 1 where unused
                total += w * term.prod(2, keepdims=True) / term
            part = value[:, None] * (o - share) * total
            out[at:at + step] = part.reshape(len(o), -1) @ to_feature
        return out

    def attribute(self, x: np.ndarray) -> np.ndarray:
        """[row, feature]: the Shapley values of the rows of ``x``."""
        columns, out = np.ascontiguousarray(x.T), np.zeros((self.n_features, len(x)))
        for group in self.groups:
            if len(group.splits) > GROUP_SPLITS:  # a path longer than that
                out += self.by_paths(x, group.first, group.last).T
                continue
            rows, features, phi = group.looked_up(columns, lambda new, g=group: self.by_paths(x[new], g.first, g.last))
            for f, values in zip(features, phi):
                out[f] += values[rows]
        return out.T


def _explain(batches: Iterable[pa.RecordBatch], tables: list[PathTable]) -> Iterator[pa.RecordBatch]:
    """(keys ..., features array) -> (keys ..., one array of Shapley values per table)."""
    for batch in batches:
        n, features = len(batch), batch.column(batch.num_columns - 1)
        x = features.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, tables[0].n_features))
        arrays = []
        for table in tables:
            phi = table.attribute(x)
            ends = np.arange(n + 1, dtype=np.int32) * table.n_features
            arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(phi.ravel())))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *arrays],
                                         names=[*batch.schema.names[:-1], *(f"_phi{i}" for i in range(len(tables)))])


def attribution_arrays(df: DataFrame, model, keep: Sequence[str], targets: Sequence[str] | None = None) -> tuple[DataFrame, list[str]]:
    """(frame, features): per row of ``df`` the columns ``keep``, and per target ``<target>_phi``, an array in the
    order of ``features``, and ``<target>_base``. See ``tree_attribution``."""
    if model.kind != "gbt":
        raise ValidationError("the tree form explains boosted trees; use linear_attribution for linear models")
    need = [c for c in [*model.spec.num, *model.spec.cat, *keep] if c not in df.columns]
    if need:
        raise MissingColumnsError(f"columns missing: {need}")
    targets = list(targets or model.targets)
    ready = model.prep.transform(df)
    names = feature_names(ready)
    tables = [PathTable(node_tables(model.models[t]), len(names)) for t in targets]  # sized by the model's parameters
    sent = [f"_k{i}" for i in range(len(keep))]
    types = [df.schema[k].dataType.simpleString() for k in keep]
    rows = ready.select(*[F.col(k).alias(s) for k, s in zip(keep, sent)], vector_to_array("features").alias("_x"))
    schema = ", ".join([*(f"{s} {t}" for s, t in zip(sent, types)), *(f"_phi{i} array<double>" for i in range(len(tables)))])
    phis = rows.mapInArrow(lambda it: _explain(it, tables), schema)
    out = [F.col(s).alias(k) for k, s in zip(keep, sent)]
    for i, t in enumerate(targets):
        out += [F.col(f"_phi{i}").alias(f"{t}_phi"), F.lit(tables[i].base).alias(f"{t}_base")]
    return phis.select(*out), names


def tree_attribution(df: DataFrame, model, keys: Sequence[str], targets: Sequence[str] | None = None) -> DataFrame:
    """X2 (tree form): (keys, target, feature, phi, base) for every row of ``df``.

    ``model`` is a fitted boosted ``MultiTargetModel``; features are the encoded ones that its trees see
    (F7 names: numerics, then one-hot levels). Rows are explained each, also repeated ones; gaps are filled by
    the model's own preprocessing, as in scoring.
    """
    targets = list(targets or model.targets)
    wide, names = attribution_arrays(df, model, keys, targets)
    cells = F.array(*[F.struct(F.lit(t).alias("target"), F.lit(n).alias("feature"), F.col(f"{t}_phi")[j].alias("phi"),
                               F.col(f"{t}_base").alias("base")) for t in targets for j, n in enumerate(names)])
    return wide.select(*keys, F.explode(cells).alias("_c")).select(*keys, "_c.*")


__all__ = ["tree_attribution", "attribution_arrays", "node_tables", "PathTable", "Node"]
