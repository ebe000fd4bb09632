"""Boosted regression trees of several trials and targets, grown together over binned rows (M8).

The trees are those of Spark ML's ``GBTRegressor`` with squared error: the first tree fits the target with weight 1, each
later one twice the residual with the step as weight; a tree draws its rows anew (``subsamplingRate``); nodes split where
the variance falls most; thresholds follow Spark ML's rule, which takes them from about max(bins^2, 10,000) training
rows. All rows are binned and fitted.

A row is one small integer per source column (a category's level instead of a one-hot vector), so a level of a tree
adds a row once per column and not once per level of every category. One pass over the rows serves a level of
all fits: a task adds up (rows, sum of residuals) per fit, node and bin, and these blocks merge as a tree. The driver receives the
merged blocks only, whose size depends on bins and nodes. Predictions of the finished trees stay beside the rows.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecraft.operators.blocks import arrow_schema, blocks_batch, merge_tree
from ratecraft.session import scratch_dir

DEFAULTS = {"maxIter": 20, "maxDepth": 5, "stepSize": 0.1, "subsamplingRate": 1.0, "minInstancesPerNode": 1,
            "minInfoGain": 0.0, "maxBins": 32, "seed": 42}  # of GBTRegressor, but for the seed
MAX_DEPTH = 10  # a block has 2^depth nodes
EDGE_ROWS = 10_000  # Spark ML takes thresholds from so many rows, or bins^2 if that is more
BLOCK_ROWS = 1 << 13
TIE = 1e-12  # of equal gains, as of the two levels of a category, the first column's counts, whatever the rounding
BLOCK = "id long, train int, bins binary, y binary, f binary"
PARTIALS = "fit int, part int, block binary"
NODE = ("id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, gain: double, leftChild: int, "
        "rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>")


def grown(params: Mapping) -> dict | None:
    """GBTRegressor parameters with their defaults, or None if these trees are left to Spark ML."""
    p = {**DEFAULTS, **params}
    ok = (set(p) == set(DEFAULTS) and p["maxIter"] >= 1 and 0 <= p["maxDepth"] <= MAX_DEPTH and 0 < p["stepSize"] <= 1
          and 0 < p["subsamplingRate"] <= 1 and p["minInstancesPerNode"] >= 1 and p["minInfoGain"] >= 0
          and 2 <= p["maxBins"] <= 256)
    return p if ok else None


def edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Thresholds between distinct values: all of them, or those nearest to equal shares (Spark ML's rule)."""
    value, n = np.unique(values, return_counts=True)
    middle = (value[:-1] + value[1:]) / 2
    if len(value) <= bins:
        return middle
    stride = n.sum() / bins
    out, seen, goal = [], n[0], stride
    for k in range(1, len(value)):
        before, seen = seen, seen + n[k]
        if abs(before - goal) < abs(seen - goal):
            out.append(middle[k - 1])
            goal += stride
    return np.array(out)


@dataclass
class Fit:
    """One boosted fit: target number ``y``, GBTRegressor parameters and the thresholds of each numeric column."""
    y: int
    params: dict
    edges: list
    allowed: list = field(default_factory=list)


@dataclass
class Tree:
    """Splits (column, slot) and values by node; node k has the children 2k and 2k + 1, the root is 1."""
    split: dict = field(default_factory=dict)
    value: dict = field(default_factory=dict)
    rows: dict = field(default_factory=dict)  # training rows of each node
    gain: dict = field(default_factory=dict)

    def ends(self, bins: np.ndarray, rows: np.ndarray, n_num: int, nodes: Sequence[int]) -> np.ndarray:
        """For every row the number in ``nodes`` of the node that it ends in; len(nodes) for others and for rows not in the mask ``rows``."""
        out, todo, number = np.full(len(rows), len(nodes)), [(1, rows)], {node: i for i, node in enumerate(nodes)}
        while todo:
            node, held = todo.pop()
            if node in self.split:
                column, slot = self.split[node]
                right = bins[column] > slot if column < n_num else bins[column] == slot
                todo += [(2 * node, held & ~right), (2 * node + 1, held & right)]
            elif node in number:
                np.copyto(out, number[node], where=held)
        return out


class Layout:
    """Slots of a block: a column's bins or levels side by side. Numeric columns have the thresholds of all fits."""

    def __init__(self, fits: Sequence[Fit], levels: Sequence[int]):
        n_num = len(fits[0].edges)
        self.edges = [np.unique(np.concatenate([f.edges[c] for f in fits])) for c in range(n_num)]
        self.n_num, self.levels = n_num, list(levels)
        self.slots = [len(e) + 1 for e in self.edges] + [n + 1 for n in levels]  # the last slot of a category: no level
        self.starts = np.concatenate([[0], np.cumsum(self.slots)]).astype(int)
        self.dtype = np.min_scalar_type(max(self.slots))
        for f in fits:
            f.allowed = [np.isin(e, f.edges[c]) for c, e in enumerate(self.edges)]

    def best(self, n: np.ndarray, s: np.ndarray, fit: Fit) -> tuple | None:
        """((column, slot), left (rows, sum), right (rows, sum), gain) of the split by which the variance falls most."""
        found, most = None, 0.0
        rows, total = n[:self.slots[0]].sum(), s[:self.slots[0]].sum()
        for c, (a, b) in enumerate(zip(self.starts, self.starts[1:])):
            if c < self.n_num:  # left: up to the slot
                ln, ls = np.cumsum(n[a:b])[:-1], np.cumsum(s[a:b])[:-1]
                rn, rs, ok = rows - ln, total - ls, fit.allowed[c]
            else:  # right: the level alone
                rn, rs, ok = n[a:b - 1], s[a:b - 1], True
                ln, ls = rows - rn, total - rs
            least = fit.params["minInstancesPerNode"]
            ok = ok & (ln >= least) & (rn >= least)
            if not np.any(ok):
                continue
            gain = np.zeros(len(ln))
            gain[ok] = ln[ok] * rn[ok] / rows ** 2 * (ls[ok] / ln[ok] - rs[ok] / rn[ok]) ** 2
            k = int(np.argmax(gain >= gain.max() * (1 - TIE)))
            if gain[k] > most * (1 + TIE) and gain[k] >= fit.params["minInfoGain"]:
                found, most = ((c, k), (ln[k], ls[k]), (rn[k], rs[k]), gain[k]), gain[k]
        return found


def _cut(batches: Iterable[pa.RecordBatch], layout: Layout, n_y: int, n_fits: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Blocks of binned rows, training rows first, from (numerics, level numbers, targets, _is_test)."""
    first, number, kept, count = TaskContext.get().partitionId() << 32, 0, [], 0

    def block() -> pa.RecordBatch:
        rows = pa.Table.from_batches(kept)
        held = rows.column(rows.num_columns - 1).to_numpy()
        order = np.argsort(held, kind="stable")
        columns = [rows.column(i).to_numpy()[order] for i in range(rows.num_columns - 1)]
        bins = np.empty((len(layout.slots), len(order)), layout.dtype)
        for c in range(len(bins)):
            bins[c] = np.searchsorted(layout.edges[c], columns[c]) if c < layout.n_num else columns[c]
        y = np.array(columns[len(bins):], dtype=float)
        one = [first + number, int(len(held) - held.sum()), bins.tobytes(), y.tobytes(), bytes(8 * n_fits * len(order))]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(one, schema)], schema=schema)

    for batch in batches:
        if batch.num_rows:
            kept.append(batch)
            count += batch.num_rows
        if count >= BLOCK_ROWS:
            yield block()
            number, kept, count = number + 1, [], 0
    if kept:
        yield block()


def _blocks(batches: Iterable[pa.RecordBatch], layout: Layout, n_y: int, n_fits: int) -> Iterator[tuple]:
    for batch in batches:
        for k in range(batch.num_rows):
            number, train, *parts = (c[k] for c in batch.columns)
            y = np.frombuffer(parts[1].as_buffer()).reshape(n_y, -1)
            bins = np.frombuffer(parts[0].as_buffer(), layout.dtype).reshape(len(layout.slots), -1)
            yield number.as_py(), train.as_py(), bins, y, np.frombuffer(parts[2].as_buffer()).reshape(n_fits, -1)


def _sums(batches, layout: Layout, fits: Sequence[Fit], n_y: int, m: int, trees: Mapping, asked: Mapping, schema: pa.Schema):
    """One block (rows and sums of residuals per asked node and slot) per fit of the task's rows, for tree ``m``."""
    total = {k: np.zeros((2, len(nodes), layout.starts[-1])) for k, nodes in asked.items()}
    for number, train, bins, y, f in _blocks(batches, layout, n_y, len(fits)):
        draws, known, bins = {}, ~np.isnan(y[:, :train]), bins[:, :train]
        wide = bins.astype(np.intp)
        for k, nodes in asked.items():
            fit = fits[k]
            rate, seed = fit.params["subsamplingRate"], fit.params["seed"]
            drawn = known[fit.y]
            if rate < 1:
                if seed not in draws:
                    draws[seed] = np.random.default_rng([seed & (1 << 64) - 1, m, number]).random(train)
                drawn = drawn & (draws[seed] < rate)
            at = trees[k].ends(bins, drawn, layout.n_num, nodes)
            rest = (y[fit.y, :train] - f[k, :train]) * (2.0 if m else 1.0)
            for c, slots in enumerate(layout.slots):  # rows of no asked node add to one more node, which is cut off
                code, a, size = at * slots + wide[c], layout.starts[c], len(nodes) * slots
                total[k][0, :, a:a + slots] += np.bincount(code, minlength=size + slots)[:size].reshape(-1, slots)
                total[k][1, :, a:a + slots] += np.bincount(code, rest, size + slots)[:size].reshape(-1, slots)
    yield blocks_batch([(k, block) for k, block in total.items()], schema)


def _added(batches, layout: Layout, fits: Sequence[Fit], n_y: int, m: int, trees: Mapping, schema: pa.Schema):
    """The blocks with the predictions of the finished trees ``m`` added."""
    for number, train, bins, y, f in _blocks(batches, layout, n_y, len(fits)):
        f, every = f.copy(), np.ones(y.shape[1], bool)
        for k, tree in trees.items():
            leaves = [node for node in tree.value if node not in tree.split]
            values = np.array([tree.value[node] for node in leaves])
            f[k] += values[tree.ends(bins, every, layout.n_num, leaves)] * (fits[k].params["stepSize"] if m else 1.0)
        one = [number, train, bins.tobytes(), y.tobytes(), f.tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array([v], t.type) for v, t in zip(one, schema)], schema=schema)


def _tested(batches, layout: Layout, n_y: int, n_fits: int, chosen: Sequence[int], schema: pa.Schema):
    """(targets, predictions of the chosen fits) of the held-out rows."""
    for _, train, _, y, f in _blocks(batches, layout, n_y, n_fits):
        columns = [*y[:, train:], *(f[k, train:] for k in chosen)]
        yield pa.RecordBatch.from_arrays([pa.array(c, from_pandas=True) for c in columns], schema=schema)


def _grow(state: DataFrame, layout: Layout, fits: Sequence[Fit], n_y: int, m: int) -> dict:
    """Tree ``m`` of every fit that has one, level by level."""
    schema = arrow_schema(PARTIALS)
    trees = {k: Tree() for k, f in enumerate(fits) if m < f.params["maxIter"]}
    asked, level = {k: [1] for k in trees}, 0
    while asked:
        partials = state.mapInArrow(lambda it: _sums(it, layout, fits, n_y, m, trees, asked, schema), PARTIALS)
        merged = {r["fit"]: np.frombuffer(r["block"]) for r in merge_tree(partials, ["fit"], np.add).collect()}
        following = {}
        for k, nodes in asked.items():
            fit, tree = fits[k], trees[k]
            counts, sums = merged[k].reshape(2, len(nodes), -1)
            for node, n, s in zip(nodes, counts, sums):
                if node == 1:
                    rows, total = n[:layout.slots[0]].sum(), s[:layout.slots[0]].sum()
                    tree.value[1], tree.rows[1] = total / rows if rows else 0.0, rows
                found = layout.best(n, s, fit) if level < fit.params["maxDepth"] else None
                if found is None:
                    continue
                tree.split[node], tree.gain[node] = found[0], found[3]
                for child, (rows, total) in zip((2 * node, 2 * node + 1), found[1:3]):
                    tree.value[child], tree.rows[child] = total / rows, rows
                    if level + 1 < fit.params["maxDepth"]:
                        following.setdefault(k, []).append(child)
        asked, level = following, level + 1
    return trees


class Boosted:
    """Fits of ``params`` (one set per trial) for every target over ``rows``: columns ``num`` (doubles), ``cat`` (level
    numbers, as many as ``levels`` says; any other number: no level), ``targets`` and _is_test. Values are finite or, in targets, NULL."""

    def __init__(self, rows: DataFrame, num: Sequence[str], cat: Sequence[str], levels: Sequence[int], targets: Sequence[str],
                 params: Sequence[Mapping], edges_of: Mapping):
        self.targets = list(targets)
        self.fits = [Fit(y, dict(p), edges_of[y, p["maxBins"]]) for p in params for y in range(len(self.targets))]
        self.trees = [[] for _ in self.fits]
        layout, fits, n_y, n_fits = Layout(self.fits, levels), self.fits, len(self.targets), len(self.fits)
        self.layout, schema = layout, arrow_schema(BLOCK)
        ready = rows.select(*[F.col(f"`{c}`").cast("double") for c in num],
                            *[F.least(F.col(f"`{c}`").cast("int"), F.lit(n)) for c, n in zip(cat, levels)],
                            *[F.col(f"`{t}`").cast("double") for t in self.targets], "_is_test").toDF(*map(str, range(len(num) + len(cat) + n_y + 1)))
        self.state = ready.mapInArrow(lambda it: _cut(it, layout, n_y, n_fits, schema), BLOCK).persist()

    def fit(self, keep_state: bool = True) -> "Boosted":
        """Grow all trees; without ``keep_state`` the last ones are not added to the rows' predictions, which ``scored`` needs."""
        layout, fits, n_y, schema = self.layout, self.fits, len(self.targets), arrow_schema(BLOCK)
        last = max(f.params["maxIter"] for f in fits)
        for m in range(last):
            trees = _grow(self.state, layout, fits, n_y, m)
            for k, tree in trees.items():
                self.trees[k].append(tree)
            if not keep_state and m + 1 == last:
                break
            before = self.state
            # m and trees are bound: the frame is computed again if a cached block is lost
            self.state = before.mapInArrow(lambda it, m=m, trees=trees: _added(it, layout, fits, n_y, m, trees, schema), BLOCK).persist()
            self.state.count()
            before.unpersist()
        return self

    def scored(self, trial: int, suffix: str = "_pred") -> DataFrame:
        """(targets, <target>_pred) of the held-out rows by the trial of that number."""
        n_y, n_fits, layout = len(self.targets), len(self.fits), self.layout
        chosen = range(trial * n_y, (trial + 1) * n_y)
        names = [*self.targets, *[t + suffix for t in self.targets]]
        ddl = ", ".join(f"c{i} double" for i in range(len(names)))
        schema = arrow_schema(ddl)
        return self.state.mapInArrow(lambda it: _tested(it, layout, n_y, n_fits, chosen, schema), ddl).toDF(*names)

    def model(self, trial: int, target: str, features_col: str):
        """The trial's trees of ``target`` as Spark ML's model, on the vector of numerics and one-hot levels.

        Written below the checkpoint folder in the form in which Spark ML saves its models, and loaded. Sums of squares are
        not kept, so impurities are NaN; gains, counts and predictions are those of the fit."""
        from pyspark.ml.regression import GBTRegressionModel  # not needed where tasks import this module

        spark, y = self.state.sparkSession, self.targets.index(target)
        k, layout = trial * len(self.targets) + y, self.layout
        one_hot = np.concatenate([[layout.n_num], layout.n_num + np.cumsum(layout.levels)]).astype(int)
        path = scratch_dir(spark, f"boosted-{uuid.uuid4().hex}")

        def text(kind: str, own: Mapping, **more) -> str:
            said = {"featuresCol": features_col, "labelCol": target, "predictionCol": "prediction", "impurity": "variance", **own}
            return json.dumps({"class": f"org.apache.spark.ml.regression.{kind}", "timestamp": int(time.time() * 1000),
                               "sparkVersion": spark.version, "uid": f"{kind}_{uuid.uuid4().hex[:12]}", "paramMap": said,
                               "defaultParamMap": {}, **more})

        own = {p: self.fits[k].params[p] for p in DEFAULTS}
        of_tree = {p: own[p] for p in ("maxDepth", "maxBins", "minInstancesPerNode", "minInfoGain", "seed")}
        nodes, trees = [], []
        for number, tree in enumerate(self.trees[k]):
            trees.append((number, text("DecisionTreeRegressionModel", of_tree), 1.0 if number == 0 else float(own["stepSize"])))
            order, todo = [], [1]
            while todo:  # Spark ML numbers nodes from the left, parents first
                node = todo.pop()
                order.append(node)
                todo += [2 * node + 1, 2 * node] if node in tree.split else []
            at = {node: i for i, node in enumerate(order)}
            for node in order:
                value, rows, split, gain, children = float(tree.value[node]), int(tree.rows[node]), (-1, [], -1), -1.0, (-1, -1)
                if node in tree.split:
                    c, slot = tree.split[node]
                    split = (c, [float(layout.edges[c][slot])], -1) if c < layout.n_num else (int(one_hot[c - layout.n_num]) + slot, [0.0], 2)
                    gain, children = float(tree.gain[node]), (at[2 * node], at[2 * node + 1])
                nodes.append((number, (at[node], value, float("nan"), [float(rows), rows * value, float("nan")], rows, gain, *children, split)))
        frames = {"metadata": spark.createDataFrame([(text("GBTRegressionModel", own, numFeatures=int(one_hot[-1]), numTrees=len(trees)),)], "value string"),
                  "treesMetadata": spark.createDataFrame(trees, "_1 int, _2 string, _3 double"),
                  "data": spark.createDataFrame(nodes, f"treeID int, nodeData struct<{NODE}>")}
        for name, frame in frames.items():
            frame.coalesce(1).write.format("text" if name == "metadata" else "parquet").save(os.path.join(path, name))
        return GBTRegressionModel.load(path)

    def unpersist(self) -> None:
        self.state.unpersist()


def sampled_edges(rows: DataFrame, num: Sequence[str], n_rows: int, bins: int) -> list:
    """Thresholds of the numeric columns from as many of the ``n_rows`` training rows as Spark ML takes."""
    bins = min(bins, n_rows)
    wanted = max(bins * bins, EDGE_ROWS)
    if wanted < n_rows:
        rows = rows.sample(wanted / n_rows, seed=42)
    found = rows.select(*[F.col(f"`{c}`") for c in num]).toDF(*map(str, range(len(num)))).toArrow()
    return [edges(found.column(c).to_numpy(), bins) for c in range(len(num))]


__all__ = ["Boosted", "grown", "sampled_edges", "edges"]
