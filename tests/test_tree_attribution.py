"""Path attribution of boosted trees against all coalitions, and its balance on whole frames."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratecraft.errors import MissingColumnsError, ValidationError
from ratecraft.operators.features import FeatureSpec
from ratecraft.operators.models import fit_linear, fit_multi_target
from ratecraft.operators.tree_attribution import Node, PathTable, node_tables, tree_attribution


def _coalition_value(nodes, x, known, at=0):
    """A tree's value when only the features of ``known`` are given."""
    n = nodes[at]
    if n.feature < 0:
        return n.value
    if n.feature in known:
        v = x[n.feature]
        left = v in n.left_levels if n.left_levels is not None else v <= n.threshold
        return _coalition_value(nodes, x, known, n.left if left else n.right)
    a, b = nodes[n.left], nodes[n.right]
    return (a.cover * _coalition_value(nodes, x, known, n.left) + b.cover * _coalition_value(nodes, x, known, n.right)) / (a.cover + b.cover)


def _brute_force(trees, x, p):
    phi = np.zeros(p)
    value = {s: sum(w * _coalition_value(nodes, x, set(s)) for w, nodes in trees)
             for k in range(p + 1) for s in itertools.combinations(range(p), k)}
    for j in range(p):
        for s, v in value.items():
            if j not in s:
                weight = math.factorial(len(s)) * math.factorial(p - len(s) - 1) / math.factorial(p)
                phi[j] += weight * (value[tuple(sorted((*s, j)))] - v)
    return phi, value[()]


def _random_tree(rng, p, depth):
    nodes = []

    def grow(cover, level):
        at = len(nodes)
        nodes.append(Node(float(rng.normal()), cover))
        if level and cover > 2 and rng.random() < 0.9:
            nodes[at].feature = int(rng.integers(p))
            if nodes[at].feature == 0:  # the first feature has levels
                nodes[at].left_levels = frozenset(rng.choice(4, 2, replace=False).astype(float).tolist())
            else:
                nodes[at].threshold = float(rng.normal() * 0.7)
            part = float(rng.integers(1, int(cover)))
            nodes[at].left = grow(part, level - 1)
            nodes[at].right = grow(cover - part, level - 1)
        return at

    grow(200.0, depth)
    return nodes


@pytest.mark.parametrize("depth", [0, 1, 3, 6, 8])
def test_paths_equal_all_coalitions(depth):
    rng = np.random.default_rng(depth)
    p = 5
    trees = [(float(w), _random_tree(rng, p, depth)) for w in (1.0, 0.1, 0.1)]
    table = PathTable(trees, p)
    x = rng.normal(size=(20, p))
    x[:, 0] = rng.integers(0, 4, 20)
    x[3, 2] = np.nan  # a NaN goes right, as in the trees
    got = table.attribute(x)
    for row, phi in zip(x, got):
        want, base = _brute_force(trees, row, p)
        assert np.allclose(phi, want, atol=1e-9) and table.base == pytest.approx(base)


@pytest.fixture(scope="module")
def fitted(spark):
    rng = np.random.default_rng(3)
    rows = [(i, float(a), float(b), str(c), float(3 * a - b * b + (c == "b") + e), float(a * b))
            for i, (a, b, c, e) in enumerate(zip(rng.normal(size=500), rng.normal(size=500),
                                                 rng.choice(["a", "b", "c"], 500), rng.normal(size=500) * 0.1))]
    rows += [(900, None, 0.5, None, 1.0, 1.0), (900, None, 0.5, None, 1.0, 1.0), (901, 0.1, float("nan"), "new", None, None)]
    df = spark.createDataFrame(rows, "id long, x1 double, x2 double, c string, y1 double, y2 double")
    spec = FeatureSpec(num=["x1", "x2"], cat=["c"], target=["y1", "y2"])
    return df, spec, fit_multi_target(df, spec, spec.target, {"n_estimators": 6, "max_depth": 4, "learning_rate": 0.3, "seed": 1})


def test_fitted_model_equals_all_coalitions(spark, fitted):
    df, spec, model = fitted
    some = df.where("id in (1, 2, 3, 900, 901)").distinct()
    got = {}
    for r in tree_attribution(some, model, ["id"]).collect():
        got.setdefault((r.id, r.target), {})[r.feature] = (r.phi, r.base)
    ready = model.prep.transform(some).select("id", "features").collect()
    for target in spec.target:
        trees = node_tables(model.models[target])
        for r in ready:
            x = r.features.toArray()
            want, base = _brute_force(trees, x, len(x))
            phis = got[r.id, target]
            assert len(phis) == len(x)
            assert np.allclose([v for v, _ in phis.values()], want, atol=1e-9)
            assert next(iter(phis.values()))[1] == pytest.approx(base)


def test_attributions_add_up_to_the_prediction_for_every_row(spark, fitted):
    df, spec, model = fitted
    total = tree_attribution(df, model, ["id"]).groupBy("id", "target").agg(F.sum("phi").alias("phi"), F.sum("base").alias("b"), F.count(F.lit(1)).alias("n"))
    pred = {(r.id, t): r[t + "_pred"] for r in model.predict(df).collect() for t in spec.target}
    rows = total.collect()
    features = len(model.prep.transform(df).first().features)
    assert len(rows) == 502 * 2  # the repeated row is explained twice under its one key
    for r in rows:
        times = 2 if r.id == 900 else 1
        assert r.n == features * times
        assert (r.phi + r.b / features) / times == pytest.approx(pred[r.id, r.target], abs=1e-9)


def test_what_cannot_be_explained_is_an_error_and_nothing_gives_nothing(spark, fitted):
    df, spec, model = fitted
    assert tree_attribution(df.limit(0), model, ["id"]).count() == 0
    with pytest.raises(MissingColumnsError):
        tree_attribution(df.drop("x1"), model, ["id"])
    with pytest.raises(ValidationError):
        tree_attribution(df, fit_linear(df, FeatureSpec(num=["x1"], target=["y1"]), "y1"), ["id"])
