"""Blocks of normal equations against numpy: replicate fits and leave-fold-out fits."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratecraft.errors import ValidationError
from ratecraft.operators.features import FeatureSpec, kfold_assign, preprocess_pipeline
from ratecraft.operators.models import FEATURES, BootstrapEnsemble, bootstrap_coefficients
from ratecraft.operators.normal_equations import cv_linear, poisson_table


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(2)
    out = []
    for i in range(600):
        x1, x2, c = 1e5 + rng.normal(), float(rng.normal()), str(rng.choice(["a", "b", "c"]))
        y1 = 2 * (x1 - 1e5) - x2 + (c == "b") + rng.normal() * 0.1
        out.append((i, None if i % 7 == 0 else float(x1), x2 if i % 11 else float("nan"), None if i % 50 == 0 else c,
                    float(y1), None if i % 3 == 0 else float(x2 + rng.normal())))
    return out, spark.createDataFrame(out, "id long, x1 double, x2 double, c string, y1 double, y2 double").repartition(5)


def _weights(i, b, seed):
    h = hashlib.md5(f"{i}|{seed}|{b // 2}".encode()).hexdigest()
    u = int(h[:13] if b % 2 == 0 else h[16:29], 16) / 2.0 ** 52
    return float(np.searchsorted(poisson_table(), u, "right"))


def test_poisson_table_is_whole():
    table = poisson_table()
    assert table[0] == pytest.approx(np.exp(-1)) and table[-1] >= 1 - 2.0 ** -52 and len(table) > 15


@pytest.mark.parametrize("reg", [0.0, 0.3])
def test_replicates_equal_weighted_least_squares(spark, rows, reg):
    data, df = rows
    spec = FeatureSpec(num=["x1", "x2"], cat=["c"], target=["y1", "y2"])
    feats = preprocess_pipeline(df, spec, FEATURES).transform(df)
    got = {(r.b, r.target): r.coefficients for r in bootstrap_coefficients(feats, ["y1", "y2"], ["id"], 5, reg, 9).collect()}
    assert set(got) == {(b, t) for b in range(5) for t in ("y1", "y2")}
    local = feats.select("id", FEATURES, "y1", "y2").collect()
    for (b, t), beta in got.items():
        kept = [r for r in local if r[t] is not None]
        x = np.array([[1.0, *r[FEATURES].toArray()] for r in kept])
        y, w = np.array([r[t] for r in kept]), np.array([_weights(r.id, b, 9) for r in kept])
        penalty = np.diag([0.0] + [reg * w.sum()] * (x.shape[1] - 1))
        want = np.linalg.lstsq(x.T @ (x * w[:, None]) + penalty, x.T @ (w * y), rcond=None)[0]
        assert np.allclose(x @ beta, x @ want, atol=1e-6)


def test_ensemble_without_rows_is_an_error(spark, rows):
    _, df = rows
    spec = FeatureSpec(num=["x1"], target=["y1"])
    with pytest.raises(ValidationError):
        BootstrapEnsemble.fit(df.withColumn("y1", F.lit(None).cast("double")).limit(0), spec, ["y1"], ["id"], 3)


def test_fold_fits_equal_numpy(spark, rows):
    data, df = rows
    spec = FeatureSpec(num=["x1", "x2"], cat=["c"])
    regs = [0.0, 0.2]
    got = {(r.fold, r.target, r.reg): r for r in cv_linear(df, spec, ["y1", "y2"], ["id"], 3, regs, 5).collect()}
    assert len(got) == 3 * 2 * 2
    fold = {r.id: r.fold for r in kfold_assign(df.select("id"), ["id"], 3, 5).collect()}
    levels = ["a", "b", "c", "nan"]
    for (k, t, reg), r in got.items():
        at = 4 if t == "y1" else 5
        train = [d for d in data if fold[d[0]] != k and d[at] is not None]
        valid = [d for d in data if fold[d[0]] == k and d[at] is not None]
        num = np.array([[np.nan if v is None else v for v in d[1:3]] for d in train])
        mean = np.nanmean(num, axis=0)
        sd = np.where(np.isnan(num), mean, num).std(axis=0)

        def design(part):
            x = np.array([[np.nan if v is None else v for v in d[1:3]] for d in part])
            z = (np.where(np.isnan(x), mean, x) - mean) / sd
            return np.column_stack([np.ones(len(part)), z, [[(d[3] or "nan") == v for v in levels] for d in part]])

        x, y = design(train), np.array([d[at] for d in train])
        penalty = np.diag([0.0] + [reg * len(train)] * (x.shape[1] - 1))
        beta = np.linalg.lstsq(x.T @ x + penalty, x.T @ y, rcond=None)[0]
        xv, yv = design(valid), np.array([d[at] for d in valid])
        assert (r.n_train, r.n_valid) == (len(train), len(valid))
        assert np.allclose(x @ [r.intercept, *r.coefficients], x @ beta, atol=1e-6)
        error = yv - xv @ beta
        assert r.mse == pytest.approx(float(error @ error) / len(valid), rel=1e-6)
        assert r.r2 == pytest.approx(1 - float(error @ error) / float(((yv - yv.mean()) ** 2).sum()), abs=1e-6)


def test_fold_fits_of_odd_frames(spark, rows):
    _, df = rows
    assert cv_linear(df.limit(0), FeatureSpec(num=["x1"]), ["y1"], ["id"]).count() == 0
    constant = spark.createDataFrame([(i, 2.0, 3.0) for i in range(30)], "id long, x double, y double")
    for r in cv_linear(constant, FeatureSpec(num=["x"]), ["y"], ["id"]).collect():
        assert r.coefficients == [0.0] and r.intercept == pytest.approx(3.0) and r.mse == pytest.approx(0.0) and r.r2 is None
    with pytest.raises(ValidationError):
        cv_linear(df, FeatureSpec(num=["x1"]), ["y1"], [])
