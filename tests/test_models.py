import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratecraft.errors import AssetLoadError, MissingColumnsError, ValidationError
from ratecraft.operators.explain import (
    background_kmeans, background_sample, linear_attribution, mean_abs_topk, sampled_attribution,
)
from ratecraft.operators.features import FeatureSpec
from ratecraft.operators.metrics import regression_metrics
from ratecraft.operators.models import (
    BootstrapEnsemble, MultiTargetModel, fit_multi_target, fit_with_validation,
    gbt_params, random_search_cv, sample_space, trial_search,
)

SPEC = FeatureSpec(num=["x1", "x2"], cat=["c"], target=["y1", "y2"])


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    n = 400
    x1, x2 = rng.normal(size=n), rng.normal(size=n)
    c = rng.choice(["a", "b", "c"], size=n)
    y1 = 3 * x1 - 2 * x2 + (c == "b") * 1.5 + rng.normal(scale=0.1, size=n)
    y2 = x1 + 0.5 + rng.normal(scale=0.1, size=n)
    rows = [(i, float(a), float(b), str(k), float(u), float(v))
            for i, (a, b, k, u, v) in enumerate(zip(x1, x2, c, y1, y2))]
    return spark.createDataFrame(rows, "id bigint, x1 double, x2 double, c string, y1 double, y2 double")


def test_param_mapping():
    assert gbt_params({"n_estimators": 5, "colsample_bytree": 0.5, "gamma": 0.1}) == \
        {"maxIter": 5, "featureSubsetStrategy": "0.5", "minInfoGain": 0.1}
    with pytest.raises(ValidationError):
        gbt_params({"reg_alpha": 1})


def test_fit_predict_save_load(spark, data, tmpdir_path):
    model = fit_multi_target(data, SPEC, SPEC.target, {"n_estimators": 5, "max_depth": 3})
    pred = model.predict(data)
    assert pred.columns == data.columns + ["y1_pred", "y2_pred"]
    m = regression_metrics(pred, {"y1": "y1_pred", "y2": "y2_pred"}).collect()
    assert all(r["r2"] > 0.5 for r in m)
    path = os.path.join(tmpdir_path, "model")
    model.save(path)
    again = MultiTargetModel.load(path).predict(data)
    s1 = pred.agg(F.sum("y1_pred")).first()[0]
    s2 = again.agg(F.sum("y1_pred")).first()[0]
    assert s1 == pytest.approx(s2, rel=1e-12)
    with pytest.raises(AssetLoadError):
        MultiTargetModel.load(os.path.join(tmpdir_path, "absent"))
    with pytest.raises(MissingColumnsError):
        model.predict(data.drop("c"))


def test_validation_fit_runs(spark, data):
    m = fit_with_validation(data, SPEC, ["y1"], {"n_estimators": 5}, keys=["id"])
    assert m.predict(data).count() == 400


def test_bootstrap_interval_properties(spark, data, tmpdir_path):
    ens = BootstrapEnsemble.fit(data, SPEC, ["y1"], ["id"], iterations=8)
    out = ens.predict_interval(data).collect()
    assert all(r["y1_lower_95"] <= r["y1_pred"] <= r["y1_upper_95"] for r in out)
    path = os.path.join(tmpdir_path, "ens")
    ens.save(path)
    again = BootstrapEnsemble.load(path).predict_interval(data)
    assert again.agg(F.sum("y1_upper_95")).first()[0] == pytest.approx(
        sum(r["y1_upper_95"] for r in out), rel=1e-12)


def test_sample_space_repeatable_and_bounded(spark):
    space = {"n": ("int", 2, 4), "lr": ("logfloat", 0.01, 0.3), "ss": ("float", 0.5, 1.0),
             "k": ("choice", ["x", "y"])}
    a = sample_space(spark, space, 200, seed=3).collect()
    b = sample_space(spark, space, 200, seed=3).collect()
    assert a == b
    assert {r["n"] for r in a} == {2, 3, 4}
    assert all(0.01 <= r["lr"] <= 0.3 and 0.5 <= r["ss"] < 1.0 for r in a)
    with pytest.raises(ValidationError):
        sample_space(spark, {"x": ("float", 1.0, 1.0)}, 2)


def test_searches(spark, data):
    space = {"n_estimators": ("int", 2, 4), "max_depth": ("int", 2, 3)}
    best, table = random_search_cv(data, SPEC, ["y1", "y2"], space, n_iter=3, folds=2, keys=["id"])
    assert table.count() == 3 and set(best) == {"n_estimators", "max_depth"}
    log = trial_search(data, SPEC, ["y1"], space, n_trials=3, keys=["id"])
    assert log.where("state = 'COMPLETE'").count() == 3
    done = log.limit(2)
    more = trial_search(data, SPEC, ["y1"], space, n_trials=3, keys=["id"], done=done)
    assert more.count() == 1


def test_linear_attribution_sums(spark, data):
    w = {"x1": 2.0, "x2": -1.0}
    phi = linear_attribution(data, w, ["id"])
    sums = phi.groupBy("id").agg(F.sum("phi").alias("s"))
    mu = data.agg(F.avg("x1"), F.avg("x2")).first()
    check = data.join(sums, "id").select(
        (F.col("s") - (2.0 * (F.col("x1") - mu[0]) - 1.0 * (F.col("x2") - mu[1]))).alias("d"))
    assert check.agg(F.max(F.abs("d"))).first()[0] < 1e-9
    top = mean_abs_topk(phi, 1).collect()
    assert len(top) == 1 and top[0]["rank"] == 1 and top[0]["feature"] == "x1"


def test_sampled_attribution_matches_linear(spark, data):
    spec = FeatureSpec(num=["x1", "x2"], target=["y2"])
    model = fit_multi_target(data, spec, ["y2"], {"reg": 0.0}, kind="linear")
    explain = data.limit(5)
    bg = background_sample(data, 20, ["id"], seed=1)
    phi = sampled_attribution(explain, model, ["x1", "x2"], ["id"], bg, permutations=4)
    fx = {r["id"]: r["y2_pred"] for r in model.predict(explain).collect()}
    fbg = model.predict(bg).agg(F.avg("y2_pred")).first()[0]
    # efficiency: sum(phi) = f(x) - mean f(background)
    for r in phi.groupBy("id").agg(F.sum("phi").alias("s")).collect():
        assert r["s"] == pytest.approx(fx[r["id"]] - fbg, abs=1e-6)
    # linear model: phi_j = a_j (x_j - mean_bg x_j), i.e. X1 centred on the background
    probe = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (0.0, 1.0)], "x1 double, x2 double")
    p0, p1, p2 = [r["y2_pred"] for r in model.predict(probe).collect()]
    slopes = {"x1": p1 - p0, "x2": p2 - p0}
    bgm = bg.agg(F.avg("x1").alias("x1"), F.avg("x2").alias("x2")).first()
    x1 = {(r["id"], r["feature"]): r["phi"]
          for r in linear_attribution(explain, slopes, ["id"], means=bgm.asDict()).collect()}
    for r in phi.collect():
        assert r["phi"] == pytest.approx(x1[(r["id"], r["feature"])], abs=1e-6)


def test_kmeans_background(spark, data):
    bg = background_kmeans(data, ["x1", "x2"], ["c"], k=4)
    rows = bg.collect()
    assert len(rows) == 4 and sum(r["_weight"] for r in rows) == pytest.approx(1.0)
    assert all(r["c"] in ("a", "b", "c") for r in rows)
