"""Boosted trials grown together: the trees of Spark ML's fits, from passes that all trials share."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratecraft.errors import ValidationError
from ratecraft.operators import boosting, models
from ratecraft.operators.features import FeatureSpec
from ratecraft.operators.metrics import regression_metrics
from ratecraft.operators.models import _estimator, _prepared_split, trial_search
from ratecraft.plans import catalogue

SPEC = FeatureSpec(num=["a", "b"], cat=["c", "d"], target=["y1", "y2"])
SPACE = {"n_estimators": ("int", 2, 3), "max_depth": ("int", 2, 3), "learning_rate": ("float", 0.1, 0.9),
         "max_bins": ("choice", [8, 32]), "min_child_weight": ("choice", [1, 40]), "gamma": ("choice", [0.0, 0.02])}


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(3000):
        a, b, c, d = rng.normal(), float(rng.integers(0, 12)), f"k{rng.integers(0, 30)}", "uv"[int(rng.integers(0, 2))]
        y1 = 3 * a + (b > 5) * 2 + (c in ("k3", "k7")) * 4 - (d == "u") + rng.normal() / 5
        y2 = a * b + len(c) + rng.normal() / 5
        rows.append((i, None if i % 11 == 0 else float(a), b, None if i % 13 == 0 else c, d, float(y1), None if i % 7 == 0 else float(y2)))
    return spark.createDataFrame(rows, "id long, a double, b double, c string, d string, y1 double, y2 double").coalesce(1)


def _spark_ml(data, params, targets):
    rows = _prepared_split(data, SPEC, targets, ["id"], 0.2, 42)
    scored = rows.where("_is_test")
    for t in targets:
        train = rows.where(~F.col("_is_test") & F.col(t).isNotNull())
        scored = _estimator("gbt", t, models._typed(params)).fit(train).setPredictionCol(t + "_pred").transform(scored)
    rows.unpersist()
    return regression_metrics(scored, {t: t + "_pred" for t in targets}).agg(F.avg("rmse")).first()[0]


def _no_spark_ml(*_, **__):
    raise AssertionError("a fit of Spark ML")


def test_trials_equal_the_fits_of_spark_ml(data, monkeypatch):
    """Nulls in features and in one target, categories of many levels, all parameters but the draw of rows."""
    with monkeypatch.context() as m:
        m.setattr(models, "_estimator", _no_spark_ml)
        log = trial_search(data, SPEC, SPEC.target, SPACE, n_trials=3, keys=["id"], parallelism=2).collect()
    assert [r.trial_id for r in log] == [0, 1, 2] and {r.state for r in log} == {"COMPLETE"}
    for r in log:
        assert r.value == pytest.approx(_spark_ml(data, r.params, SPEC.target), rel=1e-9)


def test_models_on_all_rows_equal_those_of_spark_ml(spark, data, monkeypatch, tmpdir_path):
    """``fit_multi_target`` grows the trees of all targets together; what it returns are models of Spark ML, saved and loaded as such."""
    params = {"n_estimators": 4, "max_depth": 3, "learning_rate": 0.3, "max_bins": 16, "min_child_weight": 3, "seed": 7}
    train = data.where("id % 5 > 0")
    with monkeypatch.context() as m:
        m.setattr(models, "_estimator", _no_spark_ml)
        with pytest.raises(AssertionError, match="a fit of Spark ML"):  # these are too few rows
            models.fit_multi_target(train, SPEC, SPEC.target, params, fit_on=train)
        m.setattr(models, "SHARED_ROWS", 1)
        model = models.fit_multi_target(train, SPEC, SPEC.target, params, fit_on=train)
    model.save(f"{tmpdir_path}/model")
    loaded = models.MultiTargetModel.load(f"{tmpdir_path}/model").predict(data)
    ready, both = model.prep.transform(data), model.predict(data).join(loaded.select("id", *[F.col(t + "_pred").alias(t + "_loaded") for t in SPEC.target]), "id")
    for t in SPEC.target:
        plain = _estimator("gbt", t, params).fit(model.prep.transform(train).where(F.col(t).isNotNull()))
        ours, theirs = (m.featureImportances.toArray() for m in (model.models[t], plain))
        # the two levels of d split alike: Spark ML takes either of them, by rounding
        assert ours[:-2] == pytest.approx(theirs[:-2], abs=1e-9) and sum(ours[-2:]) == pytest.approx(sum(theirs[-2:]), abs=1e-9)
        assert model.models[t].treeWeights == plain.treeWeights and model.models[t].numFeatures == plain.numFeatures
        assert [x.depth for x in model.models[t].trees] == [x.depth for x in plain.trees]
        both = both.join(plain.setPredictionCol(t + "_plain").transform(ready).select("id", t + "_plain"), "id")
    off = [F.max(F.abs(F.col(f"{t}_pred") - F.col(f"{t}_{x}"))) for t in SPEC.target for x in ("plain", "loaded")]
    assert both.count() == 3000 and max(both.agg(*off).first()) < 1e-9


def test_a_fit_that_draws_rows_is_left_to_spark_ml(data, monkeypatch):
    monkeypatch.setattr(models, "_estimator", _no_spark_ml)
    monkeypatch.setattr(models, "SHARED_ROWS", 1)
    for params in ({"subsample": 0.5}, {"colsample_bytree": 0.5}):
        with pytest.raises(AssertionError, match="a fit of Spark ML"):
            models.fit_multi_target(data, SPEC, SPEC.target, {"n_estimators": 1, **params})


def test_more_trials_than_asked_at_a_time_change_nothing(data, monkeypatch):
    space = {"n_estimators": ("int", 1, 3), "max_depth": ("int", 2, 3), "subsample": ("choice", [0.5, 1.0])}
    sizes, plain = [], boosting.Boosted.__init__
    monkeypatch.setattr(boosting.Boosted, "__init__", lambda self, *a: sizes.append(len(a[5])) or plain(self, *a))
    got = []
    for cells in (1 << 26, 0):
        monkeypatch.setattr(models, "BATCH_CELLS", cells)
        log = trial_search(data, SPEC, SPEC.target, space, n_trials=5, keys=["id"], parallelism=2).collect()
        got.append({r.trial_id: r.value for r in log})
    assert sizes == [5, 2, 2, 1] and got[0] == {k: pytest.approx(v, rel=1e-9) for k, v in got[1].items()}


def test_the_search_query_runs_the_trials_of_the_reference(spark, monkeypatch):
    asked = {}

    def told(df, spec, targets, space, **more):
        asked.update(more, trials=models.sample_space(spark, space, more["n_trials"], more["seed"]).drop("params").distinct().count())
        return spark.createDataFrame([], models.TRIAL_SCHEMA)

    monkeypatch.setattr(models, "trial_search", told)
    monkeypatch.setattr(catalogue, "model_table", lambda *_: None)
    assert catalogue.search(spark, "").count() == 0
    assert asked["n_trials"] == asked["trials"] == 50


def test_a_draw_of_rows_repeats(data):
    space = {"n_estimators": ("int", 2, 2), "max_depth": ("int", 2, 2), "subsample": ("choice", [0.3, 1.0])}
    got = [{r.trial_id: (r.params["subsample"], r.value) for r in
            trial_search(data, SPEC, SPEC.target, space, n_trials=4, keys=["id"], parallelism=p).collect()} for p in (4, 1)]
    assert got[0] == {k: (s, pytest.approx(v, rel=1e-9)) for k, (s, v) in got[1].items()}
    by_rate = {s: v for s, v in got[0].values()}
    assert len(by_rate) == 2 and by_rate["0.3"] != by_rate["1.0"]
    # a draw of rows costs some accuracy, but the fit remains one of the same function
    assert by_rate["0.3"] == pytest.approx(_spark_ml(data, {"n_estimators": 2, "max_depth": 2, "subsample": 0.3}, SPEC.target), rel=0.1)


def test_what_is_not_finite_or_not_taken_is_left_to_spark_ml(data):
    space = {"n_estimators": ("choice", [2, -1]), "max_depth": ("int", 2, 2)}
    log = trial_search(data, SPEC, ["y1"], space, n_trials=4, keys=["id"]).collect()
    assert {(r.params["n_estimators"], r.state) for r in log} == {("2", "COMPLETE"), ("-1", "FAIL")}
    assert [r.trial_id for r in log] == list(range(4))
    odd = data.withColumn("y1", F.when(F.col("id") == 5, float("nan")).otherwise(F.col("y1")))
    with pytest.raises(ValidationError, match="every trial failed"):
        trial_search(odd, SPEC, ["y1"], {"n_estimators": ("int", 2, 2)}, n_trials=1, keys=["id"])


def test_a_failing_shared_fit_is_done_alone(data, monkeypatch):
    monkeypatch.setattr(boosting.Boosted, "fit", _no_spark_ml)
    log = trial_search(data, SPEC, ["y1"], {"n_estimators": ("int", 2, 2), "max_depth": ("int", 2, 2)}, n_trials=2, keys=["id"]).collect()
    assert {r.state for r in log} == {"COMPLETE"}


def test_work_of_a_row_is_by_column_and_not_by_level(spark):
    """A block of binned rows has one number per source column, whatever the levels of a category."""
    rows = spark.range(1000).selectExpr("CAST(id AS double) AS z", "CAST(id % 300 AS double) AS i", "CAST(id % 7 AS double) AS y", "id % 5 = 0 AS _is_test")
    fits = boosting.Boosted(rows, ["z"], ["i"], [300], ["y"], [boosting.grown({"maxIter": 1})], {(0, 32): [np.arange(10.0)]})
    sizes = fits.state.select(F.sum("train"), F.sum(F.length("bins")), F.sum(F.length("y")), F.sum(F.length("f"))).first()
    assert tuple(sizes) == (800, 1000 * 2 * 2, 8000, 8000)
    fits.unpersist()


def test_edges():
    assert boosting.edges(np.array([1.0, 3.0, 3.0, 7.0]), 32).tolist() == [2.0, 5.0]
    assert boosting.edges(np.array([2.0, 2.0]), 32).tolist() == []
    assert boosting.edges(np.repeat(np.arange(100.0), 3), 4).tolist() == [24.5, 49.5, 74.5]
