"""The durable log, resuming a search that was ended, and the rules run on its steps."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratecraft.operators.features import FeatureSpec, holdout_split, preprocess_pipeline
from ratecraft.operators.metrics import regression_metrics
from ratecraft.operators.models import FEATURES, _estimator, trial_search
from ratecraft.operators.trial_log import END, TrialLog, staged_search, step_losses
from ratecraft.operators.trials import best_trial, early_stop, median_prune, trial_state_counts

SPEC = FeatureSpec(num=["x1", "x2"], target=["y1", "y2"])
SPACE = {"n_estimators": ("int", 2, 4), "max_depth": ("int", 1, 2), "learning_rate": ("float", 0.01, 1.0)}


class Ended(Exception):
    pass


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(1)
    rows = [(i, float(a), float(b), float(2 * a - b), None if i % 9 == 0 else float(a * b)) for i, (a, b) in enumerate(rng.normal(size=(300, 2)))]
    return spark.createDataFrame(rows, "id long, x1 double, x2 double, y1 double, y2 double")


def _search(spark, data, path, **more):
    log = TrialLog(spark, path)
    staged_search(data, SPEC, ["y1"], SPACE, log, n_trials=4, rungs=(2, 4), keys=["id"], seed=3, patience=2,
                  min_trials=2, parallelism=1, **more)
    return log


def _rows(log):
    return sorted((r.trial_id, r.rung, r.step, r.value, r.state, sorted(r.params.items()), r.error) for r in log.read().collect())


def test_entries_are_written_once(spark, tmpdir_path):
    log = TrialLog(spark, os.path.join(tmpdir_path, "log"))
    assert log.read().count() == 0 and log.entries() == set()
    for value in (9.0, 1.0):  # the entry written again replaces itself
        log.append(4, 0, [(0, value, "RUNNING", {"a": "1"}, None), (1, value / 2, "RUNNING", {"a": "1"}, None)])
    TrialLog(spark, log.path).append(5, END, [(0, None, "FAIL", {}, "broken")])
    assert log.entries() == {(4, 0), (5, END)}
    assert sorted((r.step, r.value) for r in log.steps().collect()) == [(0, 1.0), (1, 0.5)]
    assert [r.error for r in log.results().collect()] == ["broken"]


def test_losses_of_steps_are_those_of_shorter_fits(spark, data):
    split = holdout_split(data, ["id"], 0.3, 1, col="_is_test")
    prep = preprocess_pipeline(split, SPEC, FEATURES, fit_on=split.where("not _is_test"))
    ready = prep.transform(split).select(FEATURES, "_is_test", *SPEC.target).repartition(3).persist()
    train, test = ready.where("not _is_test"), ready.where("_is_test")
    params = {"seed": 3, "max_depth": 3, "learning_rate": 0.5, "subsample": 0.8}
    losses = step_losses(train, test, SPEC.target, {**params, "n_estimators": 4})
    for n in (1, 4):
        scored = test
        for t in SPEC.target:
            scored = _estimator("gbt", t, {**params, "n_estimators": n}).fit(train.where(F.col(t).isNotNull())) \
                .setPredictionCol(t + "_pred").transform(scored)
        want = regression_metrics(scored, {t: t + "_pred" for t in SPEC.target}).agg(F.avg("rmse")).first()[0]
        assert losses[n - 1] == pytest.approx(want)
    ready.unpersist()


@pytest.mark.parametrize("after", [2, 5])
def test_a_search_that_was_ended_goes_on_as_an_unbroken_one(spark, data, tmpdir_path, unbroken, monkeypatch, after):
    path, written = os.path.join(tmpdir_path, "log"), TrialLog.append

    def append(self, *args):
        if len(self.entries()) >= after:
            raise Ended
        written(self, *args)

    monkeypatch.setattr(TrialLog, "append", append)
    with pytest.raises(Ended):
        _search(spark, data, path)
    assert len(TrialLog(spark, path).entries()) == after
    counted = []
    monkeypatch.setattr(TrialLog, "append", lambda self, *args: (counted.append(args[:2]), written(self, *args)))
    log = _search(spark, data, path)
    assert _rows(log) == unbroken[0]
    assert len(counted) == len(unbroken[1]) - after  # nothing that was written is run again
    assert best_trial(log.results()).collect() == unbroken[2]


@pytest.fixture(scope="module")
def unbroken(spark, data, tmp_path_factory):
    log = _search(spark, data, str(tmp_path_factory.mktemp("unbroken")))
    return _rows(log), log.entries(), best_trial(log.results()).collect()


def test_rules_run_on_the_log(spark, data, tmpdir_path):
    log = _search(spark, data, os.path.join(tmpdir_path, "log"))
    ends = {r.trial_id: r for r in log.results().collect()}
    assert set(ends) == set(range(4))
    states = {r["state"]: r["n"] for r in trial_state_counts(log.results()).collect()}
    assert states.get("PRUNED", 0) >= 1 and states["COMPLETE"] >= 1 and set(states) <= {"PRUNED", "COMPLETE"}
    steps = log.steps()
    per = {r.trial_id: r for r in steps.groupBy("trial_id").agg(F.sort_array(F.collect_list("step")).alias("s"), F.min("value").alias("m")).collect()}
    for t, r in per.items():
        assert r.s == list(range(len(r.s)))  # every step once
        assert ends[t].value == r.m
    assert early_stop(steps, "trial_id", "step", "value", patience=2).count() == 4
    pruned = {r.trial_id for r in median_prune(steps, "trial_id", "step", "value", min_trials=2).where("pruned_step is not null").collect()}
    assert {t for t, r in ends.items() if r.state == "PRUNED"} <= pruned
    # a second call finds everything done
    before = _rows(log)
    assert _rows(_search(spark, data, log.path)) == before


def test_failed_fits_end_their_trial_only(spark, data, tmpdir_path):
    space = {"max_depth": ("choice", [2, 99]), "n_estimators": ("int", 2, 2)}
    log = TrialLog(spark, os.path.join(tmpdir_path, "log"))
    staged_search(data, SPEC, ["y1"], space, log, n_trials=4, rungs=(2,), keys=["id"], seed=1)
    got = {(r.params["max_depth"], r.state) for r in log.results().collect()}
    assert got == {("2", "COMPLETE"), ("99", "FAIL")}


def test_trial_search_with_a_log_resumes(spark, data, tmpdir_path, monkeypatch):
    path, written = os.path.join(tmpdir_path, "log"), TrialLog.append

    def append(self, *args):
        if len(self.entries()) >= 2:
            raise Ended
        written(self, *args)

    def run():
        return trial_search(data, SPEC, ["y1"], SPACE, n_trials=3, seed=2, keys=["id"], parallelism=1, log=TrialLog(spark, path))

    monkeypatch.setattr(TrialLog, "append", append)
    with pytest.raises(Ended):
        run()
    monkeypatch.setattr(TrialLog, "append", written)
    whole = trial_search(data, SPEC, ["y1"], SPACE, n_trials=3, seed=2, keys=["id"], parallelism=1)
    got = {r.trial_id: (r.value, r.state) for r in run().collect()}
    assert got == {r.trial_id: (pytest.approx(r.value), r.state) for r in whole.collect()}
