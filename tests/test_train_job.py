"""Train, score with intervals and attribute, end to end over files."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratecraft.errors import MissingColumnsError, ValidationError
from ratecraft.operators.features import FeatureSpec
from ratecraft.operators.trial_log import END, TrialLog
from ratecraft.plans.attribute_job import attribute_job
from ratecraft.plans.score_job import score
from ratecraft.plans.train_job import run_metadata, train

SPEC = FeatureSpec(num=["x1", "x2"], cat=["c"], target=["y1", "y2"], drop=["junk"])
SPACE = {"n_estimators": ("int", 2, 3), "max_depth": ("int", 2, 2), "learning_rate": ("float", 0.5, 0.9)}


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    rng = np.random.default_rng(6)
    rows = [(i, float(a), None if i % 9 == 0 else float(b), None if i % 20 == 0 else str(c), float(3 * a + (c == "u")), float(a - 2 * b), "j")
            for i, (a, b, c) in enumerate(zip(rng.normal(size=400), rng.normal(size=400), rng.choice(["u", "v"], 400)))]
    path = str(tmp_path_factory.mktemp("train") / "table.parquet")
    spark.createDataFrame(rows, "id long, x1 double, x2 double, c string, y1 double, y2 double, junk string").write.parquet(path)
    return path


def test_table_to_model_to_scores_to_attributions(spark, table, tmpdir_path):
    model_path = os.path.join(tmpdir_path, "model")
    df = spark.read.parquet(table)
    fitted = train(df, SPEC, model_path, ["id"], space=SPACE, trials=2, rungs=(2, 3), iterations=30, seed=5)
    meta = run_metadata(spark, model_path)
    assert meta["cardinalities"] == {"c": {"levels": 3, "embedding": 2}}
    assert meta["best_params"]["n_estimators"] <= 3 and set(meta["holdout_metrics"]) == {"y1", "y2"}
    assert all(m["r2"] > 0.3 for m in meta["holdout_metrics"].values()) and sum(meta["trials"].values()) == 2
    plain = score(spark, table, model_path)
    assert plain.columns == [*df.columns, "y1_pred", "y2_pred"]
    want = {r.id: r.y1_pred for r in fitted.predict(df).collect()}
    assert all(r.y1_pred == pytest.approx(want[r.id]) for r in plain.collect())
    ranged = score(spark, table, model_path, iterations=20)
    assert ranged.where(~((F.col("y1_lower_95") <= F.col("y1_pred")) & (F.col("y1_pred") <= F.col("y1_upper_95")))).count() == 0
    assert ranged.count() == 400
    with pytest.raises(ValidationError):
        score(spark, table, model_path, iterations=31)
    top = attribute_job(spark, table, model_path, ["id"], os.path.join(tmpdir_path, "phi"), top=2)
    assert {(r.target, r.feature) for r in top.where("rank = 1").collect()} <= {("y1", "x1"), ("y2", "x1"), ("y2", "x2")}
    values = spark.read.parquet(os.path.join(tmpdir_path, "phi", "values"))
    sums = {(r.id, r.target): r.s + r.b for r in values.groupBy("id", "target").agg(F.sum("phi").alias("s"), F.first("base").alias("b")).collect()}
    for r in plain.collect():
        assert sums[r.id, "y1"] == pytest.approx(r.y1_pred) and sums[r.id, "y2"] == pytest.approx(r.y2_pred)
    assert attribute_job(spark, table, model_path, ["id"], os.path.join(tmpdir_path, "some"), sample=15).count() > 0
    assert spark.read.parquet(os.path.join(tmpdir_path, "some", "values")).select("id").distinct().count() == 15


def test_a_job_started_again_fits_no_trial_twice(spark, table, tmpdir_path, monkeypatch):
    model_path = os.path.join(tmpdir_path, "model")
    df = spark.read.parquet(table)
    spec = FeatureSpec(num=["x1"], target=["y1"])
    train(df, spec, model_path, ["id"], space=SPACE, trials=2, rungs=(2,), seed=5)
    first = run_metadata(spark, model_path)

    def append(self, *args):
        raise AssertionError("a trial was run again")

    monkeypatch.setattr(TrialLog, "append", append)
    train(df, spec, model_path, ["id"], space=SPACE, trials=2, rungs=(2,), seed=5)
    again = run_metadata(spark, model_path)
    assert again["best_params"] == first["best_params"] and again["best_value"] == first["best_value"]
    assert {t for t, r in TrialLog(spark, os.path.join(model_path, "trials")).entries() if r == END} == {0, 1}


def test_wrong_columns_are_named_before_any_fit(spark, table, tmpdir_path):
    df = spark.read.parquet(table)
    with pytest.raises(MissingColumnsError):
        train(df, FeatureSpec(num=["absent"], target=["y1"]), tmpdir_path, ["id"])
    with pytest.raises(MissingColumnsError):
        train(df, FeatureSpec(num=["x1"], target=["y1"]), tmpdir_path, ["nokey"])
    with pytest.raises(ValidationError):
        train(df, FeatureSpec(num=["x1"], target=["y1", "y1"]), tmpdir_path, ["id"])
