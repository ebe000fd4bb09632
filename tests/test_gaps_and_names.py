"""Gaps in features, values out of range, colliding names, required keys, failing candidates."""

import os

import pytest
from pyspark.sql import functions as F

from ratecraft.errors import ValidationError
from ratecraft.functions.scalar import rate_per, to_nullable_int, truncate_int
from ratecraft.operators.aggregates import pivot_mean
from ratecraft.operators.features import FeatureSpec, dummies
from ratecraft.operators.joins import remaining_trials
from ratecraft.operators.models import (
    BootstrapEnsemble, MultiTargetModel, fit_linear, fit_with_validation, random_search_cv, trial_search,
)
from ratecraft.operators.profile import variance_inflation
from ratecraft.plans.model_table_job import counts_table

SPEC = FeatureSpec(num=["x", "z"], target=["y"])


@pytest.fixture(scope="module")
def gaps(spark):
    df = spark.range(200).withColumn("x", F.when(F.col("id") % 5 != 0, F.col("id").cast("double")))
    return df.withColumn("z", F.when(F.col("id") % 7 != 0, (F.col("id") * 3 % 11).cast("double")).otherwise(float("nan"))) \
        .withColumn("y", 2.0 * F.coalesce("x", F.lit(0.0)) + 1.0)


def test_a_gap_is_filled_with_the_training_median(spark, gaps, tmpdir_path):
    model = fit_linear(gaps, SPEC, "y")
    path = os.path.join(tmpdir_path, "m")
    model.save(path)
    # the median of 1..199 without multiples of five is 100: a gap scores like that value
    rows = spark.createDataFrame([(None, 5.0), (100.0, 5.0), (100.0, None)], "x double, z double")
    got = [r.y_pred for r in MultiTargetModel.load(path).predict(rows).collect()]
    assert got[0] == pytest.approx(got[1]) and got[2] is not None
    assert model.predict(gaps).where(F.col("y_pred").isNull() | F.isnan("y_pred")).count() == 0
    ens = BootstrapEnsemble.fit(gaps, SPEC, ["y"], ["id"], iterations=6)
    out = ens.predict_interval(gaps)
    assert out.where(F.isnan("y_pred")).count() == 0
    assert len(ens.first_replicates(4).coefs["y"]) == 4
    with pytest.raises(ValidationError):
        ens.first_replicates(7)


def test_searches_need_keys_and_tell_failures(gaps):
    for call in (lambda: fit_with_validation(gaps, SPEC, ["y"]), lambda: trial_search(gaps, SPEC, ["y"], {}, n_trials=1),
                 lambda: random_search_cv(gaps, SPEC, ["y"], {}, n_iter=1)):
        with pytest.raises(ValidationError, match="keys"):
            call()
    log = trial_search(gaps, SPEC, ["y"], {"n_estimators": ("choice", [2, -1])}, n_trials=6, keys=["id"]).collect()
    assert {r.state for r in log} == {"COMPLETE", "FAIL"}
    assert all((r.error is None) == (r.state == "COMPLETE") for r in log)
    with pytest.raises(ValidationError, match="failed"):
        trial_search(gaps, SPEC, ["y"], {"n_estimators": ("choice", [-1])}, n_trials=2, keys=["id"])


def test_only_complete_trials_are_done(spark):
    done = spark.createDataFrame([(1, "COMPLETE"), (2, "FAIL"), (3, "PRUNED")], "trial_id long, state string")
    grid = spark.range(5).withColumnRenamed("id", "trial_id")
    assert sorted(r[0] for r in remaining_trials(grid, done).collect()) == [0, 2, 3, 4]


def test_numbers_out_of_range_are_null(spark):
    df = spark.createDataFrame([("1e30",), ("Infinity",), ("NaN",), ("12.7",), ("x",)], "t string")
    assert [r[0] for r in df.select(to_nullable_int("t")).collect()] == [None, None, None, 12, None]


def test_rate_scales_the_quotient(spark):
    df = spark.createDataFrame([(9, 1000), (1, 0)], "c long, p long")
    assert [r[0] for r in df.select(truncate_int(rate_per("c", "p"))).collect()] == [int(9 / 1000 * 100000), None]


def test_names_that_collide_raise(spark):
    df = spark.createDataFrame([("A b", 1, 1.0), ("a b", 1, 2.0)], "k string, i int, v double")
    with pytest.raises(ValidationError):
        dummies(df, "k", ["A b", "a b", "c"], drop_first=False)
    with pytest.raises(ValueError):
        pivot_mean(df, ["i"], "k", "v")


def test_a_constant_column_does_not_blank_the_others(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("a"), (F.col("id") * 7 % 13).cast("double").alias("b"),
                                 F.lit(3.0).alias("c"), (F.col("id") * 7 % 13 * 2.0).alias("d"))
    got = {r.feature: r.vif for r in variance_inflation(df, ["a", "b", "c"]).collect()}
    assert got["c"] is None and got["a"] == pytest.approx(got["b"]) and got["a"] >= 1
    got = {r.feature: r.vif for r in variance_inflation(df, ["a", "b", "d"]).collect()}
    assert got["b"] is None and got["d"] is None and got["a"] is not None


def test_each_count_file_is_read_by_its_own_header(spark, tmpdir_path):
    one, two = (os.path.join(tmpdir_path, f"cnt_{n}.txt") for n in ("agegte65", "agegte25lt45"))
    with open(one, "w") as f:
        f.write('"States"\t"States Code"\t"Count"\n"Ohio"\t"39"\t5\n---\n')
    with open(two, "w") as f:
        f.write('"States Code"\t"States"\t"Count"\n"01"\t"Alabama"\t7\n---\n')
    got = {(r["states"], r["states_code"], r["count"]) for r in counts_table(spark, [one, two]).collect() if r["count"] is not None}
    assert got == {("Ohio", "39", 5), ("Alabama", "01", 7)}
