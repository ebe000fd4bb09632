import numpy as np
import pytest
from pyspark.sql import functions as F

from ratecraft.operators.fill import mean_fill, median_fill
from ratecraft.operators.profile import (
    correlation_matrix, cross_correlation, describe, missing_summary, mutual_information, profile,
    variance_inflation,
)


def test_missing_nan_mix_and_half_even(spark):
    # 8 rows: x has 1 NaN + 0 NULL (12.5%), y has 3 missing (37.5%), s none
    rows = [(float("nan"), None, "a"), (1.0, None, "b"), (2.0, None, "c")] + \
           [(3.0, 1.0, "d")] * 5
    df = spark.createDataFrame(rows, "x double, y double, s string")
    out = missing_summary(df).collect()
    assert [r["column"] for r in out] == ["y", "x", "s"]
    assert [r["missing_count"] for r in out] == [3, 1, 0]
    assert [r["missing_percent"] for r in out] == [37.5, 12.5, 0.0]
    assert out[0]["dtype"] == "double"


def test_half_even_rounding(spark):
    # 1 of 800 missing = 0.125% -> 0.12 ; 3 of 800 = 0.375% -> 0.38
    rows = [(None, None)] + [(1.0, None)] * 2 + [(1.0, 1.0)] * 797
    df = spark.createDataFrame(rows, "a double, b double")
    out = {r["column"]: r["missing_percent"] for r in missing_summary(df).collect()}
    assert out == {"a": 0.12, "b": 0.38}


def test_empty_profiles(spark):
    df = spark.createDataFrame([], "a double, b string")
    out = missing_summary(df).collect()
    assert [(r["missing_count"], r["missing_percent"]) for r in out] == [(0, None), (0, None)]
    d = describe(df, ["a"]).collect()
    assert d[0]["count"] == 0 and d[0]["p50"] is None


def test_describe_quartiles(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    r = describe(df).first()
    assert (r["count"], r["min"], r["p25"], r["p50"], r["p75"], r["max"]) == (4, 1.0, 1.75, 2.5, 4.75, 10.0)
    assert r["std"] == pytest.approx(4.082483, abs=1e-6)
    p = profile(df).first()
    assert p["missing_count"] == 0 and p["dtype"] == "double"


def test_pairwise_and_constant_corr(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 1.0, 5.0), (3.0, None, 5.0), (None, 4.0, 5.0),
                                (5.0, 9.0, 5.0)], "a double, b double, c double")
    m = {(r["col_a"], r["col_b"]): r["corr"] for r in correlation_matrix(df).collect()}
    assert m[("a", "b")] == pytest.approx(0.936766, abs=1e-6)
    assert m[("a", "b")] == m[("b", "a")]
    assert m[("a", "c")] is None and m[("c", "c")] is None
    assert m[("a", "a")] == pytest.approx(1.0)


def test_cross_correlation_groups_and_mask(spark):
    rows = [("g1", float(i), float(2 * i), float(i % 2)) for i in range(10)] + \
           [(None, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "g string, t double, x double, y double")
    out = {(r["group"], r["feature"]): r["corr"]
           for r in cross_correlation(df, ["t"], "g", threshold=0.5).collect()}
    assert set(out) == {("g1", "x"), ("g1", "y")}
    assert out[("g1", "x")] == pytest.approx(1.0) and out[("g1", "y")] is None


def test_vif_two_columns(spark):
    rng = np.random.default_rng(0)
    a = rng.normal(size=200)
    b = a + rng.normal(size=200)
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a double, b double")
    r = np.corrcoef(a, b)[0, 1]
    out = {row["feature"]: row["vif"] for row in variance_inflation(df, ["a", "b"]).collect()}
    assert out["a"] == pytest.approx(1 / (1 - r * r)) and out["b"] == pytest.approx(1 / (1 - r * r))


def test_vif_singular_is_null(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i) for i in range(10)], "a double, b double")
    assert all(r["vif"] is None for r in variance_inflation(df, ["a", "b"]).collect())


def test_mutual_information_orders_dependence(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=2000)
    rows = [(float(v), float(v + 0.1 * rng.normal()), float(rng.normal())) for v in x]
    df = spark.createDataFrame(rows, "t double, close double, noise double")
    out = mutual_information(df, ["close", "noise"], ["t"]).collect()
    assert out[0]["feature"] == "close" and out[0]["mi"] > out[1]["mi"] >= -1e-9


def test_fills(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, None), (None, 3), (float("nan"), 4), (10.0, None)],
                               "x double, n bigint")
    med = median_fill(df, ["x", "n"], truncate=["n"]).collect()
    assert [r["x"] for r in med] == [1.0, 2.0, 2.0, 2.0, 10.0]
    assert [r["n"] for r in med] == [1, 3, 3, 4, 3]
    mean = mean_fill(df, ["x"]).collect()
    assert mean[2]["x"] == pytest.approx(13.0 / 3)
