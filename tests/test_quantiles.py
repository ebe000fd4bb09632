"""Bracketed quantiles against numpy: hot groups, repeated values, infinities, several rounds of narrowing."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ratecraft.operators import quantiles
from ratecraft.operators.quantiles import exact_quantiles, quantile_values

PROBS = [0.0, 0.001, 0.25, 0.5, 0.9, 0.975, 1.0]


@pytest.fixture(scope="module")
def wide(spark):
    rng = np.random.default_rng(4)
    n = 60_000
    pdf = pd.DataFrame({"a": rng.normal(size=n), "b": np.full(n, 7.25), "c": rng.integers(0, 3, n).astype(float), "d": rng.lognormal(0, 5, n),
                        "e": np.where(rng.random(n) < 0.3, np.nan, rng.random(n)), "f": np.nan, "g": np.where(rng.random(n) < 0.01, np.inf, rng.random(n))})
    pdf.loc[5, "g"] = -np.inf
    return pdf, spark.createDataFrame(pdf).repartition(7)


def _quantile(values, p):
    """numpy's linear rule without inf - inf."""
    x = np.sort(values)
    at = p * (len(x) - 1)
    lo, hi = int(np.floor(at)), int(np.ceil(at))
    return x[lo] if lo == hi else x[lo] + (at - lo) * (x[hi] - x[lo])


@pytest.mark.parametrize("limit", [None, 0])
def test_columns_of_any_shape(wide, limit):
    pdf, df = wide
    got = quantile_values(df, list(pdf.columns), PROBS, histogram_limit=limit)
    assert got["f"] == [None] * len(PROBS)
    for c in pdf.columns:
        if c != "f":
            want = [_quantile(pdf[c].dropna().to_numpy(), p) for p in PROBS]
            assert got[c] == pytest.approx(want, rel=1e-12), c


def test_few_rows_are_kept(wide, monkeypatch):
    """The rows that are selected from are a few per cent of the input, and narrowing makes them fewer."""
    pdf, df = wide
    seen = []
    select = quantiles._select

    def counted(rows, goal, keys, limit):
        seen.append((rows.count(), goal.agg(F.max("_rows")).first()[0]))
        return select(rows, goal, keys, limit)

    monkeypatch.setattr(quantiles, "_select", counted)
    quantile_values(df, ["a", "b"], [0.25, 0.5, 0.75])
    rows, most = seen[0]
    assert rows < 0.05 * 6 * len(pdf) and most < 0.05 * len(pdf)


@pytest.mark.parametrize("limit", [None, 0])
def test_groups_with_a_hot_one(spark, limit):
    rng = np.random.default_rng(7)
    n = 30_000
    keys = np.where(np.arange(n) < n // 3, 0, rng.integers(1, 60, n))
    pdf = pd.DataFrame({"k": keys, "v": np.where(keys % 5 == 0, rng.integers(0, 4, n), rng.normal(size=n))})
    pdf = pd.concat([pdf, pd.DataFrame({"k": [99, 99], "v": [1.5, 3.5]})])
    df = spark.createDataFrame(pdf).withColumn("k", F.when(F.col("k") != 59, F.col("k"))).repartition(5)
    got = {(None if pd.isna(r.k) else r.k, r.p): r.q for r in exact_quantiles(df, "v", PROBS, keys=["k"], histogram_limit=limit).collect()}
    assert len(got) == 61 * len(PROBS)
    for k, values in pdf.groupby("k")["v"]:
        for p in PROBS:
            assert got[None if k == 59 else k, p] == pytest.approx(_quantile(values.to_numpy(), p), rel=1e-12)


def test_without_keys_and_without_rows(spark):
    df = spark.createDataFrame([(3.0,), (1.0,), (2.0,), (float("nan"),), (None,)], "v double")
    assert {r.p: r.q for r in exact_quantiles(df, "v", [0.5, 1.0]).collect()} == {0.5: 2.0, 1.0: 3.0}
    assert exact_quantiles(df.limit(0), "v", [0.5]).count() == 0
    assert exact_quantiles(df.limit(0).withColumn("k", F.lit(1)), "v", [0.5], keys=["k"]).count() == 0
    assert quantile_values(df.limit(0), ["v"], [0.5]) == {"v": [None]}
