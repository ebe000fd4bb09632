"""Co-moment blocks against pandas: gaps, constants, groups, wide tables, awkward scales."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ratecraft.operators.comoments import block_of, merged
from ratecraft.operators.profile import correlation_matrix, cross_correlation, variance_inflation


def _frame(n, p, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, p)) @ rng.normal(size=(p, p)) + 1e6 * (np.arange(p) % 3 == 0)
    x[rng.random((n, p)) < 0.1] = np.nan
    x[:, 1] = 0.1
    return pd.DataFrame(x, columns=[f"c{i}" for i in range(p)])


def test_blocks_merge_in_any_split():
    a = _frame(700, 5, 1).to_numpy()
    want = block_of(a, a)
    for cuts in ([1, 2, 3], [350], [10, 11, 600]):
        got = None
        for part in np.split(a, cuts):
            one = block_of(part, part)
            got = one if got is None else merged(got, one)
        assert np.array_equal(got[0], want[0])
        assert np.allclose(got[3:], want[3:], rtol=1e-9, atol=1e-6) and (got[3][1] == 0).all()


@pytest.mark.parametrize("p", [3, 60])
def test_matrix_equals_pandas(spark, p):
    pdf = _frame(800, p, 2)
    df = spark.createDataFrame(pdf).repartition(6)
    got = {(r.col_a, r.col_b): r.corr for r in correlation_matrix(df).collect()}
    want = pdf.corr()
    assert len(got) == p * p
    for (a, b), v in got.items():
        w = want.loc[a, b]
        assert (v is None) == bool(np.isnan(w)) and (v is None or v == pytest.approx(w, abs=1e-9))


def test_groups_and_nulls(spark):
    pdf = _frame(900, 4, 3)
    pdf["g"] = [["x", "y", None, "one"][min(i % 4, 3 if i == 3 else 2)] for i in range(900)]
    df = spark.createDataFrame(pdf).repartition(5)
    got = {(r.group, r.target, r.feature): r.corr for r in cross_correlation(df, ["c0"], "g", features=["c2", "c3"]).collect()}
    assert {k[0] for k in got} == {"x", "y", "one"}
    for (g, t, f), v in got.items():
        part = pdf[pdf.g == g]
        w = part[t].corr(part[f]) if len(part.dropna()) > 1 else np.nan
        assert (v is None) == bool(np.isnan(w)) and (v is None or v == pytest.approx(w, abs=1e-9))


def test_nothing_and_one_row(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    assert all(r.corr is None for r in correlation_matrix(df).collect())
    assert [r.corr for r in correlation_matrix(df.limit(0)).collect()] == [None] * 4
    assert [r.vif for r in variance_inflation(df.limit(0), ["a", "b"]).collect()] == [None, None]
    assert correlation_matrix(df.select(F.col("a").cast("int").alias("a"), "b")).count() == 4
