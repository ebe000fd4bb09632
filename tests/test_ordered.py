"""Skew-safe ordered operators against pandas/numpy on data with a hot key."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ratecraft.operators.ordered import exact_quantiles, ordered_scan, quantile_values


@pytest.fixture(scope="module")
def hot(spark):
    rng = np.random.default_rng(3)
    n = 3000
    # key 0 holds a third of all rows
    keys = np.where(np.arange(n) < n // 3, 0, rng.integers(1, 40, n))
    pdf = pd.DataFrame({"k": keys.astype("int64"), "t": rng.permutation(n).astype("int64"),
                        "v": rng.integers(0, 50, n).astype("float64")})
    return pdf, spark.createDataFrame(pdf)


def test_index_and_running(hot):
    pdf, df = hot
    out = ordered_scan(df, ["k"], ["t"], index="i",
                       running=[("max", "v", "mx", True), ("min", "v", "mn_prev", False)]).toPandas()
    exp = pdf.sort_values(["k", "t"]).copy()
    exp["i"] = exp.groupby("k").cumcount()
    exp["mx"] = exp.groupby("k")["v"].cummax()
    exp["mn_prev"] = exp.groupby("k")["v"].transform(lambda s: s.cummin().shift(1))
    m = exp.merge(out, on=["k", "t"], suffixes=("", "_s"))
    assert len(m) == len(pdf)
    assert (m["i"] == m["i_s"]).all()
    assert (m["mx"] == m["mx_s"]).all()
    assert ((m["mn_prev"] == m["mn_prev_s"]) | (m["mn_prev"].isna() & m["mn_prev_s"].isna())).all()


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_exact_quantiles_grouped(hot, limit):
    pdf, df = hot
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    out = exact_quantiles(df, "v", probs, keys=["k"], histogram_limit=limit).toPandas()
    for (k, p), q in out.set_index(["k", "p"])["q"].items():
        assert q == pytest.approx(np.quantile(pdf.loc[pdf.k == k, "v"], p), abs=1e-12)


def test_quartiles_fixture(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,), (float("nan"),)], "x double")
    q = quantile_values(df, ["x"], [0.25, 0.5, 0.75])["x"]
    assert q == pytest.approx([1.75, 2.5, 4.75])


def test_empty_group_gives_no_row(spark):
    df = spark.createDataFrame([("a", None), ("b", 1.0)], "k string, v double")
    out = exact_quantiles(df, "v", [0.5], keys=["k"]).collect()
    assert [(r["k"], r["q"]) for r in out] == [("b", 1.0)]


def test_hot_key_is_split_across_partitions(spark):
    """A key holding a third of the rows lands in several balanced range partitions."""
    from ratecraft.operators.ordered import chunk
    n = 6000
    rows = [(0 if i % 3 == 0 else 1 + i % 50, i, float(i % 7)) for i in range(n)]
    df = spark.createDataFrame(rows, "k int, t int, v double")
    parts = 12
    for order, salt in ((["t"], False), (["v"], True)):  # unique order / heavy ties + salt
        c = chunk(df, ["k"], order, salt=salt, num_partitions=parts)
        sizes = {r["_pid"]: r["n"] for r in c.groupBy("_pid").count().withColumnRenamed("count", "n").collect()}
        hot = c.where("k = 0").select("_pid").distinct().count()
        assert hot >= 3                      # the hot key spans several partitions
        assert max(sizes.values()) <= 3 * n / parts  # and no partition holds the whole key


@pytest.mark.parametrize("limit", [0, 5, 1_000_000])
def test_null_key_group_kept(spark, limit):
    """A NULL key is a group of its own in every strategy (limit 5 mixes them)."""
    rows = [(None, float(i)) for i in range(4)] + [("a", float(i)) for i in range(20)]
    df = spark.createDataFrame(rows, "k string, v double")
    out = {r["k"]: r["q"] for r in exact_quantiles(df, "v", [0.5], keys=["k"],
                                                   histogram_limit=limit).collect()}
    assert out == {None: 1.5, "a": 9.5}
