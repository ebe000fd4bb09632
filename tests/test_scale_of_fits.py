"""What one task of a fit reads stays bounded, and fan-outs spread, whatever the layout of the table."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ratecraft.operators import models, normal_equations as NE
from ratecraft.operators.explain import sampled_attribution
from ratecraft.operators.features import FeatureSpec
from ratecraft.operators.tree_attribution import Node, PathTable


@pytest.fixture()
def frame(spark):
    return spark.range(4000).selectExpr("id", "CAST(id % 7 AS DOUBLE) AS x", "CAST(id % 3 AS STRING) AS c",
                                        "CAST(id % 7 + 2 * (id % 3) AS DOUBLE) AS y").coalesce(1)


def test_spread_takes_more_partitions_for_more_rows(spark, frame, monkeypatch):
    few = models.spread(frame, 4000, 10).rdd.getNumPartitions()
    assert few == max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    monkeypatch.setattr(models, "SPREAD_CELLS", 1000)
    spread = models.spread(frame, 4000, 10)
    assert spread.rdd.getNumPartitions() == 40
    assert max(spread.rdd.glom().map(len).collect()) <= 200
    assert spread.count() == 4000


@pytest.mark.parametrize("fit", ["multi", "validation", "search", "cv"])
def test_fits_spread_by_their_rows(frame, monkeypatch, fit):
    seen, plain = [], models.spread

    def spread(df, rows, values):
        out = plain(df, rows, values)
        seen.append((rows, out.rdd.getNumPartitions()))
        return out

    monkeypatch.setattr(models, "SPREAD_CELLS", 4000)
    monkeypatch.setattr(models, "spread", spread)
    spec, params = FeatureSpec(num=["x"], cat=["c"], target=["y"]), {"n_estimators": 1, "max_depth": 2}
    space = {"n_estimators": ("int", 1, 1), "max_depth": ("int", 2, 2)}
    if fit == "multi":
        models.fit_multi_target(frame, spec, ["y"], params)
    elif fit == "validation":
        models.fit_with_validation(frame, spec, ["y"], params, keys=["id"])
    elif fit == "search":
        assert models.trial_search(frame, spec, ["y"], space, n_trials=1, keys=["id"]).first()["state"] == "COMPLETE"
    else:
        models.random_search_cv(frame, spec, ["y"], space, n_iter=1, folds=2, keys=["id"])
    assert seen and all(rows == 4000 and parts >= 12 for rows, parts in seen)


def test_attribution_fan_out_leaves_the_layout_of_a_small_file(spark, frame, monkeypatch):
    """A table of one partition is scored by all tasks, or by more where the fan-out is large."""
    class Linear:
        targets = ["y"]

        def predict(self, df):
            layouts.append(df.rdd.getNumPartitions())
            return df.withColumn("y_pred", 2 * F.col("x") + F.when(F.col("c") == "1", 5.0).otherwise(0.0))

    background = spark.createDataFrame([(1.0, "0", 0.25), (3.0, "1", 0.75)], "x double, c string, _weight double")
    for cells in (1 << 23, 10_000):
        layouts = []
        monkeypatch.setattr(models, "SPREAD_CELLS", cells)
        got = sampled_attribution(frame, Linear(), ["x", "c"], ["id"], background, permutations=2)
        assert layouts[0] >= (4 if cells > 10_000 else 14)
    sums = got.groupBy("id").agg(F.sum("phi").alias("s"), F.count(F.lit(1)).alias("n")).join(frame, "id")
    off = F.abs(F.col("s") - (2 * F.col("x") + F.when(F.col("c") == "1", 5.0).otherwise(0.0) - 8.75))
    assert sums.where((off > 1e-9) | (F.col("n") != 2)).isEmpty() and sums.count() == 4000


def test_bootstrap_words_are_md5(spark):
    rng = np.random.default_rng(1)
    names = ["x" * int(n) + "\u00e9" for n in rng.integers(0, 140, 40)] + ["", "1|2|42|"]
    got = NE.pair_bits(pa.array(names), 25)
    for name, bits in zip(names, got):
        want = b"".join(hashlib.md5((name + str(p)).encode()).digest() for p in range(13))
        assert (np.frombuffer(want, ">u8")[:25] == bits).all()
    rows = spark.createDataFrame([(1, "a"), (None, "b"), (-3, None)], "k long, s string")
    sent = rows.select(NE.bootstrap_names(["k", "s"], 7).alias("n"), NE.bootstrap_bits(["k", "s"], 5, 7).alias("b")).collect()
    for r, bits in zip(sent, NE.pair_bits(pa.array([r["n"] for r in sent]), 6)):
        assert (np.frombuffer(bytes(r["b"]), ">u8") == bits).all()


def test_bootstrap_weights_at_the_steps_of_the_table():
    table = NE.poisson_table()
    bits = np.array([min(max(int(c * 2.0**52) + d, 0), 2**52 - 1) << 12 for c in table for d in (-1, 0, 1)], np.uint64)
    bits = np.concatenate([bits, np.random.default_rng(2).integers(0, 2**64, 20000, dtype=np.uint64)])
    want = np.searchsorted(table, (bits >> np.uint64(12)).astype(float) / 2.0**52, "right")
    assert (NE.bootstrap_weights(bits, table) == want).all()


def test_blocks_of_all_replicates_from_one_product(monkeypatch):
    rng = np.random.default_rng(3)
    x, y, w = rng.normal(size=(50, 4)), rng.normal(size=(50, 2)), rng.poisson(1.0, size=(50, 6)).astype(float)
    y[::7, 1] = np.nan
    monkeypatch.setattr(NE, "BLOCK_CELLS", 70)  # 7 rows at a time
    blocks = NE.Blocks(4, 2)
    got = blocks.of(x, y, w)
    assert got.shape == (6, 2, blocks.size)
    for b in range(6):
        for t in range(2):
            k = np.isfinite(y[:, t])
            gram, right, yy, y1, n = blocks.parts(got[b], t)
            assert np.allclose(gram, x[k].T @ (x[k] * w[k, b, None])) and np.allclose(right, x[k].T @ (w[k, b] * y[k, t]))
            assert np.allclose([yy, y1, n], [w[k, b] @ y[k, t] ** 2, w[k, b] @ y[k, t], w[k, b].sum()])


@pytest.mark.parametrize("columns", [2, 5, 100])
def test_row_quantiles(columns):
    values = np.random.default_rng(columns).normal(size=(30, columns))
    values[3, 1] = np.nan
    assert np.allclose(models.row_quantiles(values, [0.0, 0.025, 0.5, 0.975, 1.0]),
                       np.quantile(values, [0.0, 0.025, 0.5, 0.975, 1.0], axis=1), equal_nan=True, rtol=1e-14, atol=0)


def test_attribution_computes_an_outcome_once():
    """The leaves' integrals run once per outcome of the splits, not once per row, and give each row the same values."""
    def tree(f):
        return [Node(0.0, 8.0, f, 1, 2, 0.1), Node(0.0, 3.0, 2, 3, 4, -0.2), Node(0.0, 5.0, 0, 5, 6, left_levels=frozenset({1.0, 2.0})),
                Node(1.0, 1.0), Node(-2.0, 2.0), Node(0.5, 4.0), Node(3.0, 1.0)]

    table, rng = PathTable([(1.0, tree(1)), (0.3, tree(3))], 4), np.random.default_rng(5)
    x = rng.normal(size=(20000, 4))
    x[:, 0] = rng.integers(0, 4, len(x))
    x[::9, 2] = np.nan
    asked, plain = [], table.by_paths
    table.by_paths = lambda rows, first, last: (asked.append(len(rows)), plain(rows, first, last))[1]
    got = np.concatenate([table.attribute(part) for part in np.array_split(x, 5)])
    assert sum(asked) <= 2 * 2**3
    assert np.allclose(got, plain(x, 0, len(table.value)), rtol=0, atol=1e-14)
