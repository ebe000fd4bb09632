import os
import sqlite3

import pytest
from pyspark.sql import functions as F

from ratecraft.operators.explain import attribution_export, linear_attribution
from ratecraft.operators.features import FeatureSpec, OrdinalEncoder, holdout_split, label_encode
from ratecraft.operators.models import fit_linear, refit_best
from ratecraft.operators.ranking import (
    bottom_n, first_n, rank_groups, sample_n, sort_stable, top_n,
)
from ratecraft.sources.sqlite import scan_sqlite_table


@pytest.fixture(scope="module")
def groups(spark):
    rows = [("a", 5.0), ("b", 9.0), ("c", None), ("d", 9.0), ("e", 1.0), ("f", 3.0), ("g", 7.0)]
    return spark.createDataFrame(rows, "k string, v double")


def test_rank_groups_ties_and_nulls(groups):
    out = [(r["k"], r["rank"]) for r in rank_groups(groups, "k", "v", rank_col="rank")
           .orderBy("rank").collect()]
    assert out == [("b", 1), ("d", 2), ("g", 3), ("a", 4), ("f", 5), ("e", 6), ("c", 7)]
    assert [r["k"] for r in rank_groups(groups, "k", "v").collect()] == [k for k, _ in out]


def test_top_bottom(groups):
    assert [r["k"] for r in top_n(groups, "k", "v", 3).collect()] == ["b", "d", "g"]
    assert [r["k"] for r in bottom_n(groups, "k", "v", 2).collect()] == ["f", "e"]


def test_sample_first_sort(spark, groups):
    assert sample_n(groups, 100, ["k"]).count() == 7  # fewer rows than n: all of them
    a = [r["k"] for r in sample_n(groups, 3, ["k"], seed=5).collect()]
    b = [r["k"] for r in sample_n(groups, 3, ["k"], seed=5).collect()]
    assert a == b and len(set(a)) == 3
    assert [r["k"] for r in first_n(groups, 2, ["k"]).collect()] == ["a", "b"]
    pos = groups.withColumn("pos", F.monotonically_increasing_id())
    assert [r["k"] for r in sort_stable(pos, "v", "pos").collect()][:2] == ["b", "d"]


def test_label_encode_known_levels(spark):
    df = spark.createDataFrame([("x",), ("y",)], "c string")
    enc = OrdinalEncoder().fit(df, ["c"])
    assert [r["c_code"] for r in label_encode(df, enc, ["c"]).orderBy("c").collect()] == [0, 1]


def test_refit_rows_and_export(spark, tmpdir_path):
    rows = [(i, float(i), 2.0 * i + 1) for i in range(100)]
    df = holdout_split(spark.createDataFrame(rows, "id bigint, x double, y double"), ["id"])
    spec = FeatureSpec(num=["x"], target=["y"])
    m_all = refit_best(df, spec, ["y"], {"n_estimators": 2}, rows="all")
    m_train = refit_best(df, spec, ["y"], {"n_estimators": 2}, rows="train")
    assert m_all.predict(df).count() == m_train.predict(df).count() == 100
    lin = fit_linear(df, spec, "y")
    pred = lin.predict(df).select("y", "y_pred").collect()
    assert max(abs(r["y"] - r["y_pred"]) for r in pred) < 1e-6
    phi = linear_attribution(df, {"x": 2.0}, ["id"], target="y")
    out = os.path.join(tmpdir_path, "attr")
    attribution_export(phi, out)
    assert os.path.isdir(os.path.join(out, "target=y"))
    assert spark.read.parquet(out).count() == 100


def test_sqlite_empty_table(spark, tmpdir_path):
    db = os.path.join(tmpdir_path, "e.sqlite")
    con = sqlite3.connect(db)
    con.execute("CREATE TABLE t (a INTEGER, b TEXT)")
    con.commit()
    con.close()
    assert scan_sqlite_table(spark, db, "t").count() == 0
