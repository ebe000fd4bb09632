import pytest
from pyspark.sql import functions as F

from ratecraft.errors import UnknownCategoryError, ValidationError
from ratecraft.operators.features import (
    FeatureSpec, MinMaxScaler, OrdinalEncoder, StandardScaler, dummies, feature_names,
    holdout_split, kfold_assign, label_encode, preprocess_pipeline,
)


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, 3.0), (None, None)], "c double, x double")
    z = StandardScaler().fit(df, ["c", "x"]).transform(df).collect()
    assert [r["c"] for r in z] == [0.0, 0.0, None]
    assert [r["x"] for r in z] == [-1.0, 1.0, None]  # population sd = 1
    mm = MinMaxScaler().fit(df, ["c", "x"]).transform(df).collect()
    assert [r["c"] for r in mm] == [0.0, 0.0, None] and [r["x"] for r in mm] == [0.0, 1.0, None]


def test_scale_round_trip(spark):
    df = spark.createDataFrame([(float(i) * 1.5 - 3,) for i in range(20)], "x double")
    sc = StandardScaler().fit(df, ["x"])
    back = sc.inverse(sc.transform(df)).collect()
    for a, b in zip(df.collect(), back):
        assert b["x"] == pytest.approx(a["x"])
    mm = MinMaxScaler().fit(df, ["x"])
    for a, b in zip(df.collect(), mm.inverse(mm.transform(df)).collect()):
        assert b["x"] == pytest.approx(a["x"])


def test_unseen_and_null_levels(spark):
    fit = spark.createDataFrame([("b",), ("a",), (None,)], "c string")
    enc = OrdinalEncoder().fit(fit, ["c"])
    new = spark.createDataFrame([("a",), ("b",), ("zz",), (None,)], "c string")
    codes = [r["c_code"] for r in enc.transform(new, ["c"]).orderBy(F.col("c").asc_nulls_last()).collect()]
    assert codes == [0, 1, -1, 2]  # byte order: a, b, nan
    with pytest.raises(UnknownCategoryError):
        label_encode(new, enc, ["c"])


def test_one_hot_unknown_is_empty(spark):
    train = spark.createDataFrame([("x", 1.0), ("y", 2.0), ("z", 3.0)], "c string, n double")
    prep = preprocess_pipeline(train, FeatureSpec(cat=["c"], num=["n"]))
    new = spark.createDataFrame([("w", 2.0), ("x", 2.0)], "c string, n double")
    vecs = [r["features"] for r in prep.transform(new).collect()]
    assert vecs[0].size == 4 and list(vecs[0].toArray()[1:]) == [0.0, 0.0, 0.0]
    assert list(vecs[1].toArray()[1:]) == [1.0, 0.0, 0.0]
    assert feature_names(prep.transform(new))[0] == "n"


def test_dummies_drop_first(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "t string")
    out = dummies(df, "t", ["a", "b", "c"]).collect()
    assert out[0].asDict() == {"t": "a", "t_b": 0, "t_c": 0}
    assert out[3].asDict() == {"t": None, "t_b": 0, "t_c": 0}


def test_holdout_disjoint_complete_repeatable(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    a = holdout_split(df, ["k"], 0.2, 42)
    b = holdout_split(df, ["k"], 0.2, 42)
    assert a.subtract(b).count() == 0
    n_test = a.where("is_test").count()
    assert 800 < n_test < 1200 and a.where("NOT is_test").count() + n_test == 5000
    folds = kfold_assign(df, ["k"], 3).groupBy("fold").count().collect()
    assert sorted(r["fold"] for r in folds) == [0, 1, 2]
    with pytest.raises(ValidationError):
        kfold_assign(df, ["k"], 1)


def test_preprocess_needs_a_feature(spark):
    df = spark.createDataFrame([(1.0,)], "y double")
    with pytest.raises(ValidationError):
        preprocess_pipeline(df, FeatureSpec())


def test_holdout_fraction_below_a_bucket(spark):
    from pyspark.sql import functions as F

    from ratecraft.operators.features import holdout_split
    df = spark.range(400_000)
    share = 0.00004
    held = holdout_split(df, ["id"], share).where("is_test").count()
    assert 4 <= held <= 32  # 16 expected
    wider = holdout_split(df, ["id"], 0.00104).where("is_test")
    assert 330 <= wider.count() <= 500  # 416 expected
    whole = holdout_split(df, ["id"], 0.001).where("is_test")
    assert whole.exceptAll(wider).count() == 0 and wider.agg(F.max("id")).first()[0] is not None
