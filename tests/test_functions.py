import math

import pytest
from pyspark.sql import functions as F

from ratecraft.errors import MissingColumnsError, ValidationError
from ratecraft.functions.columns import (
    columns_of_type, drop_columns, normalize_columns, rename, select_existing,
    split_features_targets,
)
from ratecraft.functions.scalar import (
    mask_below, null_as_category, prefix, rate_per, recode, round_sig, to_nullable_int,
    truncate_int,
)


def test_normalize_names(spark):
    df = spark.createDataFrame([(1, 2)], "` A  b ` int, `\tC` int")
    assert normalize_columns(df).columns == ["a_b", "c"]
    dup = spark.createDataFrame([(1, 2)], "`A b` int, `a  B` int")
    with pytest.raises(ValidationError):
        normalize_columns(dup)


def test_rename_select_drop(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert rename(df, {"a": "x", "zz": "y"}).columns == ["x", "b", "c"]
    assert select_existing(df, ["c", "nope", "a"]).columns == ["c", "a"]
    assert drop_columns(df, ["a", "nope"]).columns == ["b", "c"]
    with pytest.raises(MissingColumnsError):
        drop_columns(df, ["nope"], strict=True)
    f, t = split_features_targets(df, ["c"])
    assert f.columns == ["a", "b"] and t.columns == ["c"]


def test_suppressed_to_null(spark):
    df = spark.createDataFrame([("12",), ("Suppressed",), ("7.9",), (None,)], "c string")
    assert [r[0] for r in df.select(to_nullable_int("c")).collect()] == [12, None, 7, None]


def test_truncate(spark):
    df = spark.createDataFrame([(1.7,), (-1.7,), (2.5,), (None,), (float("nan"),)], "x double")
    assert [r[0] for r in df.select(truncate_int("x")).collect()] == [1, -1, 2, None, None]


def test_rate_recode_prefix_mask(spark):
    df = spark.createDataFrame([(5, 1000, "01001", "a", 0.05), (3, 0, "22", "z", -0.5),
                                (None, 10, None, None, None)],
                               "cnt int, pop int, fips string, k string, c double")
    rows = df.select(rate_per("cnt", "pop").alias("r"), prefix("fips", 2).alias("p"),
                     recode("k", {"a": "A"}).alias("m"), mask_below("c", 0.1).alias("c")).collect()
    assert rows[0]["r"] == pytest.approx(500.0) and rows[1]["r"] is None and rows[2]["r"] is None
    assert [r["p"] for r in rows] == ["01", "22", None]
    assert [r["m"] for r in rows] == ["A", None, None]
    assert [r["c"] for r in rows] == [None, -0.5, None]


def test_null_as_category(spark):
    df = spark.createDataFrame([("x",), (None,)], "c string")
    assert [r[0] for r in df.select(null_as_category("c")).collect()] == ["x", "nan"]


def test_columns_of_type(spark):
    df = spark.createDataFrame([(1, 2, 1.0, 2.0, True, "s")],
                               "a bigint, b int, c double, d float, e boolean, f string")
    assert columns_of_type(df, "int64/float64") == ["a", "c"]
    assert columns_of_type(df, "number") == ["a", "b", "c", "d"]
    assert columns_of_type(df, "category") == ["f"]


def test_round_sig(spark):
    df = spark.createDataFrame([(1234567.891,), (0.000123456789,), (0.0,), (None,)], "x double")
    got = [r[0] for r in df.select(round_sig("x", 6)).collect()]
    assert got[0] == 1234570.0 and math.isclose(got[1], 0.000123457) and got[2] == 0.0 and got[3] is None
