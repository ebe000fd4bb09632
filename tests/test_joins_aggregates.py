import pytest
from pyspark.sql import functions as F

from ratecraft.errors import DuplicateKeyError
from ratecraft.operators.aggregates import (
    cardinality_profile, distinct_rows, distinct_values, group_mean, ordered_distinct, pivot_mean,
    union_all,
)
from ratecraft.operators.joins import assert_unique, left_join, remaining_trials


def test_null_keys_match(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    right = spark.createDataFrame([(None, 10), ("a", 20)], "k string, w int")
    out = sorted(left_join(left, right, ["k"]).collect(), key=lambda r: r["v"])
    assert [(r["k"], r["v"], r["w"]) for r in out] == [(None, 1, 10), ("a", 2, 20)]
    strict = left_join(left, right, ["k"], null_safe=False).where(F.col("v") == 1).first()
    assert strict["w"] is None


def test_dup_keys_raise_before_join(spark):
    left = spark.createDataFrame([("a", 1)], "k string, v int")
    right = spark.createDataFrame([("a", 1), ("a", 2)], "k string, w int")
    with pytest.raises(DuplicateKeyError):
        left_join(left, right, ["k"], validate="many_to_one")
    assert_unique(right.limit(1), ["k"])


def test_left_rows_kept_and_broadcast_bound(spark):
    left = spark.createDataFrame([(i, i % 3) for i in range(10)], "id int, k int")
    right = spark.createDataFrame([(0, "x"), (1, "y")], "k int, name string")
    out = left_join(left, right, ["k"], broadcast_max_rows=10)
    assert out.count() == 10
    assert "Broadcast" in out._jdf.queryExecution().executedPlan().toString()


def test_pivot_nulls(spark):
    df = spark.createDataFrame(
        [("a", 1, "x", 1.5), ("a", 1, "y", 2.5), ("b", 2, "x", None), ("c", None, "x", 4.0),
         (None, 5, "x", 5.0)], "k string, p int, col string, v double")
    out = pivot_mean(df, ["k", "p"], "col", "v").collect()
    assert len(out) == 1
    r = out[0]
    assert (r["k"], r["p"], r["x"], r["y"]) == ("a", 1, 1.5, 2.5)


def test_pivot_discovered_levels_skip_empty(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "z", None)], "k string, col string, v double")
    out = pivot_mean(df, ["k"], "col", "v")
    assert out.columns == ["k", "x"]


def test_group_mean_truncates(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), (None, 9.0), ("b", -3.0), ("b", -4.0)],
                               "g string, v double")
    out = {r["g"]: r["v"] for r in group_mean(df, ["g"], "v").collect()}
    assert out == {"a": 1, "b": -3}


def test_cardinality(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2), (None, 2)], "s string, n int")
    out = {r["column"]: (r["n_levels"], r["emb_dim"]) for r in cardinality_profile(df, ["s", "n"]).collect()}
    assert out == {"s": (4, 2), "n": (2, 1)}


def test_sets(spark):
    a = spark.createDataFrame([(1, "x")], "id int, s string")
    b = spark.createDataFrame([(2,)], "id int")
    u = union_all([a, b, a])
    assert u.count() == 3 and u.where(F.col("s").isNull()).count() == 1
    assert distinct_rows(u, ["s"]).count() == 2
    assert distinct_values(u, "s").count() == 1
    assert [r[0] for r in ordered_distinct(u, ["id"]).collect()] == [1, 2]


def test_remaining_trials(spark):
    grid = spark.range(5).withColumnRenamed("id", "trial_id")
    done = spark.createDataFrame([(1,), (3,)], "trial_id bigint")
    assert sorted(r[0] for r in remaining_trials(grid, done).collect()) == [0, 2, 4]


def test_subset_by_group(spark):
    from ratecraft.operators.aggregates import subset_by_group
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "g string, v int")
    assert [r["v"] for r in subset_by_group(df, "g", "b").collect()] == [2]
    assert [r["v"] for r in subset_by_group(df, "g", None).collect()] == [3]
