"""Column profiles and dependence measures.

Each profile is one aggregation pass over the data (partial aggregation per task,
one row out) followed by an unpivot of that single row, so the cost is one scan
however many columns are profiled. Exact quartiles come from the distributed
order statistics in :mod:`ratecraft.operators.quantiles`, never from a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructField, StructType, StringType

from ratecraft.functions.columns import columns_of_type
from ratecraft.functions.scalar import mask_below
from ratecraft.operators.comoments import correlations
from ratecraft.operators.quantiles import quantile_values


def _is_float(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (DoubleType, FloatType))


def _clean(df: DataFrame, c: str) -> F.Column:
    """Column as double with NaN turned into NULL (pandas treats both as missing)."""
    col = F.col(c)
    if _is_float(df, c):
        col = F.when(~F.isnan(col), col)
    return col.cast("double")


def _missing(df: DataFrame, c: str) -> F.Column:
    cond = F.col(c).isNull()
    if _is_float(df, c):
        cond = cond | F.isnan(c)
    return cond


def _unpivot_row(one_row: DataFrame, items: Sequence[tuple[str, dict]]) -> DataFrame:
    """Turn a one-row aggregate into one row per item: items are (name, {field: column})."""
    structs = [F.struct(F.lit(i).alias("position"), F.lit(name).alias("column"),
                        *[c.alias(f) for f, c in fields.items()])
               for i, (name, fields) in enumerate(items)]
    return one_row.select(F.explode(F.array(*structs)).alias("_s")).select("_s.*")


def missing_summary(df: DataFrame, sort: bool = True, digits: int | None = 2) -> DataFrame:
    """A3: (column, missing_count, missing_percent, dtype), NULL and NaN both missing.

    Sorted by percent descending, stable on column position, then rounded
    half-even (pandas ``round``) to ``digits``. An empty frame gives percent NULL.
    """
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("_n")] + [
        F.count_if(_missing(df, c)).alias(f"_m{i}") for i, c in enumerate(cols)]
    one = df.agg(*aggs)
    items = [(c, {"missing_count": F.col(f"_m{i}").cast("long"),
                  "_pct": F.try_divide(F.col(f"_m{i}") * 100.0, F.col("_n").cast("double")),
                  "dtype": F.lit(df.schema[c].dataType.simpleString())})
             for i, c in enumerate(cols)]
    long = _unpivot_row(one, items)
    if sort:
        long = long.orderBy(F.desc_nulls_last("_pct"), F.asc("position"))
    pct = F.col("_pct") if digits is None else F.bround("_pct", digits)
    return long.select("column", "missing_count", pct.alias("missing_percent"), "dtype")


def describe(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A4: transposed ``describe``: one row per column with count, mean, std (sample),
    min, exact linear-interpolated quartiles p25/p50/p75 and max."""
    cols = list(cols) if cols is not None else columns_of_type(df, "number")
    clean = df.select(*[_clean(df, c).alias(c) for c in cols])
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count(c).alias(f"_n{i}"), F.avg(c).alias(f"_a{i}"),
                 F.stddev_samp(c).alias(f"_s{i}"), F.min(c).alias(f"_lo{i}"),
                 F.max(c).alias(f"_hi{i}")]
    one = clean.agg(*aggs)
    items = [(c, {"count": F.col(f"_n{i}").cast("long"), "mean": F.col(f"_a{i}"),
                  "std": F.col(f"_s{i}"), "min": F.col(f"_lo{i}"), "max": F.col(f"_hi{i}")})
             for i, c in enumerate(cols)]
    moments = _unpivot_row(one, items)
    found = quantile_values(clean, cols, [0.25, 0.5, 0.75])  # three numbers a column
    q = df.sparkSession.createDataFrame([(i, *found[c]) for i, c in enumerate(cols)], "position int, p25 double, p50 double, p75 double")
    return (moments.join(q, "position", "left").orderBy("position")
            .select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max"))


def profile(df: DataFrame, cols: Sequence[str] | None = None, digits: int | None = None) -> DataFrame:
    """A5: describe joined with dtype, missing count and percent by column name.

    The percent is unrounded by default (rounding in the reference is display only).
    """
    d = describe(df, cols)
    m = missing_summary(df, sort=False, digits=digits)
    return d.join(m, "column", "left").select(
        "column", "dtype", "count", "mean", "std", "min", "p25", "p50", "p75", "max",
        "missing_count", "missing_percent")


def _names(cols: Sequence[str], index: str) -> F.Column:
    return F.element_at(F.array(*[F.lit(c) for c in cols]), F.col(index) + 1)


def correlation_matrix(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every column pair, long form (col_a, col_b, corr), pairwise-complete.

    One pass of co-moment blocks (see ``comoments``), both orders of a pair emitted. Constant columns and
    empty frames give NULL (pandas NaN) instead of an ANSI error.
    """
    cols = list(cols) if cols is not None else columns_of_type(df, "number")
    values = [_clean(df, c) for c in cols]
    return correlations(df, values, values).select(_names(cols, "i").alias("col_a"), _names(cols, "j").alias("col_b"), "corr")


def cross_correlation(df: DataFrame, targets: Sequence[str], group_col: str,
                      groups: Sequence | None = None, threshold: float | None = None,
                      features: Sequence[str] | None = None) -> DataFrame:
    """A7 (+P15): correlation of each target with each other numeric column, per group.

    One pass with a co-moment block per group and task replaces the per-group driver loop. NULL groups
    are dropped; with ``threshold`` cells with |corr| below it become NULL. Output: (group, target, feature,
    corr).
    """
    targets = list(targets)
    if features is None:
        features = [c for c in columns_of_type(df, "number") if c not in targets and c != group_col]
    features = list(features)
    base = df.where(F.col(group_col).isNotNull())
    if groups is not None:
        base = base.where(F.col(group_col).isin(list(groups)))
    out = correlations(base, [_clean(df, t) for t in targets], [_clean(df, f) for f in features], F.col(group_col)).select(
        F.col("g").alias("group"), _names(targets, "i").alias("target"), _names(features, "j").alias("feature"), "corr")
    if threshold is not None:
        out = out.withColumn("corr", mask_below("corr", threshold))
    return out


def variance_inflation(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """VIF per column = diagonal of the inverse correlation matrix (intercept model).

    Rows with any NULL/NaN in ``cols`` are dropped; the p x p correlation matrix is
    one pass of co-moment blocks; only its p^2 numbers come to the driver to be inverted.
    A constant column and a column that the others determine have a NULL VIF; the others keep
    theirs (least squares on the remaining columns). Sorted descending.
    """
    cols = list(cols)
    spark = df.sparkSession
    clean = df.select(*[_clean(df, c).alias(c) for c in cols]).dropna()
    p = len(cols)
    r, known = np.eye(p), np.eye(p, dtype=bool)
    for x in correlations(clean, [F.col(c) for c in cols], [F.col(c) for c in cols]).collect():  # p x p
        if x["i"] != x["j"] and x["corr"] is not None:
            r[x["i"], x["j"]], known[x["i"], x["j"]] = x["corr"], True
    r = (r + r.T) / 2
    # a column without a correlation to any other is constant
    use = [i for i in range(p) if p == 1 or known[i].sum() > 1]
    m = r[np.ix_(use, use)]
    vifs: list = [None] * p
    if use and np.linalg.cond(m) < 1e12:
        inv = np.linalg.inv(m)
        for k, i in enumerate(use):
            vifs[i] = float(inv[k, k])
    else:
        for k, i in enumerate(use):
            rest = [x for x in range(len(use)) if x != k]
            beta = np.linalg.lstsq(m[np.ix_(rest, rest)], m[rest, k], rcond=1e-10)[0]
            left = 1.0 - float(m[rest, k] @ beta)
            vifs[i] = 1.0 / left if left > 1e-10 else None
    schema = StructType([StructField("feature", StringType()), StructField("vif", DoubleType())])
    out = spark.createDataFrame(list(zip(cols, vifs)), schema)
    return out.orderBy(F.desc_nulls_last("vif"), "feature")


def bin_index(c: F.Column, cuts: Sequence[float]) -> F.Column:
    """Number of cut points strictly below the value: 0 .. len(cuts)."""
    arr = F.array(*[F.lit(float(x)) for x in cuts])
    return F.size(F.filter(arr, lambda k: c > k))


def mutual_information(df: DataFrame, features: Sequence[str], targets: Sequence[str],
                       bins: int = 4) -> DataFrame:
    """Binned mutual information (nats) of each feature with each target, averaged
    over targets, sorted descending. Output: (feature, mi).

    Cut points are exact quantiles at k/bins; one pass emits (feature, target, bin_f,
    bin_t) per row and counts them with partial aggregation; the contingency tables
    are small (pairs x bins^2) and the sum runs on them.
    """
    features, targets = list(features), list(targets)
    cols = list(dict.fromkeys(features + targets))
    probs = [k / bins for k in range(1, bins)]
    cuts = quantile_values(df.select(*[_clean(df, c).alias(c) for c in cols]), cols, probs)
    clean = df.select(*[_clean(df, c).alias(c) for c in cols])
    binned = clean.select(*[(F.when(F.col(c).isNotNull(), bin_index(F.col(c), cuts[c])))
                            .alias(c) for c in cols])
    structs = [F.struct(F.lit(f).alias("feature"), F.lit(t).alias("target"),
                        F.col(f).alias("bf"), F.col(t).alias("bt"))
               for f in features for t in targets]
    cells = (binned.select(F.explode(F.array(*structs)).alias("_s")).select("_s.*")
             .where(F.col("bf").isNotNull() & F.col("bt").isNotNull())
             .groupBy("feature", "target", "bf", "bt").agg(F.count(F.lit(1)).alias("nxy")))
    n = cells.groupBy("feature", "target").agg(F.sum("nxy").alias("n"))
    nx = cells.groupBy("feature", "target", "bf").agg(F.sum("nxy").alias("nx"))
    ny = cells.groupBy("feature", "target", "bt").agg(F.sum("nxy").alias("ny"))
    j = (cells.join(n, ["feature", "target"]).join(nx, ["feature", "target", "bf"])
         .join(ny, ["feature", "target", "bt"]))
    # All in double: count products overflow BIGINT at very large row counts.
    nxy, nn, nx_, ny_ = (F.col(c).cast("double") for c in ("nxy", "n", "nx", "ny"))
    term = (nxy / nn) * F.log((nxy / nx_) * (nn / ny_))
    per_pair = j.groupBy("feature", "target").agg(F.sum(term).alias("mi"))
    return (per_pair.groupBy("feature").agg(F.avg("mi").alias("mi"))
            .orderBy(F.desc("mi"), "feature"))


__all__ = ["missing_summary", "describe", "profile", "correlation_matrix", "cross_correlation",
           "variance_inflation", "mutual_information", "bin_index"]
