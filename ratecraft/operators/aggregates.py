"""Grouped aggregates and set operations.

All are hash aggregates with partial (map-side) combine, so a hot key is
pre-aggregated in every task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecraft.functions.columns import normalize_name
from ratecraft.functions.scalar import truncate_int


def pivot_mean(df: DataFrame, index: Sequence[str], columns: str, values: str,
               pivot_values: Sequence | None = None, normalize: bool = True) -> DataFrame:
    """A1: mean of ``values`` per index row and ``columns`` level, levels as columns.

    Kept from the pandas rule: rows with a NULL index key, NULL level or NULL value
    are dropped first, so all-NULL groups vanish and an empty level makes no column
    (when levels are discovered). Passing ``pivot_values`` saves the discovery job.
    """
    index = list(index)
    cond = F.col(values).isNotNull() & F.col(columns).isNotNull()
    for k in index:
        cond = cond & F.col(k).isNotNull()
    kept = df.where(cond)
    if pivot_values is None:
        # one output column per level, so the levels are as many as a schema can hold
        pivot_values = [r[0] for r in kept.select(columns).distinct().orderBy(columns).collect()]
    out = kept.groupBy(*index).pivot(columns, list(pivot_values)).agg(F.avg(values))
    if normalize:
        names = [c if c in index else normalize_name(str(c)) for c in out.columns]
        clash = sorted({n for n in names if names.count(n) > 1})
        if clash:
            raise ValueError(f"levels of {columns} that would share a column name: {clash}")
        out = out.toDF(*names)
    return out


def group_mean(df: DataFrame, keys: Sequence[str], value: str, alias: str | None = None,
               truncate: bool = True) -> DataFrame:
    """A2: mean per group with NULL keys dropped; result truncated to BIGINT by default."""
    keys = list(keys)
    kept = df
    for k in keys:
        kept = kept.where(F.col(k).isNotNull())
    m = F.avg(value)
    out = kept.groupBy(*keys).agg(m.alias("_mean"))
    col = truncate_int("_mean") if truncate else F.col("_mean")
    return out.select(*keys, col.alias(alias or value), F.col("_mean"))


def cardinality_profile(df: DataFrame, columns: Sequence[str], approx: bool = False,
                        max_dim: int = 50) -> DataFrame:
    """A10: (column, n_levels, emb_dim) with emb_dim = min(max_dim, (n_levels + 1) // 2).

    A NULL counts as a level (the encoders treat it as one). Exact by default:
    the columns are stacked to (column, level) and de-duplicated with partial
    aggregation, which avoids one Expand copy of the data per distinct aggregate.
    """
    columns = list(columns)
    stack = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level")) for c in columns]))
    long = df.select(stack.alias("_s")).select("_s.column", "_s.level")
    if approx:
        counted = long.groupBy("column").agg(
            (F.approx_count_distinct("level") +
             F.max(F.col("level").isNull().cast("int"))).alias("n_levels"))
    else:
        counted = (long.distinct().groupBy("column")
                   .agg(F.count(F.lit(1)).alias("n_levels")))
    return counted.select(
        "column", F.col("n_levels").cast("long").alias("n_levels"),
        F.least(F.lit(max_dim), F.floor((F.col("n_levels") + 1) / 2)).cast("long").alias("emb_dim"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-NULL values of one column."""
    return df.select(column).where(F.col(column).isNotNull()).distinct()


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct combinations of ``columns``."""
    return df.select(*columns).distinct()


def ordered_distinct(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """K7: distinct combinations, sorted (range-partitioned sort, no single task)."""
    return df.select(*columns).distinct().orderBy(*columns)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name; a missing column becomes NULL; duplicates kept."""
    frames = list(frames)
    if not frames:
        raise ValueError("union_all needs at least one frame")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def subset_by_group(df: DataFrame, column: str, value) -> DataFrame:
    """P10: rows of one group (a pushed-down filter). To process every group, prefer one
    grouped pass (e.g. ``cross_correlation(group_col=...)``) over a loop of subsets."""
    if value is None:
        return df.where(F.col(column).isNull())
    return df.where(F.col(column) == F.lit(value))
