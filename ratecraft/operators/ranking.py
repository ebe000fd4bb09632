"""Sort, top-k and deterministic sampling (K1-K6).

``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: every task keeps its own
top k and only k rows per task reach the final merge, so it is safe on any size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def rank_groups(df: DataFrame, key: str, value: str, rank_col: str | None = None) -> DataFrame:
    """K1: descending order of ``value`` with NULLs last and ``key`` as tie-break.

    With ``rank_col`` a 1-based ``row_number`` is added. Use it on grouped results
    (one row per group); the ranking window is global.
    """
    ordered = [F.desc_nulls_last(value), F.asc_nulls_last(key)]
    if rank_col:
        # Row numbers from distributed ranks (range partitions), not a global window
        # that would pull every group into one task.
        from ratecraft.operators.ordered import ordered_scan
        tagged = df.withColumns({
            "_r_null": F.col(value).isNull(), "_r_neg": -F.col(value),
            "_r_knull": F.col(key).isNull()})
        ranked = ordered_scan(tagged, [], ["_r_null", "_r_neg", "_r_knull", key], index="_r_idx")
        return ranked.select(*df.columns, (F.col("_r_idx") + 1).cast("long").alias(rank_col))
    return df.orderBy(*ordered)


def top_n(df: DataFrame, key: str, value: str, n: int = 5) -> DataFrame:
    """K2: the ``n`` largest values (NULLs last, ties by key)."""
    return df.orderBy(F.desc_nulls_last(value), F.asc_nulls_last(key)).limit(n)


def bottom_n(df: DataFrame, key: str, value: str, n: int = 5) -> DataFrame:
    """K3: the ``n`` smallest non-NULL values, shown in descending order (worst last)."""
    low = (df.where(F.col(value).isNotNull())
           .orderBy(F.asc(value), F.desc_nulls_last(key)).limit(n))
    return low.orderBy(F.desc(value), F.asc_nulls_last(key))


def top_n_by(df: DataFrame, by: Sequence[str], key: str, value: str, n: int = 5, largest: bool = True) -> DataFrame:
    """K2/K3 per group: the rows of the ``n`` largest (or smallest non-NULL) values of each group ``by``, with
    a 1-based ``rank``. Tasks keep n rows per group before the shuffle (window group limit)."""
    value_order = F.desc_nulls_last(value) if largest else F.asc(value)
    rows = df if largest else df.where(F.col(value).isNotNull())
    w = Window.partitionBy(*by).orderBy(value_order, F.asc_nulls_last(key) if largest else F.desc_nulls_last(key))
    return rows.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= n)


def sort_stable(df: DataFrame, value: str, position: str, descending: bool = True) -> DataFrame:
    """K4: sort by ``value`` with an explicit tie-break on an original position column."""
    v = F.desc_nulls_last(value) if descending else F.asc_nulls_last(value)
    return df.orderBy(v, F.asc(position))


def hash_key(keys: Sequence[str], seed: int) -> F.Column:
    """md5 of the key columns and the seed: a deterministic per-row pseudo-random text."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys] + [F.lit(str(seed))]
    return F.md5(F.concat_ws("|", *parts))


def sample_n(df: DataFrame, n: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """K5: ``n`` rows chosen by a seeded hash of the key; all rows when fewer exist.

    The remaining columns break ties, so a key that repeats still gives one answer.
    """
    rest = [c for c in df.columns if c not in keys]
    return df.orderBy(hash_key(keys, seed), *keys, *rest).limit(n)


def first_n(df: DataFrame, n: int, keys: Sequence[str]) -> DataFrame:
    """K6: first ``n`` rows by an explicit key order."""
    return df.orderBy(*keys).limit(n)
