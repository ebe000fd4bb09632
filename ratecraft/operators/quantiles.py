"""Exact quantiles by brackets: sketch, count, select.

1. One pass keeps a mergeable quantile sketch per group (``percentile_approx``); its ``GRID`` cut points bracket
   the two order statistics that each probability needs, with room for the sketch's error.
2. A second pass counts the values on the shorter side outside the bracket and keeps only those inside, as
   (value, count) rows with partial aggregation: a few per cent of the distinct values are shuffled, and a
   value repeated any number of times is one row.
3. Brackets that still hold more than ``RANKED`` rows are narrowed: cut points of their own rows split
   them into ``CELLS`` cells, the cells' counts tell which hold the wanted ranks, and only those are
   kept, until few rows remain. Those are ranked by cumulative counts.

One algorithm for every size: no group is sorted or gathered in one task, however many rows it has.
Quantiles are linear-interpolated at p (n - 1) over the non-NULL, non-NaN values, as Spark's ``percentile``
and DuckDB's ``quantile_cont``; a group without a value has no row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratecraft.operators.joins import left_join
from ratecraft.session import cut_lineage, written

GRID = 200         # cut points of the sketch
ACCURACY = 10_000  # its rank error is n / ACCURACY at most, far below a grid cell
RANKED = 100_000   # rows of one bracket that a window ranks
CELLS = 64


def _fractions(cells: int) -> Column:
    return F.array(*[F.lit((j + 1) / (cells + 1)) for j in range(cells)])


def _edges(n, lo, hi, floor, ceil):
    """Grid indices whose cut points lie surely at or below rank ``lo`` and at or above rank ``hi``: one
    cell and two rows further out than the grid says."""
    room = 1 + ceil(2.0 * (GRID + 1) / n)
    return floor(lo * (GRID + 1.0) / n) - 1 - room, ceil((hi + 1) * (GRID + 1.0) / n) - 1 + room


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], keys: Sequence[str] = (), *, prob_col: str = "p",
                    out_col: str = "q", histogram_limit: int | None = None) -> DataFrame:
    """(keys, p, q): exact quantiles of ``value`` per group. ``histogram_limit`` replaces ``RANKED``. A NULL key
    is a group of its own."""
    keys, probs = list(keys), [float(p) for p in probs]
    limit = RANKED if histogram_limit is None else histogram_limit
    v = F.col(value).cast("double")
    data = df.select(*keys, v.alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    if not keys:
        found = quantile_values(data, ["_v"], probs, histogram_limit=limit)["_v"]
        rows = [(p, q) for p, q in zip(probs, found) if q is not None]
        return df.sparkSession.createDataFrame(rows, f"`{prob_col}` double, `{out_col}` double")
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sketch = data.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("_v", _fractions(GRID), ACCURACY).alias("_cuts"))
        cells = []
        for i, p in enumerate(probs):
            at = F.lit(p) * (F.col("_n") - 1)
            lo, hi = F.floor(at), F.ceil(at)
            a, b = _edges(F.col("_n"), lo, hi, F.floor, F.ceil)
            cells.append(F.struct(
                F.lit(i).alias("i"), lo.cast("long").alias("lo"), hi.cast("long").alias("hi"), (at - lo).alias("frac"),
                F.coalesce(F.when(a >= 0, F.get("_cuts", a.cast("int"))), F.lit(float("-inf"))).alias("low"),
                F.coalesce(F.when(b < GRID, F.get("_cuts", b.cast("int"))), F.lit(float("inf"))).alias("high")))
        # a written table has a size in bytes, by which the join below is planned
        brackets = written(sketch.select(*keys, "_n", F.array(*cells).alias("_b")), "brackets")
        one = F.col("_b")
        places = []
        for i, p in enumerate(probs):
            b, v = one[i], F.col("_v")
            outside = (v < b["low"]) if p <= 0.5 else (v > b["high"])
            inside = (v >= b["low"]) & (v <= b["high"])
            places.append(F.when(outside, F.struct(F.lit(i).alias("_i"), F.lit(None).cast("double").alias("_v")))
                          .when(inside, F.struct(F.lit(i).alias("_i"), v.alias("_v"))))
        kept = left_join(data, brackets, keys, how="inner") \
            .select(*keys, F.explode(F.filter(F.array(*places), lambda x: x.isNotNull())).alias("_s")).select(*keys, "_s.*") \
            .groupBy(*keys, "_i", "_v").agg(F.count(F.lit(1)).alias("_c"))
        kept = cut_lineage(kept)
    finally:
        data.unpersist()
    totals = kept.groupBy(*keys, "_i").agg(
        F.coalesce(F.sum(F.when(F.col("_v").isNull(), F.col("_c"))), F.lit(0)).alias("_out"),
        F.sum(F.when(F.col("_v").isNotNull(), F.col("_c"))).alias("_in"), F.count("_v").alias("_rows"))
    need = brackets.select(*keys, "_n", F.explode("_b").alias("_s")).select(*keys, "_n", F.col("_s.i").alias("_i"), "_s.lo", "_s.hi", "_s.frac")
    upper = F.element_at(F.array(*[F.lit(p > 0.5) for p in probs]), F.col("_i") + 1)
    below = F.when(upper, F.col("_n") - F.col("_out") - F.col("_in")).otherwise(F.col("_out"))
    goal = left_join(totals, need, [*keys, "_i"], how="inner").select(
        *keys, "_i", (F.col("lo") - below).alias("_lo"), (F.col("hi") - below).alias("_hi"), F.col("frac").alias("_frac"), "_rows")
    picked = _select(kept.where(F.col("_v").isNotNull()), goal, keys, limit)
    p = F.element_at(F.array(*[F.lit(x) for x in probs]), F.col("_i") + 1)
    return picked.select(*keys, p.alias(prob_col), F.col("_q").alias(out_col))


def quantile_values(df: DataFrame, columns: Sequence[str], probs: Sequence[float], *, histogram_limit: int | None = None) -> dict:
    """``{column: [q(p) for p in probs]}`` of several columns (None for a column without a value).

    The sketch and the counts below the brackets are one aggregate each over all columns; the brackets
    (columns x probs numbers) go back into the plan as literals, so no row is joined or exploded
    but those inside a bracket.
    """
    columns, probs = list(columns), [float(p) for p in probs]
    limit = RANKED if histogram_limit is None else histogram_limit
    spark = df.sparkSession
    out: dict = {c: [None] * len(probs) for c in columns}
    names = [f"_x{k}" for k in range(len(columns))]
    double = [F.col(c).cast("double") for c in columns]
    data = df.select(*[F.when(~F.isnan(x), x).alias(n) for x, n in zip(double, names)]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        one = data.agg(*[F.count(n).alias(f"n{k}") for k, n in enumerate(names)],
                       *[F.percentile_approx(n, _fractions(GRID), ACCURACY).alias(f"c{k}") for k, n in enumerate(names)]).first()
        wanted, below, places = [], [], []
        for k, name in enumerate(names):
            n, cuts, v = one[f"n{k}"], one[f"c{k}"], F.col(name)
            for i, p in enumerate(probs):
                if not n:
                    continue
                at = p * (n - 1)
                lo, hi = math.floor(at), math.ceil(at)
                a, b = _edges(n, lo, hi, math.floor, math.ceil)
                low = cuts[a] if a >= 0 else -math.inf
                high = cuts[b] if b < GRID else math.inf
                where = len(wanted)
                wanted.append((k, i, lo, hi, at - lo))
                below.append(F.count_if(v < F.lit(float(low))).alias(f"b{where}"))
                places.append(F.when((v >= F.lit(float(low))) & (v <= F.lit(float(high))), F.struct(F.lit(where).alias("_i"), v.alias("_v"))))
        if not wanted:
            return out
        under = data.agg(*below).first()
        kept = data.select(F.explode(F.filter(F.array(*places), lambda x: x.isNotNull())).alias("_s")).select("_s.*") \
            .groupBy("_i", "_v").agg(F.count(F.lit(1)).alias("_c"))
        kept = cut_lineage(kept)
    finally:
        data.unpersist()
    rows = {r[0]: r[1] for r in kept.groupBy("_i").count().collect()}
    goal = spark.createDataFrame([(w, lo - under[f"b{w}"], hi - under[f"b{w}"], frac, rows.get(w, 0))
                                  for w, (_, _, lo, hi, frac) in enumerate(wanted)], "_i int, _lo long, _hi long, _frac double, _rows long")
    for r in _select(kept, goal, [], limit).collect():
        k, i, *_ = wanted[r["_i"]]
        out[columns[k]][i] = r["_q"]
    return out


def _select(rows: DataFrame, goal: DataFrame, keys: list, limit: int) -> DataFrame:
    """(keys, _i, _q): the interpolated order statistics at ranks ``_lo`` and ``_hi`` of ``goal`` among the weighted
    values (keys, _i, _v, _c) of ``rows``."""
    by, limit = [*keys, "_i"], max(limit, 2 * CELLS)
    goal = cut_lineage(goal)
    while (goal.agg(F.max("_rows")).first()[0] or 0) > limit:
        rows, goal = _narrowed(rows, goal, by, limit)
    w = Window.partitionBy(*by).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end, start = F.col("_end"), F.col("_end") - F.col("_c")
    met = left_join(rows.withColumn("_end", F.sum("_c").over(w)), goal, by, how="inner")
    found = met.groupBy(*by).agg(
        F.max(F.when((start <= F.col("_lo")) & (F.col("_lo") < end), F.col("_v"))).alias("_a"),
        F.max(F.when((start <= F.col("_hi")) & (F.col("_hi") < end), F.col("_v"))).alias("_b"), F.first("_frac").alias("_frac"))
    sure = F.when(F.col("_a").isNull() | F.col("_b").isNull(), F.raise_error(F.lit("an order statistic lies outside its bracket")).cast("double"))
    value = F.when(F.col("_frac") == 0, F.col("_a")).otherwise(F.col("_a") + F.col("_frac") * (F.col("_b") - F.col("_a")))
    return found.select(*by, F.coalesce(sure, value).alias("_q"))


def _narrowed(rows: DataFrame, goal: DataFrame, by: list, limit: int) -> tuple[DataFrame, DataFrame]:
    """One round of narrowing: ``rows`` and ``goal`` of the cells that hold the wanted ranks."""
    large = goal.where(F.col("_rows") > limit).select(*by)
    cuts = left_join(rows, large, by, how="inner").groupBy(*by).agg(F.percentile_approx("_v", _fractions(CELLS - 1), ACCURACY).alias("_cuts"))
    cell = F.coalesce(F.size(F.filter("_cuts", lambda k: F.col("_v") > k)), F.lit(0))
    split = cut_lineage(left_join(rows, written(cuts, "cuts"), by).select(*by, "_v", "_c", F.when(F.col("_cuts").isNull(), 0).otherwise(cell).alias("_cell")))
    w = Window.partitionBy(*by).orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = split.groupBy(*by, "_cell").agg(F.sum("_c").alias("_s"), F.count(F.lit(1)).alias("_r")).withColumn("_end", F.sum("_s").over(w))
    start = F.col("_end") - F.col("_s")
    # the cells from the one of _lo to the one of _hi
    near = left_join(sizes, goal, by, how="inner").where((start <= F.col("_hi")) & (F.col("_lo") < F.col("_end"))).groupBy(*by).agg(
        F.min("_cell").alias("_c0"), F.max("_cell").alias("_c1"), F.min(start).alias("_base"), F.sum("_r").alias("_left"))
    near = written(near, "cells")
    kept = left_join(split, near.select(*by, "_c0", "_c1"), by, how="inner").where(F.col("_cell").between(F.col("_c0"), F.col("_c1")))
    after = left_join(goal, near, by, how="inner").select(
        *by, (F.col("_lo") - F.col("_base")).alias("_lo"), (F.col("_hi") - F.col("_base")).alias("_hi"), "_frac", F.col("_left").alias("_rows"))
    return cut_lineage(kept.select(*by, "_v", "_c")), cut_lineage(after)


__all__ = ["exact_quantiles", "quantile_values"]
