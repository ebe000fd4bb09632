"""Missing-value fills.

Fill values are parameter-sized (one number per column): they are computed by a
distributed aggregation, brought to the driver, and applied as literals, so the
transform stays a narrow projection inside whole-stage codegen. Fit on training
rows only (pass ``fit_on``) to avoid leaking held-out rows into the fill.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ratecraft.functions.scalar import truncate_int
from ratecraft.operators.quantiles import quantile_values


def _missing(df: DataFrame, c: str) -> F.Column:
    cond = F.col(c).isNull()
    if isinstance(df.schema[c].dataType, (DoubleType, FloatType)):
        cond = cond | F.isnan(c)
    return cond


def _apply(df: DataFrame, values: dict, truncate: Sequence[str]) -> DataFrame:
    out = {}
    for c, v in values.items():
        filled = F.when(_missing(df, c), F.lit(v)).otherwise(F.col(c))
        if c in truncate:
            filled = truncate_int(filled)
        out[c] = filled
    return df.withColumns(out) if out else df


def median_values(df: DataFrame, cols: Sequence[str]) -> dict:
    """Exact medians (linear interpolation between the two middle values)."""
    cols = list(cols)
    clean = df.select(*[F.when(~_missing(df, c), F.col(c).cast("double")).alias(c) for c in cols])
    return {c: v[0] for c, v in quantile_values(clean, cols, [0.5]).items()}


def mean_values(df: DataFrame, cols: Sequence[str]) -> dict:
    cols = list(cols)
    row = df.agg(*[F.avg(F.when(~_missing(df, c), F.col(c))).alias(c) for c in cols]).first()
    return {c: row[c] for c in cols}


def median_fill(df: DataFrame, cols: Sequence[str], truncate: Sequence[str] = (),
                fit_on: DataFrame | None = None) -> DataFrame:
    """Replace NULL/NaN by the column's exact median; ``truncate`` columns become BIGINT."""
    return _apply(df, median_values(fit_on if fit_on is not None else df, cols), truncate)


def mean_fill(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Replace NULL/NaN by the column mean."""
    return _apply(df, mean_values(fit_on if fit_on is not None else df, cols), ())
