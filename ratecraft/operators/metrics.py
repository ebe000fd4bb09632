"""Regression metrics (A16): one aggregation pass for all targets."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def regression_metrics(df: DataFrame, pairs: Mapping[str, str]) -> DataFrame:
    """(target, n, mse, rmse, r2) per ``{target: prediction_column}``.

    Rows where truth or prediction is NULL are skipped for that target.
    R^2 = 1 - SSE / SST with SST = n * var_pop(y) over the same rows.
    """
    aggs, items = [], []
    for i, (t, p) in enumerate(pairs.items()):
        both = F.col(t).isNotNull() & F.col(p).isNotNull()
        y, yhat = F.when(both, F.col(t).cast("double")), F.when(both, F.col(p).cast("double"))
        aggs += [F.count(y).alias(f"n{i}"), F.avg((y - yhat) * (y - yhat)).alias(f"mse{i}"),
                 F.var_pop(y).alias(f"v{i}")]
        items.append((t, i))
    one = df.agg(*aggs)
    structs = [F.struct(F.lit(t).alias("target"), F.col(f"n{i}").alias("n"),
                        F.col(f"mse{i}").alias("mse"), F.sqrt(F.col(f"mse{i}")).alias("rmse"),
                        (F.lit(1.0) - F.try_divide(F.col(f"mse{i}"), F.col(f"v{i}"))).alias("r2"))
               for t, i in items]
    return one.select(F.explode(F.array(*structs)).alias("_s")).select("_s.*")
