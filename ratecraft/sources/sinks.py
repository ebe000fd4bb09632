"""Writers (S7, S8). Outputs are written by the executors as part files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def sink_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                 mode: str = "overwrite") -> None:
    """Parquet, optionally partitioned by columns."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def sink_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite",
             key_columns: Sequence[str] = ()) -> None:
    """CSV with a header. The pandas row index has no Spark meaning: pass the key
    columns to write first instead."""
    cols = list(key_columns) + [c for c in df.columns if c not in key_columns]
    df.select(*cols).write.mode(mode).option("header", header).csv(path)
