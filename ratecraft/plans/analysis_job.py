"""Rate analysis of a model table: group rankings and target cross-correlations.

    spark-submit ratecraft/plans/analysis_job.py --table model_table.parquet \
        --targets breast,lung_and_bronchus,melanoma_of_the_skin --output analysis/

Writes, one folder each: ``rankings`` (mean rate per group for every grouping
column and target, truncated, with its rank), ``cross_correlation`` (target x
numeric feature per group of ``--group``), ``missing`` and ``profile``.
Every table is one or a few grouped Spark aggregations; nothing loops on the driver.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft.functions.columns import columns_of_type
from ratecraft.functions.scalar import truncate_int
from ratecraft.operators.aggregates import union_all
from ratecraft.operators.ordered import ordered_scan
from ratecraft.operators.profile import cross_correlation, missing_summary, profile
from ratecraft.session import build_session
from ratecraft.sources.files import scan_parquet
from ratecraft.sources.sinks import sink_parquet


def group_rankings(df: DataFrame, group_cols: Sequence[str], targets: Sequence[str]) -> DataFrame:
    """(group_col, group, target, mean_rate, rank): mean of each target per level of each
    grouping column (NULL levels dropped), ranked descending (NULL means last, ties
    by level). One stacked aggregation for all grouping columns and targets."""
    stack = F.explode(F.array(*[
        F.struct(F.lit(g).alias("group_col"), F.col(g).cast("string").alias("group"),
                 F.lit(t).alias("target"), F.col(t).cast("double").alias("v"))
        for g in group_cols for t in targets]))
    long = df.select(stack.alias("_s")).select("_s.*").where(F.col("group").isNotNull())
    means = long.groupBy("group_col", "group", "target").agg(F.avg("v").alias("_mean"))
    ranked = ordered_scan(
        means.withColumns({"_null": F.col("_mean").isNull(), "_neg": -F.col("_mean")}),
        ["group_col", "target"], ["_null", "_neg", "group"], index="_r")
    return ranked.select("group_col", "group", "target",
                         truncate_int("_mean").alias("mean_rate"),
                         (F.col("_r") + 1).cast("long").alias("rank"))


def analyse(df: DataFrame, targets: Sequence[str], group_col: str = "age_group",
            ranking_cols: Sequence[str] = ("states", "sex", "age_group"),
            threshold: float | None = None) -> dict[str, DataFrame]:
    targets = list(targets)
    ranking_cols = [c for c in ranking_cols if c in df.columns]
    features = [c for c in columns_of_type(df, "number") if c not in targets]
    cc = cross_correlation(df, targets, group_col, threshold=threshold,
                           features=[c for c in features if c != group_col])
    overall = cross_correlation(df.withColumn("_all", F.lit("all")), targets, "_all",
                                threshold=threshold, features=[c for c in features if c != group_col])
    return {
        "rankings": group_rankings(df, ranking_cols, targets),
        "cross_correlation": union_all([cc, overall]),
        "missing": missing_summary(df),
        "profile": profile(df),
    }


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description="rank and correlate a rate model table")
    ap.add_argument("--table", required=True)
    ap.add_argument("--targets", required=True, help="comma-separated target columns")
    ap.add_argument("--group", default="age_group")
    ap.add_argument("--threshold", type=float, default=None)
    ap.add_argument("--output", required=True)
    a = ap.parse_args(argv)
    spark = build_session(app_name="ratecraft-analysis")
    df = scan_parquet(spark, a.table)
    for name, out in analyse(df, a.targets.split(","), a.group, threshold=a.threshold).items():
        sink_parquet(out, os.path.join(a.output, name))


if __name__ == "__main__":
    main()
