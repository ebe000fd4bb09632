"""Batch scoring job (spark-submit entry point).

    spark-submit ratecraft/plans/score_job.py --input in.parquet --output out_csv \
        --model model_dir [--iterations N]

Reads parquet, checks columns and rows, appends ``<t>_pred`` (and with an ensemble
``<t>_lower_95`` / ``<t>_upper_95``), writes CSV part files. Input columns are kept.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession

from ratecraft.errors import AssetLoadError, ValidationError
from ratecraft.operators.checks import require_columns, require_rows
from ratecraft.operators.models import BootstrapEnsemble, MultiTargetModel
from ratecraft.sources.files import scan_parquet
from ratecraft.sources.sinks import sink_csv
from ratecraft.session import build_session


def score(spark: SparkSession, input_path: str, model_path: str,
          iterations: int | None = None) -> DataFrame:
    df = scan_parquet(spark, input_path)
    if iterations:
        ens_path = os.path.join(model_path, "ensemble")
        ens = BootstrapEnsemble.load(ens_path).first_replicates(iterations)
        require_columns(df, ens.spec)
        require_rows(df)
        return ens.predict_interval(df)
    model = MultiTargetModel.load(model_path)
    require_columns(df, model.spec)
    require_rows(df)
    return model.predict(df)


def score_job(spark: SparkSession, input_path: str, output_path: str, model_path: str,
              iterations: int | None = None) -> None:
    sink_csv(score(spark, input_path, model_path, iterations), output_path)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description="score a parquet table with a saved model")
    ap.add_argument("--input", required=True)
    ap.add_argument("--output", required=True)
    ap.add_argument("--model", required=True)
    ap.add_argument("--iterations", type=int, default=None)
    a = ap.parse_args(argv)
    spark = build_session(app_name="ratecraft-score")
    try:
        score_job(spark, a.input, a.output, a.model, a.iterations)
    except (AssetLoadError, ValidationError) as e:
        raise SystemExit(str(e))


if __name__ == "__main__":
    main()
