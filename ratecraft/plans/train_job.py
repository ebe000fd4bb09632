"""Training job (spark-submit entry point): search, refit, ensemble, metadata.

    spark-submit ratecraft/plans/train_job.py --table model_table.parquet --model model_dir \
        --targets breast,lung --num gdp,rate --cat sex,age_group --keys fips,year,sex,age_group \
        [--drop col,...] [--trials 50] [--rungs 8,24,72] [--iterations 100] [--seed 42]

Reads parquet, drops columns, checks the frame (V1-V3), searches by rungs on a hashed hold-out with a log in
``<model>/trials`` (a job that is started again goes on where the last one was ended), refits the best trial on
all rows, and writes:

* ``<model>``: the boosted model, loaded by the score job;
* ``<model>/ensemble``: linear replicates for intervals, when iterations are asked for (``score_job --iterations``);
* ``<model>/run``: one JSON document with best parameters, trial counts, hold-out metrics of the best trial,
  column lists, targets and, per category, levels and embedding size (S10).

Medians, scalers and levels are fitted on training rows within the search and on all rows in the refit.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft.errors import MissingColumnsError, ValidationError
from ratecraft.functions.columns import drop_columns
from ratecraft.operators.aggregates import cardinality_profile
from ratecraft.operators.checks import require_columns, validate_frame
from ratecraft.operators.features import FeatureSpec, holdout_split
from ratecraft.operators.metrics import regression_metrics
from ratecraft.operators.models import BootstrapEnsemble, MultiTargetModel, _typed, fit_multi_target, read_run_metadata, refit_best, write_run_metadata
from ratecraft.operators.trial_log import TrialLog, staged_search
from ratecraft.operators.trials import best_trial, trial_state_counts
from ratecraft.session import build_session
from ratecraft.sources.files import scan_parquet

SPACE = {"n_estimators": ("int", 8, 72), "max_depth": ("int", 3, 8), "learning_rate": ("logfloat", 0.01, 0.3),
         "subsample": ("float", 0.6, 1.0), "colsample_bytree": ("float", 0.6, 1.0), "min_child_weight": ("int", 1, 7)}


def train(df: DataFrame, spec: FeatureSpec, model_path: str, keys: Sequence[str], *, space: Mapping = SPACE, trials: int = 50,
          rungs: Sequence[int] = (8, 24, 72), iterations: int | None = None, fraction: float = 0.2, seed: int = 42,
          patience: int = 7, parallelism: int = 4) -> MultiTargetModel:
    """Search, refit and export; returns the refitted model."""
    spark = df.sparkSession
    targets = list(spec.target)
    if spec.drop:
        df = drop_columns(df, spec.drop, strict=True)
    validate_frame(df, targets)
    require_columns(df, spec)
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise MissingColumnsError(f"key columns missing: {missing}")
    log = TrialLog(spark, os.path.join(model_path, "trials"))
    staged_search(df, spec, targets, space, log, n_trials=trials, rungs=rungs, keys=keys, fraction=fraction, seed=seed,
                  patience=patience, parallelism=parallelism)
    best = best_trial(log.results()).first()
    if best is None:
        raise ValidationError("no trial was completed")
    params = {"seed": seed, **_typed(best["params"]), "n_estimators": best["step"] + 1}
    split = holdout_split(df, keys, fraction, seed)
    rows = split.where(~F.col("is_test"))
    scored = fit_multi_target(rows, spec, targets, params).predict(split.where(F.col("is_test")))
    metrics = {r["target"]: {m: r[m] for m in ("mse", "rmse", "r2")}
               for r in regression_metrics(scored, {t: t + "_pred" for t in targets}).collect()}
    model = refit_best(df, spec, targets, params, rows="all")
    model.save(model_path)
    if iterations:
        BootstrapEnsemble.fit(df, spec, targets, keys, iterations, seed=seed).save(os.path.join(model_path, "ensemble"))
    levels = {r["column"]: {"levels": r["n_levels"], "embedding": r["emb_dim"]}
              for r in cardinality_profile(df, spec.cat).collect()} if spec.cat else {}
    write_run_metadata(spark, os.path.join(model_path, "run"), {
        "best_params": params, "best_trial": best["trial_id"], "best_value": best["value"], "holdout_metrics": metrics,
        "trials": {r["state"]: r["n"] for r in trial_state_counts(log.results()).collect()},
        "num": list(spec.num), "cat": list(spec.cat), "targets": targets, "keys": list(keys), "cardinalities": levels,
        "iterations": iterations or 0, "seed": seed})
    return model


def run_metadata(spark: SparkSession, model_path: str) -> dict:
    """The document that ``train`` wrote."""
    return read_run_metadata(spark, os.path.join(model_path, "run"))


def _names(text: str) -> list[str]:
    return [c for c in text.split(",") if c]


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description="search, fit and save a multi-target model")
    for name in ("--table", "--model", "--targets", "--keys"):
        ap.add_argument(name, required=True)
    for name in ("--num", "--cat", "--drop"):
        ap.add_argument(name, default="")
    ap.add_argument("--trials", type=int, default=50)
    ap.add_argument("--rungs", default="8,24,72")
    ap.add_argument("--iterations", type=int, default=None)
    ap.add_argument("--seed", type=int, default=42)
    a = ap.parse_args(argv)
    spark = build_session(app_name="ratecraft-train")
    spec = FeatureSpec(cat=_names(a.cat), num=_names(a.num), target=_names(a.targets), drop=_names(a.drop))
    try:
        train(scan_parquet(spark, a.table), spec, a.model, _names(a.keys), trials=a.trials, rungs=[int(r) for r in _names(a.rungs)],
              iterations=a.iterations, seed=a.seed)
    except ValidationError as e:
        raise SystemExit(str(e))


if __name__ == "__main__":
    main()
