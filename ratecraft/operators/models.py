"""Models on Spark ML (M1-M9, S9): one regressor per target over a shared
preprocessing pipeline, searches, bootstrap intervals, save/load.

Every fit is a distributed Spark ML job. The driver only loops over a bounded
number of candidates (the search size) and submits independent fits from a
thread pool, the way ``CrossValidator(parallelism=...)`` does.
"""

from __future__ import annotations

import json
import os
import warnings
from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.regression import (
    GBTRegressionModel, GBTRegressor, LinearRegression, LinearRegressionModel,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType, LongType, MapType, StringType, StructField, StructType,
)

from ratecraft.errors import AssetLoadError, MissingColumnsError, ValidationError
from ratecraft.operators.features import (
    FeatureSpec, hash_bucket, holdout_split, kfold_assign, preprocess_pipeline, strip_helpers,
)

FEATURES = "features"

# Boosting parameter names of the reference's regressor and their Spark GBT twins.
PARAM_MAP = {
    "n_estimators": "maxIter",
    "max_depth": "maxDepth",
    "learning_rate": "stepSize",
    "subsample": "subsamplingRate",
    "min_child_weight": "minInstancesPerNode",
    "gamma": "minInfoGain",
    "colsample_bytree": "featureSubsetStrategy",
    "max_bins": "maxBins",
    "seed": "seed",
}
UNSUPPORTED = ("reg_alpha", "reg_lambda", "max_delta_step")


def gbt_params(params: Mapping) -> dict:
    """Translate boosting parameters to GBTRegressor keyword arguments (M1)."""
    out = {}
    for k, v in params.items():
        if k in UNSUPPORTED:
            raise ValidationError(f"parameter {k!r} has no Spark GBT counterpart")
        name = PARAM_MAP.get(k, k)
        if name in ("maxIter", "maxDepth", "minInstancesPerNode", "maxBins", "seed"):
            v = int(v)
        elif name == "featureSubsetStrategy":
            v = str(float(v)) if not isinstance(v, str) else v
        else:
            v = float(v)
        out[name] = v
    return out


def _check(df: DataFrame, spec: FeatureSpec, targets: Sequence[str]) -> None:
    missing = [c for c in list(spec.num) + list(spec.cat) + list(targets) if c not in df.columns]
    if missing:
        raise MissingColumnsError(f"columns missing: {missing}")


@dataclass
class MultiTargetModel:
    """Shared preprocessing + one fitted regressor per target."""
    prep: PipelineModel
    models: dict
    spec: FeatureSpec
    targets: list
    kind: str = "gbt"
    params: dict = field(default_factory=dict)

    def predict(self, df: DataFrame, suffix: str = "_pred") -> DataFrame:
        """M6: input columns unchanged, ``<target>_pred`` appended per target."""
        need = [c for c in list(self.spec.num) + list(self.spec.cat) if c not in df.columns]
        if need:
            raise MissingColumnsError(f"feature columns missing: {need}")
        out = self.prep.transform(df)
        for t in self.targets:
            out = self.models[t].setPredictionCol(t + suffix).transform(out)
        return strip_helpers(out).drop(FEATURES)

    # -- S9 ----------------------------------------------------------------------
    def save(self, path: str) -> None:
        self.prep.write().overwrite().save(os.path.join(path, "prep"))
        for t, m in self.models.items():
            m.write().overwrite().save(os.path.join(path, "targets", t))
        spark = SparkSession.getActiveSession()
        write_run_metadata(spark, os.path.join(path, "meta"), {
            "kind": self.kind, "targets": self.targets, "params": self.params,
            "num": list(self.spec.num), "cat": list(self.spec.cat),
            "drop": list(self.spec.drop)})

    @classmethod
    def load(cls, path: str) -> "MultiTargetModel":
        spark = SparkSession.getActiveSession()
        try:
            meta = read_run_metadata(spark, os.path.join(path, "meta"))
            prep = PipelineModel.load(os.path.join(path, "prep"))
            loader = GBTRegressionModel if meta["kind"] == "gbt" else LinearRegressionModel
            models = {t: loader.load(os.path.join(path, "targets", t)) for t in meta["targets"]}
        except Exception as e:  # absent or unreadable assets
            raise AssetLoadError(f"cannot load model from {path}: {e}") from e
        spec = FeatureSpec(cat=meta["cat"], num=meta["num"], target=meta["targets"], drop=meta["drop"])
        return cls(prep, models, spec, meta["targets"], meta["kind"], meta.get("params", {}))


def write_run_metadata(spark: SparkSession, path: str, meta: Mapping) -> None:
    """One-row JSON document (best params, column lists, targets, cardinalities)."""
    spark.createDataFrame([(json.dumps(meta, sort_keys=True),)], "doc string") \
        .coalesce(1).write.mode("overwrite").text(path)


def read_run_metadata(spark: SparkSession, path: str) -> dict:
    rows = spark.read.text(path).collect()
    if not rows:
        raise AssetLoadError(f"no metadata at {path}")
    return json.loads(rows[0][0])


SHARED_ROWS = 1_000_000  # on fewer rows a fit of Spark ML is mostly the time of its jobs
SPREAD_CELLS = 1 << 23  # values of a partition of ``spread``, 64 MB of doubles


def spread(df: DataFrame, rows: int, values: int) -> DataFrame:
    """Spread a frame of ``rows`` rows with about ``values`` values each over the session's shuffle
    partitions (at least one per core), or over as many more as keep a task at ``SPREAD_CELLS`` values,
    so that what one task reads does not grow with the table."""
    spark = df.sparkSession
    return df.repartition(max(spark.sparkContext.defaultParallelism,
                              int(spark.conf.get("spark.sql.shuffle.partitions", "8")),
                              -(-rows * values // SPREAD_CELLS)))


def _row_values(spec: FeatureSpec, columns: Sequence[str]) -> int:
    """Values of a prepared row: numerics, a one-hot entry's index and value, other columns, and the row's own header."""
    return len(spec.num) + 2 * len(spec.cat) + len(columns) + 8


def _split_keys(keys: Sequence[str]) -> list:
    """Keys that tell rows apart must be named: a guess could put whole groups on one side."""
    if not keys:
        raise ValidationError("keys of the split are required")
    return list(keys)


def _prepared(df: DataFrame, spec: FeatureSpec, targets: Sequence[str],
              fit_on: DataFrame | None) -> tuple[PipelineModel, DataFrame]:
    prep = preprocess_pipeline(df, spec, FEATURES, fit_on=fit_on)
    return prep, prep.transform(df)


def _estimator(kind: str, target: str, params: Mapping, validation_col: str | None = None,
               validation_tol: float = 0.01, weight_col: str | None = None):
    """One Spark ML regressor for ``target`` on the assembled feature vector."""
    if kind == "gbt":
        extra = {}
        if validation_col:
            extra = {"validationIndicatorCol": validation_col, "validationTol": validation_tol}
        est = GBTRegressor(featuresCol=FEATURES, labelCol=target, **gbt_params(params), **extra)
    elif kind == "linear":
        est = LinearRegression(featuresCol=FEATURES, labelCol=target,
                               regParam=float(params.get("reg", 0.0)),
                               elasticNetParam=float(params.get("mix", 0.0)))
    else:
        raise ValidationError(f"unknown model kind {kind!r}")
    if weight_col:
        est = est.setWeightCol(weight_col)
    return est


def fit_multi_target(df: DataFrame, spec: FeatureSpec, targets: Sequence[str],
                     params: Mapping | None = None, kind: str = "gbt",
                     weight_col: str | None = None, fit_on: DataFrame | None = None,
                     validation_col: str | None = None, validation_tol: float = 0.01,
                     parallelism: int = 1) -> MultiTargetModel:
    """M1/M9: preprocessing fitted once, then one regressor per target.

    ``kind='gbt'`` (squared error boosting) or ``'linear'`` (elastic net). Rows with a
    NULL target are skipped for that target only. ``validation_col`` turns on M2.

    From ``SHARED_ROWS`` rows boosted trees are grown together for all targets (``boosting``) and become Spark ML's models; with
    weights, a validation column, a draw of rows or parameters and values that it does not take they are Spark ML's fits, as
    on fewer rows. Both take thresholds from a sample of more than 10,000 rows, each by a draw of its own.
    """
    from ratecraft.operators.boosting import Boosted, grown

    targets = list(targets)
    _check(df, spec, targets)
    params = dict(params or {})
    plan = grown(gbt_params(params)) if kind == "gbt" and not weight_col and not validation_col else None
    extra = [c for c in (weight_col, validation_col) if c]
    # Only the columns the fits read are cached: the preprocessing fit passes and the
    # prepared rows then evaluate the input's lineage once.
    cols = list(dict.fromkeys([*spec.num, *spec.cat, *targets, *extra]))
    narrow = df.select(*cols).persist()
    data = None
    try:
        src = narrow if (fit_on is None or fit_on is df) else fit_on
        prep = preprocess_pipeline(narrow, spec, FEATURES, fit_on=src)
        if plan and plan["subsamplingRate"] == 1.0 and targets and narrow.count() >= SHARED_ROWS:
            binned = _binned(prep, narrow.withColumn("_is_test", F.lit(False)), spec, targets, [plan["maxBins"]])
            if binned is not None:
                rows, n_rows, args, edges = binned
                fits = Boosted(spread(rows, n_rows, _row_values(spec, targets)), *args, [plan], edges)
                try:
                    fits.state.count()
                    narrow.unpersist()
                    fits.fit(keep_state=False)
                    return MultiTargetModel(prep, {t: fits.model(0, t, FEATURES) for t in targets}, spec, targets, kind, params)
                finally:
                    fits.unpersist()
        data = spread(prep.transform(narrow).select(FEATURES, *targets, *extra), narrow.count(),
                      _row_values(spec, targets + extra)).persist()
        data.count()
        narrow.unpersist()  # the fits read the prepared rows only

        def one(t: str):
            rows = data.where(F.col(t).isNotNull())
            est = _estimator(kind, t, params, validation_col, validation_tol, weight_col)
            return t, est.fit(rows)

        with ThreadPoolExecutor(max(1, parallelism)) as pool:
            models = dict(pool.map(one, targets))
    finally:
        if data is not None:
            data.unpersist()
        narrow.unpersist()
    return MultiTargetModel(prep, models, spec, targets, kind, params)


def fit_linear(df: DataFrame, spec: FeatureSpec, target: str, reg: float = 0.0, mix: float = 0.0,
               weight_col: str | None = None) -> MultiTargetModel:
    """M9: elastic-net linear regression of one target."""
    return fit_multi_target(df, spec, [target], {"reg": reg, "mix": mix}, kind="linear",
                            weight_col=weight_col)


def fit_with_validation(df: DataFrame, spec: FeatureSpec, targets: Sequence[str],
                        params: Mapping | None = None, keys: Sequence[str] = (),
                        fraction: float = 0.2, seed: int = 42, tol: float = 0.01) -> MultiTargetModel:
    """M2: boosting that watches a hashed hold-out and may stop early on it."""
    flagged = holdout_split(df, _split_keys(keys), fraction, seed, col="_is_val")
    return fit_multi_target(flagged, spec, targets, params, validation_col="_is_val",
                            validation_tol=tol, fit_on=flagged.where(~F.col("_is_val")))


def refit_best(df: DataFrame, spec: FeatureSpec, targets: Sequence[str], best_params: Mapping,
               rows: str = "all", split_col: str = "is_test") -> MultiTargetModel:
    """M5: refit the chosen parameters on all rows or on the training rows only."""
    if rows == "train":
        train = df.where(~F.col(split_col))
        return fit_multi_target(train, spec, targets, best_params, fit_on=train)
    if rows != "all":
        raise ValidationError("rows must be 'all' or 'train'")
    return fit_multi_target(df, spec, targets, best_params)


# -- search space (M4) -------------------------------------------------------------

def _uniform(trial: F.Column, name: str, seed: int) -> F.Column:
    """Deterministic uniform [0, 1) per (trial, parameter, seed) from md5."""
    h = F.md5(F.concat_ws("|", trial.cast("string"), F.lit(name), F.lit(str(seed))))
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("double") / F.lit(float(16 ** 13))


def sample_space(spark: SparkSession, space: Mapping, n: int | None = None, seed: int = 42,
                 ids: DataFrame | None = None) -> DataFrame:
    """M4: trial table (trial_id, <param> columns, params map) of ``n`` candidates, or
    one candidate per id of ``ids`` (a frame whose first column holds trial ids).

    ``space`` items: ``('int', lo, hi)`` inclusive, ``('int_excl', lo, hi)`` (hi
    excluded), ``('float', lo, hi)``, ``('logfloat', lo, hi)``, ``('choice', [v...])``.
    """
    if ids is not None:
        trials = ids.select(F.col(ids.columns[0]).cast("long").alias("trial_id"))
    else:
        trials = spark.range(n).withColumnRenamed("id", "trial_id")
    cols = {}
    for name, spec in space.items():
        kind = spec[0]
        u = _uniform(F.col("trial_id"), name, seed)
        if kind in ("int", "int_excl"):
            lo, hi = int(spec[1]), int(spec[2])
            if kind == "int":
                hi += 1
            if hi <= lo:
                raise ValidationError(f"{name}: empty integer range")
            cols[name] = (F.floor(u * (hi - lo)) + lo).cast("long")
        elif kind in ("float", "logfloat"):
            lo, hi = float(spec[1]), float(spec[2])
            if not lo < hi:
                raise ValidationError(f"{name}: lower bound must be below upper bound")
            if kind == "float":
                cols[name] = F.lit(lo) + u * (hi - lo)
            else:
                if lo <= 0:
                    raise ValidationError(f"{name}: log range needs positive bounds")
                cols[name] = F.exp(F.log(F.lit(lo)) + u * (F.log(F.lit(hi)) - F.log(F.lit(lo))))
        elif kind == "choice":
            values = list(spec[1])
            arr = F.array(*[F.lit(str(v)) for v in values])
            cols[name] = F.element_at(arr, (F.floor(u * len(values)) + 1).cast("int"))
        else:
            raise ValidationError(f"{name}: unknown kind {kind!r}")
    out = trials.withColumns(cols) if cols else trials
    pm = F.create_map(*[x for name in space for x in (F.lit(name), F.col(name).cast("string"))]) \
        if space else F.create_map().cast(MapType(StringType(), StringType()))
    return out.withColumn("params", pm)


def _typed(row_params: Mapping) -> dict:
    out = {}
    for k, v in row_params.items():
        try:
            out[k] = int(v) if str(v).lstrip("-").isdigit() else float(v)
        except (TypeError, ValueError):
            out[k] = v
    return out


# -- searches (M3, M8) ---------------------------------------------------------------

def random_search_cv(df: DataFrame, spec: FeatureSpec, targets: Sequence[str], space: Mapping,
                     n_iter: int = 20, folds: int = 3, seed: int = 42, keys: Sequence[str] = (),
                     parallelism: int = 4) -> tuple[dict, DataFrame]:
    """M3: k-fold search of one parameter set shared by all targets (mean R^2 over
    folds, then over targets).

    Folds come from the key hash (F11); preprocessing is fitted on each fold's training
    rows, so nothing of the validation rows reaches the fit. A candidate that fails in any
    fold scores NULL and is never best; if all fail, the last error is raised. Returns
    (best params, table of (trial_id, params, mean_r2)).
    """
    targets = list(targets)
    spark = df.sparkSession
    trials = sample_space(spark, space, n_iter, seed).collect()  # n_iter rows, bounded
    cand = [(r["trial_id"], _typed(r["params"])) for r in trials]
    data = kfold_assign(df, _split_keys(keys), folds, seed, col="_fold")
    n_rows = data.count()
    scores: dict = {tid: [] for tid, _ in cand}
    failed: dict = {}
    # k-fold loop as CrossValidator runs it (parallel fits per fold), without its
    # final per-target refit: the shared best set is refitted once by refit_best.
    for k in range(folds):
        fit_rows = data.where(F.col("_fold") != k)
        prep = preprocess_pipeline(data, spec, FEATURES, fit_on=fit_rows)
        feats = spread(prep.transform(data).select(FEATURES, "_fold", *targets), n_rows, _row_values(spec, targets)).persist()
        try:
            for t in targets:
                est = GBTRegressor(featuresCol=FEATURES, labelCol=t)
                ev = RegressionEvaluator(labelCol=t, metricName="r2")
                rows_t = feats.where(F.col(t).isNotNull())
                train, valid = rows_t.where(F.col("_fold") != k), rows_t.where(F.col("_fold") == k)

                def score(item, train=train, valid=valid, est=est, ev=ev):
                    tid, p = item
                    try:
                        m = est.copy({getattr(est, a): v for a, v in gbt_params(p).items()}).fit(train)
                        return tid, ev.evaluate(m.transform(valid))
                    except Exception as e:  # the other candidates go on
                        failed[tid] = e
                        return tid, None

                with ThreadPoolExecutor(max(1, parallelism)) as pool:
                    for tid, r2 in pool.map(score, cand):
                        scores[tid].append(r2)
        finally:
            feats.unpersist()
    if cand and len(failed) == len(cand):
        raise ValidationError("every candidate failed") from next(reversed(failed.values()))
    rows = [(int(tid), {k: str(v) for k, v in p.items()},
             None if tid in failed else float(sum(scores[tid]) / len(scores[tid]))) for tid, p in cand]
    table = spark.createDataFrame(rows, StructType([
        StructField("trial_id", LongType()), StructField("params", MapType(StringType(), StringType())),
        StructField("mean_r2", DoubleType())]))
    best = max((r for r in rows if r[2] is not None), key=lambda r: (r[2], -r[0]))
    return _typed(best[1]), table


def _prepared_split(df: DataFrame, spec: FeatureSpec, targets: Sequence[str], keys: Sequence[str],
                    fraction: float, seed: int) -> DataFrame:
    """(features, _is_test, targets) of a hashed hold-out, cached; preprocessing is fitted on the training rows.
    The passes of that fit read one cache of the columns they need, which is let go once the rows are prepared."""
    split = holdout_split(df, _split_keys(keys), fraction, seed, col="_is_test")
    split = split.select(*dict.fromkeys([*spec.num, *spec.cat, *targets]), "_is_test").persist()
    try:
        prep = preprocess_pipeline(split, spec, FEATURES, fit_on=split.where(~F.col("_is_test")))
        data = spread(prep.transform(split).select(FEATURES, "_is_test", *targets), split.count(),
                      _row_values(spec, targets)).persist()
        data.count()
    finally:
        split.unpersist()
    return data


TRIAL_SCHEMA = StructType([
    StructField("trial_id", LongType()), StructField("step", LongType()),
    StructField("value", DoubleType()), StructField("state", StringType()),
    StructField("params", MapType(StringType(), StringType())),
    StructField("error", StringType())])


BATCH_CELLS = 1 << 26  # predictions kept beside the rows for the trials of a batch, 512 MB over all tasks
BLOCK_CELLS = 1 << 22  # a task's rows and sums for the trials of a batch, 32 MB


def _finite(c: str):
    return F.col(f"`{c}`").isNull() | (F.abs(F.col(f"`{c}`").cast("double")) < float("inf"))  # NaN is above infinity


def _binned(prep: PipelineModel, split: DataFrame, spec: FeatureSpec, targets: list, bins: Sequence[int]) -> tuple | None:
    """(rows, their number, leading arguments of ``Boosted``, thresholds) of ``split`` (features, targets, _is_test) under the
    fitted ``prep``. None where values are not finite or a target has too few rows: Spark ML tells of those."""
    from ratecraft.operators.boosting import sampled_edges

    num, cat = [f"__z_{c}" for c in spec.num], [f"__i_{c}" for c in spec.cat]
    levels = [len(x) for s in prep.stages if isinstance(s, StringIndexerModel) for x in s.labelsArray]
    rows = prep.transform(split).select(*[F.col(f"`{c}`") for c in num + cat], *dict.fromkeys(targets), "_is_test")
    train = rows.where(~F.col("_is_test"))
    seen = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("_is_test")).alias("train"),
                    F.count_if(~reduce(and_, [_finite(c) for c in [*num, *targets]])).alias("odd"),
                    *[F.count_if(~F.col("_is_test") & F.col(f"`{t}`").isNotNull()).alias(f"n{i}") for i, t in enumerate(targets)]).first()
    n = [seen[f"n{i}"] for i in range(len(targets))]
    if seen["odd"] or min(n) < 2:
        return None
    edges = {}
    for most in dict.fromkeys(bins):
        of = {}  # targets without gaps share their thresholds
        for i, t in enumerate(targets):
            key = n[i] if n[i] == seen["train"] else t
            if key not in of:
                of[key] = sampled_edges(train.where(F.col(f"`{t}`").isNotNull()), num, n[i], most)
            edges[i, most] = of[key]
    return rows, seen["rows"], (num, cat, levels, targets), edges


def _boosted_together(df: DataFrame, spec: FeatureSpec, targets: list, trials: Sequence[Mapping], keys: Sequence[str],
                      fraction: float, seed: int, parallelism: int) -> Iterator[list | None]:
    """Mean hold-out RMSE of each of ``trials`` (``grown`` parameters), a list per batch of ``parallelism`` trials, or of as many
    more as keep within ``BATCH_CELLS`` and ``BLOCK_CELLS``; None for trials whose fit failed. Nothing is yielded where values are not finite or a target has too few rows: Spark ML tells of those."""
    from ratecraft.operators.boosting import Boosted
    from ratecraft.operators.metrics import regression_metrics

    split = holdout_split(df, _split_keys(keys), fraction, seed, col="_is_test")
    split = split.select(*dict.fromkeys([*spec.num, *spec.cat, *targets]), "_is_test").persist()
    data = None
    try:
        prep = preprocess_pipeline(split, spec, FEATURES, fit_on=split.where(~F.col("_is_test")))
        binned = _binned(prep, split, spec, targets, [p["maxBins"] for p in trials])
        if binned is None:
            return
        rows, n_rows, args, edges = binned
        data = spread(rows, n_rows, _row_values(spec, targets) + min(parallelism, len(trials)) * len(targets))
        slots = sum(args[2]) + len(args[1]) + len(args[0]) * max(p["maxBins"] for p in trials)
        widest = len(targets) * slots * 2 ** max(p["maxDepth"] for p in trials)  # rows and sums of a trial's last level
        batch = max(parallelism, min(BATCH_CELLS // (n_rows * len(targets)), BLOCK_CELLS // widest))
        if len(trials) > batch:  # read once more for each batch
            data.persist()

        def values(some: Sequence[Mapping]) -> list:
            fits = Boosted(data, *args, some, edges)
            try:
                fits.state.count()
                split.unpersist()
                fits.fit()
                with ThreadPoolExecutor(parallelism) as pool:
                    return list(pool.map(lambda k: float(regression_metrics(fits.scored(k), {t: t + "_pred" for t in targets})
                                                         .agg(F.avg("rmse")).first()[0]), range(len(some))))
            finally:
                fits.unpersist()

        for k in range(0, len(trials), batch):
            try:
                found = values(trials[k:k + batch])
            except Exception as e:  # each of them is then fitted, and may fail, alone
                warnings.warn(f"shared boosting failed, its trials are fitted one by one: {type(e).__name__}: {e}"[:2000])
                found = [None] * len(trials[k:k + batch])
            yield found
    finally:
        if data is not None:
            data.unpersist()
        split.unpersist()


def trial_search(df: DataFrame, spec: FeatureSpec, targets: Sequence[str], space: Mapping,
                 n_trials: int = 10, seed: int = 42, keys: Sequence[str] = (),
                 fraction: float = 0.2, done: DataFrame | None = None,
                 parallelism: int = 4, kind: str = "gbt", log=None) -> DataFrame:
    """M8 (+J6): score candidates by mean RMSE over targets on a hashed hold-out.

    Trials completed in ``done`` are skipped (anti join). A failing fit is logged as
    state FAIL with its error instead of stopping the search; if every trial fails, the
    search raises. Returns the trial log (trial_id, step, value, state, params, error); pick the best with ``best_trial``.
    With a ``TrialLog`` as ``log`` each trial is written when it ends, what the log holds is not run again,
    and the log's results are returned.

    Boosted trials are grown ``parallelism`` at a time, or more on small tables, over shared passes (``boosting``); those whose parameters or rows it
    does not take, or whose shared fit failed, are Spark ML's fits.
    """
    from ratecraft.operators.boosting import grown
    from ratecraft.operators.joins import remaining_trials
    from ratecraft.operators.metrics import regression_metrics

    spark = df.sparkSession
    grid = sample_space(spark, space, n_trials, seed)
    if done is not None:
        grid = remaining_trials(grid, done)
    if log is not None:
        grid = remaining_trials(grid, log.results().select("trial_id"))
    todo = [(r["trial_id"], r["params"]) for r in grid.select("trial_id", "params").collect()]
    targets = list(targets)
    _check(df, spec, targets)
    parallelism = max(1, parallelism)

    def run(item, data):
        tid, p = item
        train, test = data.where(~F.col("_is_test")), data.where(F.col("_is_test"))
        try:
            scored = test
            for t in targets:
                m = _estimator(kind, t, _typed(p)).fit(train.where(F.col(t).isNotNull()))
                scored = m.setPredictionCol(t + "_pred").transform(scored)
            m = regression_metrics(scored, {t: t + "_pred" for t in targets})
            value = m.agg(F.avg("rmse")).first()[0]
            return (int(tid), 0, float(value), "COMPLETE", dict(p), None)
        except Exception as e:  # a failed candidate is recorded, the search goes on
            return (int(tid), 0, None, "FAIL", dict(p), f"{type(e).__name__}: {e}"[:2000])

    def ended(row):
        if log is not None:
            log.append(row[0], log.END, [row[1:]])
        return row

    def together(p):
        try:
            return grown(gbt_params(_typed(p))) if kind == "gbt" else None
        except Exception:  # the fit of this trial alone records the error
            return None

    found = {}
    shared = [(item, plan) for item in todo if (plan := together(item[1])) is not None]
    if shared:
        batches = _boosted_together(df, spec, targets, [plan for _, plan in shared], keys, fraction, seed, parallelism)
        items = (item for item, _ in shared)
        for values in batches:
            for value, (tid, p) in zip(values, items):
                if value is not None:
                    found[tid] = ended((int(tid), 0, value, "COMPLETE", dict(p), None))
    alone = [item for item in todo if item[0] not in found]
    if alone or not todo:
        # preprocessing does not depend on the candidate: fit it once on the training rows
        # and cache the prepared rows for every candidate's fits
        data = _prepared_split(df, spec, targets, keys, fraction, seed)
        try:
            with ThreadPoolExecutor(parallelism) as pool:
                found.update((row[0], row) for row in pool.map(lambda item: ended(run(item, data)), alone))
        finally:
            data.unpersist()
    rows = [found[tid] for tid, _ in todo]
    if log is not None:
        return log.results()
    if rows and all(r[3] == "FAIL" for r in rows):
        raise ValidationError(f"every trial failed: {rows[0][5]}")
    return spark.createDataFrame(rows, TRIAL_SCHEMA)


# -- intervals (M7) -------------------------------------------------------------------

def bootstrap_coefficients(feats: DataFrame, targets: Sequence[str], keys: Sequence[str], iterations: int,
                           reg: float = 0.0, seed: int = 42) -> DataFrame:
    """(b, target, coefficients): ``iterations`` weighted refits of a linear model on the vector ``features``.

    One pass: every task adds up one block of normal equations per replicate, X'X shared by targets that miss
    the same rows; blocks merge as a tree and are solved on executors (see ``normal_equations``). Replicate b
    weighs a row by Poisson(1) drawn from md5 of (keys, seed, b). The first coefficient is the intercept; ``reg`` is a
    ridge penalty reg * sum(w) on the others. Rows with a non-finite feature are left out, rows without a target for
    that target only.
    """
    from pyspark.ml.functions import vector_to_array
    from ratecraft.operators.normal_equations import Blocks, bootstrap_names, merged_blocks, ridge, solved

    attrs = feats.schema[FEATURES].metadata["ml_attr"]["attrs"]
    blocks = Blocks(1 + sum(len(v) for v in attrs.values()), len(targets))
    rows = feats.select(F.lit(0).alias("_g"), F.concat(F.array(F.lit(1.0)), vector_to_array(F.col(FEATURES))).alias("_x"),
                        F.array(*[F.col(t).cast("double") for t in targets]).alias("_y"),
                        bootstrap_names(keys, seed).alias("_name"))
    names = list(targets)

    def solve(g, b, block):
        for t, name in enumerate(names):
            gram, right, *_, weight = blocks.parts(block, t)
            yield b, name, ridge(gram, right, weight, reg).tolist()

    return solved(merged_blocks(rows, blocks, iterations), blocks, solve,
                  "b int, target string, coefficients array<double>")


def row_quantiles(values, qs: Sequence[float]) -> list:
    """Linear-interpolated quantiles of each row of a matrix from one sort per row (NaN in a row: NaN)."""
    import numpy as np
    ordered = np.sort(values, axis=1)  # NaN last
    last = ordered.shape[1] - 1
    unknown, out = np.isnan(ordered[:, last]), []
    for q in qs:
        k = int(q * last)
        part, a, b = q * last - k, ordered[:, k], ordered[:, min(k + 1, last)]
        one = a + (b - a) * part if part < 0.5 else b - (b - a) * (1 - part)
        out.append(np.where(unknown, np.nan, one))
    return out


@dataclass
class BootstrapEnsemble:
    """M7: B weighted linear refits per target over one shared preprocessing pipeline.

    ``coefs[t]`` is a (B, 1 + p) array of intercept and slopes in the preprocessed
    (z-scored, one-hot) feature space.
    """
    prep: PipelineModel
    coefs: dict
    spec: FeatureSpec
    targets: list

    @classmethod
    def fit(cls, train: DataFrame, spec: FeatureSpec, targets: Sequence[str], keys: Sequence[str],
            iterations: int = 50, params: Mapping | None = None, seed: int = 42) -> "BootstrapEnsemble":
        """All B replicates in one pass over the data (``bootstrap_coefficients``); the driver gets
        their B x T coefficient rows. ``params['reg']`` is the ridge penalty.
        """
        targets = list(targets)
        _check(train, spec, targets)
        if iterations < 2:
            raise ValidationError("an interval needs at least 2 iterations")
        reg = float((params or {}).get("reg", 0.0))
        # cache only what the fit reads; preprocessing passes and the one pass of normal
        # equations then evaluate the training rows' lineage once
        train = train.select(*dict.fromkeys([*spec.num, *spec.cat, *targets, *keys])).persist()
        try:
            return cls._fit_cached(train, spec, targets, keys, iterations, reg, seed)
        finally:
            train.unpersist()

    @classmethod
    def _fit_cached(cls, train: DataFrame, spec: FeatureSpec, targets: list, keys: Sequence[str],
                    iterations: int, reg: float, seed: int) -> "BootstrapEnsemble":
        import numpy as np

        prep = preprocess_pipeline(train, spec, FEATURES)
        found = {(r["b"], r["target"]): r["coefficients"] for r in
                 bootstrap_coefficients(prep.transform(train), targets, keys, iterations, reg, seed).collect()}
        if len(found) < iterations * len(targets):
            raise ValidationError("no training row")
        coefs = {t: np.array([found[b, t] for b in range(iterations)]) for t in targets}
        return cls(prep, coefs, spec, targets)

    def first_replicates(self, n: int) -> "BootstrapEnsemble":
        """The ensemble cut to ``n`` replicates; more than were fitted cannot be had."""
        fitted = min(len(c) for c in self.coefs.values())
        if not 2 <= n <= fitted:
            raise ValidationError(f"{n} iterations asked for; the ensemble has {fitted} (2 at least)")
        return BootstrapEnsemble(self.prep, {t: c[:n] for t, c in self.coefs.items()}, self.spec, self.targets)

    def predict_interval(self, df: DataFrame, lo: float = 2.5, hi: float = 97.5) -> DataFrame:
        """Adds ``<t>_pred`` (bootstrap mean), ``<t>_lower_95``, ``<t>_upper_95``.

        Only the feature array crosses to Python, in Arrow batches: one matrix
        product scores all B replicates of a batch, then the mean and the linear-
        interpolated percentiles are taken across replicates, row by row. No shuffle.
        """
        import numpy as np
        import pandas as pd
        from pyspark.ml.functions import vector_to_array

        need = [c for c in list(self.spec.num) + list(self.spec.cat) if c not in df.columns]
        if need:
            raise MissingColumnsError(f"feature columns missing: {need}")
        targets = list(self.targets)
        coefs = {t: np.asarray(self.coefs[t], dtype=float) for t in targets}
        fields = [f"{t}{sfx}" for t in targets for sfx in ("_pred", "_lower_95", "_upper_95")]
        schema = ", ".join(f"`{f}` double" for f in fields)
        qs = [lo / 100, hi / 100]

        def score(xs):
            if len(xs) == 0:
                return pd.DataFrame({f: pd.Series([], dtype=float) for f in fields})
            X = np.column_stack([np.ones(len(xs)), np.stack(xs.to_numpy())])
            out = {}
            for t in targets:
                P = X @ coefs[t].T  # rows x B
                out[f"{t}_pred"] = P.mean(axis=1)
                out[f"{t}_lower_95"], out[f"{t}_upper_95"] = row_quantiles(P, qs)
            return pd.DataFrame(out)

        score.__annotations__ = {"xs": pd.Series, "return": pd.DataFrame}
        score_udf = F.pandas_udf(score, schema)
        sc = self.prep.transform(df)
        res = sc.withColumn("__s", score_udf(vector_to_array(F.col(FEATURES))))
        res = res.select(*df.columns, *[F.col(f"__s.`{f}`").alias(f) for f in fields])
        return res

    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        self.prep.write().overwrite().save(os.path.join(path, "prep"))
        write_run_metadata(spark, os.path.join(path, "meta"), {
            "kind": "bootstrap", "targets": self.targets,
            "coefs": {t: c.tolist() for t, c in self.coefs.items()},
            "num": list(self.spec.num), "cat": list(self.spec.cat)})

    @classmethod
    def load(cls, path: str) -> "BootstrapEnsemble":
        import numpy as np
        spark = SparkSession.getActiveSession()
        try:
            meta = read_run_metadata(spark, os.path.join(path, "meta"))
            prep = PipelineModel.load(os.path.join(path, "prep"))
        except Exception as e:
            raise AssetLoadError(f"cannot load ensemble from {path}: {e}") from e
        spec = FeatureSpec(cat=meta["cat"], num=meta["num"], target=meta["targets"])
        coefs = {t: np.array(c) for t, c in meta["coefs"].items()}
        return cls(prep, coefs, spec, meta["targets"])


def predict_interval(df: DataFrame, train: DataFrame, spec: FeatureSpec, targets: Sequence[str],
                     keys: Sequence[str], iterations: int | None = 50,
                     params: Mapping | None = None, seed: int = 42) -> DataFrame:
    """M7: prediction with a 95% bootstrap interval; 0/None iterations -> plain M6."""
    if not iterations:
        return fit_multi_target(train, spec, targets, params, kind="linear").predict(df)
    ens = BootstrapEnsemble.fit(train, spec, targets, keys, iterations, params, seed)
    return ens.predict_interval(df)
