"""A durable trial log and a search by rungs that can be resumed.

``TrialLog`` is an append-only table in a shared folder. Every entry, one (trial, rung), is written
once, as one small Parquet file that appears when its job commits; an entry that is written again (two
drivers, or a driver that died while writing) replaces itself. A search that is killed loses at most
the fits that were under way: the next run reads the log and goes on with the anti join of its grid
with the entries (J6).

``staged_search`` fits the trials rung by rung. One boosted fit gives the hold-out loss after each of
its trees (one evaluation pass over the cached rows), so the log holds a row per step. After a rung,
early stopping (W1) and median pruning (W2) run on the log itself and end trials; the others are
fitted with more trees. Decisions after a rung read only that rung's steps and those before it, so a
resumed search decides as an unbroken one does.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, MapType, StringType, StructField, StructType

from ratecraft.errors import ValidationError
from ratecraft.operators.features import FeatureSpec
from ratecraft.operators.models import _check, _estimator, _prepared_split, _typed, sample_space
from ratecraft.operators.trials import early_stop, median_prune

LOG_SCHEMA = StructType([
    StructField("trial_id", LongType()), StructField("rung", LongType()), StructField("step", LongType()),
    StructField("value", DoubleType()), StructField("state", StringType()),
    StructField("params", MapType(StringType(), StringType())), StructField("error", StringType())])

RUNNING, COMPLETE, PRUNED, FAIL = "RUNNING", "COMPLETE", "PRUNED", "FAIL"
END = -1  # rung of the row that ends a trial


class TrialLog:
    """Append-only log in the folder ``path``, which driver and executors share."""

    END = END

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        # so that a log without entries can be read
        spark.createDataFrame([], LOG_SCHEMA).coalesce(1).write.mode("ignore").parquet(f"{self.path}/entry-none")

    def append(self, trial_id: int, rung: int, rows: Sequence[tuple]) -> None:
        """Write the entry (trial, rung): (step, value, state, params, error) rows."""
        full = [(int(trial_id), int(rung), int(step), value, state, dict(params), error)
                for step, value, state, params, error in rows]
        self.spark.createDataFrame(full, LOG_SCHEMA).coalesce(1) \
            .write.mode("overwrite").parquet(f"{self.path}/entry-{int(trial_id)}-{int(rung)}")

    def read(self) -> DataFrame:
        return self.spark.read.schema(LOG_SCHEMA).parquet(f"{self.path}/entry-*")

    def entries(self) -> set[tuple[int, int]]:
        """The (trial, rung) pairs that are written: as many as trials times rungs at most."""
        return {(r[0], r[1]) for r in self.read().select("trial_id", "rung").distinct().collect()}

    def steps(self, last_rung: int | None = None) -> DataFrame:
        """(trial_id, step, value): the loss after each step, of rungs up to ``last_rung``."""
        rows = self.read().where(F.col("state") == RUNNING)
        if last_rung is not None:
            rows = rows.where(F.col("rung") <= last_rung)
        return rows.select("trial_id", "step", "value")

    def results(self) -> DataFrame:
        """One row per ended trial: (trial_id, step, value, state, params, error)."""
        return self.read().where(F.col("rung") == END).drop("rung")


def step_losses(train: DataFrame, test: DataFrame, targets: Sequence[str], params: Mapping) -> list[float]:
    """Mean over targets of the hold-out RMSE after each tree of one boosted fit per target, to 12 digits: the last
    ones depend on the order in which tasks are summed, and decisions must not."""
    per_target = []
    for t in targets:
        model = _estimator("gbt", t, params).fit(train.where(F.col(t).isNotNull()))
        errors = model.evaluateEachIteration(test.where(F.col(t).isNotNull()), "squared")
        per_target.append([e ** 0.5 for e in errors])
    return [float(f"{sum(step) / len(step):.12g}") for step in zip(*per_target)]


def staged_search(df: DataFrame, spec: FeatureSpec, targets: Sequence[str], space: Mapping, log: TrialLog, *,
                  n_trials: int = 10, rungs: Sequence[int] = (4, 8, 16), keys: Sequence[str] = (), fraction: float = 0.2,
                  seed: int = 42, patience: int = 7, delta: float = 0.0, warmup: int = 0, min_trials: int = 5,
                  parallelism: int = 4) -> DataFrame:
    """Search ``n_trials`` candidates by rungs of tree counts; returns the log (``log.read()``).

    A trial ends COMPLETE when it has all its trees (``n_estimators`` of its parameters, else the last
    rung) or stops early, PRUNED by the median rule, or FAIL with its error. The ending row holds the
    least loss and its step: ``step`` + 1 trees reach it. What the log already holds is not run again.
    """
    rungs, targets = sorted(set(rungs)), list(targets)
    if not rungs or rungs[0] < 1:
        raise ValidationError("rungs must be positive tree counts")
    _check(df, spec, targets)
    grid = sample_space(df.sparkSession, space, n_trials, seed).select("trial_id", "params").collect()  # n_trials rows
    params = {r["trial_id"]: dict(r["params"]) for r in grid}
    trees = {t: min(int(float(p.get("n_estimators", rungs[-1]))), rungs[-1]) for t, p in params.items()}
    written = log.entries()
    live = [t for t in params if (t, END) not in written]
    if not live:
        return log.read()
    data = _prepared_split(df, spec, targets, keys, fraction, seed)
    train, test = data.where(~F.col("_is_test")), data.where(F.col("_is_test"))

    def fit(trial: int, rung: int, before: int, count: int) -> None:
        """Write the steps that the rung adds; a failed fit ends its trial."""
        try:
            values = step_losses(train, test, targets, {"seed": seed, **_typed(params[trial]), "n_estimators": count})
            rows = [(k, float(v), RUNNING, params[trial], None) for k, v in enumerate(values) if k >= before]
            end = None
        except Exception as e:  # the other trials go on
            rows, end = [], (before, None, FAIL, params[trial], f"{type(e).__name__}: {e}"[:2000])
        if end:
            log.append(trial, END, [end])
        else:
            log.append(trial, rung, rows)

    try:
        for rung, count in enumerate(rungs):
            before = rungs[rung - 1] if rung else 0
            todo = [t for t in live if (t, rung) not in written and trees[t] > before]
            with ThreadPoolExecutor(max(1, parallelism)) as pool:
                list(pool.map(lambda t: fit(t, rung, before, min(count, trees[t])), todo))
            written = log.entries()
            live = [t for t in live if (t, END) not in written]
            ended = _end_trials(log, rung, live, {t: trees[t] <= count or count == rungs[-1] for t in live}, params,
                                patience, delta, warmup, min_trials)
            live = [t for t in live if t not in ended]
    finally:
        data.unpersist()
    out = log.read()
    if out.where((F.col("rung") == END) & (F.col("state") != FAIL)).isEmpty():
        raise ValidationError(f"every trial failed: {log.results().select('error').first()[0]}")
    return out


def _end_trials(log: TrialLog, rung: int, live: list[int], full: dict, params: dict, patience: int, delta: float,
                warmup: int, min_trials: int) -> set[int]:
    """Apply W1 and W2 to the log up to ``rung`` and write the ends they bring."""
    steps = log.steps(rung)
    stops = early_stop(steps, "trial_id", "step", "value", patience=patience, delta=delta).where(F.col("stop_index").isNotNull())
    stopped = {r["trial_id"] for r in stops.collect()}  # trial-sized
    pruned = {r["trial_id"] for r in median_prune(steps, "trial_id", "step", "value", warmup=warmup, min_trials=min_trials)
              .where(F.col("pruned_step").isNotNull()).collect()}
    best = {r["trial_id"]: r["b"] for r in
            steps.groupBy("trial_id").agg(F.min(F.struct("value", "step")).alias("b")).collect()}
    ended = set()
    for t in live:
        if not (full[t] or t in stopped or t in pruned):
            continue
        state = PRUNED if t in pruned and t not in stopped and not full[t] else COMPLETE
        log.append(t, END, [(best[t]["step"], best[t]["value"], state, params[t], None)])
        ended.add(t)
    return ended


__all__ = ["TrialLog", "staged_search", "step_losses", "LOG_SCHEMA"]
