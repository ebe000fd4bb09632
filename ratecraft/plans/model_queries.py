"""Registered queries of fitted models: tree attribution, search by rungs, interval replicates, fold fits.

Where a query has a DuckDB twin it states the fit in closed form (one feature) or a property that every
row must have; unit tests carry the other proofs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft.functions.scalar import round_sig
from ratecraft.operators import features as FE
from ratecraft.plans import tables as T
from ratecraft.plans.catalogue import LINE_KEYS, MODEL_SPEC, PART_SPEC, model_table
from ratecraft.plans.oracle import _hash_bucket, sig
from ratecraft.session import scratch_dir

TREE_PARAMS = {"n_estimators": 5, "max_depth": 4, "learning_rate": 0.2, "seed": 7}


def _line_model(spark: SparkSession, sf_dir: str):
    from ratecraft.operators.models import fit_multi_target
    df = model_table(spark, sf_dir)
    return df, fit_multi_target(df, MODEL_SPEC, MODEL_SPEC.target, TREE_PARAMS, parallelism=2)


def tree_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X2 (tree form) over every line item: by how much attributions and base miss the prediction."""
    from ratecraft.operators.tree_attribution import attribution_arrays
    df, model = _line_model(spark, sf_dir)
    preds = [t + "_pred" for t in MODEL_SPEC.target]
    wide, _ = attribution_arrays(model.predict(df), model, ["l_orderkey", "l_linenumber", *preds])

    def gap(t: str):
        total = F.aggregate(f"{t}_phi", F.lit(0.0), lambda a, v: a + v) + F.col(f"{t}_base")
        return F.round(F.abs(total - F.col(f"{t}_pred")) / F.greatest(F.abs(f"{t}_pred"), F.lit(1.0)), 6)

    return wide.select("l_orderkey", "l_linenumber", *[gap(t).alias(f"{t}_gap") for t in MODEL_SPEC.target])


def tree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X2 (tree form) + A14 + X6: mean |phi| over all line items, top 10 features per target."""
    from ratecraft.operators.explain import mean_abs_topk
    from ratecraft.operators.tree_attribution import tree_attribution
    df, model = _line_model(spark, sf_dir)
    return mean_abs_topk(tree_attribution(df, model, ["l_orderkey", "l_linenumber"]), 10)


STAGED_SPACE = {"n_estimators": ("int", 4, 8), "max_depth": ("int", 2, 4), "learning_rate": ("logfloat", 0.02, 0.6)}


def staged_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8 + J6 + W1 + W2 on a log that the search itself wrote: per trial its steps, the step that early
    stopping and median pruning name on the whole log, and how it ended."""
    from ratecraft.operators.trial_log import TrialLog, staged_search as search
    from ratecraft.operators.trials import early_stop, median_prune
    log = TrialLog(spark, scratch_dir(spark, f"trials/{uuid.uuid4().hex}"))
    search(T.table(spark, sf_dir, "part"), PART_SPEC, PART_SPEC.target, STAGED_SPACE, log, n_trials=6, rungs=(3, 8),
           keys=["p_partkey"], seed=11, patience=2, min_trials=5)
    steps = log.steps()
    stops = early_stop(steps, "trial_id", "step", "value", patience=2)
    pruned = median_prune(steps, "trial_id", "step", "value", min_trials=5)
    counts = steps.groupBy("trial_id").agg(F.count(F.lit(1)).alias("n_steps"))
    ends = log.results().select("trial_id", "state", F.col("step").alias("best_step"), "value")
    return ends.join(counts, "trial_id").join(stops, "trial_id", "left").join(pruned, "trial_id", "left")


REPLICATES = 100
BOOTSTRAP_SEED = 42


def bootstrap_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7: 100 Poisson-weighted refits of price on quantity over all line items, from one pass of blocks."""
    from ratecraft.operators.models import FEATURES, bootstrap_coefficients
    li = T.table(spark, sf_dir, "lineitem").select(*LINE_KEYS, "l_quantity", "l_extendedprice")
    spec = FE.FeatureSpec(num=["l_quantity"], target=["l_extendedprice"])
    feats = FE.preprocess_pipeline(li, spec, FEATURES).transform(li)
    found = bootstrap_coefficients(feats, spec.target, LINE_KEYS, REPLICATES, seed=BOOTSTRAP_SEED)
    return found.select("b", round_sig(F.col("coefficients")[0], 7).alias("intercept"), round_sig(F.col("coefficients")[1], 7).alias("slope"))


CV_REGS = (0.0, 0.1, 1.0)
CV_FOLDS, CV_SEED = 3, 42
CV_TARGETS = ("o_totalprice", "r_price")


def cv_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3 by leave-fold-out blocks: order value and returned price on the returned quantity (NULL for most
    orders), three folds and three ridge candidates."""
    from ratecraft.operators.normal_equations import cv_linear as fit
    spec = FE.FeatureSpec(num=["r_qty"])
    out = fit(T.order_returns(spark, sf_dir), spec, CV_TARGETS, ["o_orderkey"], CV_FOLDS, CV_REGS, CV_SEED)
    return out.select("fold", "target", "reg", "n_train", "n_valid", round_sig("intercept", 7).alias("intercept"),
                      round_sig(F.col("coefficients")[0], 7).alias("slope"), round_sig("mse", 7).alias("mse"), F.round("r2", 6).alias("r2"))


CATALOGUE = {
    "tree_balance": tree_balance,
    "tree_topk": tree_topk,
    "staged_search": staged_search,
    "bootstrap_lines": bootstrap_lines,
    "cv_linear": cv_linear,
}


# -- DuckDB twins -----------------------------------------------------------------------

TREE_BALANCE = "SELECT l_orderkey, l_linenumber, CAST(0 AS DOUBLE) AS l_extendedprice_gap, CAST(0 AS DOUBLE) AS l_tax_gap FROM lineitem"


def _bootstrap_lines() -> str:
    from ratecraft.operators.normal_equations import poisson_table
    weight = " ".join(f"WHEN u < CAST({float(c)!r} AS DOUBLE) THEN {k}" for k, c in enumerate(poisson_table()))
    name = ", ".join(f"coalesce(CAST({k} AS VARCHAR), '')" for k in LINE_KEYS)
    return f"""
WITH s AS (SELECT avg(l_quantity) AS m, stddev_pop(l_quantity) AS sd FROM lineitem),
r AS (SELECT (l_quantity - m) / sd AS z, l_extendedprice AS y, b,
             md5(concat_ws('|', {name}, '{BOOTSTRAP_SEED}', CAST(b // 2 AS VARCHAR))) AS h
      FROM lineitem, s, range({REPLICATES}) t(b)),
u AS (SELECT z, y, b, CAST(CAST('0x' || substr(h, CASE WHEN b % 2 = 0 THEN 1 ELSE 17 END, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS u FROM r),
w AS (SELECT z, y, b, CAST(CASE {weight} END AS DOUBLE) AS w FROM u),
a AS (SELECT b, sum(w) AS n, sum(w * z) AS z1, sum(w * y) AS y1, sum(w * z * z) AS zz, sum(w * z * y) AS zy FROM w GROUP BY b),
c AS (SELECT b, (n * zy - z1 * y1) / (n * zz - z1 * z1) AS slope, n, z1, y1 FROM a)
SELECT CAST(b AS INTEGER) AS b, {sig('((y1 - slope * z1) / n)', 7)} AS intercept, {sig('slope', 7)} AS slope FROM c
"""


def _cv_linear() -> str:
    targets = "\nUNION ALL\n".join(f"SELECT fold, r_qty AS x, '{t}' AS target, {t} AS y FROM o" for t in CV_TARGETS)
    regs = ", ".join(f"(CAST({r!r} AS DOUBLE))" for r in CV_REGS)
    return f"""
WITH rr AS (SELECT l_orderkey, sum(l_quantity) AS r_qty, avg(l_extendedprice) AS r_price
            FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey),
o AS (SELECT CAST({_hash_bucket(['o_orderkey'], CV_SEED)} % {CV_FOLDS} AS INTEGER) AS fold, r_qty, o_totalprice, r_price
      FROM orders LEFT JOIN rr ON o_orderkey = l_orderkey),
d AS (SELECT * FROM ({targets}) WHERE y IS NOT NULL),
k AS (SELECT CAST(k AS INTEGER) AS k FROM range({CV_FOLDS}) t(k)),
m AS (SELECT k, target, avg(x) AS mean FROM d, k WHERE fold <> k GROUP BY k, target),
s AS (SELECT k.k, d.target, stddev_pop(coalesce(x, mean)) AS sd FROM d, k, m
      WHERE fold <> k.k AND m.k = k.k AND m.target = d.target GROUP BY k.k, d.target),
z AS (SELECT m.k, d.target, d.fold, y, (coalesce(x, mean) - mean) / sd AS z
      FROM d JOIN m ON m.target = d.target JOIN s ON s.k = m.k AND s.target = m.target),
f AS (SELECT k, target, count(*) AS n, avg(y) AS intercept, covar_pop(z, y) AS cov FROM z WHERE fold <> k GROUP BY k, target),
c AS (SELECT f.*, reg, cov / (1 + reg) AS slope FROM f, (VALUES {regs}) g(reg)),
v AS (SELECT z.k, z.target, reg, count(*) AS n_valid, avg((y - intercept - slope * z) ** 2) AS mse, var_pop(y) AS v
      FROM z JOIN c ON c.k = z.k AND c.target = z.target WHERE fold = z.k GROUP BY z.k, z.target, reg)
SELECT c.k AS fold, c.target, c.reg, CAST(c.n AS BIGINT) AS n_train, CAST(n_valid AS BIGINT) AS n_valid,
       {sig('intercept', 7)} AS intercept, {sig('slope', 7)} AS slope, {sig('mse', 7)} AS mse, round(1 - mse / v, 6) AS r2
FROM c JOIN v ON v.k = c.k AND v.target = c.target AND v.reg = c.reg
"""


SQL = {"tree_balance": TREE_BALANCE, "bootstrap_lines": _bootstrap_lines(), "cv_linear": _cv_linear()}
