"""The query catalogue: one function (spark, sf_dir) -> DataFrame per registered query.

Every query reads whole driver tables (or tables Spark derives from them).
Floating results are rounded to 9 significant digits at the end (z-scores to 6,
money sums to cents) so the DuckDB oracle, which sums in a different order, agrees value for
value; the operators themselves keep full precision.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ratecraft.functions.columns import rename, select_existing
from ratecraft.functions.scalar import (
    prefix, recode, round_sig, to_nullable_int, truncate_int,
)
from ratecraft.operators import aggregates as A
from ratecraft.operators import features as FE
from ratecraft.operators import fill as FL
from ratecraft.operators import profile as PR
from ratecraft.operators import ranking as K
from ratecraft.operators import trials as TR
from ratecraft.operators.joins import duplicate_keys, left_join, remaining_trials
from ratecraft.operators.metrics import regression_metrics
from ratecraft.plans import tables as T

def _round_doubles(df: DataFrame, digits: int = 9, skip: tuple = ()) -> DataFrame:
    return df.select(*[round_sig(c, digits).alias(c)
                       if isinstance(df.schema[c].dataType, (DoubleType, FloatType)) and c not in skip
                       else F.col(c) for c in df.columns])


# -- rates ----------------------------------------------------------------------------

def rate_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: rate per 100,000 by (nation, year, priority), return flags as columns."""
    r = T.rate_long(spark, sf_dir)
    p = A.pivot_mean(r, ["nk", "yr", "pr", "population"], "site", "rate", pivot_values=T.SITES)
    return p.select("nk", "yr", "pr", "population",
                    *[truncate_int(s.lower()).alias(s.lower()) for s in T.SITES])


def rate_with_economy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate table + economy (gdp, n_jobs) on (nation, year), many-to-one."""
    return left_join(rate_pivot(spark, sf_dir), T.economy(spark, sf_dir), ["nk", "yr"])


def rate_with_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 (+P2, P3, P9): the model table: + share of finished orders as the survey rate.

    The survey side is filtered, renamed and projected before the join; Catalyst
    pushes the filter below the survey's own aggregation inputs.
    """
    s = T.survey(spark, sf_dir)
    s = s.where((F.col("measure") == "order status") & (F.col("response") == "F"))
    s = rename(s, {"data_value": "non_smoker_rate"})
    s = select_existing(s, ["nk", "yr", "non_smoker_rate"])
    # economy and survey are group-by results, unique on (nk, yr) by construction, so
    # the many-to-one check (an extra pass) is not repeated here
    out = left_join(rate_with_economy(spark, sf_dir), s, ["nk", "yr"])
    return _round_doubles(out, skip=("gdp",))


def join_key_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(customer, year) keys that repeat in orders; a many-to-one join on them would raise."""
    o = T.table(spark, sf_dir, "orders").select(
        "o_custkey", F.year("o_orderdate").cast("long").alias("yr"))
    return duplicate_keys(o, ["o_custkey", "yr"])


# -- scalar recodes -------------------------------------------------------------------

PRIORITY_CODES = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium"}


def recode_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: map priority text through a fixed dictionary; unmapped levels -> NULL."""
    o = T.table(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_orderpriority",
                    recode("o_orderpriority", PRIORITY_CODES).alias("priority_code"))


def prefix_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A 5-char zero-padded area code and its 2-char state prefix."""
    c = T.table(spark, sf_dir, "customer")
    fips = F.concat(F.lpad(F.col("c_nationkey").cast("string"), 2, "0"),
                    F.lpad((F.col("c_custkey") % 1000).cast("string"), 3, "0"))
    return c.select("c_custkey", fips.alias("fips")).withColumn("state_code", prefix("fips", 2))


def coerce_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text counts with 'Suppressed' -> NULL BIGINT; double -> BIGINT truncation."""
    o = T.table(spark, sf_dir, "orders")
    text = F.when(F.col("o_orderstatus") == "P", F.lit("Suppressed")).otherwise(
        truncate_int("o_totalprice").cast("string"))
    return o.select("o_orderkey", text.alias("count_text"), "o_totalprice").select(
        "o_orderkey", "count_text", to_nullable_int("count_text").alias("count_value"),
        truncate_int(F.col("o_totalprice") / 1000).alias("price_k"))


# -- ranking --------------------------------------------------------------------------

def _nation_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = T.rate_long(spark, sf_dir).where(F.col("site").isNotNull())
    m = A.group_mean(r, ["site", "nk"], "rate", alias="mean_rate")
    n = T.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nk"), "n_name")
    return left_join(m, n, ["nk"], null_safe=False)


def top5_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 + K2: per return flag the five nations with the highest mean rate."""
    return K.top_n_by(_nation_means(spark, sf_dir), ["site"], "nk", "_mean", 5).select("site", "rank", "nk", "n_name", "mean_rate")


def bottom5_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 + K3: per return flag the five nations with the lowest mean rate, the lowest with rank 1."""
    return K.top_n_by(_nation_means(spark, sf_dir), ["site"], "nk", "_mean", 5, largest=False) \
        .select("site", "rank", "nk", "n_name", "mean_rate")


def rank_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 + K1: market segments ranked by mean order value (row_number, ties by name)."""
    o = T.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_totalprice")
    c = T.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    m = A.group_mean(o.join(c, "c_custkey"), ["c_mktsegment"], "o_totalprice", alias="mean_price")
    return K.rank_groups(m, "c_mktsegment", "_mean", rank_col="rank").select(
        "c_mktsegment", "mean_price", "rank")


# -- profiles -------------------------------------------------------------------------

def missing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 + K4 on the order/returns frame (NULLs from the left join, NaN for open orders)."""
    return PR.missing_summary(T.order_returns(spark, sf_dir))


PROFILE_NUMERIC = ("o_orderkey", "o_totalprice", "yr", "price_nan", "r_qty", "r_price", "r_lines")


def describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: count, mean, std, min, exact quartiles, max per numeric column."""
    return _round_doubles(PR.describe(T.order_returns(spark, sf_dir), PROFILE_NUMERIC))


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: describe + dtype + missing count and percent."""
    return _round_doubles(PR.profile(T.order_returns(spark, sf_dir), PROFILE_NUMERIC))


def corr_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairwise Pearson correlation of the line-item measures, long form."""
    li = T.table(spark, sf_dir, "lineitem")
    return _round_doubles(PR.correlation_matrix(li, T.LINE_NUMERIC))


def cross_corr_by_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per return flag, correlation of price and quantity with the other measures."""
    li = T.table(spark, sf_dir, "lineitem")
    return _round_doubles(PR.cross_correlation(
        li, ["l_extendedprice", "l_quantity"], "l_returnflag",
        features=["l_discount", "l_tax", "l_linenumber"]))


def cross_corr_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7 + P15: as above for flags A and R, |corr| < 0.01 masked to NULL."""
    li = T.table(spark, sf_dir, "lineitem")
    return _round_doubles(PR.cross_correlation(
        li, ["l_extendedprice", "l_quantity"], "l_returnflag", groups=["A", "R"], threshold=0.01,
        features=["l_discount", "l_tax", "l_linenumber"]))


def median_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact-median fill of returned quantity (truncated) and NaN prices."""
    f = T.order_returns(spark, sf_dir)
    out = FL.median_fill(f, ["r_qty", "price_nan", "r_lines"], truncate=["r_lines"])
    return _round_doubles(out.select("o_orderkey", "r_qty", "price_nan", "r_lines"))


def mean_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean fill of the returned-item price."""
    f = T.order_returns(spark, sf_dir)
    return _round_doubles(FL.mean_fill(f, ["r_price"]).select("o_orderkey", "r_price"))


# -- levels and sets ------------------------------------------------------------------

def cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: levels and embedding size per category column of part."""
    p = T.table(spark, sf_dir, "part")
    return A.cardinality_profile(p, ["p_brand", "p_type", "p_size"])


def distinct_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U2 + K7 + A11: ordered distinct (status, priority) pairs of orders."""
    return A.ordered_distinct(T.table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"])


def union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and suppliers stacked by name; segment is NULL for suppliers."""
    c = T.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("segment"), F.lit("customer").alias("kind"))
    s = T.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"),
        F.lit("supplier").alias("kind"))
    return A.union_all([c, s])


# -- feature preparation --------------------------------------------------------------

def standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1: population z-scores of the line-item measures."""
    li = T.table(spark, sf_dir, "lineitem")
    sc = FE.StandardScaler().fit(li, T.LINE_NUMERIC)
    out = sc.transform(li.select("l_orderkey", "l_linenumber", *T.LINE_NUMERIC), suffix="_z")
    return _round_doubles(out.select("l_orderkey", "l_linenumber", *[c + "_z" for c in T.LINE_NUMERIC]), 6)


def unstandardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2: z-scores mapped back to the original scale (round trip)."""
    li = T.table(spark, sf_dir, "lineitem")
    sc = FE.StandardScaler().fit(li, T.LINE_NUMERIC)
    z = sc.transform(li.select("l_orderkey", "l_linenumber", *T.LINE_NUMERIC))
    back = sc.inverse(z)
    return _round_doubles(back.select("l_orderkey", "l_linenumber", *T.LINE_NUMERIC))


def minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """min-max scaling of the line-item measures."""
    li = T.table(spark, sf_dir, "lineitem")
    sc = FE.MinMaxScaler().fit(li, T.LINE_NUMERIC)
    out = sc.transform(li.select("l_orderkey", "l_linenumber", *T.LINE_NUMERIC), suffix="_mm")
    return _round_doubles(out.select("l_orderkey", "l_linenumber", *[c + "_mm" for c in T.LINE_NUMERIC]))


def ordinal_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4 + P12: byte-ordered integer codes of brand and type."""
    p = T.table(spark, sf_dir, "part")
    enc = FE.OrdinalEncoder().fit(p, ["p_brand", "p_type"])
    return enc.transform(p.select("p_partkey", "p_brand", "p_type"), ["p_brand", "p_type"])


def dummies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: 0/1 columns per part type, first level dropped."""
    p = T.table(spark, sf_dir, "part")
    levels = FE.fit_levels(p, "p_type")
    return FE.dummies(p.select("p_partkey", "p_type"), "p_type", levels, prefix="type").drop("p_type")


def holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """repeatable 20% hold-out flag per line item."""
    li = T.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return FE.holdout_split(li, ["l_orderkey", "l_linenumber"], 0.2, 42)


def kfold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fold 0..2 per line item from the same hash."""
    li = T.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return FE.kfold_assign(li, ["l_orderkey", "l_linenumber"], 3, 42)


def sample_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: 100 line items chosen by a seeded hash of their key."""
    li = T.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return K.sample_n(li, 100, ["l_orderkey", "l_linenumber"], seed=7)


def first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: the first 20 orders by key."""
    return K.first_n(T.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"),
                     20, ["o_orderkey"])


# -- dependence -----------------------------------------------------------------------

VIF_COLS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def vif(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variance inflation of the line-item measures."""
    return _round_doubles(PR.variance_inflation(T.table(spark, sf_dir, "lineitem"), VIF_COLS))


MI_FEATURES = ("l_quantity", "l_discount", "l_linenumber")
MI_TARGETS = ("l_extendedprice", "l_tax")


def mutual_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binned (quartile) mutual information of measures, averaged over price and tax."""
    li = T.table(spark, sf_dir, "lineitem")
    return _round_doubles(PR.mutual_information(li, MI_FEATURES, MI_TARGETS, bins=4))


# -- trials ---------------------------------------------------------------------------

def interval_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per trial, mean and 2.5/97.5 percentiles of its values (skew-safe)."""
    m = T.trial_metrics(spark, sf_dir)
    return _round_doubles(TR.interval_summary(m, ["trial_id"], "loss"))


def best_trial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lowest mean loss among completed trials, ties to the lowest id."""
    return _round_doubles(TR.best_trial(T.trial_results(spark, sf_dir)))


def state_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trials per final state."""
    return TR.trial_state_counts(T.trial_results(spark, sf_dir))


def epoch_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean loss per (trial, day)."""
    return _round_doubles(TR.epoch_loss(T.trial_metrics(spark, sf_dir), "trial_id", "epoch", "loss"))


def early_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patience-3 early stop over each trial's losses in (ts, event_id) order."""
    m = T.trial_metrics(spark, sf_dir)
    return _round_doubles(TR.early_stop(m, "trial_id", ["ts", "event_id"], "loss", patience=3))


def early_stop_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1, strict variant: only a strictly lower loss improves."""
    m = T.trial_metrics(spark, sf_dir)
    return _round_doubles(TR.early_stop(m, "trial_id", ["ts", "event_id"], "loss", patience=3,
                                        strict=True))


EARLY_STOP_DELTA = 0.5


def early_stop_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 with a minimum improvement (delta 0.5, patience 3): record chain by pointer doubling."""
    m = T.trial_metrics(spark, sf_dir)
    return _round_doubles(TR.early_stop(m, "trial_id", ["ts", "event_id"], "loss", patience=3,
                                        delta=EARLY_STOP_DELTA))


EARLY_STOP_TOLERANCE = -0.5


def early_stop_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 with a negative delta (a loss up to 0.5 worse still counts as improvement;
    patience 3): bounded look-ahead next-pointers and pointer doubling."""
    m = T.trial_metrics(spark, sf_dir)
    return _round_doubles(TR.early_stop(m, "trial_id", ["ts", "event_id"], "loss", patience=3,
                                        delta=EARLY_STOP_TOLERANCE))


def median_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First step where a trial's best-so-far loss is worse than the median of the
    completed trials at that step (pruning starts after 5 completed trials)."""
    m = T.trial_metrics(spark, sf_dir)
    done = T.trial_results(spark, sf_dir).where(F.col("state") == "COMPLETE").select("trial_id")
    return TR.median_prune(m, "trial_id", ["ts", "event_id"], "loss", warmup=0, min_trials=1,
                           completed=done, startup=5)


def resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trials of the grid (all customers) not yet completed in the log (events users)."""
    grid = T.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("trial_id"))
    done = T.trial_results(spark, sf_dir).select("trial_id", "state")
    return remaining_trials(grid, done)


# -- fixed-coefficient scoring ----------------------------------------------------------

# Fixed linear scorer used by the metric and attribution queries (not fitted).
FIXED_MODEL = {
    "l_extendedprice": {"intercept": 100.0, "l_quantity": 1500.0, "l_discount": -2000.0},
    "l_tax": {"intercept": 0.02, "l_discount": 0.5, "l_quantity": 0.0001},
}


def _fixed_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = T.table(spark, sf_dir, "lineitem")
    preds = {}
    for t, coefs in FIXED_MODEL.items():
        e = F.lit(coefs["intercept"])
        for f, w in coefs.items():
            if f != "intercept":
                e = e + F.lit(w) * F.col(f)
        preds[t + "_pred"] = e
    return li.withColumns(preds)


def regression_metrics_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MSE, RMSE, R^2 of the fixed scorer per target."""
    p = _fixed_predictions(spark, sf_dir)
    return _round_doubles(regression_metrics(p, {t: t + "_pred" for t in FIXED_MODEL}))


def _line_attributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ratecraft.operators.explain import linear_attribution as x1
    li = T.table(spark, sf_dir, "lineitem")
    parts = [x1(li, coefs, ["l_orderkey", "l_linenumber"], target=t) for t, coefs in FIXED_MODEL.items()]
    out = parts[0]
    for q in parts[1:]:
        out = out.unionByName(q)
    return out


def linear_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per line item and target, phi = w * (x - mean(x)) of the fixed scorer."""
    return _line_attributions(spark, sf_dir).withColumn("phi", F.round("phi", 6))


def topk_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A14 + X6: features ranked by mean |phi| per target (top 10)."""
    from ratecraft.operators.explain import mean_abs_topk
    return _round_doubles(mean_abs_topk(_line_attributions(spark, sf_dir), 10))


# -- fitted models (row-count checks; unit tests carry the proofs) ----------------------

LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
MODEL_SPEC = FE.FeatureSpec(
    num=["l_quantity", "l_discount", "p_size", "p_retailprice"],
    cat=["p_type", "l_returnflag", "l_linestatus"],
    target=["l_extendedprice", "l_tax"])
GBT_PARAMS = {"n_estimators": 8, "max_depth": 4, "learning_rate": 0.2, "subsample": 1.0, "seed": 7}


def model_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their part's size, price and type: features and targets."""
    li = T.table(spark, sf_dir, "lineitem")
    p = T.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_size", "p_retailprice", "p_type")
    return li.join(p, "l_partkey", "left")


def fit_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F9 + F10 + M1 + M6: boosted trees per target fitted on the training rows,
    every row scored."""
    from ratecraft.operators.models import fit_multi_target
    df = FE.holdout_split(model_table(spark, sf_dir), LINE_KEYS, 0.2, 42)
    train = df.where(~F.col("is_test"))
    model = fit_multi_target(train, MODEL_SPEC, MODEL_SPEC.target, GBT_PARAMS, fit_on=train,
                             parallelism=2)
    return model.predict(df).select(*LINE_KEYS, "is_test", "l_extendedprice_pred", "l_tax_pred")


def fit_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7: 95% bootstrap intervals (100 weighted linear refits) for every row."""
    from ratecraft.operators.models import predict_interval
    df = FE.holdout_split(model_table(spark, sf_dir), LINE_KEYS, 0.2, 42)
    train = df.where(~F.col("is_test"))
    out = predict_interval(df, train, MODEL_SPEC, MODEL_SPEC.target, LINE_KEYS, iterations=100)
    return out.select(*LINE_KEYS, *[c for c in out.columns if c.endswith(("_pred", "_95"))])


SEARCH_SPACE = {"n_estimators": ("int", 3, 8), "max_depth": ("int", 2, 4),
                "learning_rate": ("logfloat", 0.05, 0.3), "subsample": ("float", 0.6, 1.0)}
SEARCH_TRIALS = 50


def search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4 + M8 + A17: 50 hash-sampled candidates (the reference's number) scored by mean hold-out RMSE; trial log."""
    from ratecraft.operators.models import trial_search
    log = trial_search(model_table(spark, sf_dir), MODEL_SPEC, MODEL_SPEC.target, SEARCH_SPACE,
                       n_trials=SEARCH_TRIALS, seed=11, keys=LINE_KEYS, parallelism=4)
    return log.select("trial_id", "step", "value", "state",
                      F.to_json("params").alias("params"))


def search_space(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4: a hash-sampled parameter set for every trial of the log (events users)."""
    from ratecraft.operators.models import sample_space
    ids = T.trial_metrics(spark, sf_dir).select("trial_id").distinct()
    return _round_doubles(sample_space(spark, SEARCH_SPACE, seed=11, ids=ids).select(
        "trial_id", *SEARCH_SPACE.keys()))


def part_model(spark: SparkSession, sf_dir: str):
    from ratecraft.operators.models import fit_multi_target
    p = T.table(spark, sf_dir, "part")
    spec = FE.FeatureSpec(num=["p_size"], cat=["p_brand", "p_type"], target=["p_retailprice"])
    return p, fit_multi_target(p, spec, spec.target, GBT_PARAMS)


def sampled_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X2 + X4: permutation Shapley values of a boosted model of part price, every
    part explained against a 5-centre k-means background."""
    from ratecraft.operators.explain import background_kmeans, sampled_attribution as x2
    p, model = part_model(spark, sf_dir)
    bg = background_kmeans(p, ["p_size"], ["p_brand", "p_type"], k=5)
    return x2(p, model, ["p_size", "p_brand", "p_type"], ["p_partkey"], bg, permutations=2)


def background_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """15 k-means centres of the line-item measures with their weights."""
    from ratecraft.operators.explain import background_kmeans
    li = T.table(spark, sf_dir, "lineitem")
    return background_kmeans(li, list(T.LINE_NUMERIC), ["l_returnflag"], k=15)


def distinct_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct non-NULL market segments of the customers."""
    return A.distinct_values(T.table(spark, sf_dir, "customer"), "c_mktsegment")


PART_SPEC = FE.FeatureSpec(num=["p_size"], cat=["p_brand", "p_type"], target=["p_retailprice"])


def fit_validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: boosting on part prices that watches a 20% hashed hold-out (may stop early)."""
    from ratecraft.operators.models import fit_with_validation
    p = T.table(spark, sf_dir, "part")
    model = fit_with_validation(p, PART_SPEC, PART_SPEC.target,
                                {"n_estimators": 20, "max_depth": 3, "learning_rate": 0.3},
                                keys=["p_partkey"], tol=0.001)
    return model.predict(p).select("p_partkey", "p_retailprice", "p_retailprice_pred")


def cv_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3 + M5: 3 candidates x 2 hashed folds by mean R^2, best refitted on all rows; returns the
    candidate table with the chosen one flagged and the refit's R^2 on all rows beside it."""
    from ratecraft.operators.models import random_search_cv, refit_best
    p = T.table(spark, sf_dir, "part")
    space = {"n_estimators": ("int", 3, 6), "max_depth": ("int", 2, 4)}
    best, table = random_search_cv(p, PART_SPEC, PART_SPEC.target, space, n_iter=3, folds=2,
                                   seed=5, keys=["p_partkey"], parallelism=3)
    refit = refit_best(p, PART_SPEC, PART_SPEC.target, best, rows="all").predict(p)
    r2 = regression_metrics(refit, {t: t + "_pred" for t in PART_SPEC.target}).agg(F.avg("r2")).first()[0]
    chosen = F.create_map(*[x for k, v in best.items() for x in (F.lit(k), F.lit(str(v)))])
    return table.select("trial_id", F.to_json("params").alias("params"), "mean_r2",
                        (F.to_json("params") == F.to_json(chosen)).alias("chosen"),
                        F.when(F.to_json("params") == F.to_json(chosen), F.lit(r2)).alias("refit_r2"))


def saved_model_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S9 + S10 + S11: fit, save to the shared checkpoint folder, load and score."""
    import uuid
    from ratecraft.operators.models import fit_multi_target
    from ratecraft.plans.score_job import score
    from ratecraft.session import scratch_dir
    p = T.table(spark, sf_dir, "part")
    path = scratch_dir(spark, f"models/part-{uuid.uuid4().hex}")
    fit_multi_target(p, PART_SPEC, PART_SPEC.target, {"n_estimators": 5, "max_depth": 3}).save(path)
    return score(spark, f"{sf_dir.rstrip('/')}/part.parquet", path)


RANKING_GROUPS = ("nk", "pr")
RANKING_TARGETS = ("a", "n", "r")


def rate_rankings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 + K1 over the model table: mean rate per nation and per priority for each flag,
    ranked (the analysis job's ranking table)."""
    from ratecraft.plans.analysis_job import group_rankings
    return group_rankings(rate_with_survey(spark, sf_dir), RANKING_GROUPS, RANKING_TARGETS)


CATALOGUE = {
    "rate_pivot": rate_pivot,
    "rate_with_economy": rate_with_economy,
    "rate_with_survey": rate_with_survey,
    "rate_rankings": rate_rankings,
    "join_key_duplicates": join_key_duplicates,
    "recode_priority": recode_priority,
    "prefix_code": prefix_code,
    "coerce_int": coerce_int,
    "top5_nations": top5_nations,
    "bottom5_nations": bottom5_nations,
    "rank_segments": rank_segments,
    "missing_summary": missing_summary,
    "describe": describe,
    "profile": profile,
    "corr_matrix": corr_matrix,
    "cross_corr_by_flag": cross_corr_by_flag,
    "cross_corr_masked": cross_corr_masked,
    "median_fill": median_fill,
    "mean_fill": mean_fill,
    "cardinality": cardinality,
    "distinct_pairs": distinct_pairs,
    "union_all": union_all,
    "standardize": standardize,
    "unstandardize": unstandardize,
    "minmax": minmax,
    "ordinal_codes": ordinal_codes,
    "dummies": dummies,
    "holdout": holdout,
    "kfold": kfold,
    "sample_n": sample_n,
    "first_n": first_n,
    "vif": vif,
    "mutual_info": mutual_info,
    "interval_summary": interval_summary,
    "best_trial": best_trial,
    "state_counts": state_counts,
    "epoch_loss": epoch_loss,
    "early_stop": early_stop,
    "early_stop_strict": early_stop_strict,
    "early_stop_delta": early_stop_delta,
    "early_stop_tolerant": early_stop_tolerant,
    "median_prune": median_prune,
    "resume": resume,
    "regression_metrics": regression_metrics_q,
    "linear_attribution": linear_attribution,
    "topk_features": topk_features,
    "fit_score": fit_score,
    "fit_interval": fit_interval,
    "search": search,
    "search_space": search_space,
    "sampled_attribution": sampled_attribution,
    "background_centres": background_centres,
    "distinct_segments": distinct_segments,
    "fit_validated": fit_validated,
    "cv_search": cv_search,
    "saved_model_score": saved_model_score,
}
