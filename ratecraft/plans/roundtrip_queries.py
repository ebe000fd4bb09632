"""Registered queries with closed-form twins: files written and read back, schema helpers, checks, and model
fits whose result SQL can state (one feature, one level per leaf).

Files lie below the session's checkpoint folder; every query reads whole driver tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft.errors import RatecraftError
from ratecraft.functions.columns import columns_of_type, drop_columns, normalize_columns, split_features_targets
from ratecraft.functions.scalar import round_sig
from ratecraft.operators import checks
from ratecraft.operators import features as FE
from ratecraft.plans import tables as T
from ratecraft.plans.catalogue import _line_attributions
from ratecraft.plans.oracle import LINEAR_ATTRIBUTION, SAMPLE_N, _hash_bucket, sig
from ratecraft.session import scratch_dir
from ratecraft.sources.files import scan_json_records, scan_parquet, scan_sectioned_tsv
from ratecraft.sources.sinks import sink_csv, sink_parquet

FILE_ROWS = 1000  # rows of a written array or section file: keys are cut into ranges of as many


def _path(spark: SparkSession, name: str) -> str:
    return scratch_dir(spark, f"roundtrip/{uuid.uuid4().hex}/{name}")


def clean_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings normalised, a column dropped by name, numeric columns picked, targets split off."""
    o = T.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias(" Order  Key "), F.col("o_orderstatus").alias("Order\tStatus"), F.col("o_totalprice").alias("TOTAL price"),
        F.year("o_orderdate").cast("long").alias("Year "), F.lit(1).alias("junk"))
    d = drop_columns(normalize_columns(o), ["junk"], strict=True)
    features, targets = split_features_targets(d, ["total_price"])
    return d.select(*columns_of_type(features, "int64/float64"), *targets.columns)


def label_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """strict codes of the brands (an unseen one raises)."""
    p = T.table(spark, sf_dir, "part")
    return FE.label_encode(p.select("p_partkey", "p_brand"), FE.OrdinalEncoder().fit(p, ["p_brand"]), ["p_brand"])


def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """z-scores and one-hot levels fitted on the training rows, by feature name."""
    from pyspark.ml.functions import vector_to_array
    p = FE.holdout_split(T.table(spark, sf_dir, "part"), ["p_partkey"], 0.2, 42)
    spec = FE.FeatureSpec(num=["p_size"], cat=["p_type"])
    feats = FE.preprocess_pipeline(p, spec, fit_on=p.where(~F.col("is_test"))).transform(p)
    cells = F.arrays_zip(F.array(*[F.lit(n) for n in FE.feature_names(feats)]).alias("feature"), vector_to_array("features").alias("value"))
    return feats.select("p_partkey", F.explode(cells).alias("c")).select("p_partkey", "c.feature", F.round("c.value", 6).alias("value"))


def csv_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers written as CSV and read with text codes, whose leading zeros stay."""
    c = T.table(spark, sf_dir, "customer").select("c_custkey", F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("code"), "c_acctbal")
    path = _path(spark, "csv")
    sink_csv(c, path, key_columns=["code"])
    return spark.read.schema("code string, c_custkey long, c_acctbal double").option("header", True).csv(path)


def parquet_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written by status and read back."""
    path = _path(spark, "parquet")
    sink_parquet(T.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), path, partition_by=["o_orderstatus"])
    return scan_parquet(spark, path)


def json_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts in files of one array of records each, read with a schema."""
    p = T.table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size", "p_retailprice")
    rows = p.groupBy(F.floor(F.col("p_partkey") / FILE_ROWS).alias("file")).agg(F.collect_list(F.to_json(F.struct(*p.columns))).alias("r"))
    path = _path(spark, "json")
    rows.select("file", F.concat(F.lit("["), F.array_join("r", ",\n"), F.lit("]")).alias("value")).write.partitionBy("file").text(path)
    return scan_json_records(spark, f"{path}/*", p.schema)


def section_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in tab-separated files with a notes section, with a column from the file name."""
    c = T.table(spark, sf_dir, "customer")
    line = F.concat_ws("\t", F.lit(""), F.col("c_custkey").cast("string"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0"), "c_mktsegment")
    rows = c.groupBy(F.floor(F.col("c_custkey") / FILE_ROWS).alias("file")).agg(F.collect_list(line).alias("r"))
    text = F.concat(F.lit('"Notes"\t"Key"\t"Code"\t"Segment"\n'), F.array_join("r", "\n"), F.lit('\n"---"\n"Query date:"\n"---"\n99\tnot data'))
    path = _path(spark, "sections")
    rows.select("file", text.alias("value")).write.partitionBy("file").text(path)
    return scan_sectioned_tsv(spark, path, "Notes string, c_custkey long, code string, c_mktsegment string", file_column="kind",
                              file_pattern=r"^([a-z]+)-")


def attribution_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixed scorer's attributions in one folder per target, read back."""
    from ratecraft.operators.explain import attribution_export
    path = _path(spark, "phi")
    attribution_export(_line_attributions(spark, sf_dir), path)
    return scan_parquet(spark, path).withColumn("phi", F.round("phi", 6))


def background_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The background sample of line items."""
    from ratecraft.operators.explain import background_sample
    li = T.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return background_sample(li, 100, ["l_orderkey", "l_linenumber"], seed=7)


def checks_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1, V2, V3: what the frame checks say of the orders and of frames spoilt on purpose, with their rows."""
    o = T.table(spark, sf_dir, "orders")
    none, spec = o.where(F.col("o_orderkey").isNull()), FE.FeatureSpec(num=["o_totalprice", "absent"], cat=["o_orderstatus"])
    cases = {"whole": lambda: checks.validate_frame(o, ["o_totalprice"]), "empty": lambda: checks.validate_frame(none, ["o_totalprice"]),
             "missing target": lambda: checks.validate_frame(o, ["absent"]), "repeated target": lambda: checks.validate_frame(o, ["o_totalprice"] * 2),
             "no feature": lambda: checks.validate_frame(o.select("o_totalprice"), ["o_totalprice"]),
             "missing columns": lambda: checks.require_columns(o, spec), "no rows": lambda: checks.require_rows(none), "rows": lambda: checks.require_rows(o)}
    out = []
    for name, run in cases.items():
        try:
            run()
            out.append((name, "ok"))
        except RatecraftError as e:
            out.append((name, type(e).__name__))
    said = spark.createDataFrame(out, "case string, outcome string")
    counted = o.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("case", F.lit("whole"))
    return said.unionByName(counted, allowMissingColumns=True).groupBy("case").agg(
        F.max("outcome").alias("outcome"), F.max("n_rows").alias("n_rows"))


def linear_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order value on the returned quantity (NULL for most orders), fitted, saved, and scored
    by the job from Parquet to CSV."""
    from ratecraft.operators.models import fit_linear
    from ratecraft.plans.score_job import score_job
    df = T.order_returns(spark, sf_dir).select("o_orderkey", "r_qty", "o_totalprice")
    path = _path(spark, "linear")
    fit_linear(df, FE.FeatureSpec(num=["r_qty"], target=["o_totalprice"]), "o_totalprice").save(f"{path}/model")
    sink_parquet(df.select("o_orderkey", "r_qty"), f"{path}/in")
    score_job(spark, f"{path}/in", f"{path}/out", f"{path}/model")
    scored = spark.read.schema("o_orderkey long, r_qty double, o_totalprice_pred double").option("header", True).csv(f"{path}/out")
    return scored.withColumn("o_totalprice_pred", round_sig("o_totalprice_pred", 7))


LEVEL_SPEC = FE.FeatureSpec(cat=["l_linestatus"], target=["l_extendedprice", "l_tax"])
STUMP = {"n_estimators": 1, "max_depth": 1, "seed": 1}
LEVEL_KEYS = ["l_orderkey", "l_linenumber"]


def _level_scores(model, li: DataFrame) -> DataFrame:
    return model.predict(li).select(*LEVEL_KEYS, *[round_sig(f"{t}_pred", 9).alias(f"{t}_pred") for t in LEVEL_SPEC.target])


def level_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1, M5, M6: one boosted stump on a category of two levels, refitted on the training rows: their means."""
    from ratecraft.operators.models import refit_best
    li = T.table(spark, sf_dir, "lineitem").select(*LEVEL_KEYS, "l_linestatus", *LEVEL_SPEC.target)
    split = FE.holdout_split(li, LEVEL_KEYS, 0.2, 42)
    return _level_scores(refit_best(split, LEVEL_SPEC, LEVEL_SPEC.target, STUMP, rows="train", split_col="is_test"), li)


def validated_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: the stump fitted while it watches the hold-out: the means of the other rows."""
    from ratecraft.operators.models import fit_with_validation
    li = T.table(spark, sf_dir, "lineitem").select(*LEVEL_KEYS, "l_linestatus", *LEVEL_SPEC.target)
    return _level_scores(fit_with_validation(li, LEVEL_SPEC, LEVEL_SPEC.target, STUMP, keys=LEVEL_KEYS, fraction=0.2, seed=42), li)


def search_stumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8: a search among stumps: every trial's value is the hold-out RMSE of the level means."""
    from ratecraft.operators.models import trial_search
    li = T.table(spark, sf_dir, "lineitem").select(*LEVEL_KEYS, "l_linestatus", *LEVEL_SPEC.target)
    log = trial_search(li, LEVEL_SPEC, LEVEL_SPEC.target, {"n_estimators": ("int", 1, 1), "max_depth": ("int", 1, 1)}, n_trials=2, seed=42, keys=LEVEL_KEYS)
    return log.select("trial_id", "step", round_sig("value", 9).alias("value"), "state")


CATALOGUE = {f.__name__: f for f in (
    clean_columns, label_codes, one_hot, csv_files, parquet_files, json_files, section_files, attribution_files, background_rows,
    checks_report, linear_score, level_means, validated_means, search_stumps)}


# -- DuckDB twins -----------------------------------------------------------------------

_PART_TRAIN = f"{_hash_bucket(['p_partkey'], 42)} >= 2000"
_LINE_TEST = f"{_hash_bucket(LEVEL_KEYS, 42)} < 2000"

ONE_HOT = f"""
WITH t AS (SELECT * FROM part WHERE {_PART_TRAIN}),
s AS (SELECT avg(p_size) AS m, stddev_pop(p_size) AS sd FROM t),
l AS (SELECT DISTINCT p_type AS level FROM t)
SELECT p_partkey, 'p_size' AS feature, round((p_size - m) / sd, 6) AS value FROM part, s
UNION ALL SELECT p_partkey, 'p_type_' || level, CASE WHEN p_type = level THEN 1.0 ELSE 0.0 END FROM part, l
"""

CHECKS = """
SELECT * FROM (VALUES ('whole', 'ok', (SELECT count(*) FROM orders)), ('empty', 'EmptyFrameError', NULL), ('missing target', 'MissingColumnsError', NULL),
  ('repeated target', 'ValidationError', NULL), ('no feature', 'ValidationError', NULL), ('missing columns', 'MissingColumnsError', NULL),
  ('no rows', 'EmptyFrameError', NULL), ('rows', 'ok', NULL)) v("case", outcome, n_rows)
"""

LINEAR_SCORE = f"""
WITH rr AS (SELECT l_orderkey, sum(l_quantity) AS r_qty FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey),
o AS (SELECT o_orderkey, r_qty, o_totalprice AS y FROM orders LEFT JOIN rr ON o_orderkey = l_orderkey),
m AS (SELECT quantile_cont(r_qty, 0.5) AS med FROM o),
f AS (SELECT o_orderkey, r_qty, coalesce(r_qty, med) AS x, y FROM o, m),
c AS (SELECT avg(x) AS mx, avg(y) AS my, covar_pop(x, y) / var_pop(x) AS slope FROM f)
SELECT o_orderkey, r_qty, {sig('(my + slope * (x - mx))', 7)} AS o_totalprice_pred FROM f, c
"""

_LEVELS = f"SELECT l_linestatus, avg(l_extendedprice) AS p, avg(l_tax) AS t FROM lineitem WHERE NOT ({_LINE_TEST}) GROUP BY l_linestatus"

LEVEL_MEANS = f"""
WITH m AS ({_LEVELS})
SELECT l_orderkey, l_linenumber, {sig('p')} AS l_extendedprice_pred, {sig('t')} AS l_tax_pred FROM lineitem JOIN m USING (l_linestatus)
"""

SEARCH_STUMPS = f"""
WITH m AS ({_LEVELS}),
e AS (SELECT sqrt(avg((l_extendedprice - p) ** 2)) AS a, sqrt(avg((l_tax - t) ** 2)) AS b
      FROM lineitem JOIN m USING (l_linestatus) WHERE {_LINE_TEST})
SELECT CAST(i AS BIGINT) AS trial_id, CAST(0 AS BIGINT) AS step, {sig('((a + b) / 2)')} AS value, 'COMPLETE' AS state FROM e, range(2) t(i)
"""

SQL = {
    "clean_columns": "SELECT o_orderkey AS order_key, CAST(year(o_orderdate) AS BIGINT) AS year, o_totalprice AS total_price FROM orders",
    "label_codes": "SELECT p_partkey, p_brand, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS BIGINT) AS p_brand_code FROM part",
    "one_hot": ONE_HOT,
    "csv_files": "SELECT lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS code, c_custkey, c_acctbal FROM customer",
    "parquet_files": "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders",
    "json_files": "SELECT p_partkey, p_brand, p_size, p_retailprice FROM part",
    "section_files": "SELECT c_custkey, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS code, c_mktsegment, 'part' AS kind FROM customer",
    "attribution_files": LINEAR_ATTRIBUTION,
    "background_rows": f"SELECT *, CAST(1 AS DOUBLE) AS _weight FROM ({SAMPLE_N})",
    "checks_report": CHECKS,
    "linear_score": LINEAR_SCORE,
    "level_means": LEVEL_MEANS,
    "validated_means": LEVEL_MEANS,
    "search_stumps": SEARCH_STUMPS,
}
