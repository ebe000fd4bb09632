"""Feature preparation.

Fitted state is parameter-sized (a mean and deviation per column, a level table
per category) and kept as a DataFrame so it can be saved beside a model. Numeric
transforms are literal projections (whole-stage codegen); level tables are written, so
Spark knows their bytes when it decides whether their join may broadcast them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType, StructField, StructType

from ratecraft.errors import MissingColumnsError, UnknownCategoryError, ValidationError
from ratecraft.functions.scalar import null_as_category
from ratecraft.operators.ordered import ordered_scan
from ratecraft.operators.ranking import hash_key
from ratecraft.session import written


def _clean(df: DataFrame, c: str) -> F.Column:
    col = F.col(c)
    if isinstance(df.schema[c].dataType, (DoubleType, FloatType)):
        col = F.when(~F.isnan(col), col)
    return col.cast("double")


def _params_frame(spark: SparkSession, rows: list, names: tuple[str, str]) -> DataFrame:
    schema = StructType([StructField("column", StringType()),
                         StructField(names[0], DoubleType()), StructField(names[1], DoubleType())])
    return spark.createDataFrame(rows, schema)


@dataclass
class StandardScaler:
    """z = (x - mean) / population sd; a constant column scales to 0.

    NULLs are ignored in the fit and kept in the transform.
    """
    params: dict = field(default_factory=dict)  # column -> (mean, sd)

    def fit(self, df: DataFrame, cols: Sequence[str]) -> "StandardScaler":
        cols = list(cols)
        row = df.agg(*[F.avg(_clean(df, c)).alias(f"m{i}") for i, c in enumerate(cols)],
                     *[F.stddev_pop(_clean(df, c)).alias(f"s{i}") for i, c in enumerate(cols)]).first()
        self.params = {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(cols)}
        return self

    def expr(self, c: str, src: F.Column | None = None) -> F.Column:
        mean, sd = self.params[c]
        x = F.col(c) if src is None else src
        if mean is None:
            return F.lit(None).cast("double")
        if not sd:
            return F.when(x.isNotNull(), F.lit(0.0))
        return (x.cast("double") - F.lit(mean)) / F.lit(sd)

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        return df.withColumns({c + suffix: self.expr(c, _clean(df, c)) for c in self.params})

    def inverse(self, df: DataFrame, suffix: str = "", cols: Sequence[str] | None = None) -> DataFrame:
        out = {}
        for c in (cols or self.params):
            mean, sd = self.params[c]
            src = F.col(c + suffix) if suffix else F.col(c)
            out[c + suffix] = src * F.lit(sd or 0.0) + F.lit(mean)
        return df.withColumns(out)

    def table(self, spark: SparkSession) -> DataFrame:
        return _params_frame(spark, [(c, m, s) for c, (m, s) in self.params.items()], ("mean", "sd"))

    @classmethod
    def from_table(cls, t: DataFrame) -> "StandardScaler":
        return cls({r["column"]: (r["mean"], r["sd"]) for r in t.collect()})


@dataclass
class MinMaxScaler:
    """(x - min) / (max - min); a constant column scales to 0 (not 0.5)."""
    params: dict = field(default_factory=dict)  # column -> (min, max)

    def fit(self, df: DataFrame, cols: Sequence[str]) -> "MinMaxScaler":
        cols = list(cols)
        row = df.agg(*[F.min(_clean(df, c)).alias(f"lo{i}") for i, c in enumerate(cols)],
                     *[F.max(_clean(df, c)).alias(f"hi{i}") for i, c in enumerate(cols)]).first()
        self.params = {c: (row[f"lo{i}"], row[f"hi{i}"]) for i, c in enumerate(cols)}
        return self

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        out = {}
        for c, (lo, hi) in self.params.items():
            x = _clean(df, c)
            if lo is None:
                out[c + suffix] = F.lit(None).cast("double")
            elif hi == lo:
                out[c + suffix] = F.when(x.isNotNull(), F.lit(0.0))
            else:
                out[c + suffix] = (x - F.lit(lo)) / F.lit(hi - lo)
        return df.withColumns(out)

    def inverse(self, df: DataFrame, suffix: str = "") -> DataFrame:
        return df.withColumns({c + suffix: F.col(c + suffix) * F.lit(hi - lo) + F.lit(lo)
                               for c, (lo, hi) in self.params.items()})

    def table(self, spark: SparkSession) -> DataFrame:
        return _params_frame(spark, [(c, lo, hi) for c, (lo, hi) in self.params.items()], ("min", "max"))


class OrdinalEncoder:
    """Level -> code in byte order of the level text, unknown -> -1.

    The level table (column, level, code) is built with distributed ranks (range
    partitioning, no single-partition window) and written. A missing value is
    the level 'nan'.
    """

    def __init__(self, levels: DataFrame | None = None, n_levels: int | None = None):
        self.levels = levels
        self.n_levels = n_levels

    def fit(self, df: DataFrame, cols: Sequence[str]) -> "OrdinalEncoder":
        cols = list(cols)
        stack = F.explode(F.array(*[F.struct(F.lit(c).alias("column"),
                                             null_as_category(c).alias("level")) for c in cols]))
        distinct = df.select(stack.alias("_s")).select("_s.column", "_s.level").distinct()
        ranked = ordered_scan(distinct, ["column"], ["level"], index="code")
        self.levels = written(ranked.select("column", "level", F.col("code").cast("long").alias("code")), "levels")
        self.n_levels = self.levels.count()
        return self

    def transform(self, df: DataFrame, cols: Sequence[str] | None = None, suffix: str = "_code",
                  unknown: int = -1) -> DataFrame:
        if self.levels is None:
            raise ValidationError("encoder is not fitted")
        cols = list(cols) if cols is not None else [
            r[0] for r in self.levels.select("column").distinct().collect()]
        out = df
        for c in cols:
            m = self.levels.where(F.col("column") == c).select(
                F.col("level").alias(f"__lvl_{c}"), F.col("code").alias(c + suffix))
            out = (out.join(m, null_as_category(c) == F.col(f"__lvl_{c}"), "left")
                   .drop(f"__lvl_{c}")
                   .withColumn(c + suffix, F.coalesce(F.col(c + suffix), F.lit(unknown).cast("long"))))
        return out


def label_encode(df: DataFrame, encoder: OrdinalEncoder, cols: Sequence[str],
                 suffix: str = "_code") -> DataFrame:
    """like F4 but an unseen level raises (checked with a bounded probe)."""
    out = encoder.transform(df, cols, suffix=suffix)
    bad = F.lit(False)
    for c in cols:
        bad = bad | (F.col(c + suffix) == -1)
    hit = out.where(bad).select(*cols).limit(1).collect()
    if hit:
        raise UnknownCategoryError(f"unseen level(s): {hit[0].asDict()}")
    return out


def dummies(df: DataFrame, col: str, levels: Sequence[str], drop_first: bool = True,
            prefix: str | None = None) -> DataFrame:
    """F8: one 0/1 INT column per level (first level dropped); NULL gives all zeros."""
    lv = sorted(levels)
    if drop_first:
        lv = lv[1:]
    p = prefix or col
    from ratecraft.functions.columns import normalize_name
    names = [f"{p}_{normalize_name(str(v))}" for v in lv]
    clash = sorted({n for n in names if names.count(n) > 1 or n in df.columns})
    if clash:
        raise ValidationError(f"levels of {col} that would share a column: {clash}")
    return df.withColumns({n: F.coalesce((F.col(col) == F.lit(v)).cast("int"), F.lit(0))
                           for n, v in zip(names, lv)})


def fit_levels(df: DataFrame, col: str, max_levels: int | None = None) -> list:
    """Distinct levels of one column, for column-per-level outputs.

    Each level becomes a column of the schema, so there are as many as a schema holds;
    ``max_levels`` makes more of them an error.
    """
    vals = df.select(col).where(F.col(col).isNotNull()).distinct()
    vals = (vals if max_levels is None else vals.limit(max_levels + 1)).collect()
    if max_levels is not None and len(vals) > max_levels:
        raise ValidationError(f"{col} has more than {max_levels} levels")
    return sorted(r[0] for r in vals)


def hash_bucket(keys: Sequence[str], seed: int, buckets: int = 10000) -> F.Column:
    """Deterministic bucket 0..buckets-1 from md5 of the key and the seed."""
    h = F.conv(F.substring(hash_key(keys, seed), 1, 8), 16, 10).cast("long")
    return h % F.lit(buckets)


def holdout_split(df: DataFrame, keys: Sequence[str], fraction: float = 0.2, seed: int = 42,
                  col: str = "is_test") -> DataFrame:
    """flag a repeatable ~``fraction`` of rows as held out (hash of key and seed).

    A pure projection: no shuffle, disjoint and complete by construction. Whole buckets of a
    1/10000 of the rows are held out; of the next one the part that is left of the fraction, by
    32 more bits of the hash.
    """
    if not 0 <= fraction <= 1:
        raise ValidationError("fraction must be between 0 and 1")
    share = round(fraction * 10000, 6)
    bucket, rest = hash_bucket(keys, seed), int((share - int(share)) * 2**32)
    held = bucket < F.lit(int(share))
    if rest:
        finer = F.conv(F.substring(hash_key(keys, seed), 9, 8), 16, 10).cast("long")
        held = held | ((bucket == F.lit(int(share))) & (finer < F.lit(rest)))
    return df.withColumn(col, held)


def kfold_assign(df: DataFrame, keys: Sequence[str], k: int = 3, seed: int = 42,
                 col: str = "fold") -> DataFrame:
    """fold number 0..k-1 from the same hash (for ``CrossValidator(foldCol=...)``)."""
    if k < 2:
        raise ValidationError("k must be > 1")
    return df.withColumn(col, (hash_bucket(keys, seed) % F.lit(k)).cast("int"))


@dataclass
class FeatureSpec:
    """Column roles (the config name lists)."""
    cat: list = field(default_factory=list)
    num: list = field(default_factory=list)
    target: list = field(default_factory=list)
    drop: list = field(default_factory=list)


def fill_values(df: DataFrame, num: Sequence[str]) -> dict:
    """Median per numeric column for the gaps of training and scored rows (0 for a column
    without any value). Exact where the training rows have gaps; a column that is complete
    there can only have gaps at scoring, for which an approximate median is taken in one pass."""
    from ratecraft.operators.fill import median_values
    if not num:
        return {}
    row = df.agg(*[F.percentile_approx(_clean(df, c), 0.5, 10_000).alias(f"m{i}") for i, c in enumerate(num)],
                 *[F.count_if(_clean(df, c).isNull()).alias(f"n{i}") for i, c in enumerate(num)]).first()
    gaps = [c for i, c in enumerate(num) if row[f"n{i}"] and row[f"m{i}"] is not None]
    exact = median_values(df, gaps) if gaps else {}
    return {c: float(exact.get(c, row[f"m{i}"]) or 0.0) for i, c in enumerate(num)}


def preprocess_pipeline(df: DataFrame, spec: FeatureSpec, features_col: str = "features",
                        fit_on: DataFrame | None = None) -> PipelineModel:
    """F9 (+A8, F1, F6, F12): fitted pipeline: medians for missing numerics, population
    z-scores, one-hot for categories (alphabetical levels, unknown/NULL-at-score -> all
    zeros), assembled into one vector. Fit on ``fit_on`` (training rows) when given; the
    medians are part of the pipeline, so scoring fills with the training rows' values.
    """
    src = fit_on if fit_on is not None else df
    num = [c for c in spec.num if c in df.columns]
    cat = [c for c in spec.cat if c in df.columns]
    if not num and not cat:
        raise ValidationError("no usable feature column")
    missing = [c for c in spec.num + spec.cat if c not in df.columns]
    if missing:
        raise MissingColumnsError(f"feature columns missing: {missing}")
    medians = fill_values(src, num)
    filled = src.select(*[F.coalesce(_clean(src, c), F.lit(medians[c])).alias(c) for c in num]) if num else src
    scaler = StandardScaler().fit(filled, num) if num else StandardScaler()
    sel = ["*"]
    for c in num:
        mean, sd = scaler.params[c]
        if mean is None or not sd:
            e = "0.0D"
        else:
            m = f"({medians[c]!r}D)"
            e = f"(coalesce(nanvl(CAST(`{c}` AS DOUBLE), {m}), {m}) - ({mean!r}D)) / ({sd!r}D)"
        sel.append(f"{e} AS `__z_{c}`")
    for c in cat:
        sel.append(f"coalesce(CAST(`{c}` AS STRING), 'nan') AS `__s_{c}`")
    stages = [SQLTransformer(statement=f"SELECT {', '.join(sel)} FROM __THIS__")]
    if cat:
        stages.append(StringIndexer(inputCols=[f"__s_{c}" for c in cat],
                                    outputCols=[f"__i_{c}" for c in cat],
                                    stringOrderType="alphabetAsc", handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=[f"__i_{c}" for c in cat],
                                    outputCols=[f"__o_{c}" for c in cat], dropLast=True))
    stages.append(VectorAssembler(inputCols=[f"__z_{c}" for c in num] + [f"__o_{c}" for c in cat],
                                  outputCol=features_col, handleInvalid="keep"))
    return Pipeline(stages=stages).fit(src)


def strip_helpers(df: DataFrame) -> DataFrame:
    """Drop the helper columns a preprocess pipeline adds (keeps the vector)."""
    return df.drop(*[c for c in df.columns if c.startswith(("__z_", "__s_", "__i_", "__o_"))])


def feature_names(df: DataFrame, features_col: str = "features") -> list[str]:
    """names of the vector slots from ML attribute metadata (numerics, then one-hot)."""
    meta = df.schema[features_col].metadata.get("ml_attr", {})
    attrs = meta.get("attrs", {})
    slots = []
    for kind in ("numeric", "binary", "nominal"):
        for a in attrs.get(kind, []):
            slots.append((a["idx"], a.get("name", f"f{a['idx']}")))
    names = [n for _, n in sorted(slots)]
    clean = []
    for n in names:
        for pfx, rep in (("__z_", ""), ("__o_", "")):
            if n.startswith(pfx):
                n = rep + n[len(pfx):]
        clean.append(n)
    return clean


__all__ = ["StandardScaler", "MinMaxScaler", "OrdinalEncoder", "label_encode", "dummies",
           "fit_levels", "holdout_split", "kfold_assign", "hash_bucket", "FeatureSpec",
           "preprocess_pipeline", "strip_helpers", "feature_names"]
