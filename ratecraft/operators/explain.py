"""Feature attribution.

X1 is a projection (exact for linear models). X2 estimates Shapley values for any
fitted model by permutation sampling: each explained row is paired with a
*bounded* background set (a sample or k-means centres, size checked) and a fixed
number of feature orders; every prefix of an order gives one composite row that
the model scores; marginal changes are averaged by (row, feature). The fan-out
per row is background x permutations x (features + 1), all set by parameters.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratecraft.errors import ValidationError
from ratecraft.operators.features import StandardScaler
from ratecraft.operators.ranking import hash_key, sample_n

MAX_BACKGROUND = 1000


def linear_attribution(df: DataFrame, coefficients: Mapping[str, float], keys: Sequence[str],
                       means: Mapping[str, float] | None = None, target: str = "target") -> DataFrame:
    """phi_j = w_j * (x_j - mean(x_j)); long output (keys, target, feature, phi).

    Means are taken over ``df`` unless given (e.g. the training rows). For a linear
    model sum(phi) + mean prediction = prediction.
    """
    feats = [f for f in coefficients if f != "intercept"]
    if means is None:
        row = df.agg(*[F.avg(f).alias(f) for f in feats]).first()
        means = {f: row[f] for f in feats}
    structs = [F.struct(F.lit(f).alias("feature"),
                        (F.lit(float(coefficients[f])) * (F.col(f) - F.lit(means[f]))).alias("phi"))
               for f in feats]
    return df.select(*keys, F.lit(target).alias("target"),
                     F.explode(F.array(*structs)).alias("_s")).select(*keys, "target", "_s.*")


def mean_abs_topk(attributions: DataFrame, k: int = 10, by: Sequence[str] = ("target",)) -> DataFrame:
    """Mean |phi| per feature, top ``k`` per target (ties by feature name).

    The ranking window runs on the aggregated table (targets x features rows).
    """
    by = list(by)
    agg = attributions.groupBy(*by, "feature").agg(F.avg(F.abs("phi")).alias("mean_abs_phi"))
    w = Window.partitionBy(*by).orderBy(F.desc("mean_abs_phi"), F.asc("feature"))
    return (agg.withColumn("rank", F.row_number().over(w).cast("long"))
            .where(F.col("rank") <= k))


def background_sample(df: DataFrame, n: int, keys: Sequence[str], seed: int = 0) -> DataFrame:
    """A seeded hash sample of ``n`` training rows, weight 1 each."""
    return sample_n(df, n, keys, seed).withColumn("_weight", F.lit(1.0))


def background_kmeans(df: DataFrame, num: Sequence[str], cat: Sequence[str] = (), k: int = 15,
                      seed: int = 1) -> DataFrame:
    """K-means summary of the data as background rows weighted by cluster share.

    Clusters are found on z-scored numeric columns; a centre's numeric values are
    the cluster means on the original scale, its categories the cluster's most
    frequent level (ties by level). All steps are distributed aggregations.
    """
    num, cat = list(num), list(cat)
    sc = StandardScaler().fit(df, num)
    z = sc.transform(df.select(*num, *cat), suffix="__z").na.drop(subset=[c + "__z" for c in num])
    vec = VectorAssembler(inputCols=[c + "__z" for c in num], outputCol="_v").transform(z)
    model = KMeans(k=k, seed=seed, featuresCol="_v", predictionCol="_cluster").fit(vec)
    assigned = model.transform(vec)
    total = F.sum("_n").over(Window.partitionBy())
    centres = (assigned.groupBy("_cluster")
               .agg(F.count(F.lit(1)).alias("_n"), *[F.avg(c).alias(c) for c in num]))
    centres = centres.withColumn("_weight", F.col("_n") / total)
    if cat:
        # one count of (cluster, column, level) for all categories; the least level of the greatest count
        levels = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("string").alias("level")) for i, c in enumerate(cat)]))
        modes = (assigned.select("_cluster", levels.alias("_s")).groupBy("_cluster", "_s.i", "_s.level")
                 .agg(F.count(F.lit(1)).alias("_k")).groupBy("_cluster", "i")
                 .agg(F.min_by(F.struct("level"), F.struct((-F.col("_k")).alias("k"), "level")).alias("_m")))
        wide = modes.groupBy("_cluster").agg(*[F.max(F.when(F.col("i") == i, F.col("_m.level"))).cast(assigned.schema[c].dataType).alias(c)
                                               for i, c in enumerate(cat)])
        centres = centres.join(wide, "_cluster", "left")
    return centres.drop("_n")


def _collect_background(background: DataFrame, features: Sequence[str]) -> list:
    rows = background.select(*features, "_weight").limit(MAX_BACKGROUND + 1).collect()
    if len(rows) > MAX_BACKGROUND:
        raise ValidationError(f"background larger than {MAX_BACKGROUND} rows")
    if not rows:
        raise ValidationError("empty background")
    return rows


def sampled_attribution(df: DataFrame, model, features: Sequence[str], keys: Sequence[str],
                        background: DataFrame, permutations: int = 4, seed: int = 0,
                        targets: Sequence[str] | None = None) -> DataFrame:
    """Permutation-sampled Shapley values for any model with ``predict(df)``.

    ``model.predict`` must append ``<target>_pred`` columns (MultiTargetModel does).
    Output: (keys, target, feature, phi). Per order and background row the
    marginal changes sum to f(x) - f(background), so sum(phi) = f(x) - weighted
    mean background prediction.
    """
    from ratecraft.operators.models import spread

    features, keys = list(features), list(keys)
    targets = list(targets or model.targets)
    bg = _collect_background(background, features)
    p = len(features)
    bg_arr = F.array(*[F.struct(F.lit(i).alias("b"), F.lit(float(r["_weight"])).alias("w"),
                                *[F.lit(r[f]).alias(f"bg_{j}") for j, f in enumerate(features)])
                       for i, r in enumerate(bg)])
    base = df.select(*keys, *[F.col(f).alias(f"x_{j}") for j, f in enumerate(features)])
    # a small file is few tasks: spread the rows by what they fan out to, or the whole fan-out runs in those
    fan_out = len(bg) * permutations * (p + 1)
    base = spread(base, df.count(), fan_out * (p + len(keys))).withColumn("_row", hash_key(keys, seed))
    # One feature order per (row, permutation): sort feature ids by a seeded hash.
    perm = F.transform(
        F.array_sort(F.array(*[F.struct(F.md5(F.concat_ws("|", F.col("_row"), F.col("_perm").cast("string"),
                                                            F.lit(str(j)))).alias("h"),
                                         F.lit(j).alias("j")) for j in range(p)])),
        lambda s: s["j"])
    expanded = (base.withColumn("_perm", F.explode(F.sequence(F.lit(0), F.lit(permutations - 1))))
                .withColumn("_order", perm)
                .withColumn("_bg", F.explode(bg_arr))
                .withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(p)))))
    # Position of feature j in the order; it takes the row's value when position < k.
    comp = {}
    for j, f in enumerate(features):
        pos = F.array_position(F.col("_order"), F.lit(j)) - 1
        comp[f] = F.when(pos < F.col("_k"), F.col(f"x_{j}")).otherwise(F.col(f"_bg.bg_{j}"))
    composite = expanded.select(*keys, "_perm", "_order", "_k", F.col("_bg.b").alias("_b"),
                                F.col("_bg.w").alias("_w"), *[v.alias(f) for f, v in comp.items()])
    scored = model.predict(composite)
    # Marginal change of the feature added at step k is f(k) - f(k-1). Each scored
    # prefix row therefore adds +f to the feature it added (k > 0) and -f to the
    # next feature in its order (k < p); summing these signed parts per (row,
    # feature) with a partial aggregate gives the same totals as pairing rows with
    # a window, without shuffling the expanded rows.
    total_w = float(permutations) * sum(float(r["_weight"]) for r in bg)
    names = F.array(*[F.lit(f) for f in features])
    parts = []
    for t in targets:
        fw = F.col(t + "_pred") * F.col("_w")
        plus = F.when(F.col("_k") > 0, F.struct(
            F.element_at(F.col("_order"), F.greatest(F.col("_k"), F.lit(1))).alias("j"), fw.alias("v")))
        minus = F.when(F.col("_k") < p, F.struct(
            F.element_at(F.col("_order"), F.col("_k") + 1).alias("j"), (-fw).alias("v")))
        contrib = (scored.select(*keys, F.explode(F.array(plus, minus)).alias("_c"))
                   .where(F.col("_c").isNotNull())
                   .groupBy(*keys, F.col("_c.j").alias("_j"))
                   .agg((F.sum("_c.v") / F.lit(total_w)).alias("phi")))
        parts.append(contrib.select(*keys, F.lit(t).alias("target"),
                                    F.element_at(names, F.col("_j") + 1).alias("feature"), "phi"))
    out = parts[0]
    for q in parts[1:]:
        out = out.unionByName(q)
    return out


def attribution_export(attributions: DataFrame, path: str, fmt: str = "parquet") -> None:
    """One folder per target (partitioned write)."""
    attributions.write.mode("overwrite").partitionBy("target").format(fmt).save(path)
