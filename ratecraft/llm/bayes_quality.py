"""Quality classifier with hierarchical empirical Bayes over sites (operator 4).

Two logistic regressions read a document's text: one for quality, one for toxicity. Their features
are byte shares (capitals, digits, marks, breaks ...), the presence of the words that most separate
the labelled classes and the number of words with the word beginnings that do. Together they give p,
the probability that the text is good and not toxic. The text is then seen in its place: per host, and
per first path below the host, the mean of p is shrunk to the level above,

    host = (sum of p + k1 * global mean) / (n + k1),    path = (sum of p + k2 * host) / (n + k2),

the document itself left out. k1 and k2, the number of documents that weigh as much as the level above, are
the ratio of the variance of p within groups to that between groups, estimated from grouped sums. So a
sparse site says little and a large one speaks for itself. The document's log odds move by the path's
log odds against the global ones, at most ``MAX_SHIFT``; it is kept if the result is positive.

The regressions are fitted on the driver on at most ``max_labelled`` labelled documents (those with the
smallest hash of the id), with at most ``MAX_WORDS`` words; every count and mean of the site model
covers all documents, in partial aggregates, so a site with a third of all documents is a few rows a
task. The table of sites is joined back broadcast up to ``BROADCAST_SITES`` rows (measured) and by a
shuffle, which splits skewed sites, beyond.

Defined cases: a source is ``host/path/...`` with or without a scheme; where there is no path the language
stands for it; null sources and languages are "". Null and empty texts are judged by their features
like any other. Labels that are null are left out; without labels of both kinds a regression says
nothing (log odds 6 for good). Rows of one id are judged each. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratecraft.llm.common import materialise, spare_names

MAX_LABELLED, MAX_WORDS, MIN_SCORE = 20_000, 256, 5.0
MAX_SHIFT, BROADCAST_SITES = 2.0, 200_000
BROADCAST_REJECTED = 1_000_000  # rows of two numbers each
LETTERS = re.compile(r"[^\W\d_]+").findall
STEM = 4  # letters of a word beginning
WORD_SPLIT = r"[^\p{L}]+"
# Byte classes whose shares are features.
CLASSES = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&<>", b"|", b"!?", b".,;:", b"\n", b" \t", b"@/\\_=+~^", b"()[]{}")
N_SHAPE = len(CLASSES) + 4


def shape(text: bytes, n_words: int, n_distinct: int) -> list[float]:
    if not text:
        return [0.0] * N_SHAPE
    seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    n = len(text)
    shares = [float(seen[list(c)].sum()) / n for c in CLASSES]
    return [*shares, float(seen[128:].sum()) / n, np.log1p(n_words), n_words / n, n_distinct / max(1, n_words)]


def vectors(texts: list[str], words: dict[str, int]) -> np.ndarray:
    out = np.zeros((len(texts), N_SHAPE + len(words)), np.float32)
    for row, text in zip(out, texts):
        found = LETTERS(text.lower())
        distinct = set(found)
        row[:N_SHAPE] = shape(text.encode(), len(found), len(distinct))
        for w in distinct:
            at = words.get(w)
            if at is not None:
                row[N_SHAPE + at] = 1.0
            at = words.get("^" + w[:STEM])
            if at is not None:
                row[N_SHAPE + at] += 1.0
        row[N_SHAPE:] = np.log1p(row[N_SHAPE:])
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Newton's method with a ridge; the last weight is the intercept's, which has none."""
    x = np.hstack([x, np.ones((len(x), 1))]).astype(np.float64)
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[-1] = 1e-9
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        s = np.maximum(p * (1 - p), 1e-6)
        move = np.linalg.solve((x * s[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w += move
        if np.abs(move).max() < 1e-6:
            break
    return w


def _separating_words(sample: DataFrame) -> list[str]:
    """The words and ("^...") word beginnings whose share of documents differs most between the
    classes of a label, by the score of two proportions."""
    total = sample.agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")).first()
    if not total["n"]:
        return []
    words = sample.select("good", "toxic", F.array_distinct(F.split(F.lower("text"), WORD_SPLIT)).alias("w")) \
        .select("good", "toxic", F.explode(F.array_distinct(F.concat("w", F.transform("w", lambda w: F.concat(
            F.lit("^"), F.substring(w, 1, STEM)))))).alias("word")).where(~F.col("word").isin("", "^")) \
        .groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))

    def score(label: str) -> Column:
        ones = float(total[label] or 0)
        share = ones / total["n"]
        return F.abs(F.coalesce(F.col(label), F.lit(0)) - F.col("n") * share) / F.sqrt(F.col("n") * max(share * (1 - share), 1e-6) + 1)

    best = words.where("n >= 5").select("word", F.greatest(score("good"), score("toxic")).alias("score")) \
        .where(F.col("score") >= MIN_SCORE).orderBy(F.desc("score"), "word").limit(MAX_WORDS)
    return [r["word"] for r in best.collect()]


def fit_text_model(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> dict:
    """The two regressions: words, mean and scale of the features, weights."""
    chosen = labels.where(F.col("doc_id").isNotNull() & (F.col("quality").isNotNull() | F.col("toxic").isNotNull())) \
        .groupBy("doc_id").agg(F.min("quality").alias("good"), F.max("toxic").alias("toxic")) \
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    sample = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id")
    sample = materialise(sample, "labelled")
    words = _separating_words(sample)
    index = {w: i for i, w in enumerate(words)}

    def batches(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            x = vectors(b.column(1).to_pylist(), index)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r.tobytes() for r in x], pa.binary()), b.column(2), b.column(3)],
                                             names=["doc_id", "x", "good", "toxic"])

    rows = sample.select("doc_id", "text", F.col("good").cast("double"), F.col("toxic").cast("double")) \
        .mapInArrow(batches, "doc_id long, x binary, good double, toxic double").toPandas()
    rows = rows.sort_values(["doc_id", "x"])  # sums must not depend on the order of arrival
    width = N_SHAPE + len(words)
    x = np.frombuffer(b"".join(rows["x"]), np.float32).reshape(-1, width) if len(rows) else np.zeros((0, width), np.float32)
    mean = x.mean(axis=0) if len(x) else np.zeros(width)
    scale = np.maximum(x.std(axis=0), 1e-3) if len(x) else np.ones(width)
    model = {"words": index, "mean": mean, "scale": scale}
    for label in ("good", "toxic"):
        y = rows[label].to_numpy(dtype=float) if len(rows) else np.zeros(0)
        known = ~np.isnan(y)
        model[label] = fit_logistic((x[known] - mean) / scale, y[known]) if len(set(y[known].tolist())) == 2 else None
    return model


def text_log_odds(texts: list[str], model: dict) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of good and of toxic."""
    x = (vectors(texts, model["words"]) - model["mean"]) / model["scale"]
    good, toxic = (np.full(len(texts), default) if model[k] is None else np.clip(x @ model[k][:-1] + model[k][-1], -30, 30)
                   for k, default in (("good", 6.0), ("toxic", -6.0)))
    return good, toxic


def _score_batches(batches: Iterable[pa.RecordBatch], model: dict) -> Iterator[pa.RecordBatch]:
    step = 512
    for batch in batches:
        texts, good, toxic = batch.column(1), [], []
        for k in range(0, len(texts), step):
            a, b = text_log_odds([t.as_py() or "" for t in texts.slice(k, step)], model)
            good.append(a)
            toxic.append(b)
        odds = [np.concatenate(v) if v else np.zeros(0) for v in (good, toxic)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], *(pa.array(v, pa.float64()) for v in odds)],
                                         names=["doc_id", "text_hash", "host", "path", "good_log_odds", "toxic_log_odds"])


def site(source: str = "source", lang: str = "lang") -> tuple[Column, Column]:
    """(host, path) of a document."""
    bare = F.regexp_replace(F.coalesce(F.col(source), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    below = F.regexp_extract(bare, r"^[^/?#]*/([^/?#]+)", 1)
    return F.lower(F.regexp_extract(bare, r"^([^/?#]*)", 1)), F.when(below != "", below).otherwise(F.coalesce(F.col(lang), F.lit("")))


def _logit(p: Column) -> Column:
    p = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p))
    return F.log(p / (1 - p))


def _strength(groups: DataFrame, parent: str | None) -> float:
    """Variance of p within groups over that between groups of one parent (analysis of variance);
    groups: n, s (sum of p), q (sum of p squared)."""
    if parent:
        of = groups.groupBy(parent).agg(F.sum("n").alias("pn"), F.sum("s").alias("ps"))
        groups = groups.join(of, parent)
    else:
        whole = groups.agg(F.sum("n").alias("pn"), F.sum("s").alias("ps")).first()
        groups = groups.withColumn("pn", F.lit(whole["pn"]).cast("long")).withColumn("ps", F.lit(whole["ps"]).cast("double"))
    r = groups.agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"), F.sum(F.col("q") - F.col("s") * F.col("s") / F.col("n")).alias("within"),
        F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - F.col("ps") / F.col("pn"), 2)).alias("between"),
        F.sum(F.col("n") * F.col("n") / F.col("pn")).alias("even"),
        (F.count_distinct(parent) if parent else F.lit(1)).alias("parents")).first()
    if not r["n"] or r["n"] <= r["k"] or r["k"] <= r["parents"]:
        return 1e6
    within = max(r["within"] / (r["n"] - r["k"]), 1e-9)
    between = (r["between"] - (r["k"] - r["parents"]) * within) / max(r["n"] - r["even"], 1e-9)
    return float(min(1e6, max(1.0, within / max(between, 1e-12))))


def judge(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, host, path, p_text, p_host, p_path, log_odds, kept."""
    model = docs.sparkSession.sparkContext.broadcast(fit_text_model(docs, labels, max_labelled))
    host, path = site()
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.xxhash64("text").alias("text_hash"), host.alias("host"), path.alias("path"))
    scored = slim.mapInArrow(lambda it: _score_batches(it, model.value), "doc_id long, text_hash long, host string, "
                             "path string, good_log_odds double, toxic_log_odds double")
    p = 1 / ((1 + F.exp(-F.col("good_log_odds"))) * (1 + F.exp(F.col("toxic_log_odds"))))
    # rounded, so that sums do not depend on the order of tasks
    scored = materialise(scored.withColumn("p", F.round(p, 6).cast("decimal(7,6)")), "scores")

    value = F.col("p")
    paths = materialise(scored.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("n"), F.sum(value).cast("double").alias("s"),
        F.sum(value * value).cast("double").alias("q")), "sites")
    hosts = paths.groupBy("host").agg(*[F.sum(c).alias(c) for c in ("n", "s", "q")])
    k1, k2 = _strength(hosts, None), _strength(paths, "host")
    total = hosts.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    mean = float(total["s"] / total["n"]) if total["n"] else 0.5

    sites = paths.select("host", "path", "n", "s").join(
        hosts.select("host", F.col("n").alias("hn"), F.col("s").alias("hs")), "host")
    few = paths.count() <= BROADCAST_SITES
    all_ = scored.join(F.broadcast(sites) if few else sites, ["host", "path"])
    own = F.col("p").cast("double")
    p_host = (F.col("hs") - own + k1 * mean) / (F.col("hn") - 1 + k1)
    p_path = (F.col("s") - own + k2 * F.col("p_host")) / (F.col("n") - 1 + k2)
    shift = F.greatest(F.lit(-MAX_SHIFT), F.least(F.lit(MAX_SHIFT), _logit(F.col("p_path")) - _logit(F.lit(mean))))
    return all_.withColumn("p_host", p_host).withColumn("p_path", p_path) \
        .withColumn("log_odds", _logit(own) + shift) \
        .select("doc_id", "text_hash", "host", "path", own.alias("p_text"), "p_host", "p_path", "log_odds",
                (F.col("log_odds") > 0).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """The rows of ``docs`` that are kept."""
    doc, text_hash = spare_names(docs, "rejected_id", "rejected_hash")
    gone = materialise(judge(docs, labels, max_labelled).where(~F.col("kept"))
                       .select(F.col("doc_id").alias(doc), F.col("text_hash").alias(text_hash)).distinct(), "rejected")
    if gone.count() <= BROADCAST_REJECTED:  # then the texts are not shuffled
        gone = F.broadcast(gone)
    same = docs["doc_id"].cast("long").eqNullSafe(F.col(doc)) & (F.xxhash64(docs["text"].cast("string")) == F.col(text_hash))
    return docs.join(gone, same, "left_anti")
