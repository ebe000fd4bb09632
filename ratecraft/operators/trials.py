"""Search-trial tables: per-epoch loss, early stopping, median pruning, best trial,
state counts and intervals (A15, A17-A19, W1, W2).

A metric table has one row per (trial, step). Steps of one trial are ordered work;
all order-dependent rules run through :func:`ordered_scan`, so a trial with a very
long history is split over range partitions instead of landing in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecraft.operators.joins import left_join
from ratecraft.operators.ordered import ordered_scan, partitions_of
from ratecraft.operators.patience import early_stops
from ratecraft.operators.quantiles import exact_quantiles


def step_index(metrics: DataFrame, trial: str, order: Sequence[str], out: str = "step") -> DataFrame:
    """0-based position of each row in its trial, ordered by ``order``."""
    return ordered_scan(metrics, [trial], list(order), index=out)


def epoch_loss(batches: DataFrame, trial: str, epoch: str, loss: str,
               out: str = "loss") -> DataFrame:
    """Mean of batch losses per (trial, epoch), unweighted by batch size."""
    return batches.groupBy(trial, epoch).agg(F.avg(loss).alias(out))


def _order_cols(step: str | Sequence[str]) -> list[str]:
    return [step] if isinstance(step, str) else list(step)


def early_stop(metrics: DataFrame, trial: str, step: str | Sequence[str], loss: str,
               patience: int = 7, delta: float = 0.0, strict: bool = False) -> DataFrame:
    """(trial, stop_index, best_loss) under the patience rule.

    score = -loss. The first row sets best; a row with score < best + delta adds
    one to the counter (stop when it reaches ``patience``); any other row sets
    best := score and resets the counter. An equal loss at delta 0 is an
    improvement (``strict=True`` gives the other variant of the rule, where only a
    strictly better value improves). ``stop_index`` is the 0-based position of the stopping row (NULL
    when the trial never stops); ``best_loss`` is the best loss at the stop (or at
    the end).

    At delta 0 best is the running maximum of score; sorted chunks are reduced to summaries
    that compose (``patience.py``). With delta > 0 improvements are prefix-maximum records and the
    improvement chain is found by pointer doubling (``_early_stop_chain``); with
    delta < 0 next-pointers come from a bounded look-ahead of ``patience`` rows
    (``_early_stop_lookahead``). All three are skew-safe: no trial is processed in
    one task.

    NaN losses: no comparison with NaN holds, so a NaN counts as an improvement, and so does the loss after it,
    which is the best from then on. ``best_loss`` is NaN where the last loss is. With ``strict`` NaN is an error:
    clean it first. Rows without a loss are left out; rows without a trial id are one trial.
    """
    order = _order_cols(step)
    base = metrics.select(F.col(trial).alias("trial_id"),
                          *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                          (-F.col(loss).cast("double")).alias("_score")).where(
        F.col("_score").isNotNull())
    okeys = [f"_o{i}" for i in range(len(order))]
    if strict:
        no_nan = F.when(F.isnan("_score"), F.raise_error(F.lit("NaN loss under the strict rule"))).otherwise(F.col("_score"))
        base = base.withColumn("_score", no_nan)
    if delta == 0.0:
        return early_stops(base, okeys, patience, strict, partitions_of(base))
    if strict or base.where(F.isnan("_score")).isEmpty():
        return _early_stop_rule(base, okeys, patience, delta, strict)
    return _early_stop_after_nan(base, okeys, patience, delta)


def _early_stop_after_nan(base: DataFrame, okeys: list[str], patience: int, delta: float) -> DataFrame:
    """``early_stop`` with a delta where losses are NaN: each stretch between NaN rows is a trial of its own;
    the first stretch that stops is the trial's."""
    from ratecraft.session import cut_lineage

    s = ordered_scan(base, ["trial_id"], okeys, index="_i")
    # the stretch of a row is named by the last NaN row before it
    s = ordered_scan(s.withColumn("_nan", F.when(F.isnan("_score"), F.col("_i"))), ["trial_id"], ["_i"], index=None,
                     running=[("max", "_nan", "_after", True)])
    s = cut_lineage(s.select("trial_id", "_i", "_score", F.coalesce("_after", F.lit(-1)).cast("long").alias("_after")))
    stretch = F.struct("trial_id", "_after").alias("trial_id")
    told = _early_stop_rule(s.where(~F.isnan("_score")).select(stretch, F.col("_i").alias("_o0"), "_score"), ["_o0"], patience, delta, False)
    told = told.select("trial_id.*", (F.col("stop_index") + F.col("_after") + 1).alias("stop_index"), "best_loss")
    ends = s.groupBy("trial_id").agg(F.max_by("_score", "_i").alias("_last"))
    first = told.groupBy("trial_id").agg(F.min("stop_index").alias("stop_index"), F.min_by("best_loss", "stop_index").alias("_stopped"),
                                         F.max_by("best_loss", "_after").alias("_end"))
    return left_join(ends, first, ["trial_id"]).select(
        "trial_id", "stop_index", F.when(F.col("stop_index").isNotNull(), F.col("_stopped"))
        .when(F.isnan("_last"), F.lit(float("nan"))).otherwise(F.col("_end")).alias("best_loss"))


def _early_stop_rule(base: DataFrame, okeys: list[str], patience: int, delta: float, strict: bool) -> DataFrame:
    """``early_stop`` with a delta of (trial_id, order keys, _score) without NaN."""
    if delta > 0.0:
        return _early_stop_chain(base, okeys, patience, delta, strict)
    return _early_stop_lookahead(base, okeys, patience, delta, strict)


def _chain_members(start: DataFrame, nxt: DataFrame) -> DataFrame:
    """Members (trial_id, rid) of the chain start -> nxt -> nxt ... by pointer doubling:
    after round k the first 2^k members are known; O(log length) rounds of joins on
    unique (trial_id, rid) keys, each result checkpointed."""
    from ratecraft.session import cut_lineage

    members = cut_lineage(start)
    jump = nxt.select("trial_id", "rid", F.col("nxt").alias("j"))
    count = members.count()
    while True:
        new = (members.join(jump, ["trial_id", "rid"]).where(F.col("j").isNotNull())
               .select("trial_id", F.col("j").alias("rid")))
        grown = cut_lineage(members.unionByName(new).distinct())
        grown_count = grown.count()
        if grown_count == count:
            return members
        members, count = grown, grown_count
        j2 = jump.select("trial_id", F.col("rid").alias("j"), F.col("j").alias("j2"))
        jump = cut_lineage(jump.join(j2, ["trial_id", "j"], "left")
                           .select("trial_id", "rid", F.col("j2").alias("j")))


def _early_stop_lookahead(base: DataFrame, okeys: list[str], patience: int, delta: float,
                          strict: bool = False) -> DataFrame:
    """W1 for any delta (used for delta < 0, where the best may fall), skew-safe.

    After an improvement at row j the next improvement must come within the next
    ``patience`` rows, or the trial stops at j + patience. So next-pointers need only
    a bounded look-ahead: every row offers itself as the m-th look-ahead of row i - m
    (m = 1..patience), an equi-join on unique (trial, index) keys. The chain from the
    first row is then found by pointer doubling; its last member decides the stop.
    """
    from ratecraft.session import cut_lineage

    s = ordered_scan(base, ["trial_id"], okeys, index="_i")
    pts = cut_lineage(s.select("trial_id", F.col("_i").alias("rid"), "_score"))
    n_rows = pts.groupBy("trial_id").agg(F.count(F.lit(1)).alias("_n"))
    ahead = (pts.select("trial_id", "rid", F.col("_score").alias("_s2"),
                        F.explode(F.sequence(F.lit(1), F.lit(patience))).alias("_m"))
             .select("trial_id", (F.col("rid") - F.col("_m")).alias("rid"), "_m", "_s2")
             .where(F.col("rid") >= 0))
    thr = F.col("_score") + F.lit(delta)
    improves = (F.col("_s2") > thr) if strict else (F.col("_s2") >= thr)
    first = (pts.join(ahead, ["trial_id", "rid"]).where(improves)
             .groupBy("trial_id", "rid").agg(F.min("_m").alias("_m")))
    nxt = cut_lineage(pts.join(first, ["trial_id", "rid"], "left").select(
        "trial_id", "rid", (F.col("rid") + F.col("_m")).alias("nxt")))
    members = _chain_members(pts.where(F.col("rid") == 0).select("trial_id", "rid"), nxt)
    last = members.groupBy("trial_id").agg(F.max("rid").alias("rid"))
    out = last.join(pts, ["trial_id", "rid"]).join(n_rows, "trial_id")
    stop = F.when(F.col("rid") + patience < F.col("_n"), F.col("rid") + patience)
    return out.select("trial_id", stop.cast("long").alias("stop_index"),
                      (-F.col("_score")).alias("best_loss"))


def _early_stop_chain(base: DataFrame, okeys: list[str], patience: int, delta: float,
                      strict: bool = False) -> DataFrame:
    """W1 with delta > 0, distributed and skew-safe.

    With delta > 0 each improvement beats every earlier score, so improvements are
    strict prefix-maximum records, and the improvement chain is: start at the first
    row; from a record with score v the next improvement is the first record with
    score >= v + delta. Steps:
    1. prefix scan -> records (trial, rid, pos, v), v strictly increasing in rid;
    2. next pointers: each record also emits a probe at v + delta; in one ordered
       scan (descending key) the smallest record id at or above a probe is its next;
    3. chain from rid 0 by pointer doubling: after round k the first 2^k chain
       members are known (O(log n) rounds of joins on unique (trial, rid) keys);
    4. the trial stops at the first member whose next improvement (or the end)
       is more than ``patience`` steps away, at member position + patience.
    """
    from ratecraft.session import cut_lineage

    s = ordered_scan(base, ["trial_id"], okeys, index="_i",
                     running=[("max", "_score", "_prev", False)])
    n_rows = s.groupBy("trial_id").agg(F.count(F.lit(1)).alias("_n"))
    rec = s.where(F.col("_prev").isNull() | (F.col("_score") > F.col("_prev"))).select(
        "trial_id", F.col("_i").alias("pos"), F.col("_score").alias("v"))
    rec = ordered_scan(rec, ["trial_id"], ["pos"], index="rid")
    # at equal keys a record sorts after its probe (>= improves) or before it (strict >)
    rec_typ, probe_typ = (0, 1) if strict else (1, 0)
    rows = (rec.select("trial_id", F.col("v").alias("_key"), F.lit(rec_typ).alias("_typ"),
                       F.col("rid").alias("_rrid"), F.lit(None).cast("long").alias("_src"))
            .unionByName(rec.select("trial_id", (F.col("v") + F.lit(delta)).alias("_key"),
                                    F.lit(probe_typ).alias("_typ"),
                                    F.lit(None).cast("long").alias("_rrid"),
                                    F.col("rid").alias("_src"))))
    rows = rows.withColumn("_nk", -F.col("_key")).withColumn("_nt", -F.col("_typ"))
    succ = ordered_scan(rows, ["trial_id"], ["_nk", "_nt"], index=None,
                        running=[("min", "_rrid", "_succ", True)])
    nxt = cut_lineage(succ.where(F.col("_typ") == probe_typ).select(
        "trial_id", F.col("_src").alias("rid"), F.col("_succ").alias("nxt")))
    members = _chain_members(rec.where(F.col("rid") == 0).select("trial_id", "rid"), nxt)
    m = (members.join(rec.select("trial_id", "rid", "pos", "v"), ["trial_id", "rid"])
         .join(nxt, ["trial_id", "rid"], "left")
         .join(rec.select("trial_id", F.col("rid").alias("nxt"), F.col("pos").alias("_npos")),
               ["trial_id", "nxt"], "left")
         .join(n_rows, "trial_id"))
    end = F.coalesce(F.col("_npos"), F.col("_n"))
    cand = F.when(end - F.col("pos") - 1 >= patience, F.col("pos") + patience)
    return (m.groupBy("trial_id")
            .agg(F.min(cand).alias("stop_index"),
                 F.min_by(F.col("v"), F.when(cand.isNotNull(), F.col("pos"))).alias("_vs"),
                 F.max("v").alias("_vend"))
            .select("trial_id", F.col("stop_index").cast("long"),
                    (-F.coalesce(F.col("_vs"), F.col("_vend"))).alias("best_loss")))


def median_prune(metrics: DataFrame, trial: str, step: str | Sequence[str], value: str,
                 warmup: int = 0, min_trials: int = 5, completed: DataFrame | None = None,
                 startup: int = 5) -> DataFrame:
    """(trial, pruned_step): first step index at which the trial's best value so far
    (running minimum) is worse than the median of the reference trials' values at
    that step.

    Reference trials are ``completed`` (a frame holding the ids of completed trials,
    first column) or, when it is None, all trials. Only steps >= ``warmup`` that at
    least ``min_trials`` reference trials reached can prune, and with ``completed``
    nothing is pruned before ``startup`` trials have completed. The per-step median
    is an exact distributed quantile; the running minimum a prefix scan. pruned_step
    is NULL when the trial is never pruned.
    """
    order = _order_cols(step)
    base = metrics.select(F.col(trial).alias("trial_id"),
                          *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                          F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    # one ordered pass gives both the 0-based step index and the running minimum
    run = ordered_scan(base, ["trial_id"], [f"_o{i}" for i in range(len(order))], index="step",
                       running=[("min", "_v", "_best", True)])
    trials = base.select("trial_id").distinct()
    ref = run
    if completed is not None:
        done = completed.select(F.col(completed.columns[0]).alias("trial_id")).distinct()
        if done.limit(startup).count() < startup:  # bounded probe
            return trials.select("trial_id", F.lit(None).cast("long").alias("pruned_step"))
        ref = run.join(done, "trial_id", "left_semi")
    med = exact_quantiles(ref, "_v", [0.5], keys=["step"]).select("step", F.col("q").alias("_med"))
    cnt = ref.groupBy("step").agg(F.count(F.lit(1)).alias("_k"))
    per_step = med.join(cnt, "step")
    flagged = run.join(per_step, "step").where(
        (F.col("step") >= warmup) & (F.col("_k") >= min_trials) & (F.col("_best") > F.col("_med")))
    first = flagged.groupBy("trial_id").agg(F.min("step").alias("pruned_step"))
    return trials.join(first, "trial_id", "left").select(
        "trial_id", F.col("pruned_step").cast("long"))


def best_trial(results: DataFrame, trial: str = "trial_id", value: str = "value",
               state: str | None = "state", direction: str = "minimize") -> DataFrame:
    """The completed trial with the best value; ties go to the lowest trial id.

    One global aggregate (min_by over a struct), partial per task.
    """
    r = results
    if state is not None and state in results.columns:
        r = r.where(F.col(state) == "COMPLETE")
    r = r.where(F.col(value).isNotNull())
    payload = F.struct(*[F.col(c) for c in results.columns])
    if direction == "minimize":
        pick = F.min_by(payload, F.struct(F.col(value), F.col(trial)))
    else:
        pick = F.max_by(payload, F.struct(F.col(value), -F.col(trial)))
    return r.agg(pick.alias("_b")).where(F.col("_b").isNotNull()).select("_b.*")


def trial_state_counts(results: DataFrame, state: str = "state") -> DataFrame:
    """Number of trials per state."""
    return results.groupBy(state).agg(F.count(F.lit(1)).alias("n"))


def interval_summary(samples: DataFrame, keys: Sequence[str], value: str, lo: float = 2.5,
                     hi: float = 97.5, bounded_groups: bool = False) -> DataFrame:
    """(keys, mean, lower_95, upper_95): mean and linear-interpolated percentiles
    of the sample values of each key group.

    ``bounded_groups=True`` (each group holds a known, small number of samples, as
    with B bootstrap scores per row) uses one hash aggregate with ``percentile``;
    otherwise groups may be any size and order statistics are distributed.
    """
    keys = list(keys)
    v = F.col(value).cast("double")
    clean = samples.select(*keys, v.alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    if bounded_groups:
        pq = F.percentile("_v", F.array(F.lit(lo / 100), F.lit(hi / 100)))
        return clean.groupBy(*keys).agg(F.avg("_v").alias("mean"), pq.alias("_q")).select(
            *keys, "mean", F.col("_q")[0].alias("lower_95"), F.col("_q")[1].alias("upper_95"))
    means = clean.groupBy(*keys).agg(F.avg("_v").alias("mean"))
    q = (exact_quantiles(clean, "_v", [lo / 100, hi / 100], keys=keys)
         .groupBy(*keys).pivot("p", [lo / 100, hi / 100]).agg(F.first("q")))
    q = q.toDF(*keys, "lower_95", "upper_95")
    return left_join(means, q, keys)  # null-safe: a NULL key keeps its bounds
