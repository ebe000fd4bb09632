import pytest
from pyspark.sql import functions as F

from ratecraft.operators.trials import (
    best_trial, early_stop, epoch_loss, interval_summary, median_prune, trial_state_counts,
)


def _metrics(spark, seqs):
    rows = [(t, i, float(v)) for t, s in seqs.items() for i, v in enumerate(s)]
    return spark.createDataFrame(rows, "trial bigint, step bigint, loss double")


def test_early_stop_fixture(spark):
    m = _metrics(spark, {1: [.5, .4, .3, .35, .36, .37], 2: [.5, .5, .5, .5], 3: [.9]})
    out = {r["trial_id"]: (r["stop_index"], r["best_loss"])
           for r in early_stop(m, "trial", "step", "loss", patience=3).collect()}
    assert out[1] == (5, pytest.approx(0.3))
    assert out[2] == (None, 0.5)  # equal loss counts as improvement at delta 0
    assert out[3] == (None, 0.9)
    strict = {r["trial_id"]: r["stop_index"]
              for r in early_stop(m, "trial", "step", "loss", patience=3, strict=True).collect()}
    assert strict[2] == 3  # strict variant: equal losses do not improve


def test_early_stop_delta_fold(spark):
    m = _metrics(spark, {1: [.5, .40, .39, .38, .37, .36]})
    out = early_stop(m, "trial", "step", "loss", patience=3, delta=0.05).first()
    # a loss must fall 0.05 below the best to count: .40 does, .39/.38/.37 do not
    assert out["stop_index"] == 4 and out["best_loss"] == pytest.approx(0.40)


def test_median_prune(spark):
    seqs = {t: [1.0, 1.0, 1.0] for t in range(5)}
    seqs[9] = [5.0, 5.0, 0.5]
    out = {r["trial_id"]: r["pruned_step"]
           for r in median_prune(_metrics(spark, seqs), "trial", "step", "loss").collect()}
    assert out[9] == 0 and all(out[t] is None for t in range(5))


def test_best_trial_ties_and_states(spark):
    res = spark.createDataFrame([(3, 0.1, "COMPLETE"), (1, 0.1, "COMPLETE"), (2, 0.05, "FAIL"),
                                 (4, None, "COMPLETE")], "trial_id bigint, value double, state string")
    assert best_trial(res).first()["trial_id"] == 1
    assert best_trial(res, direction="maximize").first()["trial_id"] == 1
    counts = {r["state"]: r["n"] for r in trial_state_counts(res).collect()}
    assert counts == {"COMPLETE": 3, "FAIL": 1}


def test_epoch_loss_unweighted(spark):
    b = spark.createDataFrame([(1, 0, 1.0), (1, 0, 3.0), (1, 1, 5.0)], "t int, e int, l double")
    assert {r["e"]: r["loss"] for r in epoch_loss(b, "t", "e", "l").collect()} == {0: 2.0, 1: 5.0}


@pytest.mark.parametrize("bounded", [True, False])
def test_interval_bounds(spark, bounded):
    rows = [(k, float(v)) for k in range(3) for v in range(101)]
    df = spark.createDataFrame(rows, "k int, v double")
    out = interval_summary(df, ["k"], "v", bounded_groups=bounded).collect()
    for r in out:
        assert r["lower_95"] == pytest.approx(2.5) and r["upper_95"] == pytest.approx(97.5)
        assert r["lower_95"] <= r["mean"] <= r["upper_95"]


@pytest.mark.parametrize("delta,patience", [(0.0, 5), (0.02, 3), (0.05, 8), (0.3, 2), (-0.01, 3), (-0.05, 2)])
def test_early_stop_long_hot_trial(spark, delta, patience):
    """One trial with most of the rows, spread over many range partitions."""
    import numpy as np
    from tests.test_ordered_properties import _fold
    rng = np.random.default_rng(11)
    long = np.round(2.0 / np.sqrt(np.arange(1, 3001)) + rng.normal(0, 0.02, 3000), 4)
    short = {t: np.round(rng.uniform(0.1, 1.0, 30), 4) for t in range(1, 6)}
    rows = [(0, i, float(v)) for i, v in enumerate(long)] + \
           [(t, i, float(v)) for t, ls in short.items() for i, v in enumerate(ls)]
    df = spark.createDataFrame(rows, "trial bigint, step bigint, loss double")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        got = {r["trial_id"]: (r["stop_index"], r["best_loss"])
               for r in early_stop(df, "trial", "step", "loss", patience, delta).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    for t, ls in [(0, long)] + list(short.items()):
        stop, best = _fold([float(x) for x in ls], patience, delta)
        assert got[t][0] == stop and got[t][1] == pytest.approx(best)


def test_interval_null_key(spark):
    rows = [(None, float(v)) for v in range(11)]
    out = interval_summary(spark.createDataFrame(rows, "k string, v double"), ["k"], "v").first()
    assert out["k"] is None and out["lower_95"] == pytest.approx(0.25) and out["upper_95"] == pytest.approx(9.75)


def test_median_prune_completed_reference(spark):
    seqs = {t: [1.0, 1.0, 1.0] for t in range(6)}
    seqs[9] = [5.0, 5.0, 0.5]
    m = _metrics(spark, seqs)
    done = spark.createDataFrame([(t,) for t in range(6)], "trial_id bigint")
    out = {r["trial_id"]: r["pruned_step"]
           for r in median_prune(m, "trial", "step", "loss", min_trials=1, completed=done).collect()}
    assert out[9] == 0 and all(out[t] is None for t in range(6))
    few = done.limit(3)  # fewer than `startup` completed trials: nothing is pruned
    out = median_prune(m, "trial", "step", "loss", min_trials=1, completed=few, startup=5).collect()
    assert all(r["pruned_step"] is None for r in out)


def test_early_stop_nan_counts_as_improvement(spark):
    """So does the loss after it: no comparison with NaN holds, and that loss is the best from then on."""
    nan = float("nan")
    rows = []
    for trial, losses in {1: [3.0, 4.0, 4.0, nan], 2: [3.0, nan, 4.0, 4.0, 4.0], 3: [nan, 1.0, 2.0], 4: [1.0, 2.0, 0.5]}.items():
        rows += [(trial, i, v) for i, v in enumerate(losses)]
    df = spark.createDataFrame(rows, "t int, s int, l double")
    for delta in (0.0, 0.25, -0.25):
        got = {r.trial_id: (r.stop_index, r.best_loss) for r in early_stop(df, "t", "s", "l", patience=2, delta=delta).collect()}
        # equal losses improve unless the delta asks for more
        assert got == {1: (2, 3.0), 2: (4 if delta > 0 else None, 4.0), 3: (None, 1.0), 4: (None, 0.5)}
