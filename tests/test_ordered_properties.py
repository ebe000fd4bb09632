"""Property tests: distributed order statistics equal numpy/pandas on random data."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ratecraft.operators.ordered import exact_quantiles, ordered_scan

rows = st.lists(
    st.tuples(st.sampled_from([0, 0, 0, 1, 2]),                     # key 0 is hot
              st.one_of(st.none(), st.integers(-5, 5).map(float))),  # ties and NULLs
    min_size=1, max_size=60)
probs = st.lists(st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.75, 0.975, 1.0]), min_size=1,
                 max_size=3, unique=True)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows, ps=probs, limit=st.sampled_from([0, 10_000]), keyed=st.booleans())
def test_quantiles_match_numpy(spark, data, ps, limit, keyed):
    """limit 0 forces the range-partition strategy, 10,000 the histogram one."""
    if not keyed:
        data = [(0, v) for _, v in data]
    df = spark.createDataFrame(data, "k int, v double")
    out = exact_quantiles(df, "v", ps, keys=["k"] if keyed else [], histogram_limit=limit)
    got = {(r["k"] if keyed else 0, r["p"]): r["q"] for r in out.collect()}
    pdf = pd.DataFrame(data, columns=["k", "v"]).dropna()
    want = {(k, p): float(np.quantile(g["v"].to_numpy(), p)) for k, g in pdf.groupby("k") for p in ps}
    assert set(got) == set(want)
    for key, q in want.items():
        assert got[key] == pytest.approx(q, abs=1e-12)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows)
def test_running_max_matches_pandas(spark, data):
    with_pos = [(k, i, v) for i, (k, v) in enumerate(data)]
    df = spark.createDataFrame(with_pos, "k int, t int, v double")
    out = ordered_scan(df, ["k"], ["t"], index="i", running=[("max", "v", "m", True)]).toPandas()
    exp = pd.DataFrame(with_pos, columns=["k", "t", "v"]).sort_values(["k", "t"])
    exp["i"] = exp.groupby("k").cumcount()
    # SQL running max ignores NULLs and carries the best value forward
    exp["m"] = exp.groupby("k")["v"].transform(lambda s: s.cummax().ffill())
    m = exp.merge(out, on=["k", "t"], suffixes=("", "_s"))
    assert len(m) == len(data) and (m["i"] == m["i_s"]).all()
    same = (m["m"] == m["m_s"]) | (m["m"].isna() & m["m_s"].isna())
    assert same.all()


def _fold(losses, patience, delta=0.0, strict=False):
    """Direct statement of the patience rule (score = -loss)."""
    best, counter = None, 0
    for i, loss in enumerate(losses):
        score = -loss
        if best is None:
            best = score
        elif (score <= best + delta) if strict else (score < best + delta):
            counter += 1
            if counter >= patience:
                return i, -best
        else:
            best, counter = score, 0
    return None, (None if best is None else -best)


seqs = st.dictionaries(st.integers(0, 4),
                       st.lists(st.sampled_from([0.1, 0.2, 0.3, 0.4, 0.5]), min_size=1, max_size=25),
                       min_size=1, max_size=4)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(trials=seqs, patience=st.integers(1, 4), strict=st.booleans())
def test_early_stop_scan_equals_fold(spark, trials, patience, strict):
    from ratecraft.operators.trials import early_stop
    rows = [(t, i, v) for t, ls in trials.items() for i, v in enumerate(ls)]
    df = spark.createDataFrame(rows, "trial bigint, step bigint, loss double")
    for delta in (0.0, 0.15, -0.15):
        got = {r["trial_id"]: (r["stop_index"], r["best_loss"])
               for r in early_stop(df, "trial", "step", "loss", patience, delta, strict).collect()}
        for t, ls in trials.items():
            stop, best = _fold(ls, patience, delta, strict)
            assert got[t][0] == stop and got[t][1] == pytest.approx(best)
