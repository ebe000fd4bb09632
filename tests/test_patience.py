"""Chunk summaries of the patience rule against the rule itself."""

import math
import random

import numpy as np
import pytest

from ratecraft.operators.patience import Chunk, State
from ratecraft.operators.trials import early_stop


def _rule(losses, patience, strict, delta=0.0):
    best, counter = None, 0
    for i, loss in enumerate(losses):
        score = -loss
        if best is None or (score > best if strict else not score < best + delta):
            best, counter = score, 0
        else:
            counter += 1
            if counter >= patience:
                return i, -best
    return None, -best


def _composed(losses, patience, strict, cuts, steps):
    state = State()
    for a, b in zip([0, *cuts], [*cuts, len(losses)]):
        chunk = Chunk()
        for at in range(a, b, steps):
            chunk.add(-np.array(losses[at:min(at + steps, b)], float), patience, strict)
        chunk.close(patience)
        state.follow(chunk, patience, strict)
    return state.stop, -state.best


@pytest.mark.parametrize("strict", [False, True])
def test_any_chunks_compose_to_the_rule(strict):
    rng = random.Random(5)
    for _ in range(6000):
        n, patience = rng.randint(1, 30), rng.randint(1, 6)
        losses = [float(rng.randint(0, rng.choice([2, 9, 40]))) - (i * 0.2 if rng.random() < 0.5 else 0) for i in range(n)]
        if not strict and rng.random() < 0.2:
            losses[rng.randrange(n)] = rng.choice([math.nan, math.inf, -math.inf])
        cuts = sorted(rng.sample(range(1, n), min(n - 1, rng.randint(0, 5))))
        got, want = _composed(losses, patience, strict, cuts, rng.randint(1, 7)), _rule(losses, patience, strict)
        assert got[0] == want[0] and (got[1] == want[1] or math.isnan(got[1]) and math.isnan(want[1]))


def test_summaries_are_bounded_by_the_patience():
    chunk = Chunk()
    chunk.add(np.repeat(np.arange(1000.0), 10), 3, True)  # a gap at every record
    chunk.close(3)
    assert len(chunk.head) <= 3 and len(chunk.gaps) == 2 and chunk.rows == 10_000


@pytest.mark.parametrize("strict", [False, True])
def test_trials_over_many_partitions(spark, strict):
    rng = random.Random(8)
    trials = {t: [rng.choice([1.0, 2.0, 3.0]) - 0.01 * i * (t % 3) for i in range(rng.randint(1, 60))] for t in range(40)}
    trials[None] = [5.0 - 0.001 * i for i in range(900)] + [9.0] * 4  # a hot trial, without an id
    if not strict:
        trials[77] = [1.0, math.nan, 5.0, 5.0, 5.0, 5.0]
        trials[78] = [1.0, 2.0, 2.0, 2.0, math.nan]
        trials[79] = [math.nan]
    rows = [(t, i, v) for t, losses in trials.items() for i, v in enumerate(losses)] + [(3, 1000, None)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "trial long, step long, loss double")
    got = {r.trial_id: (r.stop_index, r.best_loss) for r in early_stop(df, "trial", "step", "loss", patience=3, strict=strict).collect()}
    assert set(got) == set(trials)
    for t, losses in trials.items():
        want = _rule(losses, 3, strict)
        assert got[t][0] == want[0] and (got[t][1] == want[1] or math.isnan(want[1]) and math.isnan(got[t][1]))


@pytest.mark.parametrize("delta", [0.0, 0.5, -0.5])
def test_nan_losses_in_many_trials(spark, delta):
    rng = random.Random(3)
    trials = {t: [rng.choice([1.0, 1.25, 2.0, 3.0, math.nan]) for _ in range(rng.randint(1, 25))] for t in range(40)}
    trials[None] = [3.0, math.nan, 9.0, 9.0, 9.0, 9.0]
    rows = [(t, i, v) for t, losses in trials.items() for i, v in enumerate(losses)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "trial long, step long, loss double")
    got = {r.trial_id: (r.stop_index, r.best_loss) for r in early_stop(df, "trial", "step", "loss", patience=3, delta=delta).collect()}
    assert set(got) == set(trials)
    for t, losses in trials.items():
        want = _rule(losses, 3, False, delta)
        assert got[t][0] == want[0] and (got[t][1] == want[1] or math.isnan(want[1]) and math.isnan(got[t][1]))
