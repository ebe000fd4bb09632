"""Joins (J1-J6).

Physical strategy is left to Catalyst and AQE. A side is broadcast explicitly only
when the caller states a row bound and a probe of ``limit(n+1)`` rows proves it and
a bound on their bytes; otherwise AQE measures the materialised side at runtime and converts
to a broadcast join only under ``spark.sql.adaptive.autoBroadcastJoinThreshold``.
AQE's skew-join split handles a hot key on the large side.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecraft.errors import DuplicateKeyError, MissingColumnsError


BROADCAST_BYTES = 32 << 20


def fits(df: DataFrame, max_rows: int, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and, written as JSON, ``max_bytes`` bytes. Reads at most
    max_rows + 1 rows."""
    size = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    rows, used = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return rows <= max_rows and used <= max_bytes


def duplicate_keys(right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key groups that occur more than once (the J4 report), with their row count ``n``."""
    return (right.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def assert_unique(right: DataFrame, keys: Sequence[str]) -> None:
    """Raise before a many-to-one join when the right side repeats a key.

    One aggregation with partial (map-side) combine; only one offending group is
    brought back to name it.
    """
    missing = [k for k in keys if k not in right.columns]
    if missing:
        raise MissingColumnsError(f"join keys missing on right side: {missing}")
    hit = duplicate_keys(right, keys).limit(1).collect()
    if hit:
        row = hit[0].asDict()
        raise DuplicateKeyError(
            f"right side is not unique on {list(keys)}: {row} (validate='many_to_one')")


def left_join(left: DataFrame, right: DataFrame, keys: Sequence[str], *,
              null_safe: bool = True, validate: str | None = None,
              broadcast_max_rows: int | None = None, how: str = "left") -> DataFrame:
    """Equi-join on shared key names, all left rows kept.

    ``null_safe`` matches a NULL key with a NULL key (the pandas merge rule) via
    ``<=>``, which still plans as a hash join. ``validate='many_to_one'`` runs J4
    first. Key columns appear once, taken from the left side.
    """
    keys = list(keys)
    for side, df in (("left", left), ("right", right)):
        missing = [k for k in keys if k not in df.columns]
        if missing:
            raise MissingColumnsError(f"join keys missing on {side} side: {missing}")
    if validate == "many_to_one":
        assert_unique(right, keys)
    elif validate not in (None, "many_to_many"):
        raise ValueError(f"unsupported validate={validate!r}")
    if not null_safe:
        r = right
        if broadcast_max_rows is not None and fits(right, broadcast_max_rows):
            r = F.broadcast(right)
        return left.join(r, on=keys, how=how)
    tag = "__r_"
    r = right.select(*[F.col(c).alias(tag + c) if c in keys else F.col(c) for c in right.columns])
    if broadcast_max_rows is not None and fits(right, broadcast_max_rows):
        r = F.broadcast(r)
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(r[tag + k]) for k in keys])
    out = left.join(r, cond, how)
    return out.drop(*[tag + k for k in keys])


def remaining_trials(grid: DataFrame, done: DataFrame, key: str = "trial_id") -> DataFrame:
    """Trials of ``grid`` not yet completed in ``done`` (anti join, resumes a search).

    With a ``state`` column only COMPLETE trials count: failed and pruned ones are run again.
    """
    if "state" in done.columns:
        done = done.where(F.col("state") == "COMPLETE")
    return grid.join(done.select(key), on=key, how="left_anti")
