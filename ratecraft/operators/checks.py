"""Data checks (V1-V4). Each check is a schema inspection or a bounded probe job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ratecraft.errors import EmptyFrameError, MissingColumnsError, ValidationError
from ratecraft.operators.features import FeatureSpec
from ratecraft.operators.joins import assert_unique


def require_rows(df: DataFrame) -> None:
    """V3: raise on an empty frame (reads at most one row)."""
    if df.isEmpty():
        raise EmptyFrameError("frame has no rows")


def require_columns(df: DataFrame, spec: FeatureSpec) -> None:
    """V2: numeric and categorical gaps are named separately, before any job."""
    num = [c for c in spec.num if c not in df.columns]
    cat = [c for c in spec.cat if c not in df.columns]
    if num or cat:
        raise MissingColumnsError(f"missing numeric columns: {num}; missing categorical columns: {cat}")


def validate_frame(df: DataFrame, targets: Sequence[str]) -> None:
    """V1: empty frame, missing target, duplicate target, no feature left."""
    targets = list(targets)
    if len(set(targets)) != len(targets):
        raise ValidationError(f"duplicate target names: {targets}")
    missing = [t for t in targets if t not in df.columns]
    if missing:
        raise MissingColumnsError(f"target columns missing: {missing}")
    if not [c for c in df.columns if c not in targets]:
        raise ValidationError("no feature column left after removing the targets")
    require_rows(df)


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """V4: same as J4."""
    assert_unique(df, keys)
