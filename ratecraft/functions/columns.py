"""Schema-level helpers (P1-P4, P11, P14): they inspect or rename, they do not scan."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, DoubleType, LongType, NumericType

from ratecraft.errors import MissingColumnsError, ValidationError

_WS = re.compile(r"\s+")


def normalize_name(name: str) -> str:
    """P1 rule: lower -> strip -> each whitespace run to '_' (' A  b ' -> 'a_b')."""
    return _WS.sub("_", name.lower().strip())


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename every column by :func:`normalize_name`; raise on a duplicate result."""
    names = [normalize_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, new in zip(df.columns, names):
        if new in seen:
            raise ValidationError(f"columns {seen[new]!r} and {old!r} both normalise to {new!r}")
        seen[new] = old
    return df.toDF(*names)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename; names not present are ignored."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def select_existing(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Keep the listed columns that exist, in the listed order; skip the rest."""
    cols = [c for c in names if c in df.columns]
    return df.select(*cols)


def drop_columns(df: DataFrame, names: Iterable[str], strict: bool = False) -> DataFrame:
    """Drop columns; with ``strict`` every name must exist."""
    names = list(names)
    if strict:
        missing = [c for c in names if c not in df.columns]
        if missing:
            raise MissingColumnsError(f"cannot drop absent columns: {missing}")
    return df.drop(*names)


_WIDE_NUMERIC = (LongType, DoubleType)


def columns_of_type(df: DataFrame, kinds: str = "number") -> list[str]:
    """Column names by type rule.

    ``'int64/float64'`` keeps BIGINT and DOUBLE only (INT and FLOAT excluded);
    ``'number'`` keeps every numeric type but not boolean; ``'category'``/``'string'``
    keeps text columns.
    """
    out = []
    for f in df.schema.fields:
        t = f.dataType
        if kinds == "int64/float64":
            ok = isinstance(t, _WIDE_NUMERIC)
        elif kinds == "number":
            ok = isinstance(t, NumericType) and not isinstance(t, BooleanType)
        elif kinds in ("category", "string", "object"):
            ok = t.typeName() == "string"
        else:
            raise ValueError(f"unknown type rule {kinds!r}")
        if ok:
            out.append(f.name)
    return out


def split_features_targets(df: DataFrame, targets: Iterable[str]) -> tuple[DataFrame, DataFrame]:
    """(features, targets) projections of the same frame."""
    targets = list(targets)
    missing = [t for t in targets if t not in df.columns]
    if missing:
        raise MissingColumnsError(f"target columns missing: {missing}")
    return df.drop(*targets), df.select(*targets)


__all__ = [
    "normalize_name", "normalize_columns", "rename", "select_existing", "drop_columns",
    "columns_of_type", "split_features_targets",
]
