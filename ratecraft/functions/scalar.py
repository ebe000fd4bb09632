"""Scalar column expressions.

All are compositions of built-in functions, so they stay inside whole-stage
codegen. ANSI mode is assumed on: text-to-number goes through ``try_cast`` and
division through ``try_divide`` so bad input becomes NULL instead of failing.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

# Token used for a missing category level (P12). pandas writes 'nan' for NaN and
# 'None' for None when casting to text; one token for both is kept here.
MISSING_LEVEL = "nan"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def recode(c, mapping: Mapping) -> Column:
    """P5: map values through a fixed dictionary; unmapped values become NULL."""
    if not mapping:
        return F.lit(None).cast("string")
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.try_element_at(m, _col(c))


def prefix(c, n: int) -> Column:
    """First ``n`` characters (5-char FIPS -> 2-char state)."""
    return F.substring(_col(c), 1, n)


def to_nullable_int(c, source_type: str = "string") -> Column:
    """Coerce to BIGINT, bad text to NULL; fractions truncate toward zero."""
    col = _col(c)
    if source_type == "string":
        # "Suppressed" and other non-numbers become NULL; "12.7" -> 12.
        as_long = col.try_cast("bigint")
        as_double = col.try_cast("double")
        return F.coalesce(as_long, truncate_int(as_double))
    return truncate_int(col)


def truncate_int(c) -> Column:
    """Double -> BIGINT truncating toward zero (1.7 -> 1, -1.7 -> -1); NULL, NaN and values
    beyond BIGINT give NULL."""
    col = _col(c)
    return F.when(~F.isnan(col), col.cast("double")).try_cast("bigint")


def rate_per(count, population, scale: float = 100000.0) -> Column:
    """Count / population * scale; NULL or zero population gives NULL.

    The order matters once the rate is truncated: the quotient is rounded before it is
    scaled (9 of 1000 is 899.99... per 100,000).
    """
    return F.try_divide(_col(count).cast("double"), _col(population).cast("double")) * F.lit(scale)


def null_as_category(c) -> Column:
    """Text of a category with a missing value as its own level."""
    col = _col(c)
    return F.coalesce(col.cast("string"), F.lit(MISSING_LEVEL))


def nan_to_null(c, dtype=None) -> Column:
    """NaN -> NULL for floating columns; other types pass through."""
    col = _col(c)
    if dtype is not None and not isinstance(dtype, (DoubleType, FloatType)):
        return col
    return F.when(~F.isnan(col), col)


def mask_below(c, threshold: float) -> Column:
    """Keep values with |x| >= threshold, others become NULL (not removed)."""
    col = _col(c)
    return F.when(F.abs(col) >= F.lit(threshold), col)


def round_sig(c, digits: int = 6) -> Column:
    """Round to ``digits`` significant digits (report presentation), half away from zero.

    Written with IEEE operations only (a multiply by exact powers of ten, +0.5,
    floor), so any engine evaluating the same expression on the same double gets
    the same result; no engine-specific ``round``. Magnitudes are first nudged up
    by a relative 1e-12, so a value sitting exactly on a half-way point (common for
    means over power-of-two counts) rounds the same way even when two engines'
    sums differ in the last bit.
    """
    x = _col(c).cast("double")
    ax = F.abs(x) * F.lit(1.0 + 1e-12)
    k = F.lit(float(digits - 1)) - F.floor(F.log10(F.abs(x)))
    up = F.floor(ax * F.pow(F.lit(10.0), k) + F.lit(0.5)) / F.pow(F.lit(10.0), k)
    down = F.floor(ax / F.pow(F.lit(10.0), -k) + F.lit(0.5)) * F.pow(F.lit(10.0), -k)
    mag = F.when(k >= 0, up).otherwise(down)
    return (F.when(x.isNull(), F.lit(None).cast("double"))
            .when(F.isnan(x) | (x == 0), x)
            .when(x < 0, -mag).otherwise(mag))
