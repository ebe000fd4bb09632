"""Column expressions (scalar work, all JVM-side built-ins) and schema helpers."""

from ratecraft.functions.scalar import (
    mask_below, nan_to_null, null_as_category, prefix, rate_per, recode, to_nullable_int,
    truncate_int,
)
from ratecraft.functions.columns import (
    columns_of_type, drop_columns, normalize_columns, normalize_name, rename, select_existing,
    split_features_targets,
)

__all__ = [
    "mask_below", "nan_to_null", "null_as_category", "prefix", "rate_per", "recode",
    "to_nullable_int", "truncate_int", "columns_of_type", "drop_columns", "normalize_columns",
    "normalize_name", "rename", "select_existing", "split_features_targets",
]
