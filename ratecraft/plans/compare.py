"""Order-insensitive result comparison used by the oracle tool and tests."""

from __future__ import annotations

import hashlib
import math
import os

# RATECRAFT_EXACT_FLOATS=1 hashes the exact repr of every double (no tolerance)
_EXACT = os.environ.get("RATECRAFT_EXACT_FLOATS") == "1"

from ratecraft.plans.tables import TABLES


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v) if _EXACT else repr(round(v, 9))
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def digest(columns, rows):
    """(md5, sorted lines) of rows with columns taken in name order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.md5("\n".join(lines).encode()).hexdigest(), lines


def duck_connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


# DuckDB result type -> Spark simple type name, for schema comparison
DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
                 "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz",
                 "FLOAT": "float", "SMALLINT": "smallint", "TINYINT": "tinyint"}


def type_diff(spark_df, duck_rel) -> dict:
    """{column: (spark type, duckdb type)} for columns whose types differ."""
    st = {f.name: f.dataType.simpleString() for f in spark_df.schema.fields}
    dt = {n: DUCK_TO_SPARK.get(str(t), str(t)) for n, t in zip(duck_rel.columns, duck_rel.types)}
    return {c: (st.get(c), dt.get(c)) for c in set(st) | set(dt) if st.get(c) != dt.get(c)}
