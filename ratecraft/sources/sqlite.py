"""S3: read a SQLite table through the Python Data Source API.

The file is opened read-only on the executors (it must sit on storage they can reach). Options:
``database`` (file), ``table``, ``numPartitions`` (default 4). The schema is taken from the declared column
types unless given with ``.schema``. Comparisons, IN and NULL tests are evaluated inside SQLite when
``spark.sql.python.filterPushdown.enabled`` is on (the session defaults turn it on).

Tasks read disjoint key ranges:

* a table with row ids by ranges of them, through a name of the row id that no column of the table has. The ranges
  follow the rows: a range is cut to the least and greatest id in it before it is halved, so gaps are not read
  as work; each step looks up two ids in the index.
* a WITHOUT ROWID table by ranges of its primary key, at quantiles of one ordered scan of the key.
* anything else (a view, a virtual table, a table that takes all names of the row id) has no key to cut
  by: one task reads it with one cursor.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

FORMAT = "sqlite_table"
ROW_ID_NAMES = ("rowid", "_rowid_", "oid")
BATCH_ROWS = 8192

# the reader travels to executors by value: they need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _affinity(declared: str) -> str:
    """SQLite type affinity rules mapped to Spark types."""
    d = (declared or "").upper()
    if "INT" in d:
        return "bigint"
    if any(k in d for k in ("CHAR", "CLOB", "TEXT")):
        return "string"
    if any(k in d for k in ("REAL", "FLOA", "DOUB")):
        return "double"
    # dates, times and flags have numeric affinity by SQLite's rule, but are stored as text or 0/1
    if d == "" or "BLOB" in d or "DATE" in d or "TIME" in d:
        return "string"
    if "BOOL" in d:
        return "bigint"
    return "double"


_OPS = {"EqualTo": "=", "GreaterThan": ">", "GreaterThanOrEqual": ">=", "LessThan": "<",
        "LessThanOrEqual": "<="}


class SQLiteReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.database = options["database"]
        self.table = options["table"]
        self.parts = int(options.get("numPartitions", 4))
        self.schema = schema
        self.where: list = []   # (sql, params) pushed into every partition query
        self.pushed: list = []  # names of pushed filters (for tests and explain)

    def pushFilters(self, filters):
        """Evaluate comparisons, IN and NULL tests on top-level columns inside SQLite.

        Anything else (and anything on a nested path) is returned for Spark to apply.
        """
        names = {f.name for f in self.schema.fields}
        for f in filters:
            kind = type(f).__name__
            attr = getattr(f, "attribute", None)
            if not attr or len(attr) != 1 or attr[0] not in names:
                yield f
                continue
            col = _quoted(attr[0])
            if kind in _OPS and f.value is not None:
                self.where.append((f"{col} {_OPS[kind]} ?", (f.value,)))
            elif kind == "In" and f.value and all(v is not None for v in f.value):
                self.where.append((f"{col} IN ({', '.join('?' * len(f.value))})", tuple(f.value)))
            elif kind == "IsNull":
                self.where.append((f"{col} IS NULL", ()))
            elif kind == "IsNotNull":
                self.where.append((f"{col} IS NOT NULL", ()))
            else:
                yield f
                continue
            self.pushed.append(kind)

    def _connect(self):
        import sqlite3
        return sqlite3.connect(f"file:{self.database}?mode=ro", uri=True)

    def _key(self, con) -> list:
        """SQL names of the columns that the table is read by, [] when there are none."""
        found = con.execute("SELECT type FROM sqlite_master WHERE name = ? COLLATE NOCASE", (self.table,)).fetchone()
        if not found or found[0] != "table":
            return []
        info = con.execute(f"PRAGMA table_info({_quoted(self.table)})").fetchall()
        taken = {r[1].lower() for r in info}
        free = [n for n in ROW_ID_NAMES if n not in taken]
        if not free:
            return []
        try:
            con.execute(f"SELECT {free[0]} FROM {_quoted(self.table)} LIMIT 0")
            return [free[0]]
        except Exception:  # a WITHOUT ROWID table
            return [_quoted(r[1]) for r in sorted((r for r in info if r[5]), key=lambda r: r[5])]

    def partitions(self):
        """(key, from, to): rows with from <= key <= to for row ids, from <= key < to for other keys; None is open."""
        con = self._connect()
        try:
            key = self._key(con)
            if not key or self.parts < 2:
                return [InputPartition((key, None, None))]
            if key[0] in ROW_ID_NAMES:
                return [InputPartition((key, a, b)) for a, b in self._id_ranges(con, key[0])] or [InputPartition((key, None, None))]
            names = ", ".join(key)
            rows = con.execute(f"SELECT count(*) FROM {_quoted(self.table)}").fetchone()[0]
            step = max(1, -(-rows // self.parts))
            cuts = con.execute(f"SELECT {names} FROM (SELECT {names}, row_number() OVER (ORDER BY {names}) AS place FROM {_quoted(self.table)}) "
                               f"WHERE place > 1 AND (place - 1) % {step} = 0 ORDER BY {names}").fetchall()
            edges = [None, *cuts, None]
            return [InputPartition((key, a, b)) for a, b in zip(edges, edges[1:])]
        finally:
            con.close()

    def _id_ranges(self, con, key: str) -> list:
        """At most ``parts`` ranges of row ids, the widest halved first, each as tight as its rows."""
        def tight(lo, hi):
            found = con.execute(f"SELECT min({key}), max({key}) FROM {_quoted(self.table)} WHERE {key} BETWEEN ? AND ?", (lo, hi)).fetchone()
            return [] if found[0] is None else [found]

        ranges = tight(-2 ** 63, 2 ** 63 - 1)
        while ranges and len(ranges) < self.parts:
            widest = max(ranges, key=lambda r: r[1] - r[0])
            if widest[0] == widest[1]:
                break
            ranges.remove(widest)
            middle = (widest[0] + widest[1]) // 2
            ranges += tight(widest[0], middle) + tight(middle + 1, widest[1])
        return sorted(ranges)

    def read(self, partition):
        key, lo, hi = partition.value
        terms, params = [w for w, _ in self.where], [x for _, p in self.where for x in p]
        if key and key[0] in ROW_ID_NAMES and lo is not None:
            terms.append(f"{key[0]} BETWEEN ? AND ?")
            params += [lo, hi]
        elif key:
            row, marks = f"({', '.join(key)})", f"({', '.join('?' * len(key))})"
            for sign, edge in ((">=", lo), ("<", hi)):
                if edge is not None:
                    terms.append(f"{row} {sign} {marks}")
                    params += edge
        cols = ", ".join(_quoted(f.name) for f in self.schema.fields) or "NULL"
        con = self._connect()
        try:
            cur = con.execute(f"SELECT {cols} FROM {_quoted(self.table)}" + (" WHERE " + " AND ".join(terms) if terms else ""), params)
            kinds = [f.dataType.typeName() for f in self.schema.fields]
            if kinds and set(kinds) <= set(_ARROW):
                yield from self._batches(cur, kinds)
            else:
                yield from map(tuple, cur)
        finally:
            con.close()

    def _batches(self, cur, kinds):
        import pyarrow as pa
        names = [f.name for f in self.schema.fields]
        while rows := cur.fetchmany(BATCH_ROWS):
            yield pa.RecordBatch.from_arrays([pa.array([_ARROW[k](v) for v in c], k if k != "long" else "int64")
                                              for k, c in zip(kinds, zip(*rows))], names=names)


def _text(v):
    return v if v is None or isinstance(v, str) else v.decode() if isinstance(v, bytes) else str(v)


def _whole(v):
    return int(v) if isinstance(v, float) and v.is_integer() else v


# values of the Spark types that Arrow batches are made of; SQLite columns may hold others than declared
_ARROW = {"string": _text, "long": _whole, "double": lambda v: float(v) if isinstance(v, int) else v}


class SQLiteDataSource(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        import sqlite3
        con = sqlite3.connect(f"file:{self.options['database']}?mode=ro", uri=True)
        try:
            info = con.execute(f"PRAGMA table_info({_quoted(self.options['table'])})").fetchall()
        finally:
            con.close()
        if not info:
            raise ValueError(f"table {self.options['table']!r} not found")
        return ", ".join(f"`{r[1].replace('`', '``')}` {_affinity(r[2])}" for r in info)

    def reader(self, schema: StructType):
        return SQLiteReader(self.options, schema)


def scan_sqlite_table(spark: SparkSession, database: str, table: str, num_partitions: int = 4,
                      schema: StructType | str | None = None) -> DataFrame:
    """S3: ``SELECT *`` of one SQLite table as a DataFrame."""
    spark.dataSource.register(SQLiteDataSource)
    reader = spark.read.format(FORMAT).option("database", database).option("table", table) \
        .option("numPartitions", str(num_partitions))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load()
