"""File readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ratecraft.errors import AssetLoadError


def scan_parquet(spark: SparkSession, path: str | Sequence[str],
                 schema: StructType | str | None = None) -> DataFrame:
    """Parquet scan; filters and projections are pushed into the reader by Catalyst."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    paths = [path] if isinstance(path, str) else list(path)
    return reader.parquet(*paths)


def scan_json_records(spark: SparkSession, path: str, schema: StructType | str | None = None,
                      multiline: bool = True) -> DataFrame:
    """A file holding one JSON array of flat records (or JSON lines with multiline=False).

    Give an explicit schema on large inputs: inference is an extra pass.
    """
    reader = spark.read.option("multiLine", multiline)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def column_from_filename(pattern: str = r"_([^_]+)\.[^.]+$", group: int = 1) -> F.Column:
    """A value taken from the source file name (last '_' token without suffix)."""
    return F.regexp_extract(F.col("_metadata.file_name"), pattern, group)


def _line_mode_lines(spark: SparkSession, paths: list, separator: str,
                     file_pattern: str) -> DataFrame:
    """Body lines (after the header, before the first separator line) of every file,
    read line by line: no file has to fit in one row or one task.

    A line's place in its file is (split start offset, position in the scan); the
    header and the first separator line of each file come from one small
    aggregation (one row per file) joined back on the file path.
    """
    raw = spark.read.text(paths).select(
        F.col("value").alias("_line"), F.col("_metadata.file_path").alias("_path"),
        column_from_filename(file_pattern).alias("_file"),
        F.struct(F.col("_metadata.file_block_start").alias("b"),
                 F.monotonically_increasing_id().alias("i")).alias("_at"))
    is_sep = F.instr(F.col("_line"), separator) > 0
    bounds = raw.groupBy(F.col("_path").alias("_bp")).agg(
        F.min("_at").alias("_head"), F.min(F.when(is_sep, F.col("_at"))).alias("_sep"))
    kept = raw.join(bounds, raw["_path"] == bounds["_bp"], "inner").where(
        (F.col("_at") > F.col("_head")) & (F.col("_sep").isNull() | (F.col("_at") <= F.col("_sep"))))
    # a separator may follow text on the same line: keep the text before it
    return kept.select("_file", F.substring_index(F.col("_line"), separator, 1).alias("_line"))


def scan_sectioned_tsv(spark: SparkSession, paths: str | Sequence[str], schema: StructType | str,
                       separator: str = '"---"', drop: Sequence[str] = ("Notes",),
                       file_column: str | None = None,
                       file_pattern: str = r"_([^_]+)\.[^.]+$", whole_file: bool = False) -> DataFrame:
    """Tab-separated tables followed by a notes section after ``separator``.

    The text before the first separator is kept, the header line skipped and each
    line parsed with ``from_csv`` under an explicit schema (codes typed STRING keep
    leading zeros). Default: line by line over file splits (any file size).
    ``whole_file=True`` reads each file as one row instead (a file must fit a row).
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not paths:
        raise AssetLoadError("no input files")
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    if not whole_file:
        lines = _line_mode_lines(spark, paths, separator, file_pattern)
        lines = lines.where(F.length(F.trim(F.regexp_replace("_line", "\r$", ""))) > 0)
        parsed = lines.select("_file", F.from_csv(F.regexp_replace("_line", "\r$", ""), ddl,
                                                   {"sep": "\t", "quote": '"'}).alias("_r"))
        out = parsed.select("_r.*", "_file")
        out = out.withColumnRenamed("_file", file_column) if file_column else out.drop("_file")
        return out.drop(*[d for d in drop if d in out.columns])
    raw = spark.read.text(paths, wholetext=True)
    body = F.substring_index(F.col("value"), separator, 1)
    lines = raw.select(
        column_from_filename(file_pattern).alias("_file") if file_column else F.lit(None).alias("_file"),
        F.posexplode(F.split(F.regexp_replace(body, "\r\n", "\n"), "\n")).alias("_ln", "_line"))
    lines = lines.where((F.col("_ln") > 0) & (F.length(F.trim("_line")) > 0))
    parsed = lines.select("_file", F.from_csv("_line", ddl, {"sep": "\t", "quote": '"'}).alias("_r"))
    out = parsed.select("_r.*", "_file")
    if file_column:
        out = out.withColumnRenamed("_file", file_column)
    else:
        out = out.drop("_file")
    return out.drop(*[d for d in drop if d in out.columns])
