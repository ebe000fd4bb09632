"""The corpus pipeline: quality, line de-duplication, near duplicates, decontamination, tokens.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a frame that
is written as Parquet and read again as the next stage's ``docs``. All but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft.llm import bayes_quality, decontaminate, line_dedup, pair_bpe, simhash
from ratecraft.llm.common import materialise, spare_names
from ratecraft.llm.queries import BYTE_BPE


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier (operator 4) rejects go; its labels are the table's."""
    return bayes_quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go (operator 9), and with them documents of nothing but repeated lines; n_chars
    follows the text. Documents without a line to remove stay as they are."""
    [removed] = spare_names(docs, "lines_removed")
    out = line_dedup.dedup_lines(docs, removed=removed)
    changed = F.col(removed) > 0
    out = out.where(~changed | F.col("text").rlike(line_dedup.HAS_WORD))
    return out.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)) \
        .select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays (operator 7): the one with the smallest id."""
    return simhash.keep_one_per_group(docs, simhash.near_duplicate_groups(docs)).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, also with other numbers or names, go (operator 2)."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded text (operator 6)."""
    return pair_bpe.round_trip_digests(docs, BYTE_BPE)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("BPE encoding and decoding", tokens),
]

ORACLE_SQL = None  # a fitted classifier decides first: SQL cannot express that


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for no, (_, stage) in enumerate(STAGES):
        docs = materialise(stage(spark, docs, sf_dir), f"stage{no}")
    return docs
