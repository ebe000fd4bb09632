"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft.llm import (
    ball_search, bayes_quality, chat_format, chat_repair, decontaminate, fertility, fst_tokens, line_dedup, nnls_packing, pair_bpe, simhash,
    url_rules, warc,
)
from ratecraft.llm.common import TOKENIZER_DIR, scratch_path
from ratecraft.llm.oracle import SQL as SQL  # registered with the queries

BYTE_BPE = os.path.join(TOKENIZER_DIR, "byte_bpe_50k.json")
PIECE_BPE = os.path.join(TOKENIZER_DIR, "piece_bpe_32k.model")
WORD_BPE = os.path.join(TOKENIZER_DIR, "word_bpe_49k.json")

URL_RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"),
             ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archive(_table(spark, sf_dir, "pages"), path)
    payload = warc.payload_of(F.col("record"))
    return warc.original_record(warc.read_archive(spark, path)).select(
        F.col("key").alias("page_id"), F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha2(payload, 256).alias("payload_digest"), F.col("type").alias("record_type"), "refers_to")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.withColumn("contaminated", F.lit(True))


def op3_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.judge(_table(spark, sf_dir, "documents"), PIECE_BPE)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = bayes_quality.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return judged.drop("text_hash")


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    talks = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    examples = chat_format.expand_prefix_targets(talks)
    trained = chat_format.trained_text(F.col("text"), F.col("loss_start"), F.col("loss_end"))
    read = examples.groupBy("conv_id").agg(
        F.max(F.struct("example", "text")).alias("longest"),
        F.array_sort(F.collect_list(F.struct("example", trained.alias("trained")))).alias("parts"),
        F.sum(F.length("text").cast("long")).alias("formatted_chars"))
    turns = chat_format.read_turns(F.col("longest.text"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform("parts", lambda p: p["trained"]), "")
    return read.withColumn("turns", turns).withColumn("loss", loss).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.encode(said, "UTF-8"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.encode("loss", "UTF-8"), 256).alias("loss_sha256"),
        "formatted_chars")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_bpe.round_trip_digests(_table(spark, sf_dir, "documents"), BYTE_BPE)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicate_groups(_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", simhash.hex16(F.col("bits")).alias("fingerprint"), "component_id", "n_links")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fst_tokens.token_counts(_table(spark, sf_dir, "documents"), WORD_BPE)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, removed="lines_removed")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = url_rules.rules_frame(spark, URL_RULES)
    return url_rules.judge_urls(_table(spark, sf_dir, "pages"), rules) \
        .select(F.col("row_id").alias("page_id"), "host", "path", "rule", "verdict")


def op11_ball_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = nnls_packing.pack(_table(spark, sf_dir, "documents"), BYTE_BPE)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op13_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_repair.repair(chat_repair.damage(_table(spark, sf_dir, "conversations")), names_only="dropped")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_decontaminate": op2_decontaminate,
    "op3_fertility": op3_fertility,
    "op4_quality": op4_quality,
    "op5_chat_format": op5_chat_format,
    "op6_bpe": op6_bpe,
    "op7_simhash": op7_simhash,
    "op8_token_counts": op8_token_counts,
    "op9_line_dedup": op9_line_dedup,
    "op10_url_filter": op10_url_filter,
    "op11_ball_search": op11_ball_search,
    "op12_packing": op12_packing,
    "op13_chat_repair": op13_chat_repair,
}
