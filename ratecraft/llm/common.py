"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratecraft.session import cut_lineage, ensure_checkpoint_dir

TOKENIZER_DIR = "/opt/tokenizers"  # default of the tokenizer path parameters


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def spare_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as make it new to ``df`` (in any case of letters)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the session's checkpoint folder and read it again.

    For a frame that several later steps read: it is computed once, and what is read again
    lies in shared storage, so a lost executor costs no recomputation of the steps before.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def smallest_reachable(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node that each node of ``links`` (a, b) reaches.

    Alternates the large-star and small-star steps until the links no longer change; each round
    halves the depth of the trees, so the rounds grow with the logarithm of the longest chain.
    A node's smallest neighbour is a partial aggregate joined back, so no node's neighbours are
    ever gathered in one task. Every round is checkpointed. Nodes without links are not returned.
    """
    def stars(edges: DataFrame, large: bool) -> DataFrame:
        """edges (a, b) with a as centre: links each chosen neighbour to the smallest one."""
        least = edges.groupBy("a").agg(F.min("b").alias("least")) \
            .select("a", F.least("a", "least").alias("least"))
        out = edges.join(least, "a")
        if large:
            out = out.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
        else:
            out = out.select(F.col("b").alias("a"), F.col("least").alias("b")) \
                .union(least.select(F.col("a"), F.col("least").alias("b")))
        return out.where(F.col("a") != F.col("b")).distinct()

    def mark(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = cut_lineage(links.select("a", "b").where(F.col("a") != F.col("b"))
                        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = mark(edges)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        edges = cut_lineage(stars(stars(both, True), False))
        now = mark(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")) \
        .union(edges.select(F.col("b"), F.col("b"))).distinct()


def scratch_path(spark, name: str) -> str:
    """A fresh folder below the session's checkpoint folder, which all executors share."""
    return f"{ensure_checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}/{name}"
