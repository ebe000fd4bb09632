"""URL allow and block rules by a sort-merge range join (operator 10).

A host is turned round label by label and closed with a dot ("blog.example.net" becomes
"net.example.blog."), so a host and all its subdomains are one interval of keys:
["net.example.", "net.example/"), "/" being the character after ".". Urls are range-partitioned by
(key, path, row) and checkpointed; each rule goes to the partitions whose key range its interval
meets. Within a partition urls and rules are merged in key order by one sweep that keeps a stack
of the rules whose interval is open; hosts nest, so intervals do too. A url takes the longest rule
of the stack whose path starts the url's path, else the default verdict.

A hot host, even a hot url, is cut over many partitions, since the row's id is part of the range
key; the sweep streams and holds only the open rules. No side is broadcast, so neither the rules
nor the urls are bounded in number.

Defined cases: a null url or one without "://" has an empty host and path. A null row id sorts
first. Ties between rules of one length go to the longer host, then to the rule that sorts first
by (host, path, verdict), so "allow" before "block". An empty rules host fits every url. Repeated
urls and ids are judged row by row. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratecraft.session import cut_lineage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULE_SCHEMA = "host string, path string, verdict string"
OUT = "row_id long, host string, path string, rule string, verdict string"


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first "://" to "/", "?" or "#"; then to "?" or "#"."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, F.lit("://")) + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def reversed_host(host: Column) -> Column:
    """The canonical key: labels in reverse order, each closed with a dot; "" stays ""."""
    return F.when(host == "", "").otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit(".")))


def judge_urls(urls: DataFrame, rules: DataFrame, default: str = "allow",
               row_id: str = "page_id", url: str = "url") -> DataFrame:
    """One row per url: row_id, host, path, rule (host and path of the rule, or null), verdict."""
    host, path = url_parts(F.col(url))
    u = urls.select(F.col(row_id).cast("long").alias("row_id"), host.alias("host"), path.alias("path")) \
        .withColumn("key", reversed_host(F.col("host")))
    parts = int(urls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    u = cut_lineage(u.repartitionByRange(parts, "key", "path", "row_id").withColumn("part", F.spark_partition_id()))

    ranges = u.groupBy("part").agg(F.min("key").alias("lo"), F.max("key").alias("hi"))
    r = rules.select(F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER).alias("host"),
                     F.coalesce("path", F.lit("")).alias("path"), "verdict") \
        .withColumn("key", reversed_host(F.col("host")))
    r = _to_partitions(r, ranges) if not u.isEmpty() else r.limit(0).withColumn("part", F.lit(0))

    one = u.select("part", "key", F.lit(1).alias("kind"), "row_id", "host", "path", F.lit(None).cast("string").alias("verdict"))
    two = r.select("part", "key", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("row_id"), "host", "path", "verdict")
    merged = one.unionByName(two).repartition(parts, "part") \
        .sortWithinPartitions("part", "key", "kind", "path", "row_id")
    return merged.mapInArrow(lambda batches: _sweep(batches, default), OUT)


def _to_partitions(rules: DataFrame, ranges: DataFrame) -> DataFrame:
    """Each rule once for each url partition whose [lo, hi] meets the rule's interval.

    The partitions lie in key order, so the ones a rule meets are a run of neighbours. ``ranges``
    has a row per partition, as many as the shuffle partitions set for the session, so the driver
    can hold them and they travel as one array.
    """
    bounds = F.array(*[F.struct(F.lit(r["part"]).alias("part"), F.lit(r["lo"]).alias("lo"), F.lit(r["hi"]).alias("hi"))
                       for r in ranges.collect()])
    end = F.when(F.col("key") != "", F.concat(F.expr("left(key, length(key) - 1)"), F.lit("/")))
    met = F.filter(bounds, lambda b: (b["hi"] >= F.col("key")) & (F.col("end").isNull() | (b["lo"] < F.col("end"))))
    return rules.withColumn("end", end) \
        .select("host", "path", "verdict", "key", F.explode(F.transform(met, lambda b: b["part"])).alias("part"))


def _sweep(batches: Iterable[pa.RecordBatch], default: str) -> Iterator[pa.RecordBatch]:
    """Merge of one task's rows in (part, key, rules before urls) order."""
    part, stack = None, []  # stack: (key of the rule, [(path, rule, verdict), ...]), outermost first
    for batch in batches:
        d = batch.to_pydict()
        out: tuple[list, ...] = ([], [], [], [], [])
        for p, key, kind, row, host, path, verdict in zip(*(d[c] for c in ("part", "key", "kind", "row_id", "host", "path", "verdict"))):
            if p != part:
                part, stack = p, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if kind == 0:
                if not stack or stack[-1][0] != key:
                    stack.append((key, []))
                stack[-1][1].append((path, host + path, host, verdict))
                continue
            best = None
            for _, rules in stack:
                for rule_path, name, rule_host, verdict_ in rules:
                    if path.startswith(rule_path):
                        rank = (-len(name), -len(rule_host), rule_host, rule_path, verdict_ or "")
                        if best is None or rank < best[0]:
                            best = rank, name, verdict_
            for column, value in zip(out, (row, host, path, best and best[1], best[2] if best else default)):
                column.append(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.int64()), *(pa.array(c, pa.string()) for c in out[1:])],
            names=["row_id", "host", "path", "rule", "verdict"])


def rules_frame(spark, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """A rules table from (verdict, host, path) triples."""
    return spark.createDataFrame([(h, p, v) for v, h, p in rules], RULE_SCHEMA)
