"""Skew-safe ordered work inside groups: row index and running min/max (quantiles: ``quantiles.py``).

A window ``PARTITION BY key ORDER BY ...`` sends a whole group to one task; if one
key holds a third of the rows, one task does a third of the work. Here a group is
instead split across range partitions of ``(key, order[, salt])``:

1. range-partition and sort, then tag each row with its partition id and position
   and cut lineage (reliable checkpoint: the tags stay fixed on recompute);
2. per (partition, key) chunk: row count, first position, chunk min/max
   (a small table: at most #partitions + #keys rows);
3. an exclusive prefix over the chunks of each key (a window over that small table)
   gives every chunk its row offset and the carried-in running min/max;
4. join back; inside a chunk a window over (partition, key) finishes the scan.
   A chunk is at most one range partition, so no task sees more than its share.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratecraft.operators.quantiles import exact_quantiles, quantile_values
from ratecraft.session import cut_lineage

__all__ = ["chunk", "partitions_of", "ordered_scan", "exact_quantiles", "quantile_values"]

_AGG = {"max": (F.max, F.greatest), "min": (F.min, F.least)}


def partitions_of(df: DataFrame) -> int:
    """Range partitions for an ordered scan: the session's shuffle partitions. The plan is not
    asked for its own, since that would execute its shuffles just to count them."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8")))


def chunk(df: DataFrame, keys: Sequence[str], order: Sequence[str], *, salt: bool = False,
          num_partitions: int | None = None) -> DataFrame:
    """Step 1: range-partition by (keys, order[, salt]), sort, tag ``_pid``/``_pos``,
    and write a reliable checkpoint. Returns the checkpointed frame."""
    n = num_partitions or partitions_of(df)
    sort_cols = list(keys) + list(order)
    work = df
    if salt:
        work = work.withColumn("_salt", F.rand(seed=20240101))
        sort_cols = sort_cols + ["_salt"]
    # The range bounds are sampled by one job and the shuffle is written by another;
    # keeping the input cached between them evaluates the upstream plan once.
    work = work.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        chunked = (work.repartitionByRange(n, *sort_cols)
                   .sortWithinPartitions(*sort_cols)
                   .withColumn("_pid", F.spark_partition_id())
                   .withColumn("_pos", F.monotonically_increasing_id()))
        return cut_lineage(chunked)
    finally:
        work.unpersist()


def ordered_scan(df: DataFrame, keys: Sequence[str], order: Sequence[str], *,
                 index: str | None = "_idx",
                 running: Sequence[tuple[str, str, str, bool]] = (),
                 salt: bool = False, num_partitions: int | None = None) -> DataFrame:
    """Add a 0-based row index within each key group and running aggregates.

    ``running`` items are ``(how, column, out_name, inclusive)`` with how in
    {'max', 'min'}; ``inclusive=False`` aggregates over the rows strictly before.
    ``salt`` adds a seeded random tie-breaker so equal order values of a hot key
    still spread over partitions (use when ``order`` is not unique in a group).
    """
    keys, order = list(keys), list(order)
    chunked = chunk(df, keys, order, salt=salt, num_partitions=num_partitions)

    stat_aggs = [F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_p0")]
    for i, (how, col, _out, _inc) in enumerate(running):
        stat_aggs.append(_AGG[how][0](col).alias(f"_c{i}"))
    stats = chunked.groupBy("_pid", *keys).agg(*stat_aggs)
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    carried = [F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"), "_pid", "_p0", *keys]
    for i, (how, _col, _out, _inc) in enumerate(running):
        carried.append(_AGG[how][0](f"_c{i}").over(before).alias(f"_carry{i}"))
    stats = stats.select(*carried)

    tag = "__k_"
    s = stats.select(*[F.col(c).alias(tag + c) if c in keys else F.col(c) for c in stats.columns])
    cond = chunked["_pid"] == s["_pid"]
    for k in keys:
        cond = cond & chunked[k].eqNullSafe(s[tag + k])
    joined = chunked.join(s, cond, "inner").drop(s["_pid"]).drop(*[tag + k for k in keys])

    out_cols = [c for c in df.columns]
    extra = []
    if index:
        extra.append((F.col("_off") + F.col("_pos") - F.col("_p0")).alias(index))
    if running:
        local = Window.partitionBy("_pid", *keys).orderBy("_pos")
        for i, (how, col, out, inclusive) in enumerate(running):
            frame = local.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
            loc = _AGG[how][0](col).over(frame)
            # greatest/least skip NULLs, so an empty side does not erase the other.
            extra.append(_AGG[how][1](F.col(f"_carry{i}"), loc).alias(out))
    return joined.select(*out_cols, *extra)
