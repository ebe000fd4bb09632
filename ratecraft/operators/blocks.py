"""Binary partial results that merge as a tree.

A task reduces its rows to one block of doubles per key. Blocks of a key meet first in one of
``WIDTH`` merge tasks, then in one; a merge task reads them sorted by key and holds one block at a time. So what
is shuffled is tasks x keys blocks, no key's rows meet in one task, and memory is one block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

WIDTH = 32


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def blocks_batch(rows: Sequence[tuple], schema: pa.Schema) -> pa.RecordBatch:
    """(keys ..., block array) rows as a batch of ``schema``, which ends with part int, block binary."""
    part = TaskContext.get().partitionId() % WIDTH
    columns = list(zip(*rows)) or [()] * (len(schema) - 1)
    arrays = [pa.array(c, f.type) for c, f in zip(columns[:-1], schema)]
    return pa.RecordBatch.from_arrays([*arrays, pa.array([part] * len(rows), pa.int32()),
                                       pa.array([b.tobytes() for b in columns[-1]], pa.binary())], schema=schema)


def merge_tree(partials: DataFrame, keys: Sequence[str], merge: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """(keys ..., block): the blocks of ``partials`` (keys ..., part, block) merged per key."""
    keys = list(keys)
    ddl = ", ".join([*(f"`{k}` {partials.schema[k].dataType.simpleString()}" for k in keys), "part int", "block binary"])
    schema = arrow_schema(ddl)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, total = None, None
        for batch in batches:
            for *key, _, block in zip(*(c.to_pylist() for c in batch.columns)):
                one = np.frombuffer(block)
                if total is not None and key == current:
                    total = merge(total, one)
                    continue
                if total is not None:
                    yield blocks_batch([(*current, total)], schema)
                current, total = key, one
        if total is not None:
            yield blocks_batch([(*current, total)], schema)

    order = [F.asc_nulls_first(F.col(f"`{k}`")) for k in keys]
    names = [F.col(f"`{k}`") for k in keys]
    halfway = partials.repartition(*names, "part").sortWithinPartitions(*order).mapInArrow(run, ddl)
    return halfway.repartition(*names).sortWithinPartitions(*order).mapInArrow(run, ddl).drop("part")


__all__ = ["merge_tree", "blocks_batch", "arrow_schema", "WIDTH"]
