"""The patience rule without tolerance as mergeable summaries (W1 at delta 0).

Rows are range-partitioned and sorted by (trial, order) once, so a long trial spans many partitions. A
partition reduces each of its trials' rows, its chunk, to a summary whose size is set by the patience, and a
trial's chunks are composed in order. No row is sorted, checkpointed or joined a second time.

A record is a row that improves on all rows of its chunk before it (the first row is one). What a chunk
does to an incoming best b is decided by the first row that improves on b, and that row is a record. If it
is not among the first ``patience`` rows, the trial stops before it. From there on the chunk runs as it would on
its own: it stops ``patience`` rows after the first record that no record follows within ``patience`` rows (a
gap). Two gaps lie more than ``patience`` rows apart, so of all gaps the first two suffice. A summary is therefore: number of
rows, the records among the first ``patience`` rows, the first two gaps, the last record (its score is the best).

No comparison with NaN holds, so a NaN score counts as an improvement and so does the row after it, whose score is
the best from then on.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecraft.operators.blocks import arrow_schema


@dataclass
class Chunk:
    """Summary of consecutive rows of one trial."""
    rows: int = 0
    head: list = field(default_factory=list)  # (position, score) of records among the first ``patience`` rows
    gaps: list = field(default_factory=list)  # (position, score) of the first two records without a follower
    last: tuple = (0, math.nan)               # the last record

    def add(self, scores: np.ndarray, patience: int, strict: bool) -> None:
        record, best = np.ones(len(scores), bool), self.last[1]
        nan = np.flatnonzero(np.isnan(scores))
        for a, b in zip([0, *(nan + 1)], [*nan, len(scores)]):  # stretches between NaN rows, which are records
            if a < b:
                part = scores[a:b]
                before = np.maximum.accumulate(np.concatenate([[part[0] if math.isnan(best) else best], part]))
                record[a:b] = part > before[:-1] if strict else part >= before[:-1]
                record[a] |= math.isnan(best)
            best = math.nan
        at = np.flatnonzero(record)
        places = (self.rows + at).tolist()
        self.head += [(p, float(scores[i])) for p, i in zip(places, at[:patience]) if p < patience]
        if places:
            if len(self.gaps) < 2:
                first = [self.last] if self.rows else []
                chain = np.array([p for p, _ in first] + places)
                wide = np.flatnonzero(np.diff(chain) > patience)[:2]
                for k in wide.tolist():
                    self._gap(first[0] if first and k == 0 else (int(chain[k]), float(scores[at[k - len(first)]])))
            self.last = (places[-1], float(scores[at[-1]]))
        self.rows += len(scores)

    def _gap(self, record: tuple) -> None:
        if len(self.gaps) < 2:
            self.gaps.append(record)

    def close(self, patience: int) -> None:
        if self.rows - 1 - self.last[0] >= patience:
            self._gap(self.last)


@dataclass
class State:
    """A trial after its chunks so far."""
    rows: int = 0
    best: float | None = None
    counter: int = 0
    stop: int | None = None

    def follow(self, c: Chunk, patience: int, strict: bool) -> None:
        if self.stop is not None or not c.rows:
            return
        first = 0
        if self.best is not None:
            b = self.best
            found = [p for p, s in c.head if (s > b if strict else not s < b)]
            first = found[0] if found else c.rows
            if self.counter + first >= patience:  # enough rows without an improvement before it
                self.stop = self.rows + patience - self.counter - 1
                return
            if not found:
                self.rows, self.counter = self.rows + c.rows, self.counter + c.rows
                return
        for place, score in c.gaps:
            if place >= first:
                self.stop, self.best = self.rows + place + patience, score
                return
        self.best, self.counter, self.rows = c.last[1], c.rows - 1 - c.last[0], self.rows + c.rows


def early_stops(scores: DataFrame, order: Sequence[str], patience: int, strict: bool, parts: int) -> DataFrame:
    """(trial_id, stop_index, best_loss) of (trial_id, order columns, _score)."""
    kind = scores.schema["trial_id"].dataType.simpleString()
    between = f"trial_id {kind}, part int, rows long, head array<struct<place: long, score: double>>, " \
              "gaps array<struct<place: long, score: double>>, last_place long, last_score double"
    result = f"trial_id {kind}, stop_index long, best_loss double"
    chunk_schema, out_schema = arrow_schema(between), arrow_schema(result)

    def summarise(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, name, chunk, done = TaskContext.get().partitionId(), None, None, []

        def close() -> None:
            chunk.close(patience)
            pairs = [[{"place": p, "score": s} for p, s in x] for x in (chunk.head, chunk.gaps)]
            done.append((name, part, chunk.rows, *pairs, *chunk.last))

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), chunk_schema)], schema=chunk_schema)
            done.clear()
            return out

        for batch in batches:
            if not len(batch):
                continue
            codes = batch.column(0).dictionary_encode(null_encoding="encode")
            names, places = codes.dictionary.to_pylist(), codes.indices.to_numpy(zero_copy_only=False)
            values = batch.column(1).to_numpy(zero_copy_only=False)
            starts = [0, *(np.flatnonzero(np.diff(places)) + 1).tolist(), len(places)]
            for a, b in zip(starts, starts[1:]):
                if chunk is None or names[places[a]] != name:
                    if chunk is not None:
                        close()
                    name, chunk = names[places[a]], Chunk()
                chunk.add(values[a:b], patience, strict)
            if len(done) > 5000:
                yield flush()
        if chunk is not None:
            close()
        if done:
            yield flush()

    def compose(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, state = None, None

        def row() -> tuple:
            return name, state.stop, -state.best

        for batch in batches:
            done = []
            for trial, _, rows, head, gaps, place, score in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or trial != name:
                    if state is not None:
                        done.append(row())
                    name, state = trial, State()
                pairs = [[(x["place"], x["score"]) for x in y] for y in (head, gaps)]
                state.follow(Chunk(rows, *pairs, (place, score)), patience, strict)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), out_schema)], schema=out_schema)
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row(), out_schema)], schema=out_schema)

    chunks = scores.repartitionByRange(parts, "trial_id", *order).sortWithinPartitions("trial_id", *order) \
        .select("trial_id", "_score").mapInArrow(summarise, between)
    return chunks.repartition("trial_id").sortWithinPartitions("trial_id", "part").mapInArrow(compose, result)


__all__ = ["early_stops", "Chunk", "State"]
