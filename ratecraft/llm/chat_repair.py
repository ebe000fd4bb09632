"""Conversation structure repair: cost DP, then prefix-doubling path ranking (operator 13).

A conversation's rows are brought by the cheapest edits to the role order ``(s?(ua)+)?`` (role
initials): Keep 0, Rerole to user or assistant 1, Delete 2, Insert an empty user or assistant turn 5; blank
and duplicate rows must go, a truncated row that stays costs 5 more. The audit is the string of the edits'
initials; of the cheapest edit lists the one whose audit is least in ASCII order is taken.

Nodes are (rows read, state), a state being what the repaired turns so far end with: nothing, a system, a
user or an assistant turn. At most one arc per letter leaves a node, since states allow one role to rerole to or
insert.

1. Cost DP from the end, over all conversations of a batch at once: the least cost to a valid end.
2. The arcs that lie on a cheapest path stay. Nodes are ranked by their audit strings of 1, 2, 4, 8 ...
   letters: a node starts with its least letter and that arc's target; the rank for twice the length is
   that of the pair (rank, rank of the pointer's target), and pointers double. Each node keeps the arc
   that is least by (letter, rank of its target).
3. The audit is read off the doubled pointers, all its letters at once. Long conversations are ranked in
   segments of ``SEGMENT`` rows; their cost DP holds 32 bytes a row.

Rows meet by conversation in sorted order and are read as a stream: first without texts (for the audit),
then with texts behind their audit (for the repaired turns). A conversation is never held as a whole: of it a task
keeps a few bytes per row, and its audit, which is one value of the result. The digest of a conversation's
text is sequential by nature, so the rows of one conversation are read by one task.

Defined cases: null roles and texts are one space; an empty role fits no state, as a null one. Rows are taken by turn, nulls
first, equal turns by role and then by the SHA-256 of role and text. Null conversation ids are one conversation.
A conversation whose rows only name it (``names_only``) has zeros, an empty audit and the hash of the
empty string. Repeated rows are duplicates. An empty table gives no rows. Only the columns named are read, so other
columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SEGMENT = 1 << 16     # rows ranked together
BATCH_ROWS = 1 << 15  # rows of short conversations handled together

BLANKS = " \t\n\x0b\f\r"
NONE, SYSTEM, USER, ASSISTANT = range(4)          # states
INSERTED = {NONE: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
# state after keeping a role of class 0 (other), 1 (s), 2 (u), 3 (a); -1: not allowed
KEPT = np.array([[-1, SYSTEM, USER, -1], [-1, -1, USER, -1], [-1, -1, -1, ASSISTANT], [-1, -1, USER, -1]])
LETTERS = "DIKR"  # ASCII order
FAR = np.int64(1) << 60

# a row's code: class of its role, + 4 if it must go, + 8 if it is truncated
CLASS = {"s": 1, "u": 2, "a": 3}


def _least_costs(codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(cost, start): cost[p, state] to a valid end from position p, conversation c's positions being
    start[c] ... start[c] + rows (the last one after its rows)."""
    sizes = np.array([len(c) for c in codes])
    start = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    cost = np.full((int((sizes + 1).sum()), 4), FAR)
    order = np.argsort(-sizes, kind="stable")
    end = (start + sizes)[order]
    flat = np.zeros(len(cost), np.int64)
    for c, at in zip(codes, start):
        flat[at:at + len(c)] = c

    def inserts(at: np.ndarray) -> None:
        c = cost[at]
        user, assistant = c[:, USER].copy(), c[:, ASSISTANT].copy()
        c[:, USER] = np.minimum(user, 5 + assistant)
        c[:, ASSISTANT] = np.minimum(assistant, 5 + user)
        for s in (NONE, SYSTEM):
            c[:, s] = np.minimum(c[:, s], 5 + c[:, USER])
        cost[at] = c

    cost[end, NONE] = cost[end, ASSISTANT] = 0
    inserts(end)
    for back in range(1, int(sizes.max(initial=0)) + 1):
        live = int(np.searchsorted(-sizes[order], -back, "right"))
        at = end[:live] - back
        after, code = cost[at + 1], flat[at]
        role, stay = code & 3, np.where(code & 4, FAR, np.where(code & 8, 5, 0))
        for s in range(4):
            to = KEPT[s, role]
            keep = np.where(to >= 0, after[np.arange(live), to], FAR)
            rerole = 1 + after[:, INSERTED[s]]
            cost[at, s] = np.minimum(np.minimum(2 + after[:, s], stay + np.minimum(keep, rerole)), FAR)
        inserts(at)
    return cost, start


def _arcs(codes: np.ndarray, cost: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(target, optimal) by [letter, node]: for nodes p * 4 + state of consecutive positions. A row's code of
    -1 stands for a conversation's end."""
    n = len(cost)
    node = np.arange(4 * n)
    p, s = node >> 2, node & 3
    row = codes[p] >= 0
    code = np.where(row, codes[p], 4)
    nxt = np.minimum(p + 1, n - 1)
    to = np.array([INSERTED[k] for k in range(4)])[s]
    kept = KEPT[s, code & 3]
    stay = np.where(code & 8, 5, 0)
    may = row & (code & 4 == 0)
    target = np.stack([nxt * 4 + s, p * 4 + to, nxt * 4 + np.maximum(kept, 0), nxt * 4 + to])
    price = np.stack([np.full(4 * n, 2), np.full(4 * n, 5), stay, 1 + stay])
    allowed = np.stack([row, np.ones(4 * n, bool), may & (kept >= 0), may])
    flat = cost.ravel()
    return target, allowed & (flat < FAR) & (flat[target] + price == flat)


def _read_paths(target: np.ndarray, optimal: np.ndarray, first: np.ndarray, stop: np.ndarray) -> list[tuple[str, int]]:
    """The least audit from each node of ``first`` and the node it ends at; nodes in ``stop`` are ends."""
    n = target.shape[1]
    optimal = optimal & ~stop
    node = np.arange(n, dtype=np.int32)
    letter = np.where(optimal.any(0), optimal.argmax(0) + 1, 0)  # 0: the end, before every letter
    jump = np.where(letter > 0, target[np.maximum(letter - 1, 0), node], node).astype(np.int32)
    rank, jumps = letter.astype(np.int64), [jump]
    while True:  # ranks of audits of 1, 2, 4 ... letters
        rank = np.unique(rank * (n + 1) + rank[jumps[-1]], return_inverse=True)[1]
        doubled = jumps[-1][jumps[-1]]
        if (doubled == jumps[-1]).all():
            break
        jumps.append(doubled)
    # the least arc of a node by (letter, rank of its target); one arc per letter leaves a node
    order = np.where(optimal, (np.arange(4)[:, None] + 1) * (n + 1) + rank[target], 10 * (n + 1))
    best = order.argmin(0)
    assert (best[letter > 0] + 1 == letter[letter > 0]).all()
    length, at = np.zeros(len(first), np.int64), first.astype(np.int32)
    for k in range(len(jumps) - 1, -1, -1):  # the greatest number of steps that do not reach an end
        moved = jumps[k][at]
        far = letter[moved] > 0
        length, at = length + np.where(far, 1 << k, 0), np.where(far, moved, at)
    length += letter[first] > 0
    begin = np.concatenate([[0], np.cumsum(length)])
    step = np.arange(begin[-1]) - np.repeat(begin[:-1], length)
    place = np.repeat(first.astype(np.int32), length)
    for k, jump in enumerate(jumps):
        place = np.where(step >> k & 1, jump[place], place)
    text = np.frombuffer(LETTERS.encode(), "u1")[letter[place] - 1].tobytes().decode()
    ends = np.where(letter[first] > 0, jumps[0][at], first)
    return [(text[a:b], int(e)) for a, b, e in zip(begin, begin[1:], ends)]


def cheapest_edits(codes: list[np.ndarray]) -> list[tuple[int, str]]:
    """(cost, audit) of each conversation, given its rows' codes."""
    if not codes:
        return []
    cost, start = _least_costs(codes)
    totals = cost[start, NONE].tolist()
    if len(codes) == 1 and len(codes[0]) > SEGMENT:  # long: segment by segment
        rows, parts, state = codes[0], [], NONE
        for at in range(0, len(rows), SEGMENT):
            more = min(SEGMENT, len(rows) - at)
            ended = at + more == len(rows)
            code = np.concatenate([rows[at:at + more], [-1]])
            target, optimal = _arcs(code, cost[at:at + more + 1])
            stop = np.zeros(target.shape[1], bool)
            if not ended:  # what follows belongs to the next segment
                stop[-4:] = True
            [(audit, node)] = _read_paths(target, optimal, np.array([state]), stop)
            parts.append(audit)
            state = node & 3
        return [(totals[0], "".join(parts))]
    flat = np.full(len(cost), -1, np.int64)
    for c, at in zip(codes, start):
        flat[at:at + len(c)] = c
    target, optimal = _arcs(flat, cost)
    paths = _read_paths(target, optimal, start * 4 + NONE, np.zeros(target.shape[1], bool))
    return [(total, audit) for total, (audit, _) in zip(totals, paths)]


SUMMARY = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _audit_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (conv, turn, role initial, live, duplicate, last character) -> a summary per conversation."""
    done: list[tuple] = []   # (conv, gaps, blank, duplicate, truncated, illegal)
    codes: list[np.ndarray] = []
    rows, schema = 0, None

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal rows
        small = [k for k, c in enumerate(codes) if len(c) <= SEGMENT]
        found = dict(zip(small, cheapest_edits([codes[k] for k in small])))
        found |= {k: cheapest_edits([c])[0] for k, c in enumerate(codes) if len(c) > SEGMENT}
        if done:
            conv, *counts = zip(*done)
            cost, audit = zip(*(found[k] for k in range(len(codes))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(conv, schema.field(0).type), *(pa.array(c, pa.int64()) for c in (*counts, cost)), pa.array(audit, pa.string())],
                names=["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"])
        done.clear()
        codes.clear()
        rows = 0

    conv, open_, mine = None, False, bytearray()
    low = high = last_turn = before = None
    turns = blank = duplicate = truncated = illegal = 0
    legal = {("s", "u"), ("u", "a"), ("a", "u")}

    def close() -> None:
        nonlocal rows
        gaps = 0 if low is None else high - low + 1 - turns
        done.append((conv, gaps, blank, duplicate, truncated, illegal))
        codes.append(np.frombuffer(bytes(mine), "u1").astype(np.int64))
        rows += len(mine) + 1

    for batch in batches:
        schema = batch.schema
        for c, turn, initial, live, copy, last in zip(*(col.to_pylist() for col in batch.columns)):
            if not open_ or c != conv:
                if open_:
                    close()
                    if rows >= BATCH_ROWS:
                        yield from flush()
                conv, open_, mine = c, True, bytearray()
                low = high = last_turn = before = None
                turns = blank = duplicate = truncated = illegal = 0
            if not live:
                continue
            if turn is not None:
                low, high = turn if low is None else low, turn
                turns += turn != last_turn
                last_turn = turn
            code = CLASS.get(initial, 0)
            if last == "":
                blank, code = blank + 1, code | 4
            elif copy:
                duplicate, code = duplicate + 1, code | 4
            elif last not in ".!?":
                truncated, code = truncated + 1, code | 8
            if before is not None and (before, initial) not in legal:
                illegal += 1
            before = initial
            mine.append(code)
    if open_:
        close()
    if schema is not None:
        yield from flush()


def _edit_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """Sorted rows, a conversation's summary row before its turns -> ("summary", fields) and
    ("turn", role, text) in the repaired order, inserted turns included."""
    audit, at, state = "", 0, NONE

    def inserted() -> Iterator[tuple]:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            state, at = INSERTED[state], at + 1
            yield "turn", ROLE_OF[state], ""

    for batch in batches:
        for conv, kind, role, text, summary in zip(*(batch.column(c).to_pylist() for c in ("conv", "kind", "role", "text", "summary"))):
            if kind == 0:
                yield from inserted()
                audit, at, state = summary["audit"], 0, NONE
                yield "summary", conv, summary
                continue
            yield from inserted()
            edit, at = audit[at], at + 1
            if edit == "K":
                state = int(KEPT[state, CLASS[role[0]]])
                yield "turn", role, text
            elif edit == "R":
                state = INSERTED[state]
                yield "turn", ROLE_OF[state], text
    yield from inserted()


def _digest_task(batches: Iterable[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    conv_type, rows, digest, first = None, [], None, True

    def batch_of() -> pa.RecordBatch:
        columns = list(zip(*rows))
        types = [conv_type, *[pa.int64()] * 6, pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["conv", *names, "repaired_sha256"])

    def typed() -> Iterator[pa.RecordBatch]:
        nonlocal conv_type
        for b in batches:
            conv_type = b.schema.field("conv").type
            yield b

    current = None
    for event in _edit_rows(typed()):
        if event[0] == "summary":
            if current is not None:
                rows.append((*current, digest.hexdigest()))
                if len(rows) >= 5000:
                    yield batch_of()
                    rows = []
            current = (event[1], *(event[2][n] for n in names))
            digest, first = hashlib.sha256(), True
        else:
            digest.update(f"{'' if first else chr(10)}{event[1]}:{event[2]}".encode())
            first = False
    if current is not None:
        rows.append((*current, digest.hexdigest()))
    if rows:
        yield batch_of()


def _turns_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for conv_type, rows in _turn_groups(batches):
        conv, place, role, text = zip(*rows)
        yield pa.RecordBatch.from_arrays([pa.array(conv, conv_type), pa.array(place, pa.int64()), pa.array(role, pa.string()),
                                          pa.array(text, pa.string())], names=["conv_id", "place", "role", "text"])


def _turn_groups(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    conv_type, conv, place, rows = None, None, 0, []

    def typed() -> Iterator[pa.RecordBatch]:
        nonlocal conv_type
        for b in batches:
            conv_type = b.schema.field("conv").type
            yield b

    for event in _edit_rows(typed()):
        if event[0] == "summary":
            conv, place = event[1], 0
        else:
            rows.append((conv, place, event[1], event[2]))
            place += 1
            if len(rows) >= 2000:
                yield conv_type, rows
                rows = []
    if rows:
        yield conv_type, rows


def _rows_with_audits(talks: DataFrame, conv_id: str, turn: str, role: str, text: str, names_only: str | None) -> DataFrame:
    """(conv, kind, role, text, summary), sorted by conversation within partitions: a summary, then its turns."""
    said = talks.select(
        F.col(conv_id).alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"),
        (~F.coalesce(F.col(names_only), F.lit(False)) if names_only else F.lit(True)).alias("live"))
    said = said.withColumn("digest", F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    in_order = [F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), "role", "digest"]
    slim = said.select("conv", "turn", "role", "digest", "live", F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1).alias("last")) \
        .repartition("conv")
    # the window's grouping contains the partitioning, so it sorts but does not shuffle
    same = Window.partitionBy("conv", "digest", "live").orderBy(F.asc_nulls_first("turn"))
    marked = slim.withColumn("copy", F.row_number().over(same) > 1).sortWithinPartitions(*in_order)
    conv_type = talks.schema[conv_id].dataType.simpleString()
    audits = marked.select("conv", "turn", F.substring("role", 1, 1).alias("initial"), "live", "copy", "last") \
        .mapInArrow(_audit_task, f"conv {conv_type}, {SUMMARY}")
    fields = [f.split()[0] for f in SUMMARY.split(", ")]
    heads = audits.select("conv", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("digest"),
                          F.lit("").alias("text"), F.struct(*fields).alias("summary"))
    rows = said.where("live").select("conv", F.lit(1).alias("kind"), "turn", "role", "digest", "text",
                                     F.lit(None).cast(heads.schema["summary"].dataType).alias("summary"))
    return heads.unionByName(rows).repartition("conv") \
        .sortWithinPartitions(in_order[0], "kind", *in_order[1:]).select("conv", "kind", "role", "text", "summary")


def repair(talks: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           names_only: str | None = None) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every
    conversation; rows whose column ``names_only`` is true only name their conversation."""
    names = [f.split()[0] for f in SUMMARY.split(", ")]
    conv_type = talks.schema[conv_id].dataType.simpleString()
    return _rows_with_audits(talks, conv_id, turn, role, text, names_only) \
        .mapInArrow(lambda it: _digest_task(it, names), f"conv {conv_type}, {SUMMARY}, repaired_sha256 string") \
        .withColumnRenamed("conv", "conv_id")


def repaired_turns(talks: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                   names_only: str | None = None) -> DataFrame:
    """conv_id, place (from 0), role, text: the repaired conversations themselves."""
    conv_type = talks.schema[conv_id].dataType.simpleString()
    return _rows_with_audits(talks, conv_id, turn, role, text, names_only) \
        .mapInArrow(_turns_task, f"conv_id {conv_type}, place long, role string, text string")


def damage(talks: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, role, text, dropped: rows damaged by crc32(``conv_id:turn``) % 20 (0 drops the row, 1 empties
    the text, 2 removes its ``[.!?]``, 3 repeats the row, 4 sets role user; nulls are one space). A dropped row stays
    as one that only names its conversation."""
    def filled(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    case = F.crc32(F.concat(filled(conv_id), F.lit(":"), filled(turn)).cast("binary")) % 20
    rows = talks.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), filled(role).alias("role"), filled(text).alias("text"), case.alias("case"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("case") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("case") == 1, "").when(F.col("case") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (F.col("case") == 0).alias("dropped"),
        F.explode(F.when(F.col("case") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")
