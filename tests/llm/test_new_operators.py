"""Ranked search, packing and conversation repair against plain statements of their rules."""

import collections
import hashlib
import heapq
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ratecraft.llm import ball_search, chat_repair, nnls_packing
from ratecraft.llm.queries import BYTE_BPE

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = [None, "", " \n", "...", "a", "É é ÉCOLE école", "x" * 100_000, "tie tie", "TIE tie", "word " * 30_000, "\x00a\x7fb", "日本 語 日本"]


# -- 11 -------------------------------------------------------------------------------

def _terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def _ranking(docs, items, k=10):
    """{item: [(doc_id, score)]} by the rule, all documents scored."""
    bags = [(d, collections.Counter(_terms(t))) for d, t in docs]
    n_docs, total = sum(1 for _, b in bags if b), sum(sum(b.values()) for _, b in bags)
    df = collections.Counter(t for _, b in bags for t in b)
    out = collections.defaultdict(list)
    for item, text in set(items):
        found = []
        for d, bag in bags:
            score = 0
            for t in set(_terms(text)) & set(bag):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                m = 100 - 90 + (90 * sum(bag.values()) * n_docs) // total
                score += w * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 8 * m))
            if score > 0:
                found.append((-score, d is None, d if d is not None else 0))
        out[item] += [(None if none else d, -s) for s, none, d in sorted(found)[:k]]
    return {i: rows for i, rows in out.items() if rows}


def _search(spark, docs, items, **more):
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("rank", F.lit(9)).withColumn("q", F.lit("q")).withColumn("n", F.lit(1))
    i = spark.createDataFrame(items, "item_id long, text string").withColumn("score", F.lit(1)).withColumn("terms", F.lit(None).cast("string"))
    got = collections.defaultdict(list)
    for r in ball_search.search(d.repartition(3), i, **more).collect():
        got[r.item_id].append((r["rank"], r.doc_id, r.score))
    assert all([p for p, *_ in sorted(rows)] == list(range(1, len(rows) + 1)) for rows in got.values())
    return {i: [(d, s) for _, d, s in sorted(rows)] for i, rows in got.items()}


def test_ranking_equals_all_documents_scored(spark):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(60)] + ["École", "ÖL"]
    docs = [(i, " ".join(rng.choices(words, [1 / (k + 1) for k in range(62)], k=rng.randint(1, 40)))) for i in range(700)]
    docs += [(1000 + i, t) for i, t in enumerate(ODD)] + [(None, "tie w3"), (3, "w3 w3 tie"), (3, "w3 w3 tie")] + [(2000 + i, "same w9 words") for i in range(30)]
    items = [(i, " ".join(rng.choices(words, k=12))) for i in range(25)] + [(50, "same words"), (51, None), (52, "unknown"), (53, "..."),
             (54, "TIE"), (55, "x" * 100_000 + " 日本"), (None, "w3"), (56, "w1"), (56, "w1")]
    want = _ranking(docs, items)
    assert _search(spark, docs, items) == want
    assert _search(spark, docs, items, block_bytes=30_000) == want  # several blocks


def test_ranking_of_nothing(spark):
    assert _search(spark, [], [(1, "a")]) == {}
    assert _search(spark, [(1, "a")], []) == {}
    assert _search(spark, [(1, None), (2, "")], [(1, "a"), (2, None)]) == {}


@pytest.mark.parametrize("seed", range(4))
def test_bounds_cover_every_document_and_prune(seed):
    rng = np.random.default_rng(seed)
    terms, x, ends = [], [], [0]
    for d in range(600):  # documents about one of four subjects
        mine = rng.choice(50, rng.integers(1, 12), replace=False) + 50 * (d % 4)
        terms += sorted(mine.tolist())
        x += rng.integers(1, 10**6, len(mine)).tolist()
        ends.append(len(terms))
    ends, terms, x, w = np.array(ends), np.array(terms), np.array(x), rng.integers(0, 9000, 200)
    tree = ball_search.BallTree(ends, terms, x, w, leaf_docs=20)
    ids, none = np.arange(600), np.zeros(600, bool)
    for _ in range(10):
        q = rng.choice(50, 8, replace=False) + 50 * rng.integers(4)
        score = np.array([sum(w[t] * v for t, v in zip(terms[a:b].tolist(), x[a:b].tolist()) if t in set(q)) for a, b in zip(ends, ends[1:])])
        bound = tree.bounds(q, w[q])
        inner = (1 << tree.depth) - 1
        for leaf in range(1 << tree.depth):
            inside = score[tree.docs[tree.first[leaf]:tree.first[leaf + 1]]].max()
            node = inner + leaf
            while True:
                assert bound[node] >= inside
                if not node:
                    break
                node = (node - 1) // 2
        best = ball_search.Best(10)
        tree.search(q, w[q], best, ids, none)
        order = sorted((-s, False, d) for d, s in enumerate(score.tolist()) if s > 0)[:10]
        assert best.rows == order
    assert tree.scored < 10 * (1 << tree.depth)  # subtrees were left out


# -- 12 -------------------------------------------------------------------------------

def _check_sequences(sizes, sequences, window):
    held = collections.defaultdict(list)
    for seq in sequences:
        total = sum(n for *_, n in seq)
        assert total == window or total & (total - 1) == 0 and total < window
        for doc, start, n in seq:
            assert n > 0
            held[doc].append((start, n))
    for doc, size in enumerate(sizes):
        at = 0
        for start, n in sorted(held[doc]):
            assert start == at
            at += n
        assert at == size
    return len(sequences)


@pytest.mark.parametrize("sizes", [
    [1], [2048], [2047, 1], [5000, 3], [1024] * 7, [683, 683, 682] * 5, [1500] * 40, list(range(1, 400)), [3] * 3000, [100_000], [700, 1348, 2048 * 3 + 700]])
def test_every_token_lies_in_one_full_sequence(sizes):
    n = _check_sequences(sizes, nnls_packing.pack_lengths(sizes, 2048), 2048)
    assert n <= sum(sizes) // 2048 + 11


def test_combinations_and_counts():
    rng = np.random.default_rng(0)
    h = np.zeros(65, np.int64)
    h[rng.integers(1, 64, 40)] = rng.integers(1, 9, 40)
    lengths = np.flatnonzero(h).tolist()
    got = {tuple(sorted(n for n in row if n)) for row in nnls_packing.combinations(h, 64, depth=3, kept=10**6).tolist()}
    want = {tuple(sorted(c)) for a in lengths for b in [0, *lengths] for d in [0, *lengths]
            if sum(c := [n for n in (a, b, d) if n]) == 64}
    assert got == want
    columns = nnls_packing.combinations(h, 64)
    x = nnls_packing.solve(columns, h, steps=5000)
    a = np.zeros((65, len(columns)))
    for j, row in enumerate(columns):
        for n in row[row > 0]:
            a[n, j] += 1
    gradient = a.T @ (a @ x - h)
    assert (x >= 0).all() and (gradient > -0.05).all() and np.abs(gradient[x > 0.01]).max() < 0.05  # conditions of the optimum


def test_planned_combinations_are_used():
    sizes = [1000] * 50 + [1048] * 50 + [500] * 60 + [600] * 60 + [948] * 60
    rng = random.Random(1)
    rng.shuffle(sizes)
    sequences = nnls_packing.pack_lengths(sizes, 2048)
    _check_sequences(sizes, sequences, 2048)
    assert sum(len(s) for s in sequences) <= len(sizes) + 3  # nearly no document was cut


@pytest.mark.parametrize("shard", [50, 8_000_000])
def test_pieces_hold_the_library_ids(spark, shard):
    rng = random.Random(2)
    texts = [None, "", "<|endoftext|>a", "x" * 70_000, "some words and more " * 20_000, "日本語 😀 " * 50, *(
        " ".join(rng.choices(["alpha", "Beta", "42", "don't", "été"], k=rng.randint(1, 900))) for _ in range(60))]
    rows = [(i, t) for i, t in enumerate(texts)] + [(7, texts[7]), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit("s")).withColumn("ids", F.lit(1))
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    got = nnls_packing.pack(docs.repartition(3), BYTE_BPE, shard_tokens=shard).collect()
    want = collections.Counter()
    for i, t in rows:
        want[i, np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes()] += 1
    sequences, pieces = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        assert len(r.ids) == 4 * r.length
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id, r.doc_tokens].append((r.start, bytes(r.ids)))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == 2048 or at & (at - 1) == 0 and at < 2048
    found = collections.Counter()
    for (i, n), parts in pieces.items():
        parts.sort()
        if i == 7:  # the repeated row: each byte range twice
            assert sum(len(p) for _, p in parts) == 2 * 4 * n
            continue
        found[i, b"".join(p for _, p in parts)] += 1
    assert found == collections.Counter({k: c for k, c in want.items() if k[0] != 7})
    assert nnls_packing.pack(docs.limit(0), BYTE_BPE).count() == 0


def test_parts_of_long_texts_have_the_ids_of_the_whole():
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    text = "It's a test  of  many   words <|endoftext|> and 12 34 more\n\n lines été là " * 40
    parts = list(nnls_packing.text_parts(text, 37))
    assert "".join(parts) == text and len(parts) > 20
    assert [i for p in parts for i in tokenizer.encode(p, add_special_tokens=False).ids] == tokenizer.encode(text, add_special_tokens=False).ids


# -- 13 -------------------------------------------------------------------------------

def _faults(rows):
    seen, out = set(), []
    for role, text in rows:
        end = text.rstrip(" \t\n\x0b\f\r")
        out.append("b" if not end else "d" if (role, text) in seen else "t" if end[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def _cheapest(rows, faults):
    """(cost, audit, repaired rows): best first over (cost, audit)."""
    def may(said, c):
        return c and re.fullmatch("s?(ua)*u?", said + c)

    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, said, out = heapq.heappop(heap)
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", said):
            return cost, audit, out
        if (i, said[-1:]) in done:
            continue
        done.add((i, said[-1:]))
        steps = [(5, "I", i, r, (r, "")) for r in ("user", "assistant")]
        if i < len(rows):
            role, text = rows[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, said, out))
            if faults[i] not in ("b", "d"):
                more = 5 * (faults[i] == "t")
                steps += [(more, "K", i + 1, role, (role, text))]
                steps += [(more + 1, "R", i + 1, r, (r, text)) for r in ("user", "assistant")]
        for price, letter, to, role, row in steps:
            if may(said, role[:1]):
                heapq.heappush(heap, (cost + price, audit + letter, to, said + role[0], (*out, row)))


def _repaired(rows):
    """rows: (turn, role, text) in order -> the fields of the result."""
    said = [(r, t) for _, r, t in rows]
    faults = _faults(said)
    cost, audit, out = _cheapest(said, faults)
    turns = [t for t, *_ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum((a[:1] + b[:1]) not in ("su", "ua", "au") for (a, _), (b, _) in zip(said, said[1:]))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, digest), out


def _fields(r):
    return (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)


def _in_order(rows):
    def key(r):
        turn, role, text = r
        digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
        return (turn is not None, turn or 0, role, digest)
    return sorted(rows, key=key)


def test_repairs_equal_the_search_over_all_edit_lists(spark):
    rng = random.Random(6)
    talks = collections.defaultdict(list)
    for conv in range(400):
        for _ in range(rng.randint(1, 9)):
            turn = rng.choice([None, 0, 1, 2, 3, 4, 5, 9])
            talks[conv].append((turn, rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None, "usher"]),
                                rng.choice(["Yes.", "No!", "Why? ", "cut", "", " \n", "a.b", None, "Long one. " * 5, "é?"])))
    rows = [(c, t, r, x) for c, turns in talks.items() for t, r, x in turns] + [(None, 1, "user", "Hm."), (None, 2, "user", "So.")]
    talks[None] = [(1, "user", "Hm."), (2, "user", "So.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string") \
        .withColumn("conv", F.lit("x")).withColumn("kind", F.lit(5)).withColumn("summary", F.lit(0)).repartition(3)
    got = {r.conv_id: _fields(r) for r in chat_repair.repair(df).collect()}
    turns = collections.defaultdict(list)
    for r in chat_repair.repaired_turns(df).collect():
        turns[r.conv_id].append((r.place, r.role, r.text))
    assert set(got) == set(talks)
    for conv, said in talks.items():
        filled = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in said]
        want, out = _repaired(_in_order(filled))
        assert got[conv] == want
        assert [(r, x) for _, r, x in sorted(turns[conv])] == list(out)


def test_damage_and_conversations_without_rows(spark):
    rng = random.Random(8)
    rows = [(c, t, r, f"Said {rng.random()}. Is it {c}? End{rng.choice(['.', '', '!'])}")
            for c in range(300) for t, r in enumerate(["system", "user", "assistant", "user", "assistant"][:rng.randint(1, 5)])]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: _fields(r) for r in chat_repair.repair(chat_repair.damage(df), names_only="dropped").collect()}
    want = {c: [] for c, *_ in rows}
    for c, t, role, text in rows:
        case = zlib.crc32(f"{c}:{t}".encode()) % 20
        text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
        want[c] += [] if case == 0 else [(t, "user" if case == 4 else role, text)] * (2 if case == 3 else 1)
    assert any(not said for said in want.values())
    assert got == {c: _repaired(_in_order(said))[0] for c, said in want.items()}
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert all(got[c] == empty for c, said in want.items() if not said)
    nulls = spark.createDataFrame([(None, None, None, None)], df.schema)
    assert chat_repair.damage(nulls).drop("dropped").collect() == [(None, None, " ", " ")]
    assert chat_repair.repair(df.limit(0)).count() == 0
    assert chat_repair.repaired_turns(df.limit(0)).count() == 0


def test_long_conversations_are_ranked_in_segments(spark, monkeypatch):
    rng = random.Random(9)
    codes = [np.array([rng.choice([0, 1, 2, 3, 2, 3, 6, 7, 10, 11]) for _ in range(n)], np.int64) for n in (1, 7, 64, 65, 500, 1000)]
    whole = chat_repair.cheapest_edits(codes)
    assert whole == [chat_repair.cheapest_edits([c])[0] for c in codes]
    monkeypatch.setattr(chat_repair, "SEGMENT", 32)
    assert whole == [chat_repair.cheapest_edits([c])[0] for c in codes]


def test_a_conversation_longer_than_a_segment(spark):
    n = 70_000
    rows = [(1, i, ["user", "assistant"][i % 2] if i % 1000 else "user", f"Turn {i}.") for i in range(n)]
    r = chat_repair.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).first()
    assert r.gaps == 0 and r.duplicate == 0 and r.illegal == 0 and r.cost == 0 and r.audit == "K" * n
