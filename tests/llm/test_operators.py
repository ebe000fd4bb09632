"""Each operator of the subpackage against a plain statement of its rule."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratecraft.llm import (
    bayes_quality, chat_format, decontaminate, fertility, fst_tokens, line_dedup, pair_bpe, simhash, url_rules, warc,
)
from ratecraft.llm.common import scratch_path, smallest_reachable
from ratecraft.llm.queries import BYTE_BPE, PIECE_BPE, URL_RULES, WORD_BPE

ODD_TEXTS = [
    None, "", " ", "\n\n", "a", "Hello  World's end, they'll\tsee 123 4x!!'s", "ÀÉÎ ǅ Σίσυφος ΣΑΣ İstanbul éà ﬁ",
    "<|endoftext|>a<|endoftext|> b<|startoftext|>c <|endof", "日本語のテキスト 한국어 עברית عربى 😀😀 👩‍👩‍👧", "a" * 5000, "x y " * 900,
    "\x1c\x1d\x1e\x1f a\x1cb \x85 \xa0   ​ ﻿　z", "''''s 're're 'S 'LL don't", "\r\n\r\n  \r\n tab\t\t end ", "\x00\x01\x02",
    " ".join(chr(c) for c in (*range(1, 700), *range(0x2000, 0x2070), *range(0x3000, 0x3020))),
]


def _docs(spark, texts, **more):
    rows = [(i, t, *more.values()) for i, t in enumerate(texts)]
    names = "".join(f", {k} string" for k in more)
    return spark.createDataFrame(rows, f"doc_id long, text string{names}")


# -- 1 --------------------------------------------------------------------------------

def test_archive_gives_back_every_record(spark):
    big = "<p>" + "é" * 200 + "</p>"
    rows = [(5, "http://a/x\r\ny", big), (3, None, big), (None, "http://n", big), (7, "u", "short"), (8, "u", "short"), (9, "v", None), (3, None, big)]
    path = scratch_path(spark, "warc")
    warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"), path)
    got = warc.original_record(warc.read_archive(spark, path)).collect()
    assert len(got) == 7
    assert spark.read.parquet(f"{path}/payloads").count() == 3  # each payload once
    kinds = sorted((r.key if r.key is not None else 99, r.type, r.refers_to) for r in got if r.payload_bytes > 100)
    assert kinds == [(3, "response", None), (3, "revisit", 3), (5, "revisit", 3), (99, "revisit", 3)]
    assert {r.type for r in got if r.payload_bytes < 100} == {"response"}
    for r in got:
        head, _, body = bytes(r.record).partition(b"\r\n\r\n")
        assert body == bytes(r.payload) + b"\r\n\r\n" and head.startswith(b"WARC/1.1\r\n")
        assert hashlib.sha256(bytes(r.payload)).hexdigest() == r.payload_digest
        assert f"sha256:{r.payload_digest}" in r.header


def test_archive_of_nothing(spark):
    path = scratch_path(spark, "warc")
    warc.write_archive(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read_archive(spark, path).count() == 0


def test_damaged_archive_is_an_error(spark):
    path = scratch_path(spark, "warc")
    warc.write_archive(spark.createDataFrame([(1, "u", "x" * 300)], "page_id long, url string, html string"), path)
    spark.createDataFrame([], spark.read.parquet(f"{path}/payloads").schema).write.mode("overwrite").parquet(f"{path}/payloads")
    with pytest.raises(Exception, match="missing from the archive"):
        warc.read_archive(spark, path).collect()


# -- 2 --------------------------------------------------------------------------------

ITEM = "A train leaves Paris at 60 km per hour and Bob rides 60 km more after that trip is over."


def test_reparameterised_question_is_found_and_inconsistent_slots_are_not(spark):
    docs = _docs(spark, [
        f"Words before it. {ITEM} And words after.",
        "Some words. A train leaves Berlin at 75 km per hour and Sue rides 75 km more after that trip is over.",
        "Some words. A train leaves Berlin at 75 km per hour and Sue rides 99 km more after that trip is over.",
        "A train leaves the station and nothing else here is alike at all in any way.", None, "", "60 60 60 60 60 60 60"])
    items = spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (4, "5 5 5 5 5 5")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.changed_slots for r in decontaminate.contaminated(docs, items).collect()}
    assert set(got) == {(0, 1), (1, 1)} and got[0, 1] == 0 and got[1, 1] == 4
    left = {r.doc_id for r in decontaminate.clean_documents(docs, items).collect()}
    assert left == {2, 3, 4, 5, 6}
    assert decontaminate.contaminated(docs.limit(0), items).count() == 0
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0


def test_names_that_open_sentences_and_copies_in_another_case_are_found(spark):
    tom = "Tom has 5 apples. Tom buys 3 more apples. Anna takes 2 of them. How many apples does Tom have left?"
    other = tom.replace("Tom", "McDonald").replace("Anna", "USA").replace("5", "9").replace("3", "6")
    ships = "Yesterday Mary Smith and John Brown sailed from Dover to Calais where Peter waited with Paul for the boats of Henry"
    docs = _docs(spark, [f"Words before. {other} And after.", f"so it is said: {ships.upper()} and more", ships.lower(),
                         other.replace("McDonald have", "Peter have").replace("McDonald buys", "Henry buys"), "How many apples does Tom have left? Tom has 5."])
    items = spark.createDataFrame([(1, tom), (2, ships)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.changed_slots for r in decontaminate.contaminated(docs, items).collect()}
    assert set(got) == {(0, 1), (1, 2), (2, 2)}
    assert got[0, 1] > 0 and got[1, 2] == got[2, 2] == 0
    assert "the" in decontaminate.Template().words("It rained. The train left.")[0]  # a function word opens the sentence


def test_numbers_may_become_equal_and_a_clash_costs_its_windows_only(spark):
    boxes = "There are {} boxes with {} pens in each of them and Tom takes 4 pens out"
    long = "Every day {} trucks bring sand to the yard where men load it on ships that leave for {} ports and bring back " \
           "coal from the mines in the hills far away across the sea, while {} more wait"
    docs = _docs(spark, [boxes.format(5, 5), boxes.format(2, 3), long.format(8, 8, 9), boxes.format(7, 3).replace("4", "9")])
    items = spark.createDataFrame([(1, boxes.format(2, 3)), (2, long.format(6, 6, 6))], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(docs, items).collect()}
    assert set(got) == {(0, 1), (1, 1), (2, 2), (3, 1)}
    assert got[0, 1].share == 1 and got[0, 1].changed_slots == 2 and got[1, 1].changed_slots == 0
    assert 0.8 <= got[2, 2].share < 1 and got[2, 2].changed_slots == 2
    template = decontaminate.Template()
    assert decontaminate.aligned_share("they say Tom met Tom on the road to town", "they say Ann met Sue on the road to town", 5, template)[0] < 1


def test_short_items_are_found_inside_documents(spark):
    docs = _docs(spark, ["They ask: What is 17 * 24? Nobody knew.", "What is 17 * 25?", "what is 17", "7 8 9 10 11 12", "7 8 9 10 11 13", "so it is"])
    items = spark.createDataFrame([(1, "What is 17 * 24?"), (2, "7 8 9 10 11 12"), (3, "")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()}
    assert {(0, 1), (3, 2)} <= got and not {d for d, _ in got} & {2, 4, 5}
    assert decontaminate.short_lengths(items, 5) == (4,)


def test_documents_without_an_id_are_told_apart_by_their_text(spark):
    rows = [(None, f"Before it. {ITEM}"), (None, "a clean text without an id"), (7, "another clean text"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert sorted(map(tuple, decontaminate.clean_documents(docs, items).collect()), key=repr) == sorted(rows[1:], key=repr)
    base = " ".join(f"word{i}" for i in range(400))
    rows = [(3, base), (None, base.upper()), (None, base), (None, "quite another text here"), (4, "and one more that differs")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = simhash.keep_one_per_group(docs, simhash.near_duplicate_groups(docs)).collect()
    assert sorted(map(tuple, kept), key=repr) == sorted([rows[0], rows[3], rows[4]], key=repr)


# -- 3 --------------------------------------------------------------------------------

def _base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    triples = list(zip(words, words[1:], words[2:]))
    count, covered, seen, dup = collections.Counter(triples), set(), set(), 0
    for i, t in enumerate(triples):
        if count[t] > 1:
            covered |= {i, i + 1, i + 2}
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def test_base_counts_and_bands(spark):
    rng = random.Random(1)
    plain = [" ".join(rng.choice("the quick brown fox jumps over lazy dogs while rivers flow north".split()) + rng.choice("abcde")
                      for _ in range(120)) for _ in range(60)]
    texts = [*ODD_TEXTS, "a b c a b c a\nx\nx\n \nx", " ".join(chr(0x12000 + i) for i in range(80)), *plain]
    got = {r.doc_id: r for r in fertility.judge(_docs(spark, texts, lang="en"), PIECE_BPE).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == _base(t), t
        assert r.base_failed == (r.n_words < 50 or 2 * r.n_repeat_words > r.n_words)
        assert not (r.kept and r.base_failed)
    assert all(got[len(texts) - 60 + i].kept for i in range(60))
    assert not got[len(ODD_TEXTS) + 1].kept  # nothing but byte fallback
    assert fertility.judge(_docs(spark, ["a"], lang=None).limit(0), PIECE_BPE).count() == 0


def test_entropy_is_judged_among_texts_of_its_length(spark):
    """Entropy falls with the length: a short text of few words lies amid the long ones, not the short ones."""
    rng = random.Random(5)
    words = [a + b + c for a in ("ba", "ko", "ri", "tu") for b in ("len", "mas", "dir", "pol") for c in ("ta", "ne", "so", "gu", "vi")]
    texts = [" ".join(rng.choices(words, k=n)) for n in (54, 1200) for _ in range(60)]
    few = rng.sample(words, 12)
    texts.append(" ".join(rng.choices(few, k=54)))
    judged = fertility.outside_bands(fertility.features(_docs(spark, texts, lang="en"), PIECE_BPE)).collect()
    few = next(r for r in judged if r.doc_id == 120)
    assert not few.base_failed and few.out_entropy_share
    assert few.entropy_share > min(r.entropy_share for r in judged if r.n_words == 1200)
    assert sum(r.out_entropy_share for r in judged) <= 4
    kept = {r.doc_id: r.kept for r in fertility.judge(_docs(spark, texts, lang="en"), PIECE_BPE).collect()}
    assert not kept[120] and sum(kept.values()) > 100


def test_repeat_words_agree_beyond_packing():
    rng = np.random.default_rng(3)
    for n in (0, 3, 4, 50, 400):
        w = rng.integers(0, 6, n)
        assert fertility.repeat_words(w, 100) == fertility.repeat_words(w, 1 << 22)


# -- 4 --------------------------------------------------------------------------------

def test_held_out_documents(spark):
    rng = random.Random(5)
    vocabulary = [a + b for a in "ka lo mi ne su ta".split() for b in "ren dol mas tik".split()]
    rows, labels = [], []
    for i in range(600):
        words = [rng.choice(vocabulary) for _ in range(60)]
        toxic, junk = i % 6 == 0, i % 7 == 0
        if toxic:
            words[rng.randrange(60)] = "scumbag"
        text = " ".join(w.upper() + "!!" for w in words) if junk else " ".join(words) + "."
        rows.append((i, text, "en", f"src{i % 3}" if i % 2 else None, 1))
        if i % 2 == 0 or i < 100:
            labels.append((i, int(not junk), int(toxic)))
    docs = spark.createDataFrame([*rows, (1000, None, None, None, 0), (1001, "", "en", "s/p/q", 0), (None, "x", "en", "s", 1)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([*labels, (None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.kept for r in bayes_quality.judge(docs, labels).collect()}
    held = [i for i in range(100, 600) if i % 2]
    wrong = [i for i in held if got[i] != (i % 6 != 0 and i % 7 != 0)]
    assert len(wrong) <= 0.03 * len(held)
    assert len(got) == 603
    kept = bayes_quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(got.values())
    assert bayes_quality.judge(docs.limit(0), labels.limit(0)).count() == 0
    assert bayes_quality.judge(docs, labels.limit(0)).count() == 603


# -- 5 --------------------------------------------------------------------------------

def test_examples_read_back(spark):
    rng = random.Random(2)
    parts = ["<|im_end|>", "<|im_start|>", "<\\|", "<|", "\\", "|", "<", "\n", "%0A", "%", "é😀", "assistant"]
    rows = []
    for conv in range(40):
        for turn in range(rng.randrange(1, 7)):
            role = rng.choice(["user", "assistant", "system", "a\nb%", None])
            rows.append((conv if conv else None, turn, role, rng.choice([None, "".join(rng.choice(parts) for _ in range(6))])))
    talks = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    ex = chat_format.expand_prefix_targets(talks)
    got = ex.select("conv_id", "example", "is_target", chat_format.read_turns(F.col("text")).alias("turns"),
                    chat_format.trained_text(F.col("text"), F.col("loss_start"), F.col("loss_end")).alias("trained")).collect()
    want = collections.defaultdict(list)
    for c, _, role, text in rows:
        want[c].append((role or "", text or ""))
    by = collections.defaultdict(list)
    for r in got:
        by[r.conv_id].append(r)
    assert set(by) == set(want)
    for c, turns in want.items():
        examples = sorted(by[c], key=lambda r: r.example)
        assert [(t.role, t.text) for t in examples[-1].turns] == turns
        assert [r.trained for r in examples if r.is_target] == [t for role, t in turns if role == "assistant"]
        assert all(r.trained == "" for r in examples if not r.is_target)
    assert chat_format.expand_prefix_targets(talks.limit(0)).count() == 0


# -- 6 --------------------------------------------------------------------------------

def test_ids_and_texts_equal_the_library(spark):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(BYTE_BPE)
    docs = _docs(spark, ODD_TEXTS, ids="clash")
    encoded = pair_bpe.encode(docs, BYTE_BPE)
    got = {r.doc_id: (r.ids, r.text) for r in pair_bpe.decode(encoded, BYTE_BPE).collect()}
    digests = {r.doc_id: r for r in pair_bpe.round_trip_digests(docs, BYTE_BPE).collect()}
    for i, text in enumerate(ODD_TEXTS):
        ids = t.encode(text or "", add_special_tokens=False).ids
        assert got[i][0] == ids, text
        assert got[i][1] == t.decode(ids, skip_special_tokens=False) == (text or "")
        assert digests[i].n_tokens == len(ids)
        assert digests[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


# -- 7 --------------------------------------------------------------------------------

def test_links_equal_all_pairs(spark):
    rng = random.Random(4)
    bits = [rng.getrandbits(64) for _ in range(300)]
    for b in bits[:120]:
        for k in (1, 2, 3, 4, 5):
            x = b
            for i in rng.sample(range(64), k):
                x ^= 1 << i
            bits.append(x)
    signed = sorted({b - (1 << 64) if b >> 63 else b for b in bits})
    links = simhash.near_links(spark.createDataFrame([(b,) for b in signed], "bits long")).collect()
    a = np.array(signed, np.int64)
    want = {(signed[i], signed[j]) for i in range(len(a)) for j in np.flatnonzero(np.bitwise_count((a[i] ^ a).view(np.uint64)) <= 4) if i < j}
    assert {(r.a, r.b) for r in links} == want


def test_groups_and_one_of_each(spark):
    base = " ".join(f"word{i}" for i in range(400))
    docs = _docs(spark, [base, base.upper(), base + " tail", None, "", " \n", "one two", "One\tTWO", "quite another text here"])
    got = {r.doc_id: r.component_id for r in simhash.near_duplicate_groups(docs).collect()}
    assert got[1] == 0 and got[3] == got[4] == got[5] == 3 and got[7] == 6 and got[8] == 8
    repeated = docs.union(docs)
    kept = simhash.keep_one_per_group(repeated, simhash.near_duplicate_groups(repeated))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(got.values()))
    assert simhash.near_duplicate_groups(docs.limit(0)).count() == 0


def test_components_of_chains_and_stars(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(100, 180)] + [(500, i) for i in range(501, 540)] + [(i, rng.randrange(1000, 1020)) for i in range(1000, 1020)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in smallest_reachable(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[x] == find(x) for x in got) and {x for e in edges for x in e if e[0] != e[1]} <= set(got)


# -- 8 --------------------------------------------------------------------------------

@pytest.mark.parametrize("chunk", [5, 64, 32768])
def test_counts_equal_the_library_for_any_chunk(spark, chunk):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(WORD_BPE)
    docs = _docs(spark, [*ODD_TEXTS, *ODD_TEXTS], tokens="clash")
    got = {r.doc_id: r for r in fst_tokens.token_counts(docs, WORD_BPE, chunk_chars=chunk).collect()}
    for i, text in enumerate([*ODD_TEXTS, *ODD_TEXTS]):
        n = len(t.encode(text or "", add_special_tokens=False).ids)
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len((text or "").encode()), n > 2048), text


# -- 9 --------------------------------------------------------------------------------

def _distance_one(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def test_lines_equal_the_rule(spark):
    rng = random.Random(8)
    bases = ["".join(rng.choice("abé d") for _ in range(n)) + "z" for n in (5, 18, 19, 20, 21, 40, 128, 129, 300, 700) for _ in range(2)]
    lines = []
    for b in bases:
        lines += [b, b]
        for _ in range(6):
            i = rng.randrange(len(b))
            lines.append(rng.choice([b[:i] + b[i + 1:], b[:i] + "x" + b[i:], b[:i] + "x" + b[i + 1:], b[:i] + "xy" + b[i:]]))
    rng.shuffle(lines)
    texts = ["\n".join(["", *lines[k:k + 5], " "]) for k in range(0, len(lines), 5)] + [None, "", "\n"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (2, texts[2])]
    docs = spark.createDataFrame([(i, t, 1, "m") for i, t in rows], "doc_id long, text string, h1 int, marks string")
    got = sorted(map(tuple, line_dedup.dedup_lines(docs).collect()), key=repr)
    place = {}
    for i, t in rows:
        for no, line in enumerate((t or "").split("\n")):
            if line.strip(" "):
                key = (i if i is not None else 1 << 62, no)
                place[line] = min(place.get(line, key), key)
    gone = {a for a in place if any(place[b] < place[a] and min(len(a), len(b)) >= 20 and _distance_one(a, b) for b in place)}

    def cut(i, t):
        if t is None:
            return None
        return "\n".join(line for no, line in enumerate(t.split("\n")) if not line.strip(" ") or (
            line not in gone and place[line] == ((i if i is not None else 1 << 62), no)))
    assert got == sorted(((i, cut(i, t), 1, "m") for i, t in rows), key=repr)
    assert len(gone) > 20
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_variants_of_lines_are_not_broadcast(spark):
    """By their estimate, that of the file of blocks they are exploded from, they would be."""
    first = "CAST(named_struct('doc', named_struct('id', id, 'h', 0L), 'no', 0) AS struct<doc:struct<id:bigint,h:bigint>,no:int>)"
    rows = spark.range(3).selectExpr("7L AS key", "true AS own", "id AS h1", "id AS h2", f"{first} AS first", "concat('a line of words ', id) AS block")
    blocks = line_dedup.materialise(rows, "blocks")
    near = line_dedup._witnessed(blocks)
    assert "BroadcastHashJoin" not in spark._jvm.PythonSQLUtils.explainString(near._jdf.queryExecution(), "formatted")
    assert sorted(r.h1 for r in near.collect()) == [1, 2]


# -- 10 -------------------------------------------------------------------------------

def test_rules_equal_the_longest_fit(spark):
    rng = random.Random(9)
    labels = ["a", "b", "c", "net", "org", "x-y"]
    hosts = [".".join(rng.choice(labels) for _ in range(rng.randrange(1, 4))) for _ in range(40)]
    paths = ["/", "/en/", "/en/x", "/de", ""]
    rules = list({(rng.choice(["allow", "block"]), rng.choice([*hosts[:15], "net", ""]), rng.choice(paths)) for _ in range(30)})
    urls = [(i, rng.choice(["http://", "https://", "HTTP://"]) + rng.choice([str.upper, str])(rng.choice(hosts)) +
             rng.choice([*paths, "/en/xyz?q=://", "#top", "?a/en/"])) for i in range(300)]
    urls += [(900, None), (901, "no scheme"), (902, ""), (None, "http://net/"), (903, "http://"), (900, None)]
    got = collections.Counter(tuple(r) for r in url_rules.judge_urls(
        spark.createDataFrame(urls, "page_id long, url string").withColumn("key", F.lit(1)), url_rules.rules_frame(spark, rules)).collect())

    def judge(i, url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = host.lower()
        fits = [(-len(h + p), -len(h), h, p, v) for v, h, p in rules if (h == "" or host == h or host.endswith("." + h)) and path.startswith(p)]
        best = min(fits) if fits else None
        return i, host, path, best and best[2] + best[3], best[4] if best else "allow"
    assert got == collections.Counter(judge(i, u) for i, u in urls)
    empty = spark.createDataFrame([], "page_id long, url string")
    assert url_rules.judge_urls(empty, url_rules.rules_frame(spark, URL_RULES)).count() == 0


def test_window_bitmap_holds_every_window_of_the_benchmark(spark):
    import numpy as np
    hashes = [-(1 << 63), -1, 0, 1, (1 << 63) - 1, 1 << 40, -(1 << 40), 123456789 << 30]
    bitmap = decontaminate.window_bitmap(spark.createDataFrame([(h,) for h in hashes], "window long"))
    assert len(bitmap) * 8 == 1 << decontaminate.FILTER_BITS
    held = np.flatnonzero(np.unpackbits(np.frombuffer(bitmap, np.uint8), bitorder="little"))
    assert held.tolist() == sorted({(h % (1 << 64)) >> (64 - decontaminate.FILTER_BITS) for h in hashes})
    texts = spark.createDataFrame([(1, "Tom buys 3 apples for 4 euros on Monday."), (2, "one two three four five six")], "doc_id long, text string")
    every = {tuple(r) for r in decontaminate.windows(texts, 5, "doc_id").collect()}
    first = decontaminate.windows(texts.where("doc_id = 1"), 5, "doc_id")
    among = {tuple(r) for r in decontaminate.windows(texts, 5, "doc_id", bitmap=decontaminate.window_bitmap(first)).collect()}
    assert among == {r for r in every if r[0] == 1}
