"""Near-duplicate lines by a deletion-neighbourhood join (operator 9), DataFrame functions only.

A line goes when an earlier line, by (document id, line number), is equal to it or, if both have
``min_fuzzy_chars`` characters or more, is one inserted, deleted or changed character away. Lines
without a word are left alone.

Two lines are at most one edit apart just if they share a variant: the line itself or the line
less one character. Emitting every variant of every line would cost a line's length squared, so a
line is first cut into blocks of about ``BLOCK`` characters. One edit lies in one block; the
characters before that block, counted from the left, and after it, counted from the right, are
the same in both lines. These make the block's *frame*, hashed once for the line's own length and
once for a partner one character shorter. A first pass does so with lines cut in half, for all
lines; those that share a half with a different line are read again and cut into blocks, and only
frames that two of them share emit the variants of their block. These are joined:

* lines of one length that share a frame and the block less the character at place i differ in
  that character only;
* a block that equals a longer line's block less one character is that line less the character.

In both cases the earliest line of a variant decides for all its others, so a variant, however
many lines have it, costs one row a line and no pairs. The edit distance of each line's block to
its witness's block is verified before a line goes.

Equal lines collapse by partial aggregation before anything is joined, so a line that stands in a
third of all documents costs one row a task. Lines travel as 128 hash bits, place and length.

Defined cases: null and empty texts stay as they are, a null id is later than any other; rows without an id
are documents of their own, told apart and ordered by a hash of their text. Rows with
one id are one document: lines at the same place are not earlier than each other, so a repeated
row stays. A text that loses all its lines becomes empty. Ties cannot decide anything: places are
ordered. An empty table gives an empty table. Other columns pass through,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratecraft.llm.common import materialise, spare_names

BLOCK = 128
HAS_WORD = r"[^\x20\x09-\x0D]"
LAST = (1 << 63) - 1  # place of a null id
BROADCAST_KEYS = 1_000_000  # 8 MB of keys


def _place(doc_id: str, text: str) -> Column:
    """A document's place in the order: its id; without one, behind all others, told apart by the text."""
    known = F.col(doc_id).cast("long")
    return F.struct(F.coalesce(known, F.lit(LAST)).alias("id"), F.when(known.isNull(), F.xxhash64(F.col(text).cast("string"))).otherwise(0).alias("h"))


def _lines(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc, no, line, chars and the line's hash (h1, h2) of every line with a word."""
    split = docs.select(_place(doc_id, text).alias("doc"),
                        F.posexplode(F.split(F.col(text), "\n", -1)).alias("no", "line"))
    return split.where(F.col("line").rlike(HAS_WORD)).select(
        "doc", "no", "line", F.length("line").alias("chars"),
        F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), F.col("line")).alias("h2"))


def _half_keys(min_chars: int) -> Column:
    """Keys of the line's halves, for partners as long (m) and one character shorter: one edit leaves
    the first m / 2 or the last m - m / 2 characters of both lines equal."""
    keys = []
    for shorter in (0, 1):
        m = F.col("chars") - shorter
        half = F.floor(m / 2).cast("int")
        for side, part in ((0, F.substring(F.col("line"), F.lit(1), half)),
                           (1, F.substring(F.col("line"), F.col("chars") - (m - half) + 1, m - half))):
            keys.append(F.when(m >= min_chars, F.xxhash64(F.lit(side), m, part)))
    return F.array(*keys)


def _frames(lines: DataFrame, min_chars: int) -> DataFrame:
    """One row per line, partner length m (own or one less) and block: key, own (m is the line's
    own length), block."""
    def of(shorter: int) -> Column:
        m = F.col("chars") - shorter
        blocks = F.greatest(F.lit(2), F.ceil(m / BLOCK).cast("int"))

        def frame(j: Column) -> Column:
            lo = F.floor(j * m / blocks).cast("int")
            after = m - F.floor((j + 1) * m / blocks).cast("int")
            hi = F.col("chars") - after
            key = F.xxhash64(j, m, F.substring(F.col("line"), F.lit(1), lo), F.substring(F.col("line"), hi + 1, after))
            return F.struct(key.alias("key"), F.lit(shorter == 0).alias("own"),
                            F.substring(F.col("line"), lo + 1, hi - lo).alias("block"))

        return F.when(m >= min_chars, F.transform(F.sequence(F.lit(0), blocks - 1), frame))

    none = F.array().cast("array<struct<key:bigint,own:boolean,block:string>>")
    both = F.concat(F.coalesce(of(0), none), F.coalesce(of(1), none))
    return lines.select("h1", "h2", "first", F.explode(both).alias("f")).select("h1", "h2", "first", "f.*")


def _few(rows: DataFrame, most: int = BROADCAST_KEYS) -> DataFrame:
    """``rows`` to be broadcast if they are at most ``most``, else as they are."""
    return F.broadcast(rows) if rows.limit(most + 1).count() <= most else rows


def _shared_blocks(lines: DataFrame, slim: DataFrame, firsts: DataFrame, min_chars: int) -> DataFrame:
    """key, own, h1, h2, first, block of each different line in each frame that another line shares."""
    halves = slim.select("h1", "h2", F.explode("halves").alias("key")).where(F.col("key").isNotNull())
    shared = materialise(halves.groupBy("key").agg(F.min("h1").alias("a"), F.max("h1").alias("b"))
                         .where(F.col("a") != F.col("b")).select("key"), "halves")
    close = materialise(halves.join(_few(shared), "key", "left_semi").select("h1", "h2").distinct(), "close")
    texts = lines.where(F.col("chars") >= min_chars).join(_few(close, BROADCAST_KEYS // 2), ["h1", "h2"], "left_semi")
    texts = texts.groupBy("h1", "h2").agg(F.min("line").alias("line"), F.min("chars").alias("chars"))
    frames = materialise(_frames(texts.join(firsts.select("h1", "h2", "first"), ["h1", "h2"]), min_chars), "frames")
    shared = frames.groupBy("key").agg(F.min("h1").alias("a"), F.max("h1").alias("b")) \
        .where(F.col("a") != F.col("b")).select("key")
    return materialise(frames.join(shared, "key", "left_semi"), "blocks")


def _variants(blocks: DataFrame) -> DataFrame:
    """key, h1, h2, kind, v: v is equal for the lines of a frame that a variant links; kind tells
    lines of one length (0) and, of a shorter and longer ones, the shorter (1) and the longer (2)."""
    def less(i: Column) -> Column:
        return F.concat(F.substring(F.col("block"), F.lit(1), i - 1),
                        F.substring(F.col("block"), i + 1, F.length("block") - i))

    def tagged(kind: int, v: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), v.alias("v"))

    places = F.when(F.length("block") > 0, F.sequence(F.lit(1), F.length("block"))).otherwise(F.array().cast("array<int>"))
    own = F.concat(F.array(tagged(1, F.xxhash64(F.col("key"), F.lit(0), F.col("block")))),
                   F.transform(places, lambda i: tagged(0, F.xxhash64(F.col("key"), i, less(i)))))
    longer = F.transform(places, lambda i: tagged(2, F.xxhash64(F.col("key"), F.lit(0), less(i))))
    return blocks.select("key", "own", "h1", "h2", "first", F.explode(
        F.when(F.col("own"), own).otherwise(longer)).alias("e")).select("key", "own", "h1", "h2", "first", "e.*")


def _witnessed(blocks: DataFrame) -> DataFrame:
    """(h1, h2) of the lines with an earlier line one edit away.

    Spark takes the variants for about as many bytes as the file of blocks that they are exploded from, though they
    are a hundred times as many rows: the hints keep them, and what is joined to them, from being broadcast."""
    variants = _variants(blocks).hint("merge")
    line = F.struct("first", "h1", "h2", "own")
    least = variants.groupBy("v").agg(
        F.min(F.when(F.col("kind") == 0, line)).alias("w0"), F.min(F.when(F.col("kind") == 1, line)).alias("w1"),
        F.min(F.when(F.col("kind") == 2, line)).alias("w2"), F.min("h1").alias("a"), F.max("h1").alias("b")) \
        .where(F.col("a") != F.col("b"))
    witness = F.when(F.col("kind") == 0, F.col("w0")).when(F.col("kind") == 1, F.col("w2")).otherwise(F.col("w1"))
    found = variants.join(least.hint("merge"), "v").select("key", "own", "h1", "h2", "first", witness.alias("w")) \
        .where(F.col("w.first") < F.col("first")).select("key", "own", "h1", "h2", "w.first", F.col("w.h1").alias("w1"),
                                                         F.col("w.h2").alias("w2"), F.col("w.own").alias("wown")).distinct()
    mine = blocks.select("key", "own", "h1", "h2", "block")
    other = blocks.select("key", F.col("own").alias("wown"), F.col("h1").alias("w1"), F.col("h2").alias("w2"),
                          F.col("block").alias("other"))
    return found.join(mine.hint("merge"), ["key", "own", "h1", "h2"]).join(other.hint("merge"), ["key", "wown", "w1", "w2"]) \
        .where(F.levenshtein("block", "other", 1) == 1).select("h1", "h2").distinct()


def _mark(no: Column, line: Column) -> Column:
    """A line's number, and 32 bits of its hash: rows of one id must agree in both to lose a line."""
    return F.shiftleft(no.cast("long"), 32).bitwiseOR(F.xxhash64(line).bitwiseAND(F.lit(0xFFFFFFFF)))


def repeated_lines(docs: DataFrame, min_fuzzy_chars: int = 20, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc, marks: per document (see ``_place``) the lines that go."""
    lines = _lines(docs, doc_id, text)
    halves = F.when(F.col("chars") >= min_fuzzy_chars, _half_keys(min_fuzzy_chars))
    slim = materialise(lines.select("doc", "no", "h1", "h2", halves.alias("halves")), "lines")
    firsts = slim.groupBy("h1", "h2").agg(F.min(F.struct("doc", "no")).alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = materialise(firsts, "firsts")
    near = _witnessed(_shared_blocks(lines, slim, firsts, min_fuzzy_chars)).withColumn("near", F.lit(True))
    fate = firsts.join(near, ["h1", "h2"], "left").where(F.col("near").isNotNull() | (F.col("n") > 1))
    gone = slim.join(fate, ["h1", "h2"]).where(F.col("near").isNotNull() | (F.struct("doc", "no") != F.col("first")))
    mark = F.shiftleft(F.col("no").cast("long"), 32).bitwiseOR(F.col("h1").bitwiseAND(F.lit(0xFFFFFFFF)))
    return gone.groupBy("doc").agg(F.collect_set(mark).alias("marks"))


def dedup_lines(docs: DataFrame, min_fuzzy_chars: int = 20, doc_id: str = "doc_id", text: str = "text",
                removed: str | None = None) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text``; ``removed`` names a column for their
    number per document."""
    doc, marks, key, parts, rest = spare_names(docs, "gone_doc", "gone_marks", "own_key", "own_lines", "left_text")
    gone = repeated_lines(docs, min_fuzzy_chars, doc_id, text).select(F.col("doc").alias(doc), F.col("marks").alias(marks))
    keyed = docs.withColumn(key, _place(doc_id, text))
    joined = keyed.join(gone, F.col(key) == F.col(doc), "left")
    lines = F.split(F.col(text), "\n", -1)
    all_marks = F.transform(lines, lambda line, i: _mark(i, line))
    kept = F.array_except(all_marks, F.col(marks))
    left = F.array_join(F.transform(kept, lambda k: F.get(F.col(parts), F.shiftright(k, 32).cast("int"))), "\n")
    out = joined.withColumn(parts, lines).withColumn(rest, F.when(F.col(marks).isNull(), F.col(text)).otherwise(left))
    columns = [F.col(rest).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns]
    if removed:
        columns.append(F.when(F.col(marks).isNull(), 0).otherwise(F.size(parts) - F.size(kept)).cast("long").alias(removed))
    return out.select(*columns)
