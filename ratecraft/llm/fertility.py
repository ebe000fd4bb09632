"""Quality rules by tokeniser fertility (operator 3).

A public vocabulary with byte fallback cuts every word; per document this gives characters per
token, the share of byte-fallback tokens and the entropy of the tokens (bits, against the most that
many tokens could have). Documents outside their language's bands are rejected. The bands come from the
corpus: per language (per script where the language is unknown) the quartiles of each measure over
all documents that pass the base rules, widened by ``FENCE`` times their distance. Longer texts have
a smaller entropy share, so its bands are per language and length (half octaves of the token count).
Measures are counted in steps, so the quartiles are exact counts over a bounded number of bins, the
same in whatever order tasks finish.

Base rules: too few words, or too many words in repeated three-word windows.

Words are cut once per task and kept in a table that is emptied beyond ``CACHE_WORDS``; whole
texts are counted by numpy over the words' numbers. One row per row of the input.

Defined cases: null and empty texts have no words and fail the base rules. Documents without a language
are judged with their script's; groups of fewer than ``MIN_GROUP`` documents with the bands of all
documents. Where a language has fewer documents of a length, the length's band over all languages
counts, and where these are fewer too, the language's over all lengths. Without any such document nothing is rejected beyond the base rules. Repeated rows
and ids are judged row by row. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ratecraft.llm.common import materialise

CACHE_WORDS = 400_000
CHUNK_BYTES = 8 << 20
FENCE, MIN_GROUP = 2.5, 30  # the fence by labelled documents, see the README
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
SYMBOLS = b"#*$%&|<>"
# Measure: (step it is counted in, least width of half a band).
MEASURES = {"chars_per_token": (0.01, 0.1), "fallback_share": (0.001, 0.02), "entropy_share": (0.002, 0.02)}
BY_LENGTH = ("entropy_share",)
# First code points of Unicode ranges and the script most of their letters have.
SCRIPTS = ((0x0, "Latn"), (0x370, "Grek"), (0x400, "Cyrl"), (0x530, "Armn"), (0x590, "Hebr"), (0x600, "Arab"),
           (0x900, "Deva"), (0x980, "Beng"), (0xA00, "Zyyy"), (0xE00, "Thai"), (0xE80, "Zyyy"), (0x1100, "Hang"),
           (0x1200, "Zyyy"), (0x1E00, "Latn"), (0x1F00, "Grek"), (0x2000, "Zyyy"), (0x3040, "Kana"), (0x3100, "Zyyy"),
           (0x3400, "Hani"), (0xA000, "Zyyy"), (0xAC00, "Hang"), (0xD800, "Zyyy"), (0xF900, "Hani"), (0xFB00, "Zyyy"))
FEATURES = ("doc_id long, lang string, script string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
            "n_repeat_words long, n_tokens long, chars_per_token double, fallback_share double, entropy_share double")


class Words:
    """Numbers distinct words and holds what the vocabulary makes of each."""

    def __init__(self, model: bytes):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = self.model.get_piece_size()
        self.size = size
        self.is_byte = np.array([self.model.is_byte(i) for i in range(size)])
        self.starts = np.array([a for a, _ in SCRIPTS])
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.chars = np.zeros(0, np.int64)
        self.script = np.zeros(0, np.int64)
        self.tokens = np.zeros(0, np.int64)  # all words' tokens, one after the other
        self.ends = np.zeros(1, np.int64)

    def add(self, words: list[bytes]) -> None:
        texts = [w.decode() for w in words]
        ids = self.model.encode(texts, num_threads=1)
        for w in words:
            self.number[w] = len(self.number)
        flat = np.array([i for x in ids for i in x], np.int64)
        self.tokens = np.concatenate([self.tokens, flat])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum([len(x) for x in ids], dtype=np.int64)])
        self.chars = np.concatenate([self.chars, np.array([len(t) for t in texts], np.int64)])
        middle = np.array([ord(t[len(t) // 2]) for t in texts], np.int64)
        self.script = np.concatenate([self.script, np.searchsorted(self.starts, middle, "right") - 1])


def repeat_words(words: np.ndarray, many: int) -> int:
    """Words in three-word windows that occur twice or more; words are numbers below ``many``."""
    n = len(words)
    if n < 4:
        return 0
    if many < 1 << 21:
        keys = (words[:-2] << 42) | (words[1:-1] << 21) | words[2:]
    else:
        pairs = np.unique(words[:-1] * many + words[1:], return_inverse=True)[1].astype(np.int64)
        keys = np.unique(pairs[:-1] * many + words[2:], return_inverse=True)[1]
    order = np.argsort(keys, kind="stable")
    sorted_keys = keys[order]
    same = sorted_keys[1:] == sorted_keys[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k:n - 2 + k] |= twice
    return int(covered.sum())


def _measure(text: bytes, words: list[bytes], table: Words) -> tuple:
    numbers = np.fromiter(map(table.number.__getitem__, words), np.int64, len(words))
    n_symbols = sum(map(text.count, (bytes([c]) for c in SYMBOLS)))
    lines = [line for line in text.split(b"\n") if line.strip()]
    base = (len(words), int(table.chars[numbers].sum()), n_symbols, len(lines) - len(set(lines)),
            repeat_words(numbers, len(table.number)))
    counts = table.ends[numbers + 1] - table.ends[numbers]
    total = int(counts.sum())
    if not total:
        return (*base, 0, None, None, None, None)
    script = SCRIPTS[int(np.bincount(table.script[numbers]).argmax())][1]
    firsts = np.repeat(table.ends[numbers] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
    tokens = table.tokens[firsts + np.arange(total)]
    seen = np.bincount(tokens, minlength=table.size)
    fallback = int(seen[table.is_byte].sum())
    seen = seen[seen > 0].astype(float)
    entropy = np.log2(total) - float((seen * np.log2(seen)).sum()) / total
    most = np.log2(min(total, table.size)) if total > 1 else 1.0
    return (*base, total, script, base[1] / total, fallback / total, max(0.0, entropy) / most)


def _feature_batches(batches: Iterable[pa.RecordBatch], model: bytes) -> Iterator[pa.RecordBatch]:
    table = Words(model)
    for batch in batches:
        texts, begun = batch.column(2), 0
        while begun < len(texts):
            chunk, size, end = [], 0, begun
            while end < len(texts) and (size < CHUNK_BYTES or end == begun):
                text = (texts[end].as_py() or "").encode()
                chunk.append((text, text.split()))  # bytes split at exactly x20 and x09 to x0D
                size, end = size + len(text), end + 1
            if len(table.number) > CACHE_WORDS:
                table.clear()
            new = {w for _, words in chunk for w in words if w not in table.number}
            if new:
                table.add(list(new))
            rows = [_measure(text, words, table) for text, words in chunk]
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(begun, end - begun), batch.column(1).slice(begun, end - begun),
                 pa.array(columns[6], pa.string()), *(pa.array(c, pa.int64()) for c in columns[:6]),
                 *(pa.array(c, pa.float64()) for c in columns[7:])],
                names=["doc_id", "lang", "script", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       "n_tokens", "chars_per_token", "fallback_share", "entropy_share"])
            begun = end


def features(docs: DataFrame, model_path: str, doc_id: str = "doc_id", lang: str = "lang", text: str = "text") -> DataFrame:
    """One row of counts and measures per row of ``docs``; null measures where there is no token."""
    with open(model_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(lang).cast("string").alias("lang"),
                       F.col(text).cast("string").alias("text"))
    out = slim.mapInArrow(lambda it: _feature_batches(it, model.value), FEATURES)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("grp", F.coalesce("lang", F.concat(F.lit("script "), "script"), F.lit("")))


def _length() -> Column:
    """Half octaves of the number of tokens."""
    return F.floor(2 * F.log2("n_tokens")).cast("int")


def fit_bands(measured: DataFrame) -> DataFrame:
    """grp, measure, len, lo, hi over documents that pass the base rules; grp null: all documents, len
    null: all lengths."""
    def step_of(m: str, length: Column) -> Column:
        step, least = MEASURES[m]
        return F.named_struct(F.lit("measure"), F.lit(m), F.lit("len"), length, F.lit("step"), F.lit(step), F.lit("least"), F.lit(least),
                              F.lit("bin"), F.floor(F.col(m) / step).cast("long"))

    steps = F.array(*[step_of(m, F.lit(None).cast("int")) for m in MEASURES], *[step_of(m, _length()) for m in BY_LENGTH])
    long = measured.where(~F.col("base_failed") & F.col("chars_per_token").isNotNull()) \
        .select(F.explode(F.array("grp", F.lit(None).cast("string"))).alias("grp"), steps.alias("s")) \
        .select("grp", F.explode("s").alias("s")).select("grp", "s.*")
    bins = long.groupBy("grp", "measure", "len", "step", "least", "bin").agg(F.count(F.lit(1)).alias("n"))
    of = W.partitionBy("grp", "measure", "len")
    upto = F.sum("n").over(of.orderBy("bin"))
    ranked = bins.withColumn("upto", upto).withColumn("total", F.sum("n").over(of))
    quartile = lambda q: F.min(F.when(F.col("upto") >= q * F.col("total"), F.col("bin") * F.col("step")))
    bands = ranked.groupBy("grp", "measure", "len").agg(quartile(0.25).alias("q1"), quartile(0.75).alias("q3"),
                                                 F.max("total").alias("docs"), F.max("least").alias("least"))
    general = F.col("grp").isNull() & F.col("len").isNull()
    slack = F.greatest(FENCE * (F.col("q3") - F.col("q1")), "least")
    return bands.where((F.col("docs") >= MIN_GROUP) | general) \
        .select("grp", "measure", "len", (F.col("q1") - slack).alias("lo"), (F.col("q3") + slack).alias("hi"))


def outside_bands(measured: DataFrame) -> DataFrame:
    """``measured`` and, per measure, out_<measure>: it lies outside its band."""
    key = F.concat_ws(" ", "measure", F.col("len").cast("string"))
    bands = fit_bands(measured).groupBy("grp").agg(F.map_from_entries(
        F.collect_list(F.struct(key, F.struct("lo", "hi")))).alias("band"))
    # as many rows as languages and scripts, which are few; the plan decides how to join them
    own = bands.where(F.col("grp").isNotNull())
    common = bands.where(F.col("grp").isNull()).select(F.lit(1).alias("one"), F.col("band").alias("all_band"))
    joined = measured.join(own, "grp", "left").withColumn("one", F.lit(1)).join(F.broadcast(common), "one", "left")
    for m in MEASURES:
        keys = [F.concat_ws(" ", F.lit(m), _length().cast("string"))] if m in BY_LENGTH else []
        limits = F.coalesce(*[F.try_element_at(band, k) for k in (*keys, F.lit(m)) for band in (F.col("band"), F.col("all_band"))])
        joined = joined.withColumn(f"out_{m}", F.coalesce((F.col(m) < limits["lo"]) | (F.col(m) > limits["hi"]), F.lit(False)))
    return joined


def judge(docs: DataFrame, model_path: str, doc_id: str = "doc_id", lang: str = "lang", text: str = "text") -> DataFrame:
    """The features of every row, and kept: it passes the base rules and lies in all its bands."""
    judged = outside_bands(materialise(features(docs, model_path, doc_id, lang, text), "fertility"))
    rejected = F.col("base_failed")
    for m in MEASURES:
        rejected |= F.col(f"out_{m}")
    return judged.select("doc_id", "lang", "script", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "n_tokens", "chars_per_token", "fallback_share", "entropy_share", "base_failed",
                         (~rejected).alias("kept"))
