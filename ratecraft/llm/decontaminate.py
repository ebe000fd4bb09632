"""Benchmark decontamination by template canonicalisation (operator 2).

Texts become templates: words are lower-cased and freed of punctuation, a number becomes <num>, a
unit right after a number <unit>, a capitalised word <name> unless it is a function word that opens a
sentence or a line. Every window of ``width`` words is hashed twice, of template words and of the
lower-cased words themselves, and document windows meet benchmark windows in a join on the
hash. An item whose distinct windows of either kind are found in a document to ``min_share`` or more
makes a candidate. If the literal windows reach the share, the document is contaminated, whatever its
case; else the placeholders are compared. Windows are aligned by their distance in the two
texts, the longest alignment first, and a window is taken only if its slots agree with those taken
before and with most of its alignment: one benchmark value always stands for one document value, and
one document name or unit for one of the benchmark (different numbers may become equal by chance). The
document is contaminated if the windows taken are ``min_share`` of the item's. So a
question asked again with other numbers or names is caught, and a text that merely has the same
sentence pattern with values that change from place to place is not.

Benchmark windows are broadcast up to ``BROADCAST_WINDOWS`` (their count is measured); beyond it the
join shuffles. Before the join a bitmap of the benchmark's hashes, 2 to the ``FILTER_BITS`` bits at any
size of the benchmark, takes out document windows that cannot meet any (the join decides on the rest),
and what is left is made distinct. Only candidates are read a second time. Windows of placeholders
alone carry no template and are not windows.

Defined cases: null and empty texts have no windows; a text of fewer words than a window is one
window (of its own length), and such an item is also looked for word for word inside documents, by
literal windows of the lengths that the benchmark has; an item without a window matches nothing. Rows with one document id are
separate texts, told apart by a hash of the text; the result names each (document, item) once.
Repeated items are items each. Other columns are not read.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecraft.llm.common import materialise, spare_names

WIDTH, MIN_SHARE = 5, 0.8  # five words, a share of 0.8
BROADCAST_WINDOWS = 500_000  # 16 bytes each
FILTER_BITS = 22  # 512 kB as a bitmap, 4 MB unpacked in a task
CACHE_WORDS = 400_000
# Unit words that become <unit> after a number.
UNITS = frozenset("""mm cm m km inch inches foot feet yard yards mile miles mg g kg ton tons ounce ounces pound
pounds ml l liter liters litre litres s sec second seconds min minute minutes h hour hours day days week weeks month
months year years cent cents dollar dollars euro euros percent degree degrees mph kmh""".split())
# Words that open sentences and are no names there (English, German, French, Spanish).
FUNCTION_WORDS = frozenset("""the an this that these those there here he she it we you they his her its our your their my who whom
whose what which when where why how if then than and or but nor so yet for as at by from in into of off on onto out over to under
up with without within about above after again against all also although among any are aren't because been before being below
between both can can't cannot could did didn't do does doesn't don't during each either every few had has have having is isn't
just less let let's many may might more most much must neither next no none not now once one only other others per same several
shall should since some still such through thus today together tomorrow too twice until upon was were while will would yesterday
if else however therefore suppose assume given find compute calculate determine consider two three four five six seven eight nine ten
der die das den dem des ein eine einen einem einer eines er sie es wir ihr ihre ihren ihrem ihrer sein seine seinen seinem seiner
mein meine dein deine unser unsere dieser diese dieses diesen diesem jeder jede jedes jeden alle alles viele wenige mehr weniger wer
wen wem was wann wo warum wie wieviel welche welcher welches wenn dann als und oder aber doch denn weil dass ob damit nachdem bevor
während bis seit von vom zu zum zur aus bei beim mit nach in im ins an am ans auf für gegen ohne um unter über vor hinter neben
zwischen durch ist sind war waren wird werden wurde wurden hat haben hatte hatten kann können soll sollen muss müssen nicht kein
keine auch nur noch schon hier dort heute morgen gestern jetzt nun so man zwei drei vier fünf sechs sieben acht neun zehn
le la les un une du de il elle ils elles on nous vous je tu ce cet cette ces son sa ses leur leurs mon ma mes notre nos votre vos qui
que quoi quand où pourquoi comment combien quel quelle quels quelles si alors et ou mais donc car comme chaque tout tous toute toutes
plusieurs quelques aucun aucune plus moins dans en sur sous avec sans pour par entre chez vers depuis pendant avant après contre
est sont était étaient sera seront a ont avait avaient peut peuvent doit ne pas ici là aujourd'hui demain hier puis ensuite deux trois
quatre cinq sept huit neuf dix
el los las una unos unas él ella ellos ellas nosotros usted ustedes yo tú este esta estos estas ese esa esos esas aquel su sus mi mis
nuestro nuestra quien quién qué cuando cuándo donde dónde cómo cuánto cuánta cuántos cuántas cuál cuáles si entonces y o pero pues
porque como cada todo todos toda todas varios varias algunos algunas ningún ninguna más menos en sobre bajo con sin por para entre
hacia desde hasta durante antes después contra es son era eran fue fueron será serán está están hay ha han había puede pueden debe no
aquí allí hoy mañana ayer luego al del lo se dos tres cuatro seis siete ocho nueve diez""".split())
NUM, UNIT, NAME = "<num>", "<unit>", "<name>"
IS_NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*(?:%|st|nd|rd|th)?$").match
STRIP = ".,;:!?\"'()[]{}*#&%$|<>…«»“”‘’¿¡-–—_~`"
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


BREAK = "\x00"  # stands for a line break among the words
WORD, NUMBER, UNIT_WORD, CAPITALISED, OPENING, NOTHING, LINE_END = range(7)  # OPENING: capitalised function word
CLASS, ENDS = 7, 8
SEED = 7


class Template(dict):
    """raw word -> number of its row in a table (hash of the core, class, ends a sentence).

    A text is one array of numbers; what a word stands for in its place is array arithmetic.
    """

    def __init__(self):
        import xxhash
        super().__init__()
        self.hash, self.code = array("Q"), array("B")  # code: class, and ENDS if it ends a sentence
        self.cores: list[str] = []
        self.digest = xxhash.xxh64_intdigest
        self.placeholders = np.array([0, *(self.digest(p, SEED) for p in (NUM, UNIT, NAME))], np.uint64)

    def __missing__(self, word: str) -> int:
        n, core, code = len(self.cores), word, WORD
        if not word.isalpha():  # else there is nothing to strip and no number
            if word == BREAK:
                code = LINE_END | ENDS
            else:
                core = word.strip(STRIP)
                code = NOTHING if not core else NUMBER if IS_NUMBER(core) else WORD
                if word.rstrip("\"')]”’»")[-1:] in (".", "!", "?", ":"):
                    code |= ENDS
        folded = core.lower() if core.isascii() else core.casefold()
        if code & CLASS == WORD:
            if core.lower() in UNITS:
                code += UNIT_WORD
            elif core[0].isupper() and len(core) > 1:
                code += OPENING if core.lower() in FUNCTION_WORDS else CAPITALISED
        self.hash.append(self.digest(folded, SEED))
        self.code.append(code)
        self.cores.append(folded)
        self[word] = n
        return n

    def scan(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of the words, what each is in its place: 0 itself, 1 <num>, 2 <unit>, 3 <name>)."""
        if len(self.cores) > CACHE_WORDS:
            self.clear()
            self.cores.clear()
            del self.hash[:], self.code[:]
        raw = text.replace("\n", f" {BREAK} ").split()
        numbers = np.fromiter(map(self.__getitem__, raw), np.int64, len(raw))
        if not raw:
            return numbers, np.zeros(0, np.int8)
        code = np.frombuffer(self.code, np.uint8)[numbers]  # no view may outlive this call: the arrays grow
        cls = code & CLASS
        real = np.flatnonzero(cls < NOTHING)
        if not len(real):
            return real, np.zeros(0, np.int8)
        ended = np.concatenate([[0], np.cumsum(code >= ENDS)])[real]
        line = np.cumsum(cls == LINE_END)[real]
        numbers, cls = numbers[real], cls[real]
        fresh = np.concatenate([[True], np.diff(ended) > 0])  # a line or a sentence starts here
        after_number = np.concatenate([[False], (cls[:-1] == NUMBER) & (np.diff(line) == 0)])
        kind = np.zeros(len(numbers), np.int8)
        kind[cls == NUMBER] = 1
        kind[(cls == UNIT_WORD) & after_number] = 2
        kind[(cls == CAPITALISED) | (cls == OPENING) & ~fresh] = 3
        return numbers, kind

    def windows(self, text: str, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hash of each template window in order (0: placeholders alone), of each literal window, the
        words' kinds and numbers. Both hashes of a window without a placeholder are the same."""
        numbers, kind = self.scan(text)
        if not len(numbers):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), kind, numbers
        plain = np.frombuffer(self.hash, np.uint64)[numbers]
        size = min(width, len(numbers))
        literal = np.concatenate([[0], np.cumsum(kind == 0)])
        held = literal[size:] - literal[:-size]
        out = rolled(np.where(kind > 0, self.placeholders[kind], plain), size)
        out[held == 0] = 0
        return out.view(np.int64), rolled(plain, size).view(np.int64), kind, numbers

    def words(self, text: str) -> tuple[list[str], list[str]]:
        """(template words, the values they stand for)."""
        numbers, kind = self.scan(text)
        values = [self.cores[n] for n in numbers.tolist()]
        return [(v, NUM, UNIT, NAME)[k] for v, k in zip(values, kind.tolist())], values


def rolled(h: np.ndarray, size: int) -> np.ndarray:
    """The hash of every ``size`` neighbours of ``h``."""
    n = len(h) - size + 1
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = (out ^ h[k:k + n]) * MULTIPLIER
        out ^= out >> np.uint64(29)
    return out


def _window_batches(batches: Iterable[pa.RecordBatch], width: int, bitmap: bytes | None, literal: bool | None,
                    lengths: tuple[int, ...] = ()) -> Iterator[pa.RecordBatch]:
    template = Template()
    wanted = None if bitmap is None else np.unpackbits(np.frombuffer(bitmap, np.uint8), bitorder="little").view(bool)
    for batch in batches:
        lists = []
        for text in batch.column(1):
            templates, literals, _, numbers = template.windows(text.as_py() or "", width)
            windows = literals if literal else templates if literal is False else \
                np.concatenate([templates, literals[literals != templates]])
            if lengths:
                plain = np.frombuffer(template.hash, np.uint64)[numbers]
                windows = np.concatenate([windows, *(rolled(plain, n).view(np.int64) for n in lengths if n < len(plain))])
                del plain  # the array may grow again
            if wanted is not None:
                windows = windows[wanted[windows.view(np.uint64) >> np.uint64(64 - FILTER_BITS)]]
            windows = np.unique(windows)
            lists.append(windows[windows != 0])
        ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
        values = pa.array(np.concatenate(lists) if lists else np.zeros(0, np.int64), pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), values), *batch.columns[2:]],
                                         names=["id", "windows", *batch.schema.names[2:]])


def window_bitmap(found: DataFrame) -> bytes:
    """A bit for every leading ``FILTER_BITS`` bits of a hash: set if ``found.window`` has it."""
    place = F.shiftrightunsigned("window", 64 - FILTER_BITS) + 1
    parts = found.groupBy(F.bitmap_bucket_number(place).alias("part")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()  # 128 parts of 4 kB at most
    held = {r["part"]: bytes(r["bits"]) for r in parts}
    return b"".join(held.get(k, bytes(4096)) for k in range(1, (1 << FILTER_BITS) // 32768 + 1))


def windows(texts: DataFrame, width: int, id_column: str, text: str = "text", bitmap: bytes | None = None,
            literal: bool | None = None, lengths: tuple[int, ...] = ()) -> DataFrame:
    """id, text_hash, window: each distinct window of each row (that ``bitmap`` may hold), literal
    windows or template windows or, if ``literal`` is None, both; and literal ones of ``lengths`` words."""
    wanted = texts.sparkSession.sparkContext.broadcast(bitmap)
    slim = texts.select(F.col(id_column).cast("long").alias("id"), F.col(text).cast("string").alias("text"),
                        F.xxhash64(text).alias("text_hash"))
    return slim.mapInArrow(lambda it: _window_batches(it, width, wanted.value, literal, lengths), "id long, windows array<long>, text_hash long") \
        .select("id", "text_hash", F.explode("windows").alias("window"))


def _length_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    template = Template()
    for batch in batches:
        found = sorted({len(template.scan(text.as_py() or "")[0]) for text in batch.column(0)})
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32())], names=["n"])


def short_lengths(items: DataFrame, width: int) -> tuple[int, ...]:
    """The numbers of words below ``width`` that items have."""
    found = items.select("text").mapInArrow(_length_batches, "n int").where(F.col("n").between(1, width - 1)).distinct()
    return tuple(sorted(r["n"] for r in found.collect()))  # width - 1 rows at most


def aligned_share(doc: str, item: str, width: int, template: Template) -> tuple[float, int]:
    """(share of the item's template windows that consistent alignments cover, slots with another value)."""
    i_words, i_values = template.words(item)
    i_hash = template.windows(item, width)[0]
    d_hash, _, _, d_numbers = template.windows(doc, width)
    d_values = [template.cores[n] for n in d_numbers]
    size = min(width, len(i_words))
    places: dict[int, list[int]] = {}
    for q, h in enumerate(i_hash.tolist()):
        if h:
            places.setdefault(h, []).append(q)
    lines: dict[int, list[int]] = {}
    for p in np.flatnonzero(np.isin(d_hash, i_hash[i_hash != 0])).tolist():
        for q in places[int(d_hash[p])]:
            lines.setdefault(p - q, []).append(q)
    there: dict[tuple, str] = {}
    back: dict[tuple, str] = {}
    covered: set[int] = set()
    changed: set[int] = set()
    for shift, starts in sorted(lines.items(), key=lambda x: (-len(x[1]), x[0])):
        if covered.issuperset(int(i_hash[q]) for q in starts):
            continue
        slots = {q: [q + k for k in range(size) if i_words[q + k] in (NUM, UNIT, NAME)] for q in starts}
        pair = {k: ((i_words[k], i_values[k]), d_values[k + shift]) for ks in slots.values() for k in ks}
        # the values most windows of this alignment agree on, the earliest of equals
        votes = Counter(pair[k] for q in starts for k in slots[q])
        stands, taken = dict(there), dict(back)
        for (a, b), _ in votes.most_common():
            if a not in stands and (a[0] == NUM or taken.get((a[0], b), a) == a):
                stands[a] = b
                if a[0] != NUM:
                    taken[a[0], b] = a
        for q in starts:
            if all(stands.get(pair[k][0]) == pair[k][1] for k in slots[q]):
                covered.add(int(i_hash[q]))
                for k in slots[q]:
                    a, b = pair[k]
                    there[a] = b
                    if a[0] != NUM:
                        back[a[0], b] = a
                    if i_values[k] != b:
                        changed.add(k)
    return len(covered) / max(1, len(places)), len(changed)


def literal_share(doc: str, item: str, width: int, template: Template) -> float:
    """Share of the item's distinct literal windows that the document has."""
    _, wanted, _, words = template.windows(item, width)
    wanted = np.unique(wanted)
    return float(np.isin(wanted, template.windows(doc, min(width, max(1, len(words))))[1]).sum()) / max(1, len(wanted))


def _verify_batches(batches: Iterable[pa.RecordBatch], width: int, min_share: float) -> Iterator[pa.RecordBatch]:
    template = Template()
    for batch in batches:
        ids, hashes, items, shares, slots = [], [], [], [], []
        for doc_id, text_hash, text, candidates in zip(*(batch.column(k).to_pylist() for k in range(4))):
            for c in candidates:
                share, changed = aligned_share(text or "", c["text"] or "", width, template)
                if share < min_share:
                    share, changed = literal_share(text or "", c["text"] or "", width, template), 0
                ids.append(doc_id)
                hashes.append(text_hash)
                items.append(c["item_id"])
                shares.append(share)
                slots.append(changed)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(hashes, pa.int64()), pa.array(items, pa.int64()), pa.array(shares, pa.float64()), pa.array(slots, pa.int32())],
            names=["doc_id", "text_hash", "item_id", "share", "changed_slots"])


def contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, min_share: float = MIN_SHARE,
                 doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """One row per (document, item) found: doc_id, item_id, share, changed_slots (0: word for word).

    A document that has the literal windows only, as in another case, counts as word for word."""
    return _found(docs, benchmark, width, min_share, doc_id, item_id, text).groupBy("doc_id", "item_id").agg(
        F.max("share").alias("share"), F.min("changed_slots").alias("changed_slots"))


def _found(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, min_share: float = MIN_SHARE,
           doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """doc_id, text_hash, item_id, share, changed_slots of each row that holds an item."""
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).cast("string").alias("text"),
                             F.xxhash64(text).alias("text_hash"))
    both = [windows(items, width, "item_id", literal=x).withColumn("literal", F.lit(x)) for x in (False, True)]
    iw = materialise(both[0].union(both[1]), "item_windows") \
        .select(F.struct(F.col("id"), F.col("text_hash")).alias("item"), "window", "literal").distinct()
    sizes = iw.groupBy("item", "literal").agg(F.count(F.lit(1)).alias("item_windows"))
    iw = iw.join(F.broadcast(sizes) if sizes.count() <= BROADCAST_WINDOWS else sizes, ["item", "literal"])
    few = iw.count() <= BROADCAST_WINDOWS
    dw = windows(docs, width, doc_id, text, window_bitmap(iw), lengths=short_lengths(items, width))
    hits = dw.join(F.broadcast(iw) if few else iw, "window").groupBy("id", "text_hash", "item", "literal").agg(
        F.count(F.lit(1)).alias("found"), F.max("item_windows").alias("item_windows"))
    hits = materialise(hits.where(F.col("found") >= F.lit(min_share) * F.col("item_windows")), "candidates")
    hits = hits.select("id", "text_hash", "item").distinct()
    item_texts = items.select(F.struct(F.col("item_id").alias("id"), "text_hash").alias("item"), F.col("text").alias("item_text"))
    listed = hits.join(item_texts.distinct(), "item") \
        .groupBy("id", "text_hash").agg(F.collect_set(F.struct(F.col("item.id").alias("item_id"), F.col("item_text").alias("text"))).alias("items"))
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text")) \
        .withColumn("text_hash", F.xxhash64("text"))
    few = listed.count() <= BROADCAST_WINDOWS // 50  # items' texts included, some MB
    listed = listed.select(F.col("id").alias("__id"), F.col("text_hash").alias("__hash"), "items")
    pairs = rows.join(F.broadcast(listed) if few else listed,
                      F.col("id").eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__hash"))).select("id", "text_hash", "text", "items")
    found = pairs.mapInArrow(lambda it: _verify_batches(it, width, min_share),
                             "doc_id long, text_hash long, item_id long, share double, changed_slots int")
    return found.where(F.col("share") >= min_share)


def clean_documents(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not found to hold a benchmark item, told apart by id and text."""
    found_id, found_hash = spare_names(docs, "found_id", "found_hash")
    found = _found(docs, benchmark, doc_id=doc_id, text=text) \
        .select(F.col("doc_id").alias(found_id), F.col("text_hash").alias(found_hash)).distinct()
    same = F.col(doc_id).cast("long").eqNullSafe(F.col(found_id)) & (F.xxhash64(F.col(text).cast("string")) == F.col(found_hash))
    return docs.join(found, same, "left_anti")
