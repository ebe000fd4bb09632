"""Token counts by a compiled finite-state transducer (operator 8).

The transducer reads the bytes of a pre-token. After some bytes its state is all that the rest can depend on:

* the longest suffix read that begins a vocabulary entry, and
* for each place in that suffix from which an entry may begin, the last token of the encoding up to there and how many
  tokens that encoding has more or less than the present one.

That suffices because every prefix of a rank-merged encoding is the encoding of its own text, and a list of
tokens is an encoding if each two neighbours are: reading a byte, the new last token is the one entry
that ends there and may stand beside the last token before it (``may_follow`` undoes merges at
the border, latest first). A transition is annotated with the change in the number of tokens; a word's last byte,
which carries the end-of-word mark, leads back to the start. States are of bounded size and made when first
reached (the full table would be large); a transition is compiled once and looked up from then on. Paths from start to
start over whole words and over whole pieces without white space are compressed to one
transition. All tables are emptied beyond a bound in bytes.

Texts longer than ``chunk_chars`` are cut into chunks that go to different tasks, also within a word: at white space, beside
digits, or between two letters or two marks of one run, where normalising and pre-tokenising cannot reach across. A chunk's state
map takes the state it is entered in to tokens and the state it leaves in; a chunk that holds the
end of the entered word maps all states to one. Maps are first made for the state that the
text just before the chunk suggests, and a prefix scan composes them. Where the scan meets a state that the
next chunk has no map for, that state is asked of it, as is every state its
predecessor is known to leave in, all chunks at once, until none is missing.

Defined cases: a null or empty text has no tokens. The vocabulary's special strings count one token
each and part the text around them, as in the tokenizers library's default. Repeated rows are counted
each. A stretch without a place to cut (runs of combining marks or apostrophes) stays in one chunk. Other
columns are not read.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecraft.llm.common import materialise
from ratecraft.llm.pair_bpe import byte_symbols

TABLE_BYTES = 128 << 20  # of each table of a task
CHUNK_CHARS = 1 << 18   # longer texts are cut
LONG_WORD = 256         # longer words and pieces are read, not remembered
BYTES = [bytes([b]) for b in range(256)]
GUESS_CHARS = 64        # read before a chunk to guess the state it is entered in
# Fixed value: white space as the tokenizer's patterns have it.
SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
# Fixed value: the pre-token pattern of the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# A state: the longest suffix read that begins an entry, and for each place that an entry may begin at (farthest
# first) how far back it is, the last token up to there (-1 at a word's start), and its tokens less the present ones.
START = (b"", ((0, -1, 0),))


def load_vocabulary(path: str) -> dict:
    """Plain data: tokens are numbered; ``plain`` and ``ending`` give the number of a byte string without and with
    the end-of-word mark, ``made`` the merge (rank, left, right) that makes a token."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    end, byte_of = spec["model"]["end_of_word_suffix"] or "", {c: b for b, c in enumerate(byte_symbols())}
    names = list(spec["model"]["vocab"])
    number = {t: i for i, t in enumerate(names)}
    pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
    made, ranks = [(-1, -1, -1)] * len(names), {}
    for rank, (a, b) in enumerate(pairs):
        new = number[a + b]
        if new in (number[a], number[b]) or made[new][0] >= 0:
            raise ValueError(f"two merges make {a + b!r}; the transducer needs one for each entry")
        made[new], ranks[number[a] << 20 | number[b]] = (rank, number[a], number[b]), rank
    plain, ending = {}, {}
    for name, i in number.items():
        ends = bool(end) and name.endswith(end)
        text = name[:-len(end)] if ends else name
        if all(c in byte_of for c in text):
            (ending if ends else plain)[bytes(byte_of[c] for c in text)] = i
    if not end:
        ending = plain
    if any(bytes([b]) not in table for b in range(256) for table in (plain, ending)):
        raise ValueError("the vocabulary lacks a byte")
    begins = {t[:k] for table in (plain, ending) for t in table for k in range(len(t))}
    return {"plain": plain, "ending": ending, "made": made, "ranks": ranks, "begins": begins,
            "special": [t["content"] for t in spec.get("added_tokens", [])]}


class Transducer:
    """States, compiled transitions and the counts of words and pieces."""

    def __init__(self, vocabulary: dict):
        import regex
        self.plain, self.ending, self.begins = vocabulary["plain"], vocabulary["ending"], vocabulary["begins"]
        self.made, self.ranks = vocabulary["made"], vocabulary["ranks"]
        self.special = re.compile("(" + "|".join(map(re.escape, vocabulary["special"])) + ")") if vocabulary["special"] else None
        self.find = regex.compile(PATTERN).findall
        self.ascii = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+", re.ASCII).findall
        self.cut = re.compile(f"[{SPACE}]+").split
        self.sound: dict[int, bool] = {}
        self.beside: dict[int, bool] = {}
        self.pieces: dict[str, int] = {}
        self.words: dict[str, int] = {}
        self.word_bytes = self.state_bytes = 0
        self._no_states()

    # -- states and transitions ---------------------------------------------------------

    def _no_states(self) -> None:
        self.states, self.number = [START], {START: 0}
        self.moves: dict[int, tuple[int, int]] = {}  # by state * 256 + byte
        self.ends: dict[int, int] = {}
        self.state_bytes = 0

    def enter(self, state: tuple) -> int:
        """The number of a state, made if it is new."""
        found = self.number.get(state)
        if found is None:
            found = self.number[state] = len(self.states)
            self.states.append(state)
            self.state_bytes += 400 + 100 * len(state[1])
        return found

    def crosses(self, left: int, right: int, before: float) -> bool:
        """Would a merge over the border of two tokens be made before rank ``before``? Merges at the
        border are undone, latest first; of two of equal rank the left one was made first."""
        made, ranks = self.made, self.ranks
        while True:
            if ranks.get(left << 20 | right, before) < before:
                return True
            if made[left][0] > made[right][0]:
                before, left = made[left][0], made[left][2]
            elif made[right][0] < 0:
                return False
            else:
                before, right = made[right][0] + 1, made[right][1]

    def stands(self, token: int) -> bool:
        """Is the token the encoding of its own text?"""
        if token not in self.sound:
            rank, left, right = self.made[token]
            self.sound[token] = rank < 0 or self.stands(left) and self.stands(right) and not self.crosses(left, right, rank)
        return self.sound[token]

    def may_follow(self, left: int, right: int) -> bool:
        if left < 0:
            return self.stands(right)
        key = left << 20 | right
        if key not in self.beside:
            self.beside[key] = self.stands(right) and not self.crosses(left, right, float("inf"))
        return self.beside[key]

    def _last(self, read: bytes, window: tuple, table: dict) -> tuple[int, int]:
        """(token, tokens more than before) of the encoding that ends with ``read``."""
        size = len(read) - 1
        for back, left, more in window:
            token = table.get(read[size - back:])
            if token is not None:
                if left < 0:
                    if self.stands(token):
                        return token, more + 1
                else:
                    fits = self.beside.get(left << 20 | token)
                    if self.may_follow(left, token) if fits is None else fits:
                        return token, more + 1
        raise AssertionError("no token ends here")

    def compile(self, state: int, byte: int) -> tuple[int, int]:
        """The transition of a state on a byte within a word: (next state, change in the number of tokens)."""
        suffix, window = self.states[state]
        read, begins, size = suffix + BYTES[byte], self.begins, len(suffix)
        token, more = self._last(read, window, self.plain)
        now = [(back + 1, t, n - more) for back, t, n in window if read[size - back:] in begins]
        now.append((0, token, 0))
        move = self.moves[state << 8 | byte] = (self.enter((read[size + 1 - now[0][0]:], tuple(now))), more)
        self.state_bytes += 150
        return move

    def compile_end(self, state: int, byte: int) -> int:
        """The change in the number of tokens on a word's last byte."""
        suffix, window = self.states[state]
        self.ends[state << 8 | byte] = more = self._last(suffix + BYTES[byte], window, self.ending)[1]
        self.state_bytes += 100
        return more

    def read(self, state: int, data: bytes) -> tuple[int, int]:
        """(state, tokens) after bytes within a word."""
        total = 0
        for at in range(0, len(data), 4096):
            moves = self.moves
            for byte in data[at:at + 4096]:
                state, more = moves.get(state << 8 | byte) or self.compile(state, byte)
                total += more
            if self.state_bytes > TABLE_BYTES:  # begin a new table with the state reached
                reached = self.states[state]
                self._no_states()
                state = self.enter(reached)
        return state, total

    def finish(self, state: int, data: bytes) -> int:
        """Tokens added by the rest of a word."""
        state, total = self.read(state, data[:-1])
        more = self.ends.get(state << 8 | data[-1])
        return total + (self.compile_end(state, data[-1]) if more is None else more)

    # -- words, pieces, texts ----------------------------------------------------------

    def word(self, word: str) -> int:
        found = self.words.get(word)
        if found is None:
            found = self.finish(0, word.encode())
            if len(word) <= LONG_WORD:
                self.words[word] = found
                self.word_bytes += 100 + len(word)
        return found

    def normal(self, text: str) -> list[str]:
        """The pre-tokens of a text without special strings."""
        if text.isascii():
            return self.ascii(text.lower())
        return self.find(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def piece(self, piece: str) -> int:
        """Tokens of a run without white space."""
        found = self.pieces.get(piece)
        if found is None:
            found = 0
            for k, part in enumerate(self.special.split(piece) if self.special and "<|" in piece else [piece]):
                found += 1 if k % 2 else sum(map(self.word, self.normal(part)))
            if len(piece) <= LONG_WORD:
                self.pieces[piece] = found
                self.word_bytes += 100 + len(piece)
        return found

    def text(self, text: str) -> int:
        known, total = self.pieces, 0
        for piece in self.cut(text):
            found = known.get(piece)
            total += self.piece(piece) if found is None else found
        return total

    def trim(self) -> None:
        if self.word_bytes > TABLE_BYTES:
            self.pieces.clear()
            self.words.clear()
            self.word_bytes = 0
        if self.state_bytes > TABLE_BYTES:
            self._no_states()
        if len(self.beside) * 100 > TABLE_BYTES:
            self.beside.clear()

    # -- chunks ------------------------------------------------------------------------------

    def cuts(self, text: str, chunk_chars: int) -> list[tuple[int, bool]]:
        """(place, within a word?) of the cuts of a text: the first safe place from each multiple of ``chunk_chars`` on."""
        taken = [m.span() for m in self.special.finditer(text)] if self.special and "<|" in text else []
        out, at, k = [], chunk_chars, 0
        while at < len(text):
            while k < len(taken) and taken[k][1] <= at:
                k += 1
            if k < len(taken) and taken[k][0] < at:
                at = taken[k][1]
                if at >= len(text):
                    break
                out.append((at, False))  # behind a special string
                at += chunk_chars
                continue
            kind = _border(text, at)
            if kind is None:
                at += 1
                continue
            out.append((at, kind))
            at += chunk_chars
        return out

    def chunk(self, text: str, entered: bool, left: bool, before: str) -> dict:
        """A chunk's state map. ``entered`` and ``left`` tell whether its ends lie within a word, ``before`` is the
        text just before it."""
        head = tail = None
        total = 0
        parts = self.special.split(text) if self.special and "<|" in text else [text]
        for k, part in enumerate(parts):
            if k % 2:
                total += 1
                continue
            pieces = self.cut(part)
            for j, piece in enumerate(pieces):
                first, last = entered and k == 0 and j == 0, left and k == len(parts) - 1 and j == len(pieces) - 1
                if not first and not last:
                    found = self.pieces.get(piece)
                    total += self.piece(piece) if found is None else found
                    continue
                words = self.normal(piece)
                if first:
                    head, words = words[0], words[1:]
                if last and words:
                    tail, words = words[-1], words[:-1]
                total += sum(map(self.word, words))
        through = entered and left and tail is None
        out = {"tokens": total, "head": b"" if head is None else head.encode(), "through": through, "exit": b"", "maps": []}
        if tail is not None:
            state, more = self.read(0, tail.encode())
            out["tokens"] += more
            out["exit"] = pack_state(self.states[state])
        if entered:
            run = self.normal(before)
            state, _ = self.read(0, run[-1].encode()) if run else (0, 0)
            out["maps"] = [self.map_of(self.states[state], out["head"], through)]
        return out

    def map_of(self, state: tuple, head: bytes, through: bool) -> tuple[bytes, bytes, int]:
        """(entry, exit, tokens) of a chunk's entered word for one entry state; the exit is empty if the word ends."""
        at = self.enter(state)
        if not through:
            return pack_state(state), b"", self.finish(at, head)
        end, more = self.read(at, head)
        return pack_state(state), pack_state(self.states[end]), more


def pack_state(state: tuple) -> bytes:
    suffix, window = state
    return np.array([len(window), *(x for entry in window for x in entry)], "<i4").tobytes() + suffix


def unpack_state(data: bytes) -> tuple:
    size = 3 * int.from_bytes(data[:4], "little")
    flat = np.frombuffer(data[4:4 + 4 * size], "<i4").tolist()
    return data[4 + 4 * size:], tuple(zip(flat[::3], flat[1::3], flat[2::3]))


def _letter(c: str) -> bool:
    return "a" <= c <= "z" or "A" <= c <= "Z"


def _steady(c: str) -> bool:
    """A letter without case and composition (ideographs and the like)."""
    return c > "\xff" and unicodedata.category(c) == "Lo" and not unicodedata.combining(c) and not unicodedata.decomposition(c)


def _mark(c: str) -> bool:
    return c in "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"


def _border(text: str, at: int) -> bool | None:
    """Is the place safe to cut at: False between words, True within one, None not safe."""
    p, q = text[at - 1], text[at]
    if q in " \t\n\r" or p in " \t\n\r" and q.isascii():
        return False
    if _letter(p) and _letter(q):
        return True if at >= 4 and all(map(_letter, text[at - 4:at])) else None  # clear of 's, 'll and so on
    if p.isascii() and q.isascii() and (p.isdigit() and (q.isdigit() or _letter(q)) or _letter(p) and q.isdigit()):
        return False
    if _mark(p) and _mark(q):
        return True
    if _steady(p) and _steady(q) and unicodedata.normalize("NFC", p + q) == p + q:
        return True
    return None


ROWS = "row long, doc_id long, n_bytes long, tokens long, no int, entered boolean, left boolean, before string, text string"
MAPS = "row long, no int, tokens long, entered boolean, through boolean, head binary, exit binary, maps array<struct<entry: binary, exit: binary, tokens: long>>"
ASKED = "row long, no int, entry binary, tokens long"


def _count_task(batches: Iterable[pa.RecordBatch], vocabulary: dict, chunk_chars: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) -> a row per document, with its tokens if it is short, and a row per chunk of long ones."""
    t, next_row = Transducer(vocabulary), TaskContext.get().partitionId() << 33
    for batch in batches:
        rows, size = [], 0
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py() or ""
            n_bytes = len(text) if text.isascii() else len(text.encode())
            cuts = t.cuts(text, chunk_chars) if len(text) > chunk_chars else []
            rows.append((next_row, doc_id, n_bytes, 0 if cuts else t.text(text), None, None, None, None, None))
            if cuts:
                edges = [(0, False), *cuts, (len(text), False)]
                for no, ((a, entered), (b, left)) in enumerate(zip(edges, edges[1:])):
                    before = text[max(0, a - GUESS_CHARS):a] if entered else ""
                    rows.append((next_row, None, None, 0, no, entered, left, before, text[a:b]))
                    size += b - a
                    if size > 1 << 24:
                        yield _rows_batch(rows)
                        rows, size = [], 0
            next_row += 1
            t.trim()
        if rows:
            yield _rows_batch(rows)


def _rows_batch(rows: list) -> pa.RecordBatch:
    types = [pa.int64()] * 4 + [pa.int32(), pa.bool_(), pa.bool_(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), types)],
                                      names=["row", "doc_id", "n_bytes", "tokens", "no", "entered", "left", "before", "text"])


def _maps_batch(rows: list) -> pa.RecordBatch:
    pair = pa.list_(pa.struct([("entry", pa.binary()), ("exit", pa.binary()), ("tokens", pa.int64())]))
    types = [pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary(), pa.binary(), pair]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), types)],
                                      names=["row", "no", "tokens", "entered", "through", "head", "exit", "maps"])


def _maps_list(maps: list) -> list[dict]:
    return [{"entry": a, "exit": b, "tokens": n} for a, b, n in maps]


def _map_task(batches: Iterable[pa.RecordBatch], vocabulary: dict) -> Iterator[pa.RecordBatch]:
    """(row, no, entered, left, before, text) -> the chunks' state maps."""
    t = Transducer(vocabulary)
    for batch in batches:
        for row, no, entered, left, before, text in zip(*(c.to_pylist() for c in batch.columns)):
            m = t.chunk(text, entered, left, before)
            yield _maps_batch([(row, no, m["tokens"], entered, m["through"], m["head"], m["exit"], _maps_list(m["maps"]))])
            t.trim()


def _ask_task(batches: Iterable[pa.RecordBatch], vocabulary: dict) -> Iterator[pa.RecordBatch]:
    """Map rows with a column ``asked`` of entry states: the rows with maps for those too."""
    t = Transducer(vocabulary)
    for batch in batches:
        for *fixed, head, exit_, maps, asked in zip(*(c.to_pylist() for c in batch.columns)):
            new = [t.map_of(unpack_state(a), head, fixed[4]) for a in asked or []]
            yield _maps_batch([(*fixed, head, exit_, maps + _maps_list(new))])
            t.trim()


def _scan_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Map rows sorted by (row, no) -> per row its tokens (entry null), or the states asked of chunks."""
    current, state, total, out, open_, leaves = None, b"", 0, [], False, set()

    def close() -> None:
        if current is not None and not open_:
            out.append((current, None, None, total))

    def batch_of() -> pa.RecordBatch:
        done = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.int32(), pa.binary(), pa.int64()))],
                                          names=["row", "no", "entry", "tokens"])
        out.clear()
        return done

    for batch in batches:
        for row, no, tokens, entered, through, exit_, maps in zip(*(c.to_pylist() for c in batch.columns)):
            if row != current:
                close()
                current, state, total, open_, leaves = row, b"", 0, False, set()
            known = {m["entry"]: (m["exit"], m["tokens"]) for m in maps}
            if entered:
                wanted = (leaves if open_ else {state}) - known.keys()
                if wanted:
                    out += [(row, no, w, None) for w in sorted(wanted)]
                    open_ = True
                elif not open_:
                    total += known[state][1]
                if through:
                    leaves = {e for e, _ in known.values()}
                    state = known[state][0] if not open_ else state
            if not through:
                state, leaves = exit_, {exit_}
            total += tokens
        if len(out) > 5000:
            yield batch_of()
    close()
    if out:
        yield batch_of()


def token_counts(docs: DataFrame, vocabulary_path: str, chunk_chars: int = CHUNK_CHARS, max_tokens: int = 2048,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of ``docs``."""
    v = docs.sparkSession.sparkContext.broadcast(load_vocabulary(vocabulary_path))
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    counted = materialise(slim.mapInArrow(lambda it: _count_task(it, v.value, chunk_chars), ROWS), "counted")
    whole, chunks = counted.where("no IS NULL").select("row", "doc_id", "n_bytes", "tokens"), counted.where("no IS NOT NULL")
    if not chunks.isEmpty():
        maps = materialise(chunks.select("row", "no", "entered", "left", "before", "text").repartition("row", "no")
                           .mapInArrow(lambda it: _map_task(it, v.value), MAPS), "state_maps")
        while True:
            scanned = materialise(maps.drop("head").repartition("row").sortWithinPartitions("row", "no").mapInArrow(_scan_task, ASKED), "scan")
            asked = scanned.where("entry IS NOT NULL").groupBy("row", "no").agg(F.collect_set("entry").alias("asked"))  # a few states a chunk
            if asked.isEmpty():
                break
            maps = materialise(maps.join(asked, ["row", "no"], "left").select(*maps.columns, "asked")
                               .mapInArrow(lambda it: _ask_task(it, v.value), MAPS), "state_maps")
        long = scanned.select("row", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("n_bytes"), "tokens")
        whole = whole.union(long).groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum("tokens").alias("tokens"))
    return whole.select("doc_id", "n_bytes", F.col("tokens").alias("n_tokens"), (F.col("tokens") > max_tokens).alias("over_limit"))
