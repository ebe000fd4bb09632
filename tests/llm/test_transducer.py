"""The transducer's states, its chunk maps and their composition against the tokenizers library."""

import random

import pytest
from tokenizers import Tokenizer

from ratecraft.llm import fst_tokens
from ratecraft.llm.queries import WORD_BPE


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD_BPE)


@pytest.fixture(scope="module")
def transducer():
    return fst_tokens.Transducer(fst_tokens.load_vocabulary(WORD_BPE))


def _texts(rng, n):
    alphabets = ["ab", "aeiou", "thesandwor", "abcdefghijklmnopqrstuvwxyz", "!?.", "é è", "a1b2 ", "'sltdve a", "漢字仮名", "𝒳ΑΣσ "]
    out = ["".join(rng.choices(rng.choice(alphabets), k=rng.randint(1, 150))) for _ in range(n)]
    return out + [f"{a}<|endoftext|>{b}" for a, b in zip(out[:50], out[50:100])]


def test_words_and_texts_equal_the_library(library, transducer):
    texts = _texts(random.Random(1), 1500)
    assert [transducer.text(t) for t in texts] == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("chunk", [1, 3, 7, 50])
def test_maps_compose_wherever_the_text_is_cut(library, transducer, chunk):
    within = 0
    for text in _texts(random.Random(chunk), 300):
        cuts = transducer.cuts(text, chunk)
        edges, total, state = [(0, False), *cuts, (len(text), False)], 0, None
        for (a, entered), (b, left) in zip(edges, edges[1:]):
            m = transducer.chunk(text[a:b], entered, left, text[max(0, a - fst_tokens.GUESS_CHARS):a] if entered else "")
            if entered:
                within += 1
                known = {e: (x, n) for e, x, n in m["maps"]}
                if state not in known:
                    e, x, n = transducer.map_of(fst_tokens.unpack_state(state), m["head"], m["through"])
                    known[e] = (x, n)
                total += known[state][1]
                state = known[state][0] if m["through"] else state
            if not m["through"]:
                state = m["exit"]
            total += m["tokens"]
        assert total == len(library.encode(text, add_special_tokens=False).ids), text
    assert within > 200


def test_states_pack_and_tables_may_be_emptied_anywhere(library, monkeypatch):
    t = fst_tokens.Transducer(fst_tokens.load_vocabulary(WORD_BPE))
    text = "".join(random.Random(3).choices("abcdefghij", k=30_000))
    want = len(library.encode(text, add_special_tokens=False).ids)
    assert t.text(text) == want
    assert all(fst_tokens.unpack_state(fst_tokens.pack_state(s)) == s for s in t.states[:2000])
    monkeypatch.setattr(fst_tokens, "TABLE_BYTES", 1 << 20)
    t.trim()
    assert t.text(text) == want and t.state_bytes < 8 << 20
    t.trim()
    assert len(t.states) < 20_000


def test_long_words_are_counted_in_several_tasks(spark, library):
    rng = random.Random(4)
    texts = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=300_000)), "a" * 200_001, "ab" * 90_000 + "!", "!?" * 70_000,
             "漢" * 50_000, "é" * 30_000, "'" * 40_000, "x y " * 20_000, "short", "12345" * 20_000, None, "<|endoftext|>" * 4000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[1]), (0, texts[0])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r.doc_id, r.n_tokens) for r in fst_tokens.token_counts(df, WORD_BPE, chunk_chars=20_000).collect()), key=repr)
    assert got == sorted(((i, len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows), key=repr)


def test_a_vocabulary_without_bytes_is_an_error(tmp_path):
    path = tmp_path / "v.json"
    path.write_text('{"model": {"vocab": {"a": 0}, "merges": [], "end_of_word_suffix": "</w>"}, "added_tokens": []}')
    with pytest.raises(ValueError):
        fst_tokens.load_vocabulary(str(path))


def test_no_documents(spark):
    assert fst_tokens.token_counts(spark.createDataFrame([], "doc_id long, text string"), WORD_BPE).count() == 0
