"""Token files: exact round trips, and ids equal to the tokenizer's own."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from accessaudit.llm import tokenfiles as t

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 1 << 17), st.integers(0, (1 << 64) - 1)), max_size=2500))
def test_words_give_the_ids_back(ids):
    packed = t.encode_ids(np.array(ids, np.uint64))
    assert t.decode_ids(*packed, len(ids)).tolist() == ids


def test_small_ids_share_words():
    assert len(t.encode_ids(np.ones(6000, np.uint64))[0]) < 120
    assert len(t.encode_ids(np.arange(30000, 33000))[0]) < 1005


@pytest.mark.parametrize("n", [1, t.BLOCK - 1, t.BLOCK, t.BLOCK + 1, 3 * t.BLOCK + 37])
def test_words_are_filled_first_come_first_packed(n):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, 1 << 40, n, dtype=np.uint64) >> rng.integers(0, 41, n, dtype=np.uint64)
    ids[::29] = 0
    ids[:: t.BLOCK - 1] = (1 << 64) - 1
    words, offsets, escapes, held = [], [], [], ids.tolist()
    for low in range(0, n, t.BLOCK):
        offsets.append(len(words))
        at, high = low, min(low + t.BLOCK, n)
        while at < high:
            fit = lambda s: all(x.bit_length() <= t.WIDTHS[s] for x in held[at : min(at + t.COUNTS[s], high)])  # noqa: B023, E731
            s = next((s for s in range(1, len(t.COUNTS)) if fit(s)), 0)
            part = held[at : min(at + int(t.COUNTS[s]), high)] if s else [len(escapes)]
            escapes += [] if s else held[at : at + 1]
            words.append(s << 60 | sum(x << i * int(t.WIDTHS[s]) for i, x in enumerate(part)))
            at += int(t.COUNTS[s])
    assert [x.tolist() for x in t.encode_ids(ids)] == [words, offsets, escapes]


def test_latin_texts_are_looked_over_and_spelled_without_the_library():
    made = t.Encoder(PATH)
    kinds = made._kinds("".join(map(chr, range(256))))
    assert {chr(n) for n in range(256) if kinds[n] == ord("m")} == {c for c in map(chr, range(256)) if not (c.isalnum() or c.isspace() or c == "_")}
    assert [n for n in range(256) if kinds[n] == ord("o")] == [28, 29, 30, 31] and kinds[ord("_")] == ord("_")
    assert made._kinds("日") is None
    texts = ["Ça va, über_all!? x--y.", "na\u00efve\u00a0\u00ad\u0085caf\u00e9's (a) b...", "µ ²½ ª\x00\x7f", "ÀÉ,ÿ."]
    want = [t.encoder(PATH).whole.encode(x, add_special_tokens=False).ids for x in texts]
    made.whole = made.odd = None
    assert [np.frombuffer(made.encode(x), "<u4").tolist() for x in texts] == want


@settings(max_examples=80, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t'stremdlL\x1c\x85\xa0ßİΣ<|>")), max_size=60))
def test_cached_ids_are_the_tokenizer_s(text):
    want = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(t.encoder(PATH).encode(text), "<u4").tolist() == want


def brute(rows):
    whole, out, start = Tokenizer.from_file(PATH), [], 0
    made = []
    for doc, text in rows:
        made.append((doc is None, doc or 0, [*whole.encode(text or "", add_special_tokens=False).ids, 2]))
    for none, doc, ids in sorted(made):
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        out.append((None if none else doc, start, len(ids), crc))
        start += len(ids)
    return out


def test_table(spark, monkeypatch):
    monkeypatch.setattr(t, "FRAME_IDS", 300)
    monkeypatch.setattr(t, "FILE_BYTES", 20_000)
    monkeypatch.setattr(t, "MIN_FILES", 3)
    rng = random.Random(2)
    say = lambda n: " ".join(rng.choice(["The", "don't", "über", "x1y2", "naïve!", "日本", "Ω", "<|endoftext|>", "\n\n"]) for _ in range(n))
    rows = [(i * 7, say(rng.randint(0, 90))) for i in range(80)]
    rows += [(5, None), (6, ""), (None, "no id"), (None, "no id"), (14, "again"), (14, "again"), (14, "other"), (9999, say(5000))]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, file int")
    got = [tuple(r) for r in t.token_table(df, PATH).collect()]
    same = lambda r: (r[1], r[0] is None, r[0] or 0)
    want = brute(rows)
    assert len(got) == len(want)
    assert sorted(r[2:] for r in got) == sorted(r[2:] for r in want)
    assert [(r[0], r[1]) for r in sorted(got, key=same) if r[0] != 14] == [(r[0], r[1]) for r in want if r[0] != 14]


def test_empty_table(spark):
    assert t.token_table(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def test_broken_files_are_told():
    with pytest.raises(ValueError):
        list(t.frames(b"something else"))
