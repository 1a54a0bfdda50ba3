"""Best-two-fit packing: ids against the library, the plan against brute force and a lower bound."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from accessaudit.llm import packing
from accessaudit.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string"


def cut(n, capacity):
    first = n % capacity or capacity
    return [first] + [capacity] * ((n - first) // capacity)


def one_by_one(lengths, capacity):
    """The method, one sequence at a time over a plain list of lengths."""
    left, out = sorted(lengths, reverse=True), []
    while left:
        taken, gap = [], capacity
        for n in list(left):
            if n <= gap:
                taken.append(n)
                left.remove(n)
                gap -= n
        small = taken[-1]
        if gap and len(taken) > 1:
            free = [*left, small]
            pairs = [(a + b, max(a, b)) for i, a in enumerate(free) for b in free[:i] if small < a + b <= gap + small]
            if pairs:
                total, a = max(pairs)
                left.append(taken.pop())
                for n in (a, total - a):
                    left.remove(n)
                    taken.append(n)
                left.sort(reverse=True)
        out.append(sorted(taken))
    return out


def contents(counts, capacity):
    plan = packing.plan(counts, capacity)
    length = np.repeat(list(counts), list(counts.values())).astype(int)
    number = np.concatenate([np.arange(c) for c in counts.values()] or [np.zeros(0, int)])
    sequence, offset = plan.place(length, number)
    held = {}
    for s, o, n in sorted(zip(sequence.tolist(), offset.tolist(), length.tolist(), strict=True)):
        assert o == sum(held.get(s, []))  # gapless, in the order of the offsets
        held.setdefault(s, []).append(n)
    assert sorted(held) == list(range(plan.sequences))
    return list(held.values())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 14), max_size=40))
def test_plan_equals_the_method_one_by_one(lengths):
    found = contents(Counter(lengths), 14)
    assert Counter(tuple(sorted(x)) for x in found) == Counter(tuple(x) for x in one_by_one(lengths, 14))
    assert all(sum(x) <= 14 for x in found)


def test_the_smallest_gives_way_to_two_that_fit_better():
    assert sorted(map(sorted, contents({6: 1, 3: 1, 2: 2}, 10))) == [[2, 2, 6], [3]]


def test_plan_is_close_to_the_lower_bound_and_small():
    rng = random.Random(5)
    lengths = [min(2048, 1 + int(rng.expovariate(1 / 500))) for _ in range(30_000)]
    counts = Counter(lengths)
    plan = packing.plan(counts)
    assert plan.sequences <= -(-sum(lengths) // 2048) * 1.002
    assert len(packing.plan({n: 1000 * c for n, c in counts.items()}).length) < 4 * len(plan.length)


def test_lengths_beyond_the_capacity_are_refused():
    with pytest.raises(ValueError):
        packing.plan({11: 1}, 10)


def test_ids_equal_the_library():
    whole, own = Tokenizer.from_file(PATH), packing.encoder(PATH)
    assert own.fast is not None
    every = [chr(c) for c in range(1, 0x3000)] + [chr(c) for c in range(0x3000, 0x110000, 97) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}b {c}{c} 1{c}\n {c}  {c}'s" for c in every]
    texts += ["", " ", "\n\n  x", "don't I'LL", "<|endoftext|>x", "a" * 40_000, " " * 40_000 + "b", "x1!" * 9000, "Ünï 漢字 🙂 " * 50]
    for text, found in zip(texts, whole.encode_batch(texts, add_special_tokens=False), strict=True):
        assert own.encode(text).tolist() == found.ids, text[:20]


def test_other_files_are_left_to_their_library():
    other = packing.encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert other.fast is None
    assert other.encode("Hello there").tolist() == other.whole.encode("Hello there", add_special_tokens=False).ids


def checked(rows, docs, capacity):
    whole = Tokenizer.from_file(PATH)
    expected = Counter()
    for doc, text in docs:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 0]
        start = 0
        for n, size in enumerate(cut(len(ids), capacity)):
            part = np.array(ids[start : start + size], "<u4").tobytes()
            expected[(doc, n, start, size, zlib.crc32(part))] += 1
            start += size
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected
    held = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == held.get(r["sequence_id"], 0)
        held[r["sequence_id"]] = r["offset"] + r["length"]
    assert all(n <= capacity for n in held.values())
    return held


def test_rows_of_every_kind(spark):
    docs = [(1, "one two three"), (1, "one two three"), (1, "other"), (None, "no id"), (None, None), (4, None), (5, ""), (6, "long text " * 3000), (7, "x" * 50_000)]
    table = spark.createDataFrame(docs, SCHEMA).withColumns({c: F.lit("own") for c in ("ids", "piece", "task", "place", "before", "at", "length", "sequence_id")})
    found = packing.packed(table, PATH, 64)
    held = checked(found.withColumn("ids_crc32", F.crc32("ids")).collect(), docs, 64)
    assert len(held) == -(-sum(held.values()) // 64)
    made = packing.sequences(found)
    assert {r["sequence_id"]: r["n_tokens"] for r in made.collect()} == held
    assert all(len(r["ids"]) == 4 * r["n_tokens"] == 4 * sum(r["lengths"]) for r in made.collect())
    assert packing.packed(table.limit(0), PATH).count() == 0


def test_one_length_in_many_tasks(spark):
    docs = spark.range(0, 20_000, 1, 16).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "same").alias("text"))
    rows = packing.packed(docs, PATH, 32).collect()
    places = Counter((r["sequence_id"], r["offset"]) for r in rows)
    assert len(rows) == 20_000 and set(places.values()) == {1}
    assert len({r["sequence_id"] for r in rows}) == -(-sum(r["length"] for r in rows) // 32)


def test_the_query(spark, data):
    docs = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    held = checked(QUERIES["op13_packing"](spark, data).collect(), docs, 2048)
    assert len(held) <= -(-sum(held.values()) // 2048) + 1
