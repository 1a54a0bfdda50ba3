"""SimHash components against all pairs."""

import random

import numpy as np
import pytest
import xxhash

from accessaudit.llm import simhash


def slow_print(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, distance=4):
    prints = [slow_print(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                parent[root(i)] = root(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((doc, f"{prints[i]:016x}", min(ids, default=None)))
    return out


def key(row):
    return tuple((v is not None, v) for v in row)


def made(seed, n):
    rng = random.Random(seed)
    base = [" ".join(rng.choice("Of the And é to in is ß was").strip() + str(rng.randint(0, 40)) for _ in range(120)) for _ in range(6)]
    rows = [(5, None), (3, ""), (90, " \t\n"), (None, base[0]), (None, "no id"), (6, "one"), (7, "One\x0btwo"), (8, "one two")]
    for i in range(100, 100 + n):
        words = rng.choice(base).split(" ")
        for _ in range(rng.choice([0, 0, 1, 2, 5, 60])):
            words[rng.randrange(len(words))] = str(rng.random())
        rows.append((i, rng.choice([" ", "\n", "\x0c"]).join(words)))
    rows += [rows[-1], (rows[-1][0], "another text of that id"), (rows[-2][0], rows[-3][1])]
    rng.shuffle(rows)
    return rows


def test_components(spark):
    rows = made(1, 90)
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, bits string")
    got = [tuple(r) for r in simhash.near_copies(df).collect()]
    want = brute(rows)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert len({r[2] for r in want}) < len({r[1] for r in want})


def test_hot_parts_are_split(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HOT", 8)
    rows = made(2, 70)
    got = [tuple(r) for r in simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_copies(df).collect() == []
    assert simhash.one_of_each(df).collect() == []


def test_one_of_each_keeps_the_smallest(spark):
    rows = [(4, "a b c d e"), (2, "a b c d e"), (2, "a b c d e"), (9, "f g h i j k"), (None, "a b c d e")]
    got = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0) for r in got) == [0, 2, 9]


@pytest.mark.parametrize("distance", [0, 2, 4])
@pytest.mark.parametrize("steps", [3, 1 << 19])
def test_index_finds_all_links(distance, steps, monkeypatch):
    monkeypatch.setattr(simhash, "STEPS", steps)
    rng = np.random.default_rng(3)
    prints = np.unique(rng.integers(0, 1 << 63, 12, dtype=np.uint64)[rng.integers(0, 12, 300)] ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)))
    for mask in (0, 0xFF00, (1 << 64) - 1 << 40 & (1 << 64) - 1):
        index = simhash.GrayIndex(prints, mask)
        got = {(int(index.prints[i]), int(index.prints[j])) for a, b in index.links(distance) for i, j in zip(a, b, strict=True)}
        got = {tuple(sorted(p)) for p in got}
        want = {
            tuple(sorted((int(a), int(b))))
            for n, a in enumerate(prints)
            for b in prints[:n]
            if int(a ^ b).bit_count() <= distance and not int(a ^ b) & mask
        }
        assert got == want


@pytest.mark.parametrize("distinct", [10, 10**6, 10**9, 10**12])
def test_schemes_cover_every_pair_within_the_distance(distinct):
    masks, bits = simhash._schemes(4, distinct)
    rng = random.Random(1)
    for _ in range(300):
        differ = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(not differ & m for m in masks)
    assert bits <= min(m.bit_count() for m in masks)


def test_chains_become_one_component(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7)]
    got = {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert got == {**{i: 0 for i in range(41)}, 90: 90, 95: 90, 100: 90}


def test_one_of_each_keeps_every_text(spark):
    a, b = "a b c d e f g h", "quite different words stand in here now"
    rows = [(3, a), (5, a), (5, b), (None, "x y z u v w"), (None, "x y z u v w"), (7, None), (8, "")]
    got = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in got) == [(0, "x y z u v w"), (3, a), (5, b), (7, "")]


def test_one_id_in_two_components_stays_in_both(spark):
    a, b = "a b c d e f g h", "quite different words stand in here now"
    rows = [(5, a), (5, b), (6, a), (6, b)]
    got = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(tuple(r) for r in got) == [(5, a), (5, b)]
