"""The class model: counts and base by brute force, probabilities that sum to one, a better score than single words."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from accessaudit.llm import classlm as c


def tokens(text):
    text = "".join(x.lower() if "A" <= x <= "Z" else x for x in text or "")
    for x in "\t\n\x0b\x0c\r":
        text = text.replace(x, " ")
    return [w for w in text.split(" ") if w] + [None]


def held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 5 == 1


def base(rows):
    train = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(train.values()), len(train)
    out = []
    for i, t in rows:
        w = tokens(t)
        out.append((i, held(i), len(w), sum(train[x] > 0 for x in w), n, round(sum(math.log10((train[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), 6)))
    return out


def key(row):
    return tuple((v is not None, v) for v in row)


def made(seed=1, n=150):
    rng = random.Random(seed)
    nouns, verbs, ends = ([f"{a}{i}" for i in range(k)] for a, k in (("noun", 40), ("Verb", 30), ("é", 25)))
    rows = [(5000, None), (5001, ""), (5002, " \n"), (None, "noun1 Verb2 é3"), (5003, "unseen words only here"), (5004, "noun1 " * 4000)]
    for i in range(n):
        text = " ".join(f"{rng.choice(nouns)} {rng.choice(verbs)}\t{rng.choice(ends)}" for _ in range(rng.randint(0, 40)))
        rows.append((i, text + rng.choice(["", f" rare{i}"])))
    rows += [rows[9], rows[9], (rows[10][0], "another text")]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, word string")


def test_counts_base_and_a_better_model(spark, monkeypatch):
    monkeypatch.setattr(c, "CHUNK_TEXT", 900)
    monkeypatch.setattr(c, "ENTRIES", 5)
    rows = made()
    got = c.scored(frame(spark, rows), core_words=60, classes=8).collect()
    want = base(rows)
    names = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")
    assert sorted(((*(r[x] for x in names), round(r["base_score"], 6)) for r in got), key=key) == sorted(want, key=key)
    out = [r for r in got if r["held_out"] and r["n_tokens"] > 5]
    assert len(out) > 10
    assert sum(r["score"] for r in out) > 0.8 * sum(r["base_score"] for r in out)
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in got)


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(2)
    pairs = np.zeros((256, 256), np.int64)
    used = [1, 2, 3, 4, 2 | c.ONCE, 4 | c.ONCE]
    for a in used:
        for b in used:
            pairs[a, b] = rng.integers(0, 50)
    p = 10 ** c.log_transitions(pairs)
    for before in (1, 2, 3, 4, 100, c.UNKNOWN):
        assert abs(p[before].sum() - 1) < 1e-9


def test_exchange_never_lowers_the_likelihood():
    rng = np.random.default_rng(3)
    table = rng.integers(0, 4, (40, 40)) + 30 * (np.arange(40)[:, None] % 3 == (np.arange(40)[None, :] + 1) % 3)

    def likelihood(of):
        pairs = np.zeros((5, 5))
        np.add.at(pairs, (of[:, None].repeat(40, 1), of[None, :].repeat(40, 0)), table)
        return sum(c._xlogx(x).sum() * s for x, s in ((pairs, 1), (pairs.sum(0), -1), (pairs.sum(1), -1)))

    values = [likelihood(c.exchange(table, 2, 5, r)) for r in range(6)]
    assert all(b >= a - 1e-6 for a, b in zip(values, values[1:], strict=False))
    of = c.exchange(table, 2, 5, 20)
    groups = [{int(x) % 3 for x in range(2, 40) if of[x] == k} for k in range(2, 5)]
    assert sorted(map(sorted, groups)) == [[0], [1], [2]]


@pytest.mark.parametrize("rows", [[], [(1, "only held out" if held(1) else "a b")]])
def test_small_tables(spark, rows):
    got = c.scored(frame(spark, rows)).collect()
    assert len(got) == len(rows)


def test_nothing_to_train_on(spark):
    doc = next(i for i in range(100) if held(i))
    got = c.scored(frame(spark, [(doc, "a b c")])).collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got] == [(4, 0, 0, 0.0, 0.0)]


def classes_of(spark, rows, classed, held):
    """Class of each word, read back from the buckets."""
    out = {}
    lists = {r["bucket"]: c.zstandard.decompress(r["words"]).split(b"\n") for r in held.where("chunk = -1").collect()}
    for r in classed.collect():
        out |= dict(zip(lists[r["bucket"]], r["class"], strict=True))
    return out


def test_a_round_against_brute_force(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(c, "CHUNK_TEXT", 700)
    monkeypatch.setattr(c, "ENTRIES", 7)
    rows = made(4, 60)
    chunks = c.written(c.coded(frame(spark, rows).repartition(3)), str(tmp_path / "coded"))
    held = c.written(c.vocabulary(chunks, 16), str(tmp_path / "held"))
    lists, links = held.where("chunk = -1"), held.where("chunk >= 0").select("bucket", "chunk", "places")
    train = [[(w or "").encode() for w in tokens(t)] for i, t in rows if not held_out(i)]
    count = Counter(w for t in train for w in t)
    assert c.most_frequent(lists, 20) == [w for _, w in sorted((-n, w) for w, n in count.items() if w)][:20]
    start = {b"": 1} | {w: 2 + i % 5 for i, w in enumerate(sorted(count)[1:]) if i % 3}
    classed = c.written(c.first_classes(lists, start), str(tmp_path / "classes"))
    known = classes_of(spark, rows, classed, held)
    assert all(known[w] == start.get(w, 0) for w in count) and all(known[w] == 127 for w in known if w not in count)
    told = c.written(c.beside(chunks, c.answers(links, classed)), str(tmp_path / "told"))
    pairs, seen = np.zeros((7, 7)), {w: np.zeros((2, 7)) for w in count}
    for t in train:
        of = [1, *[known[w] for w in t], 1]
        for i, w in enumerate(t):
            pairs[of[i], of[i + 1]] += 1
            seen[w][0, of[i]] += 1
            seen[w][1, of[i + 2]] += 1
    assert (c._class_pairs(told, 7) == pairs).all()
    logs = np.log((pairs + 0.1) / (pairs + 0.1).sum(axis=1, keepdims=True))
    for unplaced in (True, False):
        got = classes_of(spark, rows, c.moved(links, classed, told, pairs, unplaced), held)
        for w in count:
            value = seen[w][0] @ logs + logs @ seen[w][1] - count[w] * np.log(np.maximum(pairs.sum(axis=0), 1))
            value[:2] = -np.inf
            stays = w == b"" or (unplaced and known[w] != 0)
            assert got[w] == known[w] if stays else value[got[w]] >= value.max() - 1e-6


def held_out(doc):
    return held(doc)


def test_rounds_raise_the_likelihood_and_cover_all_words(spark):
    report = []
    one = [r for r in c.scored(frame(spark, made(5)), core_words=10, classes=8, rounds=1).collect() if r["held_out"]]
    more = [r for r in c.scored(frame(spark, made(5)), core_words=10, classes=8, rounds=4, report=report).collect() if r["held_out"]]
    kept = report[:-1] if report[-1] < report[-2] else report
    assert all(b > a for a, b in zip(kept[1:], kept[2:], strict=False))
    assert sum(r["score"] for r in more) > sum(r["score"] for r in one)


def test_many_rows_of_one_id_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(c, "CHUNK_TEXT", 5000)
    train = next(i for i in range(100) if not held(i))
    rows = [(train, f"a b{i % 7}") for i in range(3000)] + [(train, "c d " * 20000)]
    got = c.scored(frame(spark, rows)).collect()
    assert sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in got)) == sorted(
        (*r[:5], round(r[5], 5)) for r in base(rows)
    )
