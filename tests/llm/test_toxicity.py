"""The toxicity classifier: features and ratios by hand, held-out accuracy, odd rows."""

import random
import zlib

import numpy as np

from accessaudit.llm import toxicity as t


def made(seed=1, n=500):
    rng = random.Random(seed)
    say = lambda k: [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.choice(['n', 'st', 'r'])}" for _ in range(k)]
    docs, labels = [], []
    for i in range(n):
        words, bad = say(rng.randint(5, 60)), rng.random() < 0.2
        if bad:
            words[rng.randrange(len(words))] = rng.choice(["zwollux", "zwolla", "Zwolles"]) + rng.choice(["", "en"])
        docs.append((i, " ".join(words), "en"))
        labels.append((i, int(bad)))
    return docs, labels


def frames(spark, docs, labels):
    return spark.createDataFrame(docs, "doc_id long, text string, toxic string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_features_are_the_distinct_grams():
    def slow(text):
        text = f" {text.lower()} "
        out = set()
        for n in t.GRAMS:
            for i in range(len(text) - n + 1):
                h = ord(text[i]) + 1
                for c in text[i + 1 : i + n]:
                    h = (h * 0x9E3779B97F4A7C15 + ord(c) + 1) % (1 << 64)
                out.add(((h ^ (h >> 29)) * 0xBF58476D1CE4E5B9) % (1 << 64) >> (64 - t.BITS))
        return sorted(out)

    for text in ("", "a", "ab", "Abé abé abé", "x" * 50, "\U0001f600 smile"):
        assert t.features(text).tolist() == slow(text)
    assert t.features("a\nb").tolist() == t.features("a b").tolist()


def test_counts_cover_all_rows(spark):
    docs, labels = made(2, 60)
    rows = spark.createDataFrame([(x[1], y[1]) for x, y in zip(docs, labels, strict=True)], "text string, toxic int")
    toxic, other = t.count_features(rows)
    want = np.zeros((2, (1 << t.BITS) + 1), np.int64)
    for (_, text, _), (_, y) in zip(docs, labels, strict=True):
        want[y, t.features(text)] += 1
        want[y, -1] += 1
    assert (toxic == want[1]).all() and (other == want[0]).all()


def test_held_out_rows_are_told_apart(spark):
    docs, labels = made(1, 1500)
    got = t.toxicity(*frames(spark, docs, labels)).collect()
    assert len(got) == len(docs)
    truth = dict(labels)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert r["predicted"] == int(r["score"] >= 0.7) and 0 <= r["score"] <= 1
    held = [(r["predicted"], truth[r["doc_id"]]) for r in got if r["held_out"]]
    assert sum(a == b for a, b in held) / len(held) > 0.97


def test_labels_of_held_out_rows_are_not_learned(spark):
    docs, labels = made(3, 200)
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, y in labels]
    one, two = (t.train(*frames(spark, docs, x)) for x in (labels, flipped))
    assert (one.weights == two.weights).all() and one.bias == two.bias


def test_odd_rows(spark):
    docs, labels = made(4, 120)
    docs += [(None, docs[0][1], None), (900, None, None), (901, "", None), (902, "x" * 200_000, None), docs[5], docs[5]]
    labels += [(None, 1), (0, None), (3, 7), (12345, 1), labels[7], labels[7]]
    d, l = frames(spark, docs, labels)
    got = t.toxicity(d, l).collect()
    assert len(got) == len(docs)
    score = {r["doc_id"]: r["score"] for r in got}
    assert score[900] == score[901]
    kept = t.without_toxic(d, l)
    assert kept.columns == d.columns
    assert kept.count() == sum(r["score"] < 0.7 for r in got)


def test_no_labels_and_no_documents(spark):
    docs, _ = made(5, 10)
    d, l = frames(spark, docs, [])
    assert {r["score"] for r in t.toxicity(d, l).collect()} == {0.5}
    d, l = frames(spark, [], [(1, 1)])
    assert t.toxicity(d, l).collect() == []
