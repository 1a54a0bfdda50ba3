"""Benchmark passages against a brute-force version."""

import hashlib
import math
import random
import re

import pytest

from accessaudit.llm import contamination as c


def tokens(text):
    lowered = "".join(x.lower() if "A" <= x <= "Z" else x for x in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, window=13):
    out = []
    for doc, text in docs:
        words, hit, found = tokens(text), set(), set()
        for item, passage in items:
            want = tokens(passage)
            n = min(window, len(want))
            for i in range(len(want) - n + 1) if want else ():
                for p in range(len(words) - n + 1):
                    if words[p : p + n] == want[i : i + n]:
                        hit.update(range(p, p + n))
                        found.add(item)
        found = sorted(str(i) for i in found if i is not None)
        digest = hashlib.sha256(",".join(found).encode()).hexdigest()
        out.append((doc, len(words), len(hit), len(found), digest, len(hit) > 0 and 20 * len(hit) >= len(words)))
    return out


def key(row):
    return tuple((v is not None, v) for v in row)


def check(spark, docs, items, window=13):
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, words int")
    i = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items, window)
    found = c.contamination(d, i, window)
    assert sorted((tuple(r)[:6] for r in found.collect()), key=key) == sorted(want, key=key)
    clean = [(r["doc_id"], r["text"]) for r in c.clean_documents(d, i, window).collect()]
    assert sorted(clean, key=key) == sorted((r for r, w in zip(docs, want, strict=True) if not w[5]), key=key)
    return want


def made():
    rng = random.Random(4)
    vocabulary = [f"{a}{b}" for a in "abcé7" for b in ("x", "yß", "z", "")]
    say = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    join = lambda w: "".join(x + rng.choice([" ", ", ", "\n", "-", "_"]) for x in w)
    items = [(i, join(say(rng.choice([1, 3, 12, 13, 14, 40]) if i != 4 else 14))) for i in range(30)]
    items += [(100, items[5][1]), (101, "..."), (102, None), (103, ""), (None, items[5][1].upper().replace("É", "é").replace("SS", "ß")), (104, "the " * 20), (2, items[5][1])]
    docs = [(1, None), (2, ""), (3, "., !"), (4, "the " * 200), (5, "?" + items[9][1] + "!"), (None, items[3][1])]
    for i in range(10, 70):
        parts = say(rng.randint(0, 60))
        for _ in range(rng.randint(0, 2)):
            source = tokens(rng.choice(items)[1])
            at = rng.randint(0, max(0, len(source) - 13))
            parts += source[at : at + rng.randint(10, 20)] + say(rng.randint(0, 200))
        docs.append((i, join(parts)))
    docs.append((8, "zzz " * 400 + items[4][1] + "yyy " * 100))
    docs += [docs[-1], (docs[-1][0], docs[-2][1]), docs[5]]
    return docs, items


def test_against_brute_force(spark):
    want = check(spark, *made())
    assert {w[5] for w in want} == {True, False}
    assert any(w[2] and not w[5] for w in want)


def test_without_broadcasts_and_other_window(spark, monkeypatch):
    monkeypatch.setattr(c, "hinted", lambda df: df)
    docs, items = made()
    check(spark, docs[:40], items, 5)


@pytest.mark.parametrize("docs,items", [([], [(1, "a b")]), ([(1, "a b")], []), ([], [])])
def test_empty_tables(spark, docs, items):
    check(spark, docs, items)


def test_no_python_in_the_plan(spark):
    docs, items = made()
    df = c.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def brute_near(docs, items, window, span, share):
    """Every window of every item against every span of every document."""
    out = set()
    for doc, text in docs:
        held = tokens(text)
        for item, passage in items:
            want = tokens(passage)
            n, best = min(window, len(want)), None
            for i in range(len(want) - n + 1) if want and item is not None else ():
                terms = set(want[i : i + n])
                for p in range(len(held)):
                    found = len(terms & set(held[p : p + span]))
                    if found >= max(1, math.ceil(len(terms) * share)):
                        best = max(best or (0,), (found, -i, -p, len(terms)))
            if best:
                out.add((doc, text or "", str(item), -best[1], -best[2], best[0], best[3]))
    return sorted(((d, *r) for d, _, *r in out), key=key)


def check_near(spark, docs, items, window=13, span=26, share=0.8):
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, place int")
    i = spark.createDataFrame(items, "item_id long, text string")
    got = [tuple(r[c] for c in ("doc_id", "item_id", "place", "start", "n_found", "n_terms")) for r in c.near_passages(d, i, window, span, share).collect()]
    want = brute_near(docs, items, window, span, share)
    assert sorted(got, key=key) == want
    return want


@pytest.mark.parametrize("window,span,share", [(13, 26, 0.8), (5, 7, 0.6), (4, 4, 1.0), (6, 20, 0.5)])
def test_near_passages_against_brute_force(spark, window, span, share):
    docs, items = made()
    assert check_near(spark, docs[:3] + docs[4:24] + docs[-3:], items[3:14] + items[-7:], window, span, share)


def test_reworded_passages(spark, monkeypatch):
    monkeypatch.setattr(c, "hinted", lambda df: df)
    rng = random.Random(9)
    plain = [f"w{i}" for i in range(400)]
    item = [f"t{i}" for i in range(60)]
    changed = [w if i % 12 else "other" for i, w in enumerate(item)]
    longer = [x for i, w in enumerate(item) for x in ([w] if i % 12 else [w, "more"])]
    shorter = [w for i, w in enumerate(item) if i % 12]
    docs = [(n, " ".join(rng.sample(plain, 90) + text + rng.sample(plain, 90))) for n, text in enumerate([changed, longer, shorter, item[::-1], item[::6], []])]
    items = [(7, " ".join(item)), (8, " ".join(plain[:5]) + " never seen words here at all")]
    assert {r[0] for r in check_near(spark, docs, items) if r[1] == "7"} == {0, 1, 2, 3}
    exact = c.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert not exact.where("n_hit > 0 and doc_id in (0, 1, 2)").count()


@pytest.mark.parametrize("docs,items", [([], [(1, "a b")]), ([(1, "a b")], []), ([(1, None)], [(1, None)])])
def test_near_passages_of_empty_tables(spark, docs, items):
    check_near(spark, docs, items)
