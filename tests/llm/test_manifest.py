"""The manifest against a plain tree over sorted leaves, its bitmaps against plain ranks."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from accessaudit.llm import manifest as m
from accessaudit.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def said(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, text):
    return sha(*(said(row[c]) for c in ("doc_id", "source", "lang", "n_chars")), said(text))


def tree(nodes):
    """All levels, lowest first."""
    held = [nodes]
    while len(held[-1]) > 1:
        last = held[-1]
        held.append([sha(*last[i : i + 3]) for i in range(0, len(last), 3)])
    return held


def way(held, at):
    out = []
    for level in held[:-1]:
        run = level[at - at % 3 : at - at % 3 + 3]
        out.append((at % 3, run[: at % 3] + run[at % 3 + 1 :]))
        at //= 3
    return out


def brute(rows):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row, as a multiset."""
    groups = {}
    for row in rows:
        groups.setdefault(row["source"], []).append((row["doc_id"] is None, row["doc_id"] or 0, leaf(row, row["text"]), row))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    held = {s: tree([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in names}
    top = tree([held[s][-1][0] for s in names])
    out = Counter()
    for turn, s in enumerate(names):
        for at, (none, _, own, row) in enumerate(sorted(groups[s], key=lambda x: x[:3])):
            steps = way(held[s], at) + way(top, turn)
            text = row["text"]
            if not none and zlib.crc32(str(row["doc_id"]).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            node = leaf(row, text)
            for place, others in steps:
                node = sha(*others[:place], node, *others[place:])
            proof = sha(*(x for _, others in steps for x in others))
            out[(row["doc_id"], own, held[s][-1][0], top[-1][0], proof, node, node == top[-1][0])] += 1
    return out


def found(df):
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return Counter(tuple(r[c] for c in names) for r in df.collect())


def tampered():
    change = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return change, F.regexp_replace("text", "\n", "")


def judged(spark, rows, schema=SCHEMA, extra=True):
    table = spark.createDataFrame(rows, schema)
    if extra:
        table = table.withColumns({c: F.lit("own") for c in ("leaf", "found", "pos", "high", "n", "path", "root", "block", "deal", "total")})
    return m.checked(table, *tampered())


def records(*rows):
    return [dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r, strict=True)) for r in rows]


def corpus(n, sources, seed=3, spread=1):
    rng = random.Random(seed)
    return records(*((i * spread, rng.choice(["a\nb", "plain", "", None, "x" * 50]) and f"{i} \n" * (i % 3), "de", rng.choice(sources), i) for i in range(n)))


@pytest.mark.parametrize("n", [1, 10])
def test_one_source_alone(spark, n):
    rows = corpus(n, ["one"])
    assert found(judged(spark, rows)) == brute(rows)


def test_sources_of_many_sizes(spark):
    sizes = {"a": 1, "ä": 2, "Z": 3, "": 4, None: 5, "zz": 9, "\U0001f642": 10, "\uffee": 27, "b": 28, "c": 82}
    rows = [row | {"doc_id": row["doc_id"] * 11 + i} for i, (s, n) in enumerate(sizes.items()) for row in corpus(n, [s], i)]
    assert found(judged(spark, rows)) == brute(rows)


def test_many_arrays_and_rounds(spark, monkeypatch):
    monkeypatch.setattr(m, "LEVELS", 2)
    monkeypatch.setattr(m, "BLOCK", 9)
    rows = corpus(900, ["a"] * 30 + ["b"] * 4 + [f"s{i}" for i in range(40)])
    assert found(judged(spark, rows)) == brute(rows)


def test_ids_that_repeat_and_that_are_missing(spark, monkeypatch):
    monkeypatch.setattr(m, "DEALT", 50)
    rng = random.Random(9)
    rows = corpus(60, ["a", None], spread=1 << 40)
    rows += records(*((7, f"text\n{rng.randint(0, 60)}", "en", "a", 1) for _ in range(300)))
    rows += records(*((None, f"text {rng.randint(0, 40)}", None, rng.choice(["a", None]), None) for _ in range(120)))
    rows += records(*((i, "same", None, "a", None) for i in (-(2**63), 2**63 - 1, -1, -1, -8193, 0, 8191, 8192)))
    assert found(judged(spark, rows)) == brute(rows)


def test_no_rows(spark):
    assert judged(spark, []).collect() == []


def test_one_row_of_nulls(spark):
    rows = records((None, None, None, None, None))
    assert found(judged(spark, rows)) == brute(rows)


def test_long_texts_and_whole_ids(spark):
    rows = records((5, "long \n" * 400_000, "en", "a", 2), (6, None, "en", "a", 2))
    assert found(judged(spark, rows)) == brute(rows)


def test_bitmaps_and_ranks():
    rng = np.random.default_rng(4)
    for size in (0, 1, 500, 512, 513, 4000, 8192):
        low = np.sort(rng.choice(1 << m.LOW_BITS, size, replace=False))
        data = m.compress(low)
        assert m.expand(data).tolist() == low.tolist()
        ranks = m.Ranks(data, low[::7].astype("<u2").tobytes(), np.full(len(low[::7]), 3, "<i8").tobytes())
        assert ranks(low).tolist() == [i + 2 * -(-i // 7) for i in range(size)]
        assert ranks.several(low).tolist() == [i % 7 == 0 for i in range(size)]


def test_a_source_of_many_equal_rows(spark):
    rows = records(*[(3, "copy\n", "de", "hot", 1)] * 3000) + corpus(20, ["hot", "b"])
    assert found(judged(spark, rows)) == brute(rows)


def test_paths_fold_into_the_root(spark):
    rows = corpus(50, ["a", "b"])
    table, sources = m.manifest(spark.createDataFrame(rows, SCHEMA))
    root = {bytes(r["root"]) for r in sources.collect()}
    assert {m.fold(bytes(r["leaf"]), bytes(r["path"])) for r in table.collect()} == root
    assert sum(r["n"] for r in sources.collect()) == 50


def test_the_query(spark, data):
    rows = [r.asDict() for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    assert found(QUERIES["op12_manifest"](spark, data)) == brute(rows)
