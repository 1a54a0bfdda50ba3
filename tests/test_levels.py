"""Runs merged in levels against one aggregation over all batches."""

import random
from pathlib import Path

import pytest

from accessaudit.operators.identity import latest_entries
from accessaudit.streaming import levels
from accessaudit.streaming.levels import Levels, greatest, latest_by
from tests.helpers import rows

ENTRY = "key string, user string, at string, n long"


def batch(n):
    rng = random.Random(n)
    return [(f"ip_{rng.randrange(12)}", f"u{rng.randrange(5)}", f"2024-01-{rng.randint(1, 28):02d}", 100 * n + i) for i in range(20 if n % 4 else 0)]


def made(spark, tmp_path, fanout=3):
    frames = [spark.createDataFrame(batch(n), ENTRY) for n in range(14)]
    return frames, Levels(str(tmp_path / "map"), frames[0].schema, latest_by("at", "n"), fanout)


def test_current_after_every_batch(spark, tmp_path):
    frames, kept = made(spark, tmp_path)
    assert kept.current(spark).collect() == []
    seen = None
    for n, frame in enumerate(frames):
        kept.add(frame, n)
        seen = frame if seen is None else seen.unionAll(frame)
        if n % 3 == 1 or n == 13:
            assert rows(kept.current(spark)) == rows(latest_entries(seen, ["at", "n"]))
    held = [at for at, _ in kept.runs(spark)[2]]
    assert max(held) == 2 and all(held.count(at) < 3 for at in held)  # 14 = 1 * 9 + 1 * 3 + 2
    assert sorted(held) == [0, 0, 1, 2]
    # runs of older versions are gone
    assert len(list(Path(kept.folder, "runs").iterdir())) <= len(held) + 3
    assert len(list(Path(kept.folder, "manifests").iterdir())) == levels.KEPT_VERSIONS


def test_batches_taken_again(spark, tmp_path):
    frames, kept = made(spark, tmp_path)
    for n in (1, 2, 2, 1, 3):
        kept.add(frames[n], n)
    assert rows(kept.current(spark)) == rows(latest_entries(frames[1].unionAll(frames[2]).unionAll(frames[3]), ["at", "n"]))
    assert kept.runs(spark)[:2] == (3, 3)


def test_a_failed_merge_changes_nothing(spark, tmp_path, monkeypatch):
    frames, kept = made(spark, tmp_path, fanout=2)
    kept.add(frames[1], 1)
    before = rows(kept.current(spark))
    with monkeypatch.context() as patched:
        patched.setattr(Levels, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            kept.add(frames[2], 2)
    assert rows(kept.current(spark)) == before
    kept.add(frames[2], 2)
    assert rows(kept.current(spark)) == rows(latest_entries(frames[1].unionAll(frames[2]), ["at", "n"]))


def test_greatest(spark, tmp_path):
    frames = [spark.createDataFrame([(f"i{k % 3}", 10 * n + k) for k in range(5)], "ip string, pid long") for n in range(5)]
    kept = Levels(str(tmp_path / "max"), frames[0].schema, greatest("ip", "pid"), 2)
    for n, frame in enumerate(frames):
        kept.add(frame, n)
    assert {tuple(r) for r in kept.current(spark).collect()} == {("i0", 43), ("i1", 44), ("i2", 42)}
