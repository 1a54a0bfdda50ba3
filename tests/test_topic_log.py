"""Reads from given offsets against a filter of all records."""

import random
from pathlib import Path

import pytest

from accessaudit.operators import lookup
from accessaudit.sources.topic_log import TopicLog
from tests.helpers import rows

SCHEMA = "part int, off bigint, value string"


def batches(spark):
    rng = random.Random(2)
    made, next_off = [], {p: rng.randrange(40) for p in range(7)}
    for _ in range(3):
        batch = []
        for p in next_off:
            for _ in range(rng.randrange(60) if p else 300):  # partition 0 holds most records
                batch.append((p, next_off[p], f"v{p}.{next_off[p]}"))
                next_off[p] += rng.randint(1, 2)
        made.append(batch)
    return made, [spark.createDataFrame(b, SCHEMA) for b in made]


@pytest.fixture
def log(spark, tmp_path):
    frames = batches(spark)[1]
    log = TopicLog(str(tmp_path / "log"), frames[0].schema, span=50, slots=4)
    for n, frame in enumerate(frames):
        log.append(frame, n)
    return log


def starts(spark, *pairs):
    return spark.createDataFrame(list(pairs), "part int, off bigint")


@pytest.mark.parametrize("pairs", [[(0, 0)], [(0, 700), (3, 20)], [(p, 60) for p in range(9)], [(5, 10_000)], []])
def test_rows_from_offsets(spark, log, pairs):
    want = [r for b in batches(spark)[0] for r in b if r[0] in dict(pairs) and r[1] >= dict(pairs)[r[0]]]
    got = [tuple(r) for r in log.read_from(spark, starts(spark, *pairs)).collect()]
    assert sorted(got) == sorted(want)


def test_without_broadcasts(spark, log, monkeypatch):
    first, second = log.read_from(spark, starts(spark, (0, 300), (2, 5))), None
    monkeypatch.setattr(lookup.Measured, "fits", property(lambda self: False))
    second = log.read_from(spark, starts(spark, (0, 300), (2, 5)))
    assert rows(first) == rows(second)


def test_only_needed_files_are_opened(spark, log):
    wanted = starts(spark, (0, 400), (3, 30))
    want = rows(log.read_from(spark, wanted))
    needed = {r["place"] for r in log.needed(spark, wanted).collect()}
    files = list(Path(log.records).rglob("*.parquet"))
    spoiled = 0
    for file in files:
        if file.parent.name.split("=")[1] not in needed:
            file.write_bytes(b"no Parquet")  # a read of it would fail
            file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
            spoiled += 1
    assert spoiled > len(files) // 2
    found = log.read_from(spark, wanted)
    assert rows(found) == want
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString().lower()


def test_a_batch_appended_again_and_one_without_index(spark, log):
    frames = batches(spark)[1]
    log.append(frames[1], 1)
    everything = starts(spark, *[(p, 0) for p in range(7)])
    want = rows(frames[0].unionAll(frames[1]).unionAll(frames[2]))
    assert rows(log.read_from(spark, everything)) == want
    frames[0].selectExpr("*", "'9.0.0' as place").write.partitionBy("place").parquet(f"{log.records}/batch_id=9")
    assert not log.holds(spark, 9) and log.holds(spark, 1)
    assert rows(log.read_from(spark, everything)) == want


def test_empty_log_and_bad_records(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    log = TopicLog(str(tmp_path / "log"), empty.schema)
    assert log.read_from(spark, starts(spark, (0, 0))).collect() == []
    log.append(empty, 0)
    assert log.read_from(spark, starts(spark, (0, 0))).collect() == []
    with pytest.raises(ValueError):
        log.append(empty.selectExpr("*", "1 as Place"), 1)
    with pytest.raises(Exception, match="without off"):
        log.append(spark.createDataFrame([(1, None, "x")], SCHEMA), 1)
