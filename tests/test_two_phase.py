"""Batches that are seen whole or not at all, also when a task is killed."""

import os
import signal
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from accessaudit.sources import two_phase
from accessaudit.streaming import delivery
from tests.helpers import rows


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def numbers(spark, low, high):
    return spark.range(low, high, 1, 4).select("id", F.concat(F.lit("text "), "id").alias("text"), F.timestamp_seconds("id").alias("at"))


def seen(spark, path, schema):
    return rows(two_phase.read_committed(spark, path, schema))


def test_batches_add_up_and_a_repeated_one_does_not(spark, path):
    first, second = numbers(spark, 0, 100), numbers(spark, 100, 130)
    two_phase.write_committed(first, path, 0)
    two_phase.write_committed(second, path, 1)
    two_phase.write_committed(numbers(spark, 500, 600), f"file://{path}", 1)
    assert seen(spark, path, first.schema) == rows(first.unionAll(second))
    held = two_phase.manifests(spark, path).groupBy("batch_id").agg(F.sum("rows").alias("rows"))
    assert {(r["batch_id"], r["rows"]) for r in held.collect()} == {(0, 100), (1, 30)}
    assert two_phase.remove_orphans(spark, path) == 0


def broken(df, how):
    """The same rows, but the task that meets id 90 dies after it has given out others."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                yield batch.slice(i, 1)
                if batch.column("id")[i].as_py() == 90:
                    if how == "kill":
                        os.kill(os.getpid(), signal.SIGKILL)
                    raise RuntimeError("lost")

    return df.mapInArrow(run, df.schema)


@pytest.mark.parametrize("how", ["kill", "raise"])
def test_a_task_that_dies_leaves_nothing(spark, path, how):
    good = numbers(spark, 0, 100)
    two_phase.write_committed(good, path, 0)
    files = sorted(Path(path).rglob("*.parquet"))
    with pytest.raises(Exception):  # noqa: B017
        two_phase.write_committed(broken(numbers(spark, 50, 150), how), path, 1)
    assert seen(spark, path, good.schema) == rows(good)
    time.sleep(1)  # other tasks may end after the abort
    two_phase.remove_orphans(spark, path)
    assert sorted(Path(path).rglob("*.parquet")) == files
    # the batch is run again, and now ends well
    two_phase.write_committed(numbers(spark, 50, 150), path, 1)
    assert seen(spark, path, good.schema) == rows(good.unionAll(numbers(spark, 50, 150)))


def test_files_without_a_manifest_are_neither_seen_nor_kept(spark, path):
    good = numbers(spark, 0, 10)
    two_phase.write_committed(good, path, 0)
    lost = two_phase.TwoPhaseWriter(path, 1)  # a driver that is gone before it commits
    lost.write(iter(good.toArrow().to_batches()))
    assert seen(spark, path, good.schema) == rows(good)
    assert two_phase.remove_orphans(spark, path) == 1
    assert seen(spark, path, good.schema) == rows(good)


def test_batches_without_rows(spark, path):
    none = numbers(spark, 0, 0)
    assert two_phase.read_committed(spark, path, none.schema).count() == 0
    two_phase.write_committed(none, path, 0)
    assert two_phase.read_committed(spark, path, none.schema).count() == 0
    two_phase.write_committed(numbers(spark, 0, 5), path, 0)  # batch 0 is there, though empty
    assert two_phase.read_committed(spark, path, none.schema).count() == 0


def test_tables_are_not_overwritten(spark, path):
    spark.dataSource.register(two_phase.TwoPhaseSource)
    with pytest.raises(Exception):  # noqa: B017
        numbers(spark, 0, 5).write.format(two_phase.FORMAT).option("path", path).option("batch", "0").mode("overwrite").save()


def test_results_of_the_job_go_out_once(spark, path):
    hook = delivery.committed_results(path)
    results = numbers(spark, 0, 20)
    for _ in range(2):
        hook({"results": results, "alarms": results, "user_map": results}, 0)
    assert seen(spark, path, results.schema) == rows(results)
