"""Aggregates kept current: what each batch adds is stored as a small run, and runs are merged in levels.

A batch writes its own partial aggregate (the newest entry of each key it saw) as a run of level 0. The batch that would be
a level's run number FANOUT is merged with the others into one of the next level. So a reader folds at most FANOUT - 1 runs a level, with
the logarithm of the number of batches as levels, and every entry is rewritten once a level. What is
current is told by the newest manifest; a step that fails before its manifest is written changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from accessaudit.operators.identity import latest_entries
from accessaudit.session import remove_folder

FANOUT = 8
MANIFEST = "last_batch bigint, level int, run string"
KEPT_VERSIONS = 2  # readers that began before a merge find their runs


def latest_by(*order: str) -> Callable[[DataFrame], DataFrame]:
    """Merges entries (`key, user` and `order`) into the last one of each key, as `identity.ip_user_map` does."""
    return lambda entries: latest_entries(entries, list(order))


def greatest(key: str, value: str) -> Callable[[DataFrame], DataFrame]:
    """Merges rows into the greatest `value` of each `key`, as `identity.max_pid_per_ip` does."""
    return lambda entries: entries.groupBy(key).agg(F.max(value).alias(value))


@dataclass(frozen=True)
class Levels:
    """Partial aggregates below `folder`, of the columns in `schema`.

    `merge` turns rows of that schema into the aggregate, in the same schema. It must not matter how rows were grouped before:
    merge(a + b) = merge(merge(a) + b). There is one writer at a time.
    """

    folder: str
    schema: StructType
    merge: Callable[[DataFrame], DataFrame]
    fanout: int = FANOUT

    def _manifests(self, spark: SparkSession) -> list[int]:
        """Versions written whole, the newest first. One name per kept version reaches the driver."""
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder.rstrip('/')}/manifests")
        system = place.getFileSystem(spark._jsc.hadoopConfiguration())
        if not system.exists(place):
            return []
        names = [s.getPath() for s in system.listStatus(place)]
        done = [p.getName() for p in names if system.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        return sorted((int(n.split("=")[1]) for n in done), reverse=True)

    def _manifest(self, version: int) -> str:
        return f"{self.folder.rstrip('/')}/manifests/version={version}"

    def runs(self, spark: SparkSession) -> tuple[int, int, list[tuple[int, str]]]:
        """(version, last batch, [(level, folder of a run)]); (0, -1, []) before the first batch."""
        versions = self._manifests(spark)
        if not versions:
            return 0, -1, []
        rows = spark.read.schema(MANIFEST).parquet(self._manifest(versions[0])).collect()
        return versions[0], rows[0]["last_batch"], sorted((r["level"], r["run"]) for r in rows if r["run"])

    def _write(self, entries: DataFrame) -> str:
        run = f"{self.folder.rstrip('/')}/runs/{uuid.uuid4().hex}"
        self.merge(entries).select(*self.schema.names).write.parquet(run)
        return run

    def _read(self, spark: SparkSession, runs: list[str]) -> DataFrame:
        return spark.read.schema(self.schema).parquet(*runs) if runs else spark.createDataFrame([], self.schema)

    def add(self, entries: DataFrame, batch_id: int) -> None:
        """Take a batch. Batches come in order; one that is known already changes nothing."""
        spark = entries.sparkSession
        version, last, runs = self.runs(spark)
        if batch_id <= last:
            return
        level, full = 0, []
        while len(here := [run for at, run in runs if at == level]) >= self.fanout - 1:
            full += here
            runs = [(at, run) for at, run in runs if at != level]
            level += 1
        whole = entries.select(*self.schema.names)
        if full:  # all levels that are full become one run, written once
            whole = whole.unionAll(self._read(spark, full))
        runs = [*runs, (level, self._write(whole))]
        self._commit(spark, version + 1, batch_id, runs)

    def _commit(self, spark: SparkSession, version: int, batch_id: int, runs: list[tuple[int, str]]) -> None:
        rows = [(batch_id, at, run) for at, run in runs]
        spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(self._manifest(version))
        old = [v for v in self._manifests(spark) if v <= version - KEPT_VERSIONS]
        if not old:
            return
        held = {run for v in range(version - KEPT_VERSIONS + 1, version + 1) for run in self._named(spark, v)}
        for v in old:
            for run in self._named(spark, v):
                if run not in held:
                    remove_folder(spark, run)
            remove_folder(spark, self._manifest(v))

    def _named(self, spark: SparkSession, version: int) -> list[str]:
        try:
            return [r["run"] for r in spark.read.schema(MANIFEST).parquet(self._manifest(version)).collect()]
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def current(self, spark: SparkSession) -> DataFrame:
        """The aggregate over all batches: the runs of every level, merged once more."""
        return self.merge(self._read(spark, [run for _, run in self.runs(spark)[2]])).select(*self.schema.names)
