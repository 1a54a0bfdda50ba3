"""A table whose batches become visible as a whole or not at all.

Each task writes a file of its own. Nothing reads it until the batch commits, which writes one
manifest naming the files of all tasks. A batch that fails leaves no manifest, and its files are deleted;
one that has a manifest is not written again. Unlike `sinks.append_jdbc`, where each task is a transaction
of its own, no part of a batch can stay behind.

Files are written through pyarrow's file systems: `path` is a folder all executors share, as a URI or an absolute path.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have the package

FORMAT = "two_phase"


def _place(path: str) -> tuple[fs.FileSystem, str]:
    found, folder = fs.FileSystem.from_uri(path)
    return found, folder.rstrip("/")


def _exists(store: fs.FileSystem, path: str) -> bool:
    return store.get_file_info(path).type != fs.FileType.NotFound


def _manifest(folder: str, batch: int) -> str:
    return f"{folder}/manifests/batch_id={batch}.json"


@dataclass
class Written(WriterCommitMessage):
    """The file of one task; None if it had no rows."""

    file: str | None
    rows: int


class TwoPhaseWriter(DataSourceArrowWriter):
    """Writes one batch: `write` in each task, then `commit` or `abort` once for all of them."""

    def __init__(self, path: str, batch: int):
        store, folder = _place(path)
        self.path, self.batch, self.run = path, batch, f"files/batch_id={batch}/{uuid.uuid4().hex}"
        self.done = _exists(store, _manifest(folder, batch))  # a batch that is run again
        if not self.done:  # made here only: a task that outlives an abort finds it gone
            store.create_dir(f"{folder}/{self.run}", recursive=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        if self.done:
            return Written(None, 0)
        store, folder = _place(self.path)
        file, rows, out = f"{self.run}/{uuid.uuid4().hex}.parquet", 0, None
        try:
            for batch in iterator:
                if out is None:
                    out = pq.ParquetWriter(f"{folder}/{file}", batch.schema, filesystem=store)
                out.write_batch(batch)
                rows += batch.num_rows
        finally:
            if out is not None:
                out.close()
        return Written(None if out is None else file, rows)

    def commit(self, messages: list[Written | None]) -> None:
        if self.done:
            return
        store, folder = _place(self.path)
        held = [{"file": m.file, "rows": m.rows} for m in messages if m is not None and m.file is not None]
        store.create_dir(f"{folder}/manifests", recursive=True)
        hidden = f"{folder}/manifests/_{uuid.uuid4().hex}"
        with store.open_output_stream(hidden) as out:
            out.write("".join(json.dumps(x) + "\n" for x in held or [{"file": None, "rows": 0}]).encode())
        store.move(hidden, _manifest(folder, self.batch))

    def abort(self, messages: list[Written | None]) -> None:
        store, folder = _place(self.path)
        if _exists(store, f"{folder}/{self.run}"):
            store.delete_dir(f"{folder}/{self.run}")


class TwoPhaseSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> TwoPhaseWriter:
        if overwrite:
            raise ValueError("batches are appended")
        return TwoPhaseWriter(self.options["path"], int(self.options["batch"]))


def write_committed(df: DataFrame, path: str, batch_id: int) -> None:
    """Add `df` as batch `batch_id` of the table at `path`, whole or not at all; nothing happens if that batch is there.

    One writer at a time may write a batch, as is so within `foreachBatch`.
    """
    df.sparkSession.dataSource.register(TwoPhaseSource)
    df.write.format(FORMAT).option("path", path).option("batch", str(batch_id)).mode("append").save()


def manifests(spark: SparkSession, path: str) -> DataFrame:
    """`batch_id, file, rows` of the committed batches."""
    held = spark.read.schema("file string, rows bigint").json(f"{path.rstrip('/')}/manifests")
    batch = F.regexp_extract("_metadata.file_name", "batch_id=(-?[0-9]+)", 1).cast("int")
    return held.select(batch.alias("batch_id"), "file", "rows")


def read_committed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of all committed batches; what other runs have written is not seen."""
    store, folder = _place(path)
    files = []
    if _exists(store, f"{folder}/manifests"):
        files = [f"{path.rstrip('/')}/{r['file']}" for r in manifests(spark, path).where("file IS NOT NULL").collect()]  # names only, as any table's file list
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def remove_orphans(spark: SparkSession, path: str) -> int:
    """Delete the files of runs that neither committed nor aborted, as after the loss of a driver; how many there were.

    Call it while nothing is writing.
    """
    store, folder = _place(path)
    if not _exists(store, f"{folder}/files"):
        return 0
    known = {r["file"] for r in manifests(spark, path).collect()} if _exists(store, f"{folder}/manifests") else set()
    found = [f.path for f in store.get_file_info(fs.FileSelector(f"{folder}/files", recursive=True)) if f.type == fs.FileType.File]
    orphans = [f for f in found if f.removeprefix(f"{folder}/") not in known]
    for file in orphans:
        store.delete_file(file)
    return len(orphans)
