"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the audit is tuned for; `settings` override them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir`.

    Only a local session, where driver and executors share one machine, falls back to a
    temporary folder. On a cluster a missing setting is an error, not a silent local path.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="accessaudit-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A path of our own below the shared folder."""
    return f"{shared_folder(spark)}/accessaudit/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str) -> DataFrame:
    """Write `df` as parquet at `path` and read it back.

    Cuts the lineage: what follows sees one fixed set of rows even when executors are
    lost, and reads only the columns it needs.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system Spark writes it with; nothing happens if it is gone."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def folder_done(spark: SparkSession, path: str) -> bool:
    """Whether a job that wrote to this folder has ended well."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def rows_at(spark: SparkSession, path: str, schema: str) -> list | None:
    """The rows of a small table, or None where no such folder is."""
    try:
        return spark.read.schema(schema).parquet(path).collect()
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
