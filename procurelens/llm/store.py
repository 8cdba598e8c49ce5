"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import shared_folder

_shipped: set[str] = set()
_known: set[str] = set()
#: Bytes of rows that Spark hands to a Python worker at a time, where the session keeps the default. A batch lies off the heap in
#: the executor and once more in the worker, and what an executor has taken for one it hardly returns.
BATCH, BATCH_BYTES, BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20, 64 << 20


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/procurelens-llm/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    """A path that nothing uses yet, below one folder per application, which goes when the application ends."""
    folder = _folder(spark)
    if folder not in _known:
        _known.add(folder)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)  # of what exists only
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def saved_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` once and read it back: lineage ends at a table that survives lost executors. Also its path."""
    spark = df.sparkSession
    path = new_path(spark, name)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path), path


def saved(df: DataFrame, name: str) -> DataFrame:
    """``saved_at`` without the path."""
    return saved_at(df, name)[0]


def drop(spark: SparkSession, where: str) -> None:
    """Delete an intermediate table that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_all(spark: SparkSession) -> None:
    """Delete every intermediate table of this application (results that read them end too)."""
    drop(spark, _folder(spark))


def ship(spark: SparkSession) -> None:
    """Make this library importable in Python workers: their environment may differ from the driver's. Batches become small."""
    if int(spark.conf.get(BATCH).rstrip("b")) == BATCH_DEFAULT:
        spark.conf.set(BATCH, BATCH_BYTES)
    root = Path(__file__).resolve().parents[2]
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    archive = shutil.make_archive(f"{tempfile.mkdtemp()}/procurelens", "zip", root, "procurelens")
    context.addPyFile(archive)  # Spark hands it to every worker
