"""File sources and sinks, and the shared folder for working sets."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StringType, StructType

from .schemas import all_text


def read_staging(spark: SparkSession, path: str, columns: list[str], sep: str = ",") -> DataFrame:
    """CSV with a header, every column text, no type inference."""
    return spark.read.schema(all_text(columns)).option("header", True).option("sep", sep).csv(path)


# How files are packed. Text repeats itself, and readers unpack both by themselves.
CSV_PACKED, PARQUET_PACKED = "gzip", "zstd"


def write_staging(df: DataFrame, path: str) -> None:
    """Write a text table as packed CSV, keeping the blanks that staging data may carry.

    A packed file is read by one task: there are as many files as ``df`` has tasks.
    """
    (df.write.mode("overwrite").option("header", True).option("compression", CSV_PACKED)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Replace a parquet table (safe to repeat).

    With ``partition_by`` every task writes its own rows, ordered by that column, a file for each of its values: rows are
    not exchanged once more, and a hot value is spread over the tasks as ``df`` is. There are at most as many files as tasks
    times values, so partition by a column of few values.
    """
    writer = df.write.mode("overwrite").option("compression", PARQUET_PACKED)
    (writer if partition_by is None else writer.partitionBy(partition_by)).parquet(path)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_export(df: DataFrame, path: str) -> None:
    """Tab-separated export with a header."""
    df.write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)


def read_export(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Load an export with its declared types, trimming all text."""
    df = spark.read.schema(schema).option("sep", "\t").option("header", True).csv(path)
    return df.select(*[
        F.trim(f.name).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f.name)
        for f in schema])


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project to ``schema``, rounding numbers to the declared scale."""
    def typed(field):
        column = F.col(field.name)
        if isinstance(field.dataType, DecimalType):
            column = F.round(column, field.dataType.scale)
        return column.cast(field.dataType).alias(field.name)

    return df.select(*[typed(f) for f in schema])


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="procurelens-"))
    return context.getCheckpointDir()


def working_folder(spark: SparkSession) -> str:
    """One folder per application; ``release`` deletes it, and so does the end of the application."""
    return f"{shared_folder(spark).rstrip('/')}/procurelens/{spark.sparkContext.applicationId}"


def _file_system(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def working_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the working folder."""
    folder = working_folder(spark)
    if folder not in _kept:
        _kept[folder] = {}
        files, path = _file_system(spark, folder)
        files.mkdirs(path)
        files.deleteOnExit(path)  # of what exists only
    return f"{folder}/{name}-{uuid.uuid4().hex}"


#: Per working folder the sets that can be found again: the plans they are made of, path and table, by key.
_kept: dict[str, dict[tuple, list[tuple[tuple[DataFrame, ...], str, DataFrame]]]] = {}


def _version(df: DataFrame) -> tuple:
    """What says that the files behind ``df`` are still the same.

    The names of all files (writers never use one twice), the time of each of their folders, and time and size
    of each file that is a table by itself.
    """
    inputs = sorted(df.inputFiles())
    folders = sorted({path.rsplit("/", 1)[0] for path in inputs})
    out: list[tuple] = [tuple(inputs)]
    for where in folders + [path for path in inputs if not path.rsplit("/", 1)[1].startswith("part-")]:
        files, path = _file_system(df.sparkSession, where)
        status = files.getFileStatus(path)
        out.append((where, status.getModificationTime(), status.getLen()))
    return tuple(out)


def kept_set(df: DataFrame, name: str) -> DataFrame:
    """``working_set`` that is found again: a plan over unchanged files is written once an application.

    Plans are compared by what they compute (``sameSemantics``), not by their text.
    """
    return kept_result(lambda: df, name, df)


def kept_result(build: Callable[[], DataFrame], name: str, *made_of: DataFrame) -> DataFrame:
    """``build()`` as a set found again by the plans it is ``made_of``: for results whose own plan holds written steps."""
    spark = made_of[0].sparkSession
    working_path(spark, name)  # know the folder
    key = (name, *[(df.semanticHash(), _version(df)) for df in made_of])
    known = _kept[working_folder(spark)].setdefault(key, [])
    for plans, path, table in known:
        files, where = _file_system(spark, path)
        if files.exists(where) and all(p.sameSemantics(df) for p, df in zip(plans, made_of, strict=True)):
            return table
    table, path = _written(build(), name)
    known.append((made_of, path, table))
    return table


def release(spark: SparkSession) -> None:
    """Delete all working sets of this application. Results that still read one end with them."""
    folder = working_folder(spark)
    _kept.pop(folder, None)
    files, path = _file_system(spark, folder)
    files.delete(path, True)


def working_set(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result and read it back.

    The expensive part (scan, joins, first aggregation) runs once, the lineage
    ends at a table that survives lost executors, and Spark knows the real size
    of the result when it picks join strategies for what follows.
    """
    return _written(df, name)[0]


def _written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = working_path(spark, name)
    df.write.option("compression", PARQUET_PACKED).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path
