"""Partitioned Parquet folders: reading by contract, rewriting and dropping single partitions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.session import end_shuffles, settings, staged

TARGET_FILE_BYTES = 256 * 1024 * 1024  # within the 128-512 MB wanted per object
_LISTERS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
_LEAST = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def listing(spark: SparkSession):
    """Files listed by a few tasks a core; by default a folder of thousands of days starts a task for each."""
    return settings(spark, **{_LISTERS: str(4 * spark.sparkContext.defaultParallelism)})


def read_folder(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet folder under its contract; an absent one is empty.

    With a declared schema a column that older files lack reads as NULL and partition columns keep
    their declared types.
    """
    try:
        with listing(spark):
            return spark.read.schema(schema).parquet(path).select(*schema.names)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


#: Spark knows the size of each block of a shuffle up to so many partitions, beyond it only their mean.
MOST_DEALT = 2000


#: A task has a cost of its own, so one that makes smaller files than this makes several of them.
LEAST_TASK_BYTES = 2 * 1024 * 1024
_SAMPLE_ROWS = 1000


def _file_size(spark: SparkSession, size: int):
    """Tasks of a write that make files near ``size``. A little data for many partitions still spreads over the cores, as
    opening files is then the work. Rows take about half as much in a file as in a shuffle; no task grows beyond
    ``TARGET_FILE_BYTES`` for that."""
    return settings(spark, **{_ADVISORY: str(max(size, min(2 * size, TARGET_FILE_BYTES))), _LEAST: "16k"})


def _rows_per_file(df: DataFrame, file_bytes: int) -> int:
    """How many rows make a file of ``file_bytes``, by the size of a few of them written aside."""
    with staged(df.limit(_SAMPLE_ROWS).coalesce(1), "piece") as piece:
        rows, size = piece.agg(F.count("*"), F.max("_metadata.file_size")).first()
    return max(1, rows * file_bytes // size) if rows else 0


def write_partitions(
    df: DataFrame,
    path: str,
    by: Sequence[str],
    sort: Sequence[str] = (),
    file_bytes: int = TARGET_FILE_BYTES,
    whole: bool = False,
    partitions: int = 0,
    beside: bool = False,
) -> None:
    """Replace the partitions ``df`` has rows for and no others, or with ``whole`` the whole folder.

    The rebalance hint lets AQE merge small partitions into one task and split a large one over
    several, so files come out near ``file_bytes`` however uneven the partitions are. An empty
    ``df`` writes nothing. ``partitions`` is their number, where it is known: dealt to fewer shuffle partitions
    several meet in one, and when that is split each part makes a small file of every one of them.
    With ``whole`` nobody may read the folder before a record names it; its files are put in place by the tasks then, not one by
    one by the driver. ``beside``, what a whole folder holds already stays.
    """
    spread = min(partitions, MOST_DEALT)
    few = spread <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.hint("rebalance", *by) if few else df.hint("rebalance", spread, *by)
    if sort:
        rows = rows.sortWithinPartitions(*by, *sort)
    most = _rows_per_file(df, file_bytes) if file_bytes < LEAST_TASK_BYTES else 0
    with _file_size(df.sparkSession, max(file_bytes, LEAST_TASK_BYTES)):
        (
            rows.write.mode("append" if beside else "overwrite")
            .option("partitionOverwriteMode", "static" if whole else "dynamic")
            .option("mapreduce.fileoutputcommitter.algorithm.version", 2 if whole else 1)
            .option("maxRecordsPerFile", most)
            .option("compression", "snappy").partitionBy(*by).parquet(path)
        )
    if whole:
        end_shuffles(df.sparkSession)


# Characters that are percent-encoded in the names of partition folders.
_ENCODED = "\"#%'*/:=?\\{[]^\x7f"


def partition_folder(name: str, value: object) -> str:
    text = "".join(f"%{ord(c):02X}" if c in _ENCODED or c < " " else c for c in str(value))
    return f"{name}={text}"


def folder_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """The folders directly below ``path``; none if it does not exist."""
    if not folder_exists(spark, path):
        return []
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    return [f.getPath().toString() for f in found if f.isDirectory()]


def changed_before(spark: SparkSession, path: str, moment: datetime) -> bool:
    """Whether nothing directly in a folder has changed since ``moment``."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    times = [f.getModificationTime() for f in (system.getFileStatus(folder), *system.listStatus(folder))]
    return max(times) <= moment.timestamp() * 1000


def drop_partitions(spark: SparkSession, path: str, partitions: Iterable[Sequence]) -> None:
    """Delete partition folders; a dynamic overwrite cannot empty one. Items are (name, value) pairs."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    for pairs in partitions:
        folder = hadoop.Path("/".join([path, *[partition_folder(*pair) for pair in pairs]]))
        folder.getFileSystem(conf).delete(folder, True)
