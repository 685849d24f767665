"""Stored Parquet tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgrain.session import remove


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Replace (or extend) the table at ``path`` and return it as stored."""
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.parquet(path)


def write_fact(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("DateKey",),
    sort_by: Sequence[str] = ("RouteKey", "StopKey", "TripInstanceKey", "StopSequence"),
) -> DataFrame:
    """Write with directories per ``partition_by`` and rows clustered by ``sort_by``.

    Range partitioning on both lists splits a large day into several files, each covering a narrow
    range of ``sort_by``, so Parquet statistics skip row groups.
    """
    order = [*partition_by, *sort_by]
    laid_out = df.repartitionByRange(*order).sortWithinPartitions(*order)
    laid_out.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def write_by_trip(df: DataFrame, path: str, group_bytes: int = 16 << 20) -> DataFrame:
    """A second layout of the fact, for single trips: rows in trip order, in small row groups.

    A trip lies in one row group, or two where it crosses an end; the statistics and Bloom filters of the others
    let a search for its key skip them. Ranges are by trip, so the rows of a trip are in one file.
    """
    laid_out = df.repartitionByRange("TripInstanceKey").sortWithinPartitions("TripInstanceKey", "StopSequence")
    (
        laid_out.write.mode("overwrite")
        .option("parquet.block.size", group_bytes)
        .option("parquet.bloom.filter.enabled#TripInstanceKey", "true")
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .parquet(path)
    )
    return df.sparkSession.read.parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Overwrite only the partitions present in ``df``; others stay as they are."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def append_observations(df: DataFrame, path: str, batch_id: int) -> None:
    """Add snapshots to the history, one directory per capture date and batch.

    Writing the same batch again replaces its own directories, so a replay adds nothing twice. Rows
    lie in (event, capture) order, so the statistics of the files help to find one event.
    """
    placed = df.withColumn("CaptureDate", F.to_date("CapturedAt")).withColumn(
        "BatchId", F.lit(batch_id).cast("long")
    )
    order = ["CaptureDate", "DbEventId", "CapturedAt"]
    replace_partitions(
        placed.repartitionByRange(*order).sortWithinPartitions(*order), path, ["CaptureDate", "BatchId"]
    )


def read_observations(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def land_raw(documents: DataFrame, path: str) -> None:
    """Append source documents. Those of one capture may lie in several files and come at different times."""
    documents.write.mode("append").parquet(path)


def stored_once(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table at ``path``, written now unless a write of it has come to its end."""
    return spark.read.parquet(path) if is_complete(spark, path) else write_table(build(), path)


def partition_folders(spark: SparkSession, path: str) -> dict[str, str]:
    """Value and path of the first-level partition folders below ``path``."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(target):
        return {}
    found = [status.getPath() for status in files.listStatus(target) if status.isDirectory()]
    return {p.getName().split("=", 1)[1]: p.toString() for p in found if "=" in p.getName()}


def drop_partitions(spark: SparkSession, path: str, gone: Callable[[str], bool]) -> list[str]:
    """Delete the first-level partitions whose value is ``gone``; returns their values."""
    values = [(value, folder) for value, folder in sorted(partition_folders(spark, path).items()) if gone(value)]
    for _, folder in values:
        remove(spark, folder)
    return [value for value, _ in values]


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write of the whole table at ``path`` came to its end."""
    return exists(spark, f"{path}/_SUCCESS")
