"""Folders of timetable documents as XML files, read as a batch or as a stream."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgrain.operators.realtime import flatten_change, flatten_plan

RAW_COLUMNS = ("StationEva", "Kind", "PlanHour", "CapturedAt", "Document")


@dataclass(frozen=True)
class Layout:
    """What the path of a file says: patterns with one group each, and how the capture time is written.

    A kind is taken as it is, but "fchg" and "rchg" are changes. A station that the path does not give
    is the one inside the document; a capture time that it does not give is the file's modification time.
    """

    kind: str = r"/(plan|fchg|rchg|change)/"
    station: str = r"/(?:plan|fchg|rchg|change)/([^/]+)/"
    hour: str = r"/plan/[^/]+/\d{6}/(\d{2})/"
    captured: str = r"/(\d{8}T\d{6})[^/]*\.xml$"
    capture_format: str = "yyyyMMdd'T'HHmmss"
    files: str = "*.xml"


#: plan/{eva}/{yyMMdd}/{HH}/{yyyyMMdd}T{HHmmss}.xml and fchg/{eva}/{yyyyMMdd}T{HHmmss}.xml, as the paths of the requests.
REQUEST_PATHS = Layout()
#: Folders named column=value, such as a partitioned text table has.
PARTITIONS = Layout(
    kind=r"/Kind=([^/]+)/", station=r"/StationEva=([^/]+)/", hour=r"/PlanHour=(\d{2})/",
    captured=r"/Captured=(\d{8}T\d{6})/", files="part-*",
)


def _from_path(path: Column, pattern: str) -> Column:
    found = F.regexp_extract(path, pattern, 1)
    return F.when(found != "", found)


def _documents(files: DataFrame, layout: Layout) -> DataFrame:
    path = F.url_decode(F.col("_metadata.file_path"))
    kind = _from_path(path, layout.kind)
    modified = F.col("_metadata.file_modification_time").cast("timestamp_ntz")
    captured = F.try_to_timestamp(_from_path(path, layout.captured), F.lit(layout.capture_format)).cast("timestamp_ntz")
    return files.select(
        _from_path(path, layout.station).alias("StationEva"),
        F.when(kind.isin("fchg", "rchg"), "change").otherwise(kind).alias("Kind"),
        _from_path(path, layout.hour).alias("PlanHour"),
        F.coalesce(captured, modified).alias("CapturedAt"),
        F.col("value").alias("Document"),
    )


def _options(layout: Layout) -> dict[str, str]:
    return {"wholetext": "true", "recursiveFileLookup": "true", "pathGlobFilter": layout.files}


def read_documents(spark: SparkSession, folder: str, layout: Layout = REQUEST_PATHS) -> DataFrame:
    """The documents below ``folder``, one row per file: station, kind, hour, capture time and text."""
    return _documents(spark.read.format("text").options(**_options(layout)).load(folder), layout)


def stream_documents(
    spark: SparkSession, folder: str, layout: Layout = REQUEST_PATHS, files_per_batch: int | None = None
) -> DataFrame:
    """The documents below ``folder`` as a stream; each file is read once."""
    reader = spark.readStream.format("text").options(**_options(layout))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _documents(reader.load(folder), layout)


def read_plan_xml(spark: SparkSession, folder: str, layout: Layout = REQUEST_PATHS) -> DataFrame:
    """Planned events of the plan files below ``folder``."""
    return flatten_plan(read_documents(spark, folder, layout).filter("Kind = 'plan'"))


def read_change_xml(spark: SparkSession, folder: str, layout: Layout = REQUEST_PATHS) -> DataFrame:
    """Changed events of the change files below ``folder``."""
    return flatten_change(read_documents(spark, folder, layout).filter("Kind = 'change'"))
