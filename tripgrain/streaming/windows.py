"""Streaming forms of de-duplication and delay windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tripgrain.functions.times import as_utc_instant, as_wall_clock
from tripgrain.operators.observations import delay_windows
from tripgrain.session import remove
from tripgrain.sources.tables import exists, replace_partitions, stored_once


def dedup_stream(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """One row per event and capture. The key holds the capture time, so history is kept.

    State is dropped once the watermark on the capture time has passed.
    """
    return (
        events.withColumn("_instant", as_utc_instant(F.col("CapturedAt")))
        .withWatermark("_instant", delay)
        .dropDuplicatesWithinWatermark(["DbEventId", "CapturedAt"])
        .drop("_instant")
    )


def delay_windows_stream(
    obs: DataFrame,
    width: str = "15 minutes",
    late: str = "30 minutes",
    by: Sequence[str] = ("StationEva", "LineName"),
    delay: str = "ArrivalDelayMinutes",
) -> DataFrame:
    """Tumbling delay windows; observations up to ``late`` behind the newest capture are counted."""
    timed = obs.withColumn("_instant", as_utc_instant(F.col("CapturedAt"))).withWatermark("_instant", late)
    windows = delay_windows(timed, width, by, "_instant", delay)
    return windows.withColumn("WindowStart", as_wall_clock(F.col("WindowStart"))).withColumn(
        "WindowEnd", as_wall_clock(F.col("WindowEnd"))
    )


def upsert_windows(spark: SparkSession, rows: DataFrame, path: str, by: Sequence[str], batch_id: int) -> None:
    """Put changed windows in place of the stored ones with their key; only their days are rewritten.

    The new days are stored first and copied then, so that a lost batch repeats the copy.
    """
    key = ["WindowStart", "WindowEnd", *by]
    staged_path = f"{path}-staged/{batch_id}"

    def build() -> DataFrame:
        new = rows.withColumn("WindowDay", F.to_date("WindowStart"))
        if not exists(spark, path):
            return new
        days = F.broadcast(new.select("WindowDay").distinct())  # one row per day
        stored = spark.read.parquet(path).join(days, "WindowDay", "left_semi").alias("s")
        same = [F.col(f"s.{c}").eqNullSafe(F.col(f"n.{c}")) for c in key]
        return new.unionByName(stored.join(new.alias("n"), same, "left_anti").select("s.*"))

    staged = stored_once(spark, staged_path, build)
    if not staged.isEmpty():
        replace_partitions(staged, path, ["WindowDay"])
    remove(spark, staged_path)


def run_delay_windows(
    obs: DataFrame,
    path: str,
    width: str = "15 minutes",
    late: str = "30 minutes",
    by: Sequence[str] = ("StationEva", "LineName"),
    delay: str = "ArrivalDelayMinutes",
    processing_time: str | None = None,
) -> StreamingQuery:
    """Keep the table of delay windows at ``path`` up to date with a stream of observations.

    Windows are there while they are still open, and an observation up to ``late`` behind the newest capture
    corrects its window. So the table equals the batch form over what has been read. Days are folders.
    """
    spark = obs.sparkSession
    windows = delay_windows_stream(obs, width, late, by, delay)
    trigger = {"processingTime": processing_time} if processing_time else {"availableNow": True}
    return (
        windows.writeStream.outputMode("update")
        .foreachBatch(lambda rows, batch_id: upsert_windows(spark, rows, path, by, batch_id))
        .option("checkpointLocation", f"{path}-checkpoint").trigger(**trigger).start()
    )
