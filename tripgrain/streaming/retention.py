"""Retention: what is too old goes, what no longer grows is put together."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgrain.functions.times import wall_literal
from tripgrain.session import remove
from tripgrain.sources.tables import drop_partitions, is_complete, partition_folders, stored_once
from tripgrain.streaming.realtime import LIVE_DAYS, RealtimePaths

#: Days that observations are kept.
KEEP_DAYS = 180


def _rewrite_day(spark: SparkSession, history: str, day: str, staging: str, rows: DataFrame | None) -> None:
    """Put ``rows`` in place of a day of the history, as one batch folder.

    They are stored beside it first: a job lost after that is repeated with the stored rows (``rows`` None).
    """
    staged = f"{staging}/CaptureDate={day}"
    if rows is not None:
        stored_once(spark, staged, lambda: rows.sortWithinPartitions("DbEventId", "CapturedAt"))
    kept = spark.read.parquet(staged)
    batch = kept.agg(F.min("BatchId")).first()[0]
    remove(spark, f"{history}/CaptureDate={day}")
    if batch is not None:
        kept.drop("CaptureDate", "BatchId").write.mode("overwrite").parquet(f"{history}/CaptureDate={day}/BatchId={batch}")
    remove(spark, staged)


def apply_retention(
    spark: SparkSession, paths: RealtimePaths, as_of: datetime, days: int = KEEP_DAYS, live_days: int = LIVE_DAYS
) -> dict[str, list[str]]:
    """Remove observations captured more than ``days`` before ``as_of`` and states that are not live; compact closed days.

    Whole days are dropped by their folders without reading them; only the day of the limit is rewritten. Closed
    days (before that of ``as_of``) that lie in several batches' folders become one. The realtime fact stays.
    To be run between cycles. A run that was lost in the middle is continued by the next one. Returns the days of
    the history that were dropped, cut and compacted, and the dropped days of the states.
    """
    limit = as_of - timedelta(days=days)
    staging = f"{paths.root}/staged/retention"
    for day in partition_folders(spark, staging):
        if is_complete(spark, f"{staging}/CaptureDate={day}"):
            _rewrite_day(spark, paths.history, day, staging, None)
    remove(spark, staging)

    old = limit.date().isoformat()
    done = {"dropped": drop_partitions(spark, paths.history, lambda day: day < old), "cut": [], "compacted": []}
    for day, folder in sorted(partition_folders(spark, paths.history).items()):
        batches = partition_folders(spark, folder)
        cut = day == old and limit.time() != datetime.min.time()
        if not cut and (len(batches) < 2 or day >= as_of.date().isoformat()):
            continue
        rows = spark.read.option("basePath", paths.history).parquet(folder)
        if cut:
            rows = rows.filter(F.col("CapturedAt") >= wall_literal(limit))
        _rewrite_day(spark, paths.history, day, staging, rows)
        done["cut" if cut else "compacted"].append(day)
    remove(spark, staging)
    last_live: date = as_of.date() - timedelta(days=live_days)
    done["states"] = drop_partitions(spark, paths.states, lambda day: day < last_live.isoformat())
    return done
