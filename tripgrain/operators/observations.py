"""Observation history: latest state, development over time, summaries."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripgrain.functions.times import platform_changed, wall_literal
from tripgrain.operators.keys import add_dense_key

BATCH_SPAN = 1 << 36


def number_observations(snapshots: DataFrame, batch_id: int) -> DataFrame:
    """``ObservationKey``: unique over batches, dense inside one, the same when a batch is replayed."""
    numbered = add_dense_key(snapshots, ["DbEventId", "CapturedAt"], "_n")
    return numbered.withColumn("ObservationKey", F.col("_n") + F.lit(batch_id * BATCH_SPAN)).drop("_n")


def _recency() -> Column:
    return F.struct("CapturedAt", "ObservationKey")


def latest_per_event(obs: DataFrame) -> DataFrame:
    """The last observation of each event; combined before the shuffle."""
    newest = obs.groupBy("DbEventId").agg(F.max_by(F.struct(*obs.columns), _recency()).alias("_row"))
    return newest.select("_row.*")


def event_state(obs: DataFrame) -> DataFrame:
    """Latest observation plus first and last capture and the number of observations, per event."""
    state = obs.groupBy("DbEventId").agg(
        F.max_by(F.struct(*obs.columns), _recency()).alias("_row"),
        F.min("CapturedAt").alias("FirstCapturedAt"),
        F.max("CapturedAt").alias("LatestCapturedAt"),
        F.count("*").alias("ObservationCount"),
    )
    return state.select("_row.*", "FirstCapturedAt", "LatestCapturedAt", "ObservationCount").drop("CapturedAt")


def new_states(state: DataFrame) -> DataFrame:
    """States of events that were not known before; what :func:`merge_states` gives without ``old``."""
    return state.withColumn("StateDay", F.to_date("FirstCapturedAt"))


def merge_states(old: DataFrame, new: DataFrame) -> DataFrame:
    """State of all events in either input, as if both histories had been one.

    ``old`` has ``StateDay``, the day of the first capture when the event first came; it stays.
    """
    columns = [c for c in new.columns if c not in ("DbEventId", "FirstCapturedAt", "ObservationCount")]
    recency = ["LatestCapturedAt", "ObservationKey"]
    left = old.select(
        "DbEventId", "StateDay", F.struct(*recency, *[c for c in columns if c not in recency]).alias("_a"),
        F.col("FirstCapturedAt").alias("_fa"), F.col("ObservationCount").alias("_na"),
    )
    right = new.select(
        "DbEventId", F.struct(*recency, *[c for c in columns if c not in recency]).alias("_b"),
        F.col("FirstCapturedAt").alias("_fb"), F.col("ObservationCount").alias("_nb"),
    )
    zero = F.lit(0)
    return (
        left.join(right, "DbEventId", "full_outer")
        .withColumns({
            "FirstCapturedAt": F.least("_fa", "_fb"),
            "ObservationCount": F.coalesce("_na", zero) + F.coalesce("_nb", zero),
            "StateDay": F.coalesce("StateDay", F.to_date("_fb")),
            "_row": F.greatest("_a", "_b"),  # the later capture; NULL counts as earlier
        })
        .select("DbEventId", "_row.*", "FirstCapturedAt", "ObservationCount", "StateDay")
    )


def with_previous(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column, values: Sequence[str], name: str
) -> DataFrame:
    """Add ``name``: a struct of ``values`` from the row before, per ``keys`` in ``order`` order.

    A group of any size is cut into buckets that follow the order (hours, say). Inside a bucket the
    previous row comes from a window; the first row of a bucket takes the last row of the bucket
    before, from a table with one row per group and bucket.
    """
    parts = [*keys, "_bucket"]
    cut = df.withColumn("_bucket", bucket)
    inside = Window.partitionBy(*parts).orderBy(*order)
    tails = cut.groupBy(*parts).agg(F.max_by(F.struct(*values), F.struct(*order)).alias("_tail"))
    across = Window.partitionBy(*keys).orderBy("_bucket")
    carried = tails.select(*(F.col(p).alias(f"_of_{p}") for p in parts), F.lag("_tail").over(across).alias("_carried"))
    same = reduce(and_, (F.col(p).eqNullSafe(F.col(f"_of_{p}")) for p in parts))  # a NULL key is a group too
    return (
        cut.withColumn("_near", F.lag(F.struct(*values)).over(inside))
        .join(carried, same, "left")
        .withColumn(name, F.coalesce("_near", "_carried"))
        .drop("_bucket", "_near", "_carried", *(f"_of_{p}" for p in parts))
    )


def _with_previous_snapshot(obs: DataFrame, values: Sequence[str]) -> DataFrame:
    hour = F.date_trunc("HOUR", F.col("CapturedAt")).cast("timestamp_ntz")
    return with_previous(obs, ["DbEventId"], ["CapturedAt", "ObservationKey"], hour, values, "_previous")


def delay_evolution(obs: DataFrame, delay: str = "ArrivalDelayMinutes") -> DataFrame:
    """Every snapshot with the delay of the snapshot before and the difference."""
    rows = _with_previous_snapshot(obs, [delay])
    before = F.col("_previous").getField(delay)
    return rows.select(
        "DbEventId",
        "ObservationKey",
        "CapturedAt",
        delay,
        before.alias("PreviousDelayMinutes"),
        (F.col(delay) - before).alias("DelayChange"),
    )


def first_change(obs: DataFrame) -> DataFrame:
    """First capture with a cancellation and first with a platform change, per event."""
    moved = platform_changed(F.col("PlannedPlatform"), F.col("ChangedPlatform")) == 1
    cancelled = F.col("IsArrivalCancelled")
    if "IsDepartureCancelled" in obs.columns:
        cancelled = cancelled | F.col("IsDepartureCancelled")
    return obs.groupBy("DbEventId").agg(
        F.min(F.when(cancelled, F.col("CapturedAt"))).alias("FirstCancelledAt"),
        F.min(F.when(moved, F.col("CapturedAt"))).alias("FirstPlatformChangeAt"),
    )


# What counts as operational information when looking for changes.
OPERATIONAL = (
    "ChangedArrival", "ArrivalDelayMinutes", "IsArrivalCancelled", "ChangedDeparture",
    "DepartureDelayMinutes", "IsDepartureCancelled", "ChangedPlatform",
)


def change_frequency(obs: DataFrame) -> DataFrame:
    """Snapshots per event and how many differ from the one before (NULL equals NULL)."""
    watched = [c for c in OPERATIONAL if c in obs.columns]
    rows = _with_previous_snapshot(obs, watched)
    changed = F.col("_previous").isNotNull() & ~F.struct(*watched).eqNullSafe(F.col("_previous"))
    return rows.groupBy("DbEventId").agg(
        F.count("*").alias("ObservationCount"), F.count_if(changed).alias("ChangeCount")
    )


# The measures of the summary, with the column each needs.
MEASURES = {
    "TotalRows": None,
    "WithArrival": "PlannedArrival",
    "WithDeparture": "PlannedDeparture",
    "ArrivalCancelled": "IsArrivalCancelled",
    "DepartureCancelled": "IsDepartureCancelled",
    "WithChangedPlatform": "ChangedPlatform",
    "PlatformChanged": "ChangedPlatform",
}


def observation_summary(obs: DataFrame, measures: Sequence[str] = tuple(MEASURES)) -> DataFrame:
    """Conditional counts over observations, in one pass. A measure whose column is missing raises."""
    missing = sorted({MEASURES[m] for m in measures if MEASURES[m] and MEASURES[m] not in obs.columns})
    if missing:
        raise ValueError(f"no column {', '.join(missing)} for the measures asked for")

    def condition(measure: str) -> Column:
        column = F.col(MEASURES[measure])
        if measure == "PlatformChanged":
            return platform_changed(F.col("PlannedPlatform"), column) == 1
        return column if measure.endswith("Cancelled") else column.isNotNull()

    return obs.agg(*[
        (F.count("*") if MEASURES[m] is None else F.count_if(condition(m))).alias(m) for m in measures])


def retain(obs: DataFrame, days: int, as_of: datetime) -> DataFrame:
    """Observations captured in the last ``days`` days before ``as_of``."""
    limit = wall_literal(as_of) - F.make_dt_interval(days=F.lit(days))
    kept = obs.filter(F.col("CapturedAt") >= limit)
    if "CaptureDate" in obs.columns:  # lets the scan skip whole days
        kept = kept.filter(F.col("CaptureDate") >= F.to_date(limit))
    return kept


def delay_windows(
    obs: DataFrame, width: str = "15 minutes", by: Sequence[str] = ("StationEva", "LineName"),
    time: str = "CapturedAt", delay: str = "ArrivalDelayMinutes",
) -> DataFrame:
    """Tumbling windows of delay; NULL delays count as observations but not in the sums."""
    return (
        obs.groupBy(F.window(time, width).alias("_w"), *by)
        .agg(
            F.count("*").alias("ObservationCount"),
            F.count(delay).alias("DelayCount"),
            F.sum(F.col(delay).cast("long")).alias("DelaySum"),
            F.max(delay).alias("MaxDelay"),
        )
        .select(F.col("_w.start").alias("WindowStart"), F.col("_w.end").alias("WindowEnd"), *by,
                "ObservationCount", "DelayCount", "DelaySum", "MaxDelay")
    )
