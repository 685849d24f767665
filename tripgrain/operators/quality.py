"""Data-quality jobs. Each returns rows of (Check, Value) or a small profile table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripgrain.functions.times import service_seconds, text_date
from tripgrain.operators import aggregates
from tripgrain.operators.calendar import REMOVED
from tripgrain.operators.keys import duplicates
from tripgrain.operators.trips import after_midnight, has_bad_format
from tripgrain.schemas import FEED_KEYS


def _check(name: str, df: DataFrame, value: Column) -> DataFrame:
    return df.agg(F.coalesce(value, F.lit(0)).cast("long").alias("Value")).select(
        F.lit(name).alias("Check"), "Value"
    )


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# ---------------------------------------------------------------- references


def orphan_count(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None, name: str = "") -> DataFrame:
    """Child rows whose key is missing in ``parent``.

    Child rows are counted per key before the join, so a frequent key is one row in it.
    """
    counted = child.groupBy(key).agg(F.count("*").alias("_rows"))
    known = parent.select(F.col(parent_key or key).alias(key))
    return _check(name or f"Missing{key}", counted.join(known, key, "left_anti"), F.sum("_rows"))


def uncovered_services(trips: DataFrame, calendar: DataFrame, calendar_dates: DataFrame) -> DataFrame:
    """Service ids of trips that neither calendar table defines."""
    defined = calendar.select("ServiceId").unionByName(calendar_dates.select("ServiceId"))
    used = trips.select("ServiceId").distinct()
    return _check(
        "ServiceIdsWithoutCalendarDefinition", used.join(defined, "ServiceId", "left_anti"), F.count("*")
    )


def fact_reference_gaps(fact: DataFrame, dim_date: DataFrame, dim_route: DataFrame, dim_stop: DataFrame) -> DataFrame:
    """Fact rows whose date, route or stop key has no dimension row."""
    return _union([
        orphan_count(fact, dim_date, "DateKey", name="FactWithoutDate"),
        orphan_count(fact, dim_route, "RouteKey", name="FactWithoutRoute"),
        orphan_count(fact, dim_stop, "StopKey", name="FactWithoutStop"),
    ])


# ---------------------------------------------------------------- grain


def duplicate_count(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Number of key values that occur more than once."""
    return _check(name, duplicates(df, keys), F.count("*"))


def feed_duplicates(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Repeated business identifiers of every staged table that has one."""
    return _union([
        duplicate_count(tables[name], keys, f"{name} duplicates")
        for name, keys in FEED_KEYS.items() if name in tables
    ])


# ---------------------------------------------------------------- times


def late_hours(stop_times: DataFrame) -> DataFrame:
    """Stop times with an arrival or departure at 24:00:00 or later."""
    late = [
        F.coalesce(service_seconds(F.col(c)) >= 86400, F.lit(False)) for c in ("ArrivalTime", "DepartureTime")
    ]
    return _check("TimesAfter24", stop_times, F.count_if(late[0] | late[1]))


def bad_time_formats(stop_times: DataFrame) -> DataFrame:
    """Stop times with a malformed arrival or departure text."""
    bad = [F.coalesce(has_bad_format(F.col(c)), F.lit(False)) for c in ("ArrivalTime", "DepartureTime")]
    return _check("InvalidTimeFormat", stop_times, F.count_if(bad[0] | bad[1]))


def after_midnight_count(normalized: DataFrame) -> DataFrame:
    return _check("AfterMidnightStopCount", after_midnight(normalized), F.count("*"))


def bad_stop_sequences(stop_times: DataFrame) -> DataFrame:
    """Negative sequence numbers, and stops whose time lies before that of the stop before.

    A trip holds a sequence number once, so the window sees the stops of one trip.
    """
    when = service_seconds(F.coalesce("ArrivalTime", "DepartureTime"))
    leave = service_seconds(F.coalesce("DepartureTime", "ArrivalTime"))
    along = Window.partitionBy("TripId").orderBy("StopSequence")
    rows = stop_times.select(
        "StopSequence", when.alias("_at"), F.lag(leave).over(along).alias("_left")
    )
    return _union([
        _check("NegativeStopSequence", stop_times, F.count_if(F.col("StopSequence") < 0)),
        _check("TimeGoesBackward", rows, F.count_if(F.col("_at") < F.col("_left"))),
    ])


# ---------------------------------------------------------------- calendar


def removed_still_present(service_dates: DataFrame, calendar_dates: DataFrame) -> DataFrame:
    """Removal exceptions whose date is still in the resolved calendar."""
    removed = calendar_dates.filter(F.col("ExceptionType") == REMOVED).select(
        "ServiceId", text_date(F.col("ServiceDate")).alias("ServiceDate")
    )
    still = removed.join(service_dates, ["ServiceId", "ServiceDate"], "left_semi")
    return _check("RemovedServicesStillPresent", still, F.count("*"))


def bad_service_ranges(calendar: DataFrame, calendar_dates: DataFrame, first: str, last: str) -> DataFrame:
    """Inverted or unreadable ranges, and exception dates outside the feed (``yyyyMMdd`` bounds)."""
    start, end = text_date(F.col("StartDate")), text_date(F.col("EndDate"))
    day = text_date(F.col("ServiceDate"))
    low, high = text_date(F.lit(first)), text_date(F.lit(last))
    return _union([
        _check("StartAfterEnd", calendar, F.count_if(start > end)),
        _check("UnreadableRange", calendar, F.count_if(start.isNull() | end.isNull())),
        _check("ExceptionOutsideFeed", calendar_dates, F.count_if((day < low) | (day > high))),
        _check("UnreadableExceptionDate", calendar_dates, F.count_if(day.isNull())),
    ])


def feed_bounds(feed_info: DataFrame) -> DataFrame:
    """First and last day of each feed version; unreadable bounds are NULL and bound nothing."""
    return feed_info.groupBy("FeedVersion").agg(
        F.min(text_date(F.col("FeedStartDate"))).alias("FeedStart"), F.max(text_date(F.col("FeedEndDate"))).alias("FeedEnd"))


def outside_feed(calendar: DataFrame, calendar_dates: DataFrame, feed_info: DataFrame) -> DataFrame:
    """Calendar ranges and exceptions outside their feed, per feed version: not wholly inside, and wholly outside.

    The versions are the rows of feed_info, one or a few; every range is compared with each of them.
    """
    start, end = text_date(F.col("StartDate")), text_date(F.col("EndDate"))
    day = text_date(F.col("ServiceDate"))
    parts = []
    for version in feed_bounds(feed_info).orderBy("FeedVersion").collect():
        low, high = F.lit(version.FeedStart), F.lit(version.FeedEnd)
        for name, rows, condition in (
            ("CalendarOutsideFeed", calendar, (end < low) | (start > high)),
            ("CalendarBeyondFeed", calendar, (start < low) | (end > high)),
            ("ExceptionOutsideFeed", calendar_dates, (day < low) | (day > high)),
        ):
            parts.append(_check(name, rows, F.count_if(condition)).select(F.lit(version.FeedVersion).alias("FeedVersion"), "*"))
    return _union(parts)


# ---------------------------------------------------------------- profiles


def null_profile(df: DataFrame, table: str = "table") -> DataFrame:
    """NULLs of every column, in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "ColumnName", "NullCount").select(
        F.lit(table).alias("TableName"), "ColumnName", "NullCount"
    )


def staged_null_profile(feed) -> DataFrame:
    """NULLs of every column of every staged table, one pass per table."""
    return _union([null_profile(getattr(feed, name), name) for name in _staged(feed)])


def bad_coordinates(stops: DataFrame) -> DataFrame:
    """Missing coordinates and coordinates outside the valid degrees."""
    lat, lon = F.col("StopLat"), F.col("StopLon")
    outside = (F.abs(lat) > 90) | (F.abs(lon) > 180)
    return _union([
        _check("MissingCoordinates", stops, F.count_if(lat.isNull() | lon.isNull())),
        _check("InvalidCoordinates", stops, F.count_if(outside)),
    ])


def dim_route_checks(dim_route: DataFrame) -> DataFrame:
    return _union([
        _check("RouteCount", dim_route, F.count("*")),
        _check("MissingOperatorCount", dim_route, F.count_if(F.col("OperatorName").isNull())),
    ])


def routes_per_mode(dim_route: DataFrame) -> DataFrame:
    """Routes of the dimension per transport mode."""
    return dim_route.groupBy("TransportMode").agg(F.count("*").alias("RouteCount"))


def dim_stop_checks(dim_stop: DataFrame) -> DataFrame:
    missing = F.col("Latitude").isNull() | F.col("Longitude").isNull()
    return _union([
        _check("StopCount", dim_stop, F.count("*")),
        _check("StopsWithParentStation", dim_stop, F.count_if(F.col("ParentStationId").isNotNull())),
        _check("MissingStopNameCount", dim_stop, F.count_if(F.col("StopName").isNull())),
        _check("MissingCoordinatesCount", dim_stop, F.count_if(missing)),
    ])


def phase1_route_count(classification: DataFrame) -> DataFrame:
    return _check("Phase1RouteCount", classification, F.count_if("IsPhase1"))


# ---------------------------------------------------------------- reconciliation


def mode_reconciliation(work: DataFrame, view: DataFrame) -> DataFrame:
    """Trip-stops per mode in the working table and in the view, and their difference."""
    left = work.groupBy("TransportMode").agg(F.count("*").alias("WorkRows"))
    right = view.groupBy("TransportMode").agg(F.count("*").alias("ViewRows"))
    zero = F.lit(0)
    return left.join(right, "TransportMode", "full_outer").select(
        "TransportMode",
        F.coalesce("WorkRows", zero).alias("WorkRows"),
        F.coalesce("ViewRows", zero).alias("ViewRows"),
        (F.coalesce("WorkRows", zero) - F.coalesce("ViewRows", zero)).alias("Difference"),
    )


def summary_difference(source: DataFrame, table: DataFrame, summary: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A one-row summary of both inputs side by side, one line per measure; one that a side lacks counts as 0 in it."""
    def melted(df: DataFrame, name: str) -> DataFrame:
        row = summary(df)
        return row.unpivot([], row.columns, "Measure", name)

    return melted(source, "SourceValue").join(melted(table, "TableValue"), "Measure", "full_outer").withColumn(
        "Difference", F.coalesce("SourceValue", F.lit(0)) - F.coalesce("TableValue", F.lit(0))
    )


# ---------------------------------------------------------------- report


def run_checks(feed, plan) -> DataFrame:
    """All scalar checks of the scheduled side as one report, from a feed and its plan."""
    return _union([
        orphan_count(feed.stop_times, feed.trips, "TripId", name="MissingTripReferences"),
        orphan_count(feed.stop_times, feed.stops, "StopId", name="MissingStopReferences"),
        orphan_count(feed.trips, feed.routes, "RouteId", name="MissingRouteReferences"),
        uncovered_services(feed.trips, feed.calendar, feed.calendar_dates),
        duplicate_count(feed.stop_times, ["TripId", "StopSequence"], "StopTimesDuplicates"),
        late_hours(feed.stop_times),
        bad_time_formats(feed.stop_times),
        bad_stop_sequences(feed.stop_times),
        bad_coordinates(feed.stops),
        duplicate_count(plan.service_dates, ["ServiceId", "ServiceDate"], "ServiceDatesDuplicates"),
        removed_still_present(plan.service_dates, feed.calendar_dates),
        phase1_route_count(plan.classification),
        duplicate_count(plan.trip_stops, ["TripInstanceKey", "StopSequence"], "TripStopDuplicates"),
        after_midnight_count(plan.normalized),
        dim_route_checks(plan.dim_route),
        dim_stop_checks(plan.dim_stop),
        duplicate_count(plan.fact, ["TripInstanceKey", "StopSequence"], "FactDuplicates"),
        fact_reference_gaps(plan.fact, plan.dim_date, plan.dim_route, plan.dim_stop),
    ])


def staged_counts(feed) -> DataFrame:
    """Row count per staged table."""
    return aggregates.table_counts({name: getattr(feed, name) for name in _staged(feed)})


def _staged(feed) -> list[str]:
    return [name for name in (*FEED_KEYS, "feed_info") if getattr(feed, name, None) is not None]
