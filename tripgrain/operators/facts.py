"""The trip-stop fact and its analytical view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgrain.operators.joins import lookup_join

FACT_COLUMNS = (
    "FactTripStopKey", "DateKey", "RouteKey", "StopKey", "TripInstanceKey", "StopSequence",
    "ScheduledArrivalDateTime", "ScheduledDepartureDateTime", "ArrivalDayOffset", "DepartureDayOffset",
)

VIEW_COLUMNS = (
    "FactTripStopKey", "TripInstanceKey", "StopSequence", "ServiceDate", "DayName", "MonthName",
    "WeekNumber", "IsWeekend", "RouteKey", "RouteId", "RouteShortName", "TransportMode", "OperatorName",
    "StopKey", "StopId", "StopName", "ParentStationName", "PlatformCode", "Latitude", "Longitude",
    "ScheduledArrivalDateTime", "ScheduledDepartureDateTime", "ArrivalDayOffset", "DepartureDayOffset",
)


def resolve_keys(
    normalized: DataFrame, dim_date: DataFrame, dim_route: DataFrame, dim_stop: DataFrame
) -> DataFrame:
    """Fact rows: business identifiers of normalized trip-stops replaced by dimension keys.

    The date dimension has one row per day and is broadcast; routes and stops are joined by size.
    """
    days = F.broadcast(dim_date.select("DateKey", F.col("FullDate").alias("ServiceDate")))
    spread = ["TripStopKey"]
    rows = normalized.join(days, "ServiceDate")
    rows = lookup_join(rows, dim_route.select("RouteId", "RouteKey"), ["RouteId"], spread)
    rows = lookup_join(rows, dim_stop.select("StopId", "StopKey"), ["StopId"], spread)
    return rows.withColumnRenamed("TripStopKey", "FactTripStopKey").select(*FACT_COLUMNS)


def trip_stop_analytics(
    fact: DataFrame, dim_date: DataFrame, dim_route: DataFrame, dim_stop: DataFrame
) -> DataFrame:
    """Star join: the fact with readable dimension attributes."""
    days = F.broadcast(dim_date.withColumnRenamed("FullDate", "ServiceDate"))
    spread = ["FactTripStopKey"]
    rows = fact.join(days, "DateKey")
    rows = lookup_join(rows, dim_route, ["RouteKey"], spread)
    return lookup_join(rows, dim_stop, ["StopKey"], spread).select(*VIEW_COLUMNS)


def trip_itinerary(fact: DataFrame, trip_instance_key: int) -> DataFrame:
    """Stops of one trip instance in order."""
    return fact.filter(F.col("TripInstanceKey") == trip_instance_key).orderBy("StopSequence")
