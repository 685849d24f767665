"""Trips expanded to service dates, and trip-stops."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgrain.functions.times import SERVICE_TIME, day_offset, service_seconds, wall_time
from tripgrain.operators.calendar import service_calendars
from tripgrain.operators.joins import UNKNOWN_SIZE, estimated_bytes, lookup_join
from tripgrain.operators.keys import running_total, trip_stop_key
from tripgrain.operators.routes import in_scope


# Bytes of one date in a packed row, with its share of the row.
_DATE_BYTES = 16


def first_instance_keys(trips: DataFrame, service_dates: DataFrame, calendars: DataFrame | None = None) -> DataFrame:
    """``FirstInstanceKey`` per trip such that instances are numbered 1..n by (TripId, ServiceDate).

    The numbering runs over trips, with their number of dates as weight, never over the instances.
    ``calendars`` are the packed dates where they are stored already.
    """
    if calendars is None:
        days = service_dates.groupBy("ServiceId").agg(F.count("*").alias("_days"))
    else:
        days = calendars.select("ServiceId", F.size("ServiceDates").cast("long").alias("_days"))
    named = trips.select("TripId", "ServiceId")
    weighted = lookup_join(named, days, ["ServiceId"], ["TripId"]).select("TripId", "_days")
    numbered = running_total(weighted, ["TripId"], "_days", "_before", size=estimated_bytes(named))
    return numbered.select("TripId", (F.col("_before") + 1).alias("FirstInstanceKey"))


def trip_calendars(
    trips: DataFrame, service_dates: DataFrame, with_key: bool = False, date_rows: int | None = None,
    calendars: DataFrame | None = None,
) -> DataFrame:
    """One row per trip that runs at all, with its sorted ``ServiceDates`` kept as an array.

    Later joins move these rows instead of one row per trip and date; the fan-out comes last.
    """
    columns = ["TripId", "RouteId", "ServiceId", "DirectionId", "TripHeadsign"]
    packed = pack_dates(trips.select(*columns), service_dates, date_rows=date_rows, calendars=calendars)
    if with_key:
        packed = packed.join(first_instance_keys(trips, service_dates, calendars), "TripId")
    return packed


def pack_dates(
    trips: DataFrame, service_dates: DataFrame, heat: DataFrame | None = None, date_rows: int | None = None,
    calendars: DataFrame | None = None,
) -> DataFrame:
    """``trips`` with the array of dates of their service; trips without a date drop out.

    ``date_rows`` is an upper bound of the rows of ``service_dates``; without one nothing is broadcast.
    ``calendars`` are the packed dates where they are stored already.
    """
    size = UNKNOWN_SIZE if date_rows is None else date_rows * _DATE_BYTES
    if calendars is None:
        calendars = service_calendars(service_dates)
    return lookup_join(trips, calendars, ["ServiceId"], ["TripId"], size=size, heat=heat)


def fan_out(packed: DataFrame) -> DataFrame:
    """One row per service date of each row in ``packed``, with ``TripInstanceKey`` when it is keyed."""
    keep = [c for c in packed.columns if c not in ("ServiceDates", "FirstInstanceKey")]
    if "FirstInstanceKey" not in packed.columns:
        return packed.select(*keep, F.explode("ServiceDates").alias("ServiceDate"))
    return packed.select(
        *keep, "FirstInstanceKey", F.posexplode("ServiceDates").alias("_day", "ServiceDate")
    ).select(*keep, "ServiceDate", (F.col("FirstInstanceKey") + F.col("_day")).alias("TripInstanceKey"))


def expand_trips(
    trips: DataFrame, service_dates: DataFrame, with_key: bool = True, date_rows: int | None = None,
    calendars: DataFrame | None = None,
) -> DataFrame:
    """One row per trip and service date."""
    rows = fan_out(trip_calendars(trips, service_dates, with_key, date_rows, calendars))
    key = ["TripInstanceKey"] if with_key else []
    return rows.select(
        *key, "TripId", "ServiceDate", "RouteId", "ServiceId", "DirectionId", "TripHeadsign"
    )


def scoped_trips(trips: DataFrame, classification: DataFrame) -> DataFrame:
    """Trips (or trip instances) of in-scope routes, with their mode."""
    return lookup_join(trips, in_scope(classification), ["RouteId"], ["TripId"])


def build_trip_stops(trip_instances: DataFrame, classification: DataFrame, stop_times: DataFrame) -> DataFrame:
    """In-scope trip-stops from trip instances, stored one per row or still packed per trip."""
    calls = stop_times.select(
        "TripId",
        "StopId",
        "StopSequence",
        F.col("ArrivalTime").alias("ScheduledArrival"),
        F.col("DepartureTime").alias("ScheduledDeparture"),
    )
    joined = scoped_trips(trip_instances, classification).join(calls, "TripId")
    rows = fan_out(joined) if "ServiceDates" in joined.columns else joined
    keyed = "TripInstanceKey" in rows.columns
    return rows.select(
        *([trip_stop_key().alias("TripStopKey"), "TripInstanceKey"] if keyed else ["TripId"]),
        "ServiceDate",
        "RouteId",
        "TransportMode",
        "StopId",
        "StopSequence",
        "ScheduledArrival",
        "ScheduledDeparture",
    )


def normalize_times(trip_stops: DataFrame) -> DataFrame:
    """Wall-clock timestamps and day offsets beside the raw service times."""
    seconds = {
        "_arr": service_seconds(F.col("ScheduledArrival")),
        "_dep": service_seconds(F.col("ScheduledDeparture")),
    }
    return wall_times(trip_stops.withColumns(seconds))


def wall_times(rows: DataFrame) -> DataFrame:
    """Replace the service seconds ``_arr`` and ``_dep`` by timestamps and day offsets."""
    day, arrival, departure = F.col("ServiceDate"), F.col("_arr"), F.col("_dep")
    return rows.withColumns({
        "ScheduledArrivalDateTime": wall_time(day, arrival),
        "ScheduledDepartureDateTime": wall_time(day, departure),
        "ArrivalDayOffset": day_offset(arrival),
        "DepartureDayOffset": day_offset(departure),
    }).drop("_arr", "_dep")


def after_midnight(normalized: DataFrame) -> DataFrame:
    return normalized.filter("ArrivalDayOffset > 0 OR DepartureDayOffset > 0")


def estimate_trip_stops(
    trips: DataFrame, service_dates: DataFrame, stop_times: DataFrame, route_filter: DataFrame | None = None
) -> DataFrame:
    """Number of trip-stop rows a full fan-out would have, from counts on both sides.

    ``route_filter`` is a table with a RouteId column; without it all trips are counted.
    """
    days = service_dates.groupBy("ServiceId").agg(F.count("*").alias("_days"))
    stops = stop_times.groupBy("TripId").agg(F.count("*").alias("_stops"))
    wanted = trips.select("TripId", "RouteId", "ServiceId")
    if route_filter is not None:
        wanted = lookup_join(wanted, route_filter.select("RouteId"), ["RouteId"], ["TripId"], "left_semi")
    weighted = lookup_join(wanted, days, ["ServiceId"], ["TripId"]).join(stops, "TripId")
    return weighted.agg(
        F.coalesce(F.sum(F.col("_days") * F.col("_stops")), F.lit(0)).alias("EstimatedRows")
    )


def has_bad_format(text):
    """A present service time that does not have the H:MM:SS or HH:MM:SS form."""
    return text.isNotNull() & ~text.rlike(SERVICE_TIME)
