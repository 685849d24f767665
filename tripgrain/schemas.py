"""Declared schemas, as DDL text. Nothing is inferred from the data."""

from __future__ import annotations

import re

# Column order of the feed files.
FEED: dict[str, str] = {
    "agency": (
        "AgencyId string, AgencyName string, AgencyUrl string, AgencyTimezone string, "
        "AgencyLang string, AgencyFareUrl string, AgencyEmail string"
    ),
    "routes": (
        "RouteId string, AgencyId string, RouteShortName string, RouteLongName string, "
        "RouteType int, RouteColor string, RouteTextColor string, NvbwDlid string"
    ),
    "trips": (
        "RouteId string, ServiceId string, TripId string, ShapeId string, TripHeadsign string, "
        "TripShortName string, DirectionId int, WheelchairAccessible int"
    ),
    "stops": (
        "StopId string, StopCode string, StopName string, StopLat decimal(9,6), StopLon decimal(9,6), "
        "StopUrl string, LocationType int, ParentStation string, WheelchairBoarding int, "
        "PlatformCode string, NvbwHstDhid string"
    ),
    "stop_times": (
        "TripId string, ArrivalTime string, DepartureTime string, StopId string, StopSequence int, "
        "StopHeadsign string, PickupType int, DropOffType int, ShapeDistTraveled decimal(12,3)"
    ),
    "calendar": (
        "ServiceId string, Monday int, Tuesday int, Wednesday int, Thursday int, Friday int, "
        "Saturday int, Sunday int, StartDate string, EndDate string"
    ),
    "calendar_dates": "ServiceId string, ServiceDate string, ExceptionType int",
    "feed_info": (
        "FeedPublisherName string, FeedPublisherUrl string, FeedLang string, DefaultLang string, "
        "FeedStartDate string, FeedEndDate string, FeedVersion string, FeedContactEmail string, "
        "FeedContactUrl string"
    ),
}


def feed_columns(table: str) -> list[str]:
    """Column names of a feed table in file order."""
    return re.findall(r"(\w+) [a-z]+(?:\(\d+,\d+\))?", FEED[table])


# Business key of each staged table (feed_info holds one row and has none).
FEED_KEYS: dict[str, tuple[str, ...]] = {
    "agency": ("AgencyId",),
    "routes": ("RouteId",),
    "trips": ("TripId",),
    "stops": ("StopId",),
    "stop_times": ("TripId", "StopSequence"),
    "calendar": ("ServiceId",),
    "calendar_dates": ("ServiceId", "ServiceDate"),
}

WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

_CALL = "struct<_pt:string,_ct:string,_pp:string,_cp:string,_cs:string,_l:string,_fb:string,_ppth:string>"

# One timetable document: plan documents fill the planned attributes, change documents the others.
TIMETABLE = (
    "_station string, _eva string, "
    f"s array<struct<_id:string,_eva:string,tl:struct<_c:string,_n:string>,ar:{_CALL},dp:{_CALL}>>"
)

# A landed document: one row per station, kind ('plan' or 'change'), plan hour and capture.
RAW_DOCUMENT = "StationEva string, Kind string, PlanHour string, CapturedAt timestamp_ntz, Document string"
