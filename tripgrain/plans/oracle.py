"""The same queries as DuckDB SQL, written from the definition of each table rather than from our plans."""

from __future__ import annotations

import re

from tripgrain.plans.adapter import VIEWS, duckdb_text
from tripgrain.plans.catalog import EVENTS_TEXT, OFFICIAL_TEXT, PERFORMANCE_TEXT
from tripgrain.schemas import FEED

TABLES: dict[str, str] = {name: duckdb_text(name) for name in VIEWS}

_SECONDS = (
    "CAST(split_part({0}, ':', 1) AS INT) * 3600 + CAST(split_part({0}, ':', 2) AS INT) * 60"
    " + CAST(split_part({0}, ':', 3) AS INT)"
)
_ARR, _DEP = _SECONDS.format("ScheduledArrival"), _SECONDS.format("ScheduledDeparture")


def _times(day: str = "ServiceDate") -> str:
    return f"""
 CAST({day} AS TIMESTAMP) + to_seconds({_ARR}) AS ScheduledArrivalDateTime,
 CAST({day} AS TIMESTAMP) + to_seconds({_DEP}) AS ScheduledDepartureDateTime,
 CAST(({_ARR}) // 86400 AS INT) AS ArrivalDayOffset, CAST(({_DEP}) // 86400 AS INT) AS DepartureDayOffset"""


# Route type, prefix, mode, rule text and order of precedence.
_CLASSES = """(VALUES (106, 'RE', 'RE', 'RouteType 106 + RE prefix', 1), (106, 'RB', 'RB', 'RouteType 106 + RB prefix', 2),
 (109, 'S', 'S-Bahn', 'RouteType 109 + S prefix', 3), (106, '', 'Other Rail', 'Excluded from Phase 1 after profiling', 9),
 (109, '', 'Other Rail', 'Excluded from Phase 1 after profiling', 9)) AS k(type, prefix, mode, rule, place)"""


def _classes(name: str) -> str:
    """Of all classes that fit a route, the first."""
    return f"""
SELECT RouteId, RouteShortName, RouteType, best.mode AS TransportMode, best.place < 9 AS IsPhase1, best.rule AS ClassificationRule
FROM (SELECT r.RouteId, r.RouteShortName, r.RouteType, arg_min(k, k.place) AS best
 FROM routes r JOIN {_CLASSES} ON k.type = r.RouteType AND starts_with(coalesce({name}, ''), k.prefix) GROUP BY ALL) AS b"""


_MINUTE = "date_trunc('minute', {0})"

TABLES |= {
    "regular_dates": """
SELECT ServiceId, ServiceDate FROM (
 SELECT *, CAST(unnest(generate_series(strptime(StartDate, '%Y%m%d'), strptime(EndDate, '%Y%m%d'), INTERVAL 1 DAY)) AS DATE)
  AS ServiceDate FROM calendar) AS r
WHERE CASE isodow(ServiceDate) WHEN 1 THEN Monday WHEN 2 THEN Tuesday WHEN 3 THEN Wednesday WHEN 4 THEN Thursday
 WHEN 5 THEN Friday WHEN 6 THEN Saturday ELSE Sunday END = 1""",
    "exceptions": """
SELECT ServiceId, CAST(strptime(ServiceDate, '%Y%m%d') AS DATE) AS ServiceDate, ExceptionType FROM calendar_dates""",
    "service_dates": """
(SELECT ServiceId, ServiceDate FROM regular_dates
 UNION SELECT ServiceId, ServiceDate FROM exceptions WHERE ExceptionType = 1)
EXCEPT SELECT ServiceId, ServiceDate FROM exceptions WHERE ExceptionType = 2""",
    "trip_instances": """
SELECT row_number() OVER (ORDER BY t.TripId, sd.ServiceDate) AS TripInstanceKey, t.TripId, sd.ServiceDate, t.RouteId,
 t.ServiceId, t.DirectionId, t.TripHeadsign FROM trips t JOIN service_dates sd ON t.ServiceId = sd.ServiceId""",
    "route_classification": _classes("RouteShortName"),
    "classification_ignore_case": _classes("upper(RouteShortName)"),
    # a trip's days as a list: an instance is a place in it, after the days of all trips before
    "trip_days": """
SELECT t.TripId, t.RouteId, d.days, CAST(sum(len(d.days)) OVER (ORDER BY t.TripId) - len(d.days) AS BIGINT) AS earlier
FROM trips t JOIN (SELECT ServiceId, list(ServiceDate ORDER BY ServiceDate) AS days FROM service_dates GROUP BY ServiceId) AS d
 ON d.ServiceId = t.ServiceId""",
    "trip_stops": """
SELECT (TripInstanceKey << 20) + StopSequence AS TripStopKey, * FROM (
 SELECT b.earlier + unnest(range(1, len(b.days) + 1)) AS TripInstanceKey, unnest(b.days) AS ServiceDate, b.RouteId, c.TransportMode,
  x.StopId, x.StopSequence, x.ArrivalTime AS ScheduledArrival, x.DepartureTime AS ScheduledDeparture
 FROM stop_times x, trip_days b, route_classification c
 WHERE x.TripId = b.TripId AND b.RouteId = c.RouteId AND c.TransportMode IN ('RE', 'RB', 'S-Bahn')) AS calls""",
    "normalized": f"SELECT *, {_times()} FROM trip_stops",
    "dim_date": """
SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS DateKey, d AS FullDate, CAST(day(d) AS INT) AS DayNumber, dayname(d) AS DayName,
 CAST(dayofweek(d) + 1 AS INT) AS DayOfWeek, CAST(weekofyear(d) AS INT) AS WeekNumber, CAST(month(d) AS INT) AS MonthNumber,
 monthname(d) AS MonthName, CAST(quarter(d) AS INT) AS QuarterNumber, CAST(year(d) AS INT) AS YearNumber,
 dayname(d) IN ('Saturday', 'Sunday') AS IsWeekend
FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM
 (SELECT CAST(min(ServiceDate) AS TIMESTAMP) AS lo, CAST(max(ServiceDate) AS TIMESTAMP) AS hi FROM trip_stops) AS b) AS s""",
    "route_places": """
SELECT RouteId, TransportMode, CAST(rank() OVER (ORDER BY RouteId) AS INT) AS RouteKey FROM route_classification
WHERE ClassificationRule NOT LIKE 'Excluded%'""",
    "dim_route": """
SELECT RouteKey, RouteId, RouteShortName, RouteLongName, TransportMode, AgencyId,
 (SELECT any_value(AgencyName) FROM agency WHERE agency.AgencyId = routes.AgencyId) AS OperatorName, RouteType AS SourceRouteType
FROM routes NATURAL JOIN route_places""",
    "dim_stop": """
SELECT CAST(row_number() OVER (ORDER BY StopId) AS INT) AS StopKey, * FROM (
 SELECT DISTINCT s.StopId, s.StopName, s.ParentStation AS ParentStationId, ps.StopName AS ParentStationName, s.PlatformCode,
  s.StopLat AS Latitude, s.StopLon AS Longitude, s.LocationType, s.WheelchairBoarding
 FROM trip_stops p JOIN stops s ON p.StopId = s.StopId LEFT JOIN stops ps ON s.ParentStation = ps.StopId) AS u""",
    # straight from the staged identifiers: the keys are counted here, so no key join is repeated
    "fact": """
SELECT TripStopKey AS FactTripStopKey, CAST(strftime(ServiceDate, '%Y%m%d') AS INT) AS DateKey, RouteKey,
 CAST(dense_rank() OVER (ORDER BY StopId) AS INT) AS StopKey, TripInstanceKey, StopSequence, COLUMNS('DateTime$|DayOffset$')
FROM normalized JOIN route_places USING (RouteId) WHERE StopId IN (SELECT StopId FROM stops)""",
    "view": """
SELECT TripStopKey AS FactTripStopKey, TripInstanceKey, StopSequence, ServiceDate, dayname(ServiceDate) AS DayName,
 monthname(ServiceDate) AS MonthName, CAST(weekofyear(ServiceDate) AS INT) AS WeekNumber, isodow(ServiceDate) > 5 AS IsWeekend,
 RouteKey, RouteId, RouteShortName, o.TransportMode,
 (SELECT any_value(AgencyName) FROM agency WHERE agency.AgencyId = routes.AgencyId) AS OperatorName,
 CAST(dense_rank() OVER (ORDER BY StopId) AS INT) AS StopKey, StopId, here.StopName,
 (SELECT any_value(u.StopName) FROM stops u WHERE u.StopId = here.ParentStation) AS ParentStationName,
 here.PlatformCode, here.StopLat AS Latitude, here.StopLon AS Longitude, COLUMNS('DateTime$|DayOffset$')
FROM normalized JOIN route_places o USING (RouteId) JOIN routes USING (RouteId) JOIN stops here USING (StopId)""",
    # realtime
    "state": """
SELECT l.* EXCLUDE (CapturedAt, pos), a.FirstCapturedAt, a.LatestCapturedAt, a.ObservationCount FROM (
 SELECT *, row_number() OVER (PARTITION BY DbEventId ORDER BY CapturedAt DESC, ObservationKey DESC) AS pos FROM observations) AS l
JOIN (SELECT DbEventId, min(CapturedAt) AS FirstCapturedAt, max(CapturedAt) AS LatestCapturedAt, count(*) AS ObservationCount
 FROM observations GROUP BY DbEventId) AS a ON l.DbEventId = a.DbEventId WHERE l.pos = 1""",
    "first_day": "SELECT * FROM observations WHERE CapturedAt < TIMESTAMP '2024-01-02'",
    "moves": """
SELECT *, lag(ArrivalDelayMinutes) OVER w AS PreviousDelayMinutes, lag(IsArrivalCancelled) OVER w AS pc,
 lag(ChangedPlatform) OVER w AS pp, row_number() OVER w AS pos FROM observations
 WINDOW w AS (PARTITION BY DbEventId ORDER BY CapturedAt, ObservationKey)""",
    "source": """
SELECT DbEventId, CAST(DbEventId AS BIGINT) AS FactTripStopKey, ArrivalDelayMinutes, FirstCapturedAt, LatestCapturedAt,
 ObservationCount FROM state""",
    "loaded": """
SELECT DbEventId, CAST(DbEventId AS BIGINT) AS FactTripStopKey, arg_max(
 struct_pack(v := ArrivalDelayMinutes), struct_pack(a := CapturedAt, b := ObservationKey)).v AS ArrivalDelayMinutes,
 min(CapturedAt) AS FirstCapturedAt, max(CapturedAt) AS LatestCapturedAt, count(*) AS ObservationCount
FROM first_day GROUP BY DbEventId""",
    "merged": """
SELECT DbEventId, coalesce(f.FactTripStopKey, s.FactTripStopKey) AS FactTripStopKey,
 CASE WHEN f.DbEventId IS NULL OR s.LatestCapturedAt > f.LatestCapturedAt THEN s.ArrivalDelayMinutes ELSE f.ArrivalDelayMinutes END AS ArrivalDelayMinutes,
 CASE WHEN f.DbEventId IS NULL OR s.LatestCapturedAt > f.LatestCapturedAt THEN s.FirstCapturedAt ELSE f.FirstCapturedAt END AS FirstCapturedAt,
 CASE WHEN f.DbEventId IS NULL OR s.LatestCapturedAt > f.LatestCapturedAt THEN s.LatestCapturedAt ELSE f.LatestCapturedAt END AS LatestCapturedAt,
 CASE WHEN f.DbEventId IS NULL OR s.LatestCapturedAt > f.LatestCapturedAt THEN s.ObservationCount ELSE f.ObservationCount END AS ObservationCount,
 CASE WHEN f.DbEventId IS NULL THEN 'inserted' WHEN s.LatestCapturedAt > f.LatestCapturedAt THEN 'updated' ELSE 'unchanged' END AS Action
FROM source s FULL OUTER JOIN loaded f USING (DbEventId)""",
    "shifted": """
SELECT DbEventId, CASE WHEN FactTripStopKey % 3 = 0 THEN FactTripStopKey + 1 ELSE FactTripStopKey END AS FactTripStopKey FROM source""",
    "targets": """
SELECT f.FactTripStopKey, f.DateKey, coalesce(s.ParentStationId, s.StopId) AS StationId, r.RouteShortName AS LineName,
 f.ScheduledArrivalDateTime, f.ScheduledDepartureDateTime
FROM fact f JOIN dim_route r ON f.RouteKey = r.RouteKey JOIN dim_stop s ON f.StopKey = s.StopKey""",
    "rt_events": EVENTS_TEXT.replace("{targets}", "targets"),
    "station_map": """
SELECT DISTINCT CAST(coalesce(ParentStation, StopId) AS STRING) || 'E' AS StationEva, coalesce(ParentStation, StopId) AS ParentStationId
FROM stops""",
    "candidates": """
SELECT e.DbEventId, t.FactTripStopKey, t.DateKey FROM rt_events e JOIN station_map m ON e.StationEva = m.StationEva
JOIN targets t ON t.StationId = m.ParentStationId AND upper(replace(t.LineName, ' ', '')) = upper(replace(e.LineName, ' ', ''))
 AND coalesce(e.PlannedArrival, t.ScheduledArrivalDateTime) = t.ScheduledArrivalDateTime
 AND coalesce(e.PlannedDeparture, t.ScheduledDepartureDateTime) = t.ScheduledDepartureDateTime
WHERE coalesce(e.PlannedArrival, e.PlannedDeparture) IS NOT NULL""",
    "matched": """
SELECT c.DbEventId, c.FactTripStopKey, c.DateKey FROM candidates c
JOIN (SELECT DbEventId FROM candidates GROUP BY DbEventId HAVING count(*) = 1) AS a ON a.DbEventId = c.DbEventId
JOIN (SELECT FactTripStopKey FROM candidates GROUP BY FactTripStopKey HAVING count(*) = 1) AS b
 ON b.FactTripStopKey = c.FactTripStopKey""",
    # documents
    "plan_rows": """
SELECT e.*, h.hour AS PlanHour, h.shift FROM events e, (SELECT '01' AS hour, 0 AS shift UNION ALL SELECT '02', 1) AS h""",
    # performance
    "official": OFFICIAL_TEXT.replace("{nation}", "nation"),
    "realtime_fact": PERFORMANCE_TEXT.replace("{view}", "view"),
    "perf": """
SELECT f.DbEventId, f.FactTripStopKey, coalesce(f.PlannedArrival, f.PlannedDeparture) AS PlannedTime,
 coalesce(f.ArrivalDelayMinutes, f.DepartureDelayMinutes) AS DelayMinutes,
 f.IsArrivalCancelled OR f.IsDepartureCancelled AS IsCancelled,
 CASE WHEN f.PlannedPlatform IS NOT NULL AND f.ChangedPlatform IS NOT NULL AND f.PlannedPlatform <> f.ChangedPlatform THEN 1 ELSE 0 END
  AS PlatformChanged,
 v.TripInstanceKey, v.StopSequence, v.ServiceDate, v.RouteShortName, v.TransportMode, v.OperatorName,
 coalesce(v.ParentStationName, v.StopName) AS StationName
FROM realtime_fact f JOIN view v ON f.FactTripStopKey = v.FactTripStopKey""",
}


def _with(select: str) -> str:
    """Prefix ``select`` with the tables it needs, in order of use."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"(?:FROM|JOIN|,)\s+(\w+)", text):
            if name in TABLES and name not in order:
                visit(TABLES[name])
                if name not in order:
                    order.append(name)

    visit(select)
    if not order:
        return select
    parts = ",\n".join(f"{name} AS ({TABLES[name].strip()})" for name in order)
    return f"WITH {parts}\n{select.strip()}"


def _check(name: str, value: str, table: str) -> str:
    return f"SELECT '{name}' AS \"Check\", CAST(coalesce({value}, 0) AS BIGINT) AS Value FROM {table}"


def _count(name: str, table: str) -> str:
    return _check(name, "count(*)", table)


def _dups(name: str, table: str, keys: str) -> str:
    return _count(name, f"(SELECT {keys} FROM {table} GROUP BY {keys} HAVING count(*) > 1) AS d")


def _orphans(name: str, child: str, parent: str, key: str) -> str:
    return _count(name, f"{child} WHERE NOT EXISTS (SELECT 1 FROM {parent} WHERE {parent}.{key} = {child}.{key})")


def _coverage(table: str, key: str, date: str = "ServiceDate") -> str:
    return (
        f"SELECT count(*) AS RowCount, count(DISTINCT {key}) AS DistinctKeys, min({date}) AS FirstDate,"
        f" max({date}) AS LastDate, count(DISTINCT {date}) AS DayCount FROM {table}"
    )


def _lengths(table: str, column: str) -> str:
    size = f"length(CAST({column} AS STRING))"
    return (
        f"SELECT CAST(min({size}) AS INT) AS MinLength, CAST(max({size}) AS INT) AS MaxLength,"
        f" round(avg({size}), 6) AS AvgLength FROM {table}"
    )


def _estimate(where: str = "") -> str:
    return f"""
SELECT CAST(coalesce(sum(n.days * m.stops), 0) AS BIGINT) AS EstimatedRows FROM trips t
JOIN (SELECT ServiceId, count(*) AS days FROM service_dates GROUP BY ServiceId) AS n ON n.ServiceId = t.ServiceId
JOIN (SELECT TripId, count(*) AS stops FROM stop_times GROUP BY TripId) AS m ON m.TripId = t.TripId {where}"""


def _measures(by: str) -> str:
    names = ", ".join(part.split(" AS ")[-1] for part in by.split(";"))
    return f"""
SELECT {by.replace(';', ',')}, count(*) AS StopCount, count(DelayMinutes) AS DelayCount, round(avg(DelayMinutes), 6) AS AvgDelay,
 count(*) FILTER (WHERE IsCancelled) AS CancelledCount, round(avg(CAST(IsCancelled AS INT)), 6) AS CancellationRate,
 round(avg(CAST(DelayMinutes <= 5 AS INT)), 6) AS PunctualityRate, CAST(sum(PlatformChanged) AS BIGINT) AS PlatformChangeCount
FROM perf GROUP BY {names}"""


def _punctuality(by: str, names: str) -> str:
    return f"""
SELECT {by}, count(DelayMinutes) AS DelayCount, count(*) FILTER (WHERE DelayMinutes <= 5) AS PunctualCount,
 round(avg(CAST(DelayMinutes <= 5 AS INT)), 6) AS PunctualityRate FROM perf GROUP BY {names}"""


def _volume(by: str, names: str, table: str = "view") -> str:
    return f"SELECT {by}, count(*) AS ScheduledStopCount FROM {table} GROUP BY {names}"


_LATE = " OR ".join(f"({_SECONDS.format(c)}) >= 86400" for c in ("ArrivalTime", "DepartureTime"))
_FORMAT = "^[0-9]{1,2}:[0-5][0-9]:[0-5][0-9]$"
_BAD = " OR ".join(f"NOT regexp_full_match({c}, '{_FORMAT}')" for c in ("ArrivalTime", "DepartureTime"))
_MOVED = "(PlannedPlatform IS NOT NULL AND ChangedPlatform IS NOT NULL AND PlannedPlatform <> ChangedPlatform)"
_ROUTE_DELAY = """
SELECT RouteShortName, TransportMode, count(DelayMinutes) AS DelayCount, round(avg(DelayMinutes), 6) AS AvgDelay,
 round(quantile_cont(DelayMinutes, 0.5), 6) AS MedianDelay, round(quantile_cont(DelayMinutes, 0.9), 6) AS P90Delay,
 max(DelayMinutes) AS MaxDelay FROM perf GROUP BY RouteShortName, TransportMode"""
_WINDOWS = """
SELECT time_bucket(INTERVAL 15 MINUTE, CapturedAt) AS WindowStart,
 time_bucket(INTERVAL 15 MINUTE, CapturedAt) + INTERVAL 15 MINUTE AS WindowEnd, PlannedPlatform, count(*) AS ObservationCount,
 count(ArrivalDelayMinutes) AS DelayCount, CAST(sum(ArrivalDelayMinutes) AS BIGINT) AS DelaySum, max(ArrivalDelayMinutes) AS MaxDelay
FROM observations GROUP BY ALL"""
_SUMMARY = f"""
SELECT count(*) AS TotalRows, count(*) FILTER (WHERE IsArrivalCancelled) AS ArrivalCancelled,
 count(*) FILTER (WHERE ChangedPlatform IS NOT NULL) AS WithChangedPlatform, count(*) FILTER (WHERE {_MOVED}) AS PlatformChanged
FROM observations"""
_CHANGED_TIME = _MINUTE.format("ts + to_minutes(CAST(event_id % 31 AS BIGINT))")

_TOTAL = "SELECT TransportMode, count(*) AS n FROM {0} GROUP BY TransportMode"

_COLUMNS = {
    "agency": "AgencyId AgencyName",
    "routes": "RouteId AgencyId RouteType RouteShortName RouteLongName",
    "trips": "TripId RouteId ServiceId DirectionId TripHeadsign",
    "stops": "StopId StopName ParentStation PlatformCode StopLat StopLon LocationType WheelchairBoarding",
    "stop_times": "TripId StopSequence StopId ArrivalTime DepartureTime",
    "calendar": "ServiceId Monday Tuesday Wednesday Thursday Friday Saturday Sunday StartDate EndDate",
    "calendar_dates": "ServiceId ServiceDate ExceptionType",
    "feed_info": "FeedPublisherName FeedPublisherUrl FeedLang FeedStartDate FeedEndDate FeedVersion",
}



def _unfilled(table: str) -> str:
    """The columns of a feed table that its view leaves out, as NULLs of their types."""
    kinds = re.findall(r"(\w+) ([a-z]+(?:\(\d+,\d+\))?)", FEED[table])
    return "".join(f", CAST(NULL AS {kind}) AS {c}" for c, kind in kinds if c not in _COLUMNS[table].split())


_SELECTS: dict[str, str] = {
    # feed files
    **{f"read_{name}": f"SELECT * REPLACE ({', '.join(f'CAST({c} AS STRING) AS {c}' for c in ids)}){_unfilled(name)} FROM {name}" for name, ids in (
        ("agency", ("AgencyId",)), ("routes", ("RouteId", "AgencyId")), ("trips", ("TripId", "RouteId", "ServiceId")),
        ("stops", ("StopId", "ParentStation")), ("stop_times", ("TripId", "StopId")), ("calendar", ("ServiceId",)),
        ("calendar_dates", ("ServiceId",)), ("feed_info", ("FeedVersion",)))},
    "load_stamp": "SELECT RouteId, true AS HasLoadStamp FROM routes",
    "table_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS TableName, count(*) AS RowCount FROM {name}" for name in (
            "agency", "routes", "trips", "stops", "stop_times", "calendar", "calendar_dates", "feed_info")),
    # scheduled side
    "regular_dates": "SELECT * FROM regular_dates",
    "service_dates": "SELECT * FROM service_dates",
    "trip_instances": "SELECT * FROM trip_instances",
    "route_classification": "SELECT * FROM route_classification",
    "classification_ignore_case": "SELECT * FROM classification_ignore_case",
    "classification_summary": """
SELECT TransportMode, IsPhase1, count(*) AS RouteCount FROM route_classification GROUP BY TransportMode, IsPhase1""",
    "trip_stops": "SELECT * FROM trip_stops",
    "trip_stops_normalized": "SELECT * FROM normalized",
    "after_midnight": "SELECT * FROM normalized WHERE ArrivalDayOffset > 0 OR DepartureDayOffset > 0",
    "dim_date": "SELECT * FROM dim_date",
    "dim_route": "SELECT * FROM dim_route",
    "dim_stop": "SELECT * FROM dim_stop",
    "fact_trip_stop": "SELECT * FROM fact",
    "trip_stop_analytics": "SELECT * FROM view",
    "fact_layout": "SELECT DateKey, count(*) AS RowCount, count(DISTINCT TripInstanceKey) AS TripCount FROM fact GROUP BY DateKey",
    "trip_itinerary": "SELECT * FROM fact WHERE TripInstanceKey = (SELECT min(TripInstanceKey) FROM fact)",
    "volume_by_mode": _volume("TransportMode", "TransportMode"),
    "volume_by_route": _volume("RouteShortName, TransportMode, OperatorName", "RouteShortName, TransportMode, OperatorName"),
    "volume_by_station": _volume("coalesce(ParentStationName, StopName) AS StationName", "ALL"),
    "top_routes": _volume("RouteShortName, TransportMode, OperatorName", "ALL")
    + " ORDER BY ScheduledStopCount DESC, RouteShortName, TransportMode, OperatorName NULLS FIRST LIMIT 10",
    "top_stations": _volume("coalesce(ParentStationName, StopName) AS StationName", "ALL")
    + " ORDER BY ScheduledStopCount DESC, StationName LIMIT 10",
    "preview_instances": """
SELECT TripInstanceKey, TripId, ServiceDate, RouteId, ServiceId FROM trip_instances ORDER BY ServiceDate, TripInstanceKey LIMIT 20""",
    "preview_stops": """
SELECT StopKey, StopId, StopName, ParentStationName FROM dim_stop ORDER BY coalesce(ParentStationName, StopName), StopName, StopId LIMIT 30""",
    "estimate_trip_stops": _estimate(),
    "estimate_scope": _estimate("JOIN route_classification rc ON rc.RouteId = t.RouteId AND rc.IsPhase1"),
    "estimate_rail_types": _estimate("JOIN route_classification rc ON rc.RouteId = t.RouteId"),
    # generic
    "row_count": "SELECT count(*) AS RowCount FROM lineitem",
    "duplicates": """
SELECT l_orderkey, l_linenumber, count(*) AS DuplicateCount FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "coverage": _coverage("(SELECT o_custkey, CAST(o_orderdate AS DATE) AS OrderDay FROM orders) AS o", "o_custkey", "OrderDay"),
    "distribution": "SELECT p_type, count(*) AS RowCount FROM part GROUP BY p_type",
    "length_profile": _lengths("part", "p_name"),
    **{name: """
SELECT c_custkey, c_mktsegment, row_number() OVER (ORDER BY c_mktsegment, c_custkey) AS DenseKey FROM customer"""
       for name in ("dense_key", "dense_key_distributed")},
    "running_total_distributed": """
SELECT o_orderkey, o_custkey % 7 AS Weight, CAST(coalesce(sum(o_custkey % 7) OVER (ORDER BY o_orderkey
 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS Before FROM orders""",
    "reconcile_counts": "SELECT (SELECT count(*) FROM trip_stops) AS WorkRowCount, (SELECT count(*) FROM fact) AS FactRowCount",
    "require_unique": "SELECT * FROM service_dates",
    # data quality
    "dq_trip_references": _orphans("MissingTripId", "stop_times", "trips", "TripId"),
    "dq_stop_references": _orphans("MissingStopId", "stop_times", "stops", "StopId"),
    "dq_route_references": _orphans("MissingRouteId", "trips", "routes", "RouteId"),
    "dq_agency_references": _orphans("MissingAgencyId", "routes", "agency", "AgencyId"),
    "dq_service_definitions": _count("ServiceIdsWithoutCalendarDefinition", """(SELECT DISTINCT ServiceId FROM trips) AS t
 WHERE NOT EXISTS (SELECT 1 FROM calendar c WHERE c.ServiceId = t.ServiceId)
 AND NOT EXISTS (SELECT 1 FROM calendar_dates x WHERE x.ServiceId = t.ServiceId)"""),
    "dq_line_grain": _dups("LineDuplicates", "lineitem", "l_orderkey, l_linenumber"),
    "dq_stop_time_grain": _dups("StopTimesDuplicates", "stop_times", "TripId, StopSequence"),
    "dq_late_hours": _count("TimesAfter24", f"stop_times WHERE {_LATE}"),
    "dq_time_format": _count("InvalidTimeFormat", f"stop_times WHERE {_BAD}"),
    "dq_service_date_grain": _dups("ServiceDatesDuplicates", "service_dates", "ServiceId, ServiceDate"),
    "dq_service_date_coverage": _coverage("service_dates", "ServiceId"),
    **{name: _count("RemovedServicesStillPresent", f"""exceptions x WHERE x.ExceptionType = 2 AND EXISTS (
 SELECT 1 FROM {table} s WHERE s.ServiceId = x.ServiceId AND s.ServiceDate = x.ServiceDate)""")
       for name, table in (("dq_removed_dates", "service_dates"), ("dq_removed_dates_raw", "regular_dates"))},
    "dq_instance_coverage": _coverage("trip_instances", "TripId"),
    "dq_trip_id_length": _lengths("trips", "TripId"),
    "dq_route_types": "SELECT RouteType, count(*) AS RowCount FROM routes GROUP BY RouteType",
    "dq_phase1_routes": _count("Phase1RouteCount", "route_classification WHERE IsPhase1"),
    "dq_trip_stop_modes": _volume("TransportMode", "TransportMode", "trip_stops"),
    "dq_trip_stop_grain": _dups("TripStopDuplicates", "trip_stops", "TripInstanceKey, StopSequence"),
    "dq_trip_stop_coverage": _coverage("trip_stops", "RouteId"),
    "dq_after_midnight": _count("AfterMidnightStopCount", "normalized WHERE ArrivalDayOffset > 0 OR DepartureDayOffset > 0"),
    "dq_dim_date_coverage": _coverage("dim_date", "DateKey", "FullDate"),
    "dq_dim_route": _count("RouteCount", "dim_route") + " UNION ALL "
    + _count("MissingOperatorCount", "dim_route WHERE OperatorName IS NULL"),
    "dq_dim_stop": " UNION ALL ".join([
        _count("StopCount", "dim_stop"),
        _count("StopsWithParentStation", "dim_stop WHERE ParentStationId IS NOT NULL"),
        _count("MissingStopNameCount", "dim_stop WHERE StopName IS NULL"),
        _count("MissingCoordinatesCount", "dim_stop WHERE Latitude IS NULL OR Longitude IS NULL")]),
    "dq_fact_grain": _dups("FactDuplicates", "fact", "TripInstanceKey, StopSequence"),
    "dq_mode_totals": f"""
SELECT TransportMode, coalesce(w.n, 0) AS WorkRows, coalesce(v.n, 0) AS ViewRows, coalesce(w.n, 0) - coalesce(v.n, 0) AS Difference
FROM ({_TOTAL.format('trip_stops')}) AS w FULL OUTER JOIN ({_TOTAL.format('view')}) AS v USING (TransportMode)""",
    "dq_null_profile": " UNION ALL ".join(
        f"SELECT '{table}' AS TableName, '{c}' AS ColumnName, count(*) AS NullCount FROM {table} WHERE {c} IS NULL"
        for table, columns in _COLUMNS.items() for c in columns.split()),
    "dq_coordinates": _count("MissingCoordinates", "stops WHERE StopLat IS NULL OR StopLon IS NULL") + " UNION ALL "
    + _count("InvalidCoordinates", "stops WHERE abs(StopLat) > 90 OR abs(StopLon) > 180"),
    "dq_stop_sequences": _count("NegativeStopSequence", "stop_times WHERE StopSequence < 0") + " UNION ALL "
    + _count("TimeGoesBackward", f"""(SELECT {_SECONDS.format('ArrivalTime')} AS here,
 lag({_SECONDS.format('DepartureTime')}) OVER (PARTITION BY TripId ORDER BY StopSequence) AS gone FROM stop_times) AS x WHERE here < gone"""),
    "dq_fact_references": " UNION ALL ".join([
        _orphans("FactWithoutDate", "fact", "dim_date", "DateKey"),
        _orphans("FactWithoutRoute", "fact", "dim_route", "RouteKey"),
        _orphans("FactWithoutStop", "fact", "dim_stop", "StopKey")]),
    "dq_service_ranges": " UNION ALL ".join([
        _count("StartAfterEnd", "calendar WHERE StartDate > EndDate"),
        _count("UnreadableRange", "calendar WHERE try_strptime(StartDate, '%Y%m%d') IS NULL OR try_strptime(EndDate, '%Y%m%d') IS NULL"),
        _count("ExceptionOutsideFeed", "calendar_dates WHERE ServiceDate < '20260701' OR ServiceDate > '20260915'"),
        _count("UnreadableExceptionDate", "calendar_dates WHERE try_strptime(ServiceDate, '%Y%m%d') IS NULL")]),
    "dq_feed_duplicates": " UNION ALL ".join(
        _dups(f"{name} duplicates", name, keys) for name, keys in (
            ("agency", "AgencyId"), ("routes", "RouteId"), ("trips", "TripId"), ("stops", "StopId"),
            ("stop_times", "TripId, StopSequence"), ("calendar", "ServiceId"), ("calendar_dates", "ServiceId, ServiceDate"))),
    # observations
    "latest_per_event": """
SELECT * EXCLUDE (pos) FROM (SELECT *, row_number() OVER (PARTITION BY DbEventId ORDER BY CapturedAt DESC, ObservationKey DESC) AS pos
 FROM observations) AS l WHERE pos = 1""",
    "event_state": "SELECT * FROM state",
    "observation_summary": _SUMMARY,
    "delay_evolution": """
SELECT DbEventId, ObservationKey, CapturedAt, ArrivalDelayMinutes, PreviousDelayMinutes,
 ArrivalDelayMinutes - PreviousDelayMinutes AS DelayChange FROM moves""",
    "first_change": f"""
SELECT DbEventId, min(CapturedAt) FILTER (WHERE IsArrivalCancelled) AS FirstCancelledAt,
 min(CapturedAt) FILTER (WHERE {_MOVED}) AS FirstPlatformChangeAt FROM observations GROUP BY DbEventId""",
    "change_frequency": """
SELECT DbEventId, count(*) AS ObservationCount, count(*) FILTER (WHERE pos > 1 AND (ArrivalDelayMinutes IS DISTINCT FROM PreviousDelayMinutes
 OR IsArrivalCancelled IS DISTINCT FROM pc OR ChangedPlatform IS DISTINCT FROM pp)) AS ChangeCount FROM moves GROUP BY DbEventId""",
    "platform_changed": f"SELECT ObservationKey, CAST({_MOVED} AS INT) AS PlatformChanged FROM observations",
    "retention": """
SELECT ObservationKey, DbEventId, CapturedAt FROM observations WHERE CapturedAt >= TIMESTAMP '2024-01-21'""",
    "delay_windows": _WINDOWS,
    "delay_windows_stream": f"""
SELECT * FROM ({_WINDOWS}) AS w WHERE WindowEnd <= (SELECT max(CapturedAt) FROM observations) - INTERVAL 30 MINUTE""",
    "append_observations": "SELECT * FROM observations",
    "summary_difference": " UNION ALL ".join(
        f"SELECT '{m}' AS Measure, {m} AS SourceValue, {m} AS TableValue, CAST(0 AS BIGINT) AS Difference FROM ({_SUMMARY}) AS s"
        for m in ("TotalRows", "ArrivalCancelled", "WithChangedPlatform", "PlatformChanged")),
    # documents
    "flatten_plan": f"""
SELECT CAST(event_id AS STRING) AS DbEventId, CAST(user_id AS STRING) AS StationEva, event_type AS TrainCategory,
 CAST(user_id AS STRING) AS TrainNumber, 'S' || CAST(event_id % 12 AS STRING) AS LineName, {_MINUTE.format('ts')} AS PlannedArrival,
 CASE WHEN event_id % 2 = 0 THEN {_MINUTE.format('ts + INTERVAL 2 MINUTE')} END AS PlannedDeparture,
 CAST(event_id % 5 + shift AS STRING) AS PlannedPlatform, PlanHour FROM plan_rows""",
    "flatten_change": f"""
SELECT CAST(event_id AS STRING) AS DbEventId, CASE WHEN event_type <> 'error' THEN {_CHANGED_TIME} END AS ChangedArrival,
 CASE WHEN event_id % 4 = 0 THEN CAST(event_id % 7 AS STRING) END AS ChangedPlatform,
 CASE WHEN event_type = 'error' THEN 'c' END AS ArrivalStatus FROM events WHERE event_type <> 'signup'""",
    "dedup_events": """
SELECT CAST(event_id AS STRING) AS DbEventId, CAST(date_trunc('day', ts) AS TIMESTAMP) AS CapturedAt, '01' AS PlanHour,
 CAST(event_id % 5 AS STRING) AS PlannedPlatform FROM events""",
    "snapshots": f"""
SELECT CAST(event_id AS STRING) AS DbEventId, CAST(user_id AS STRING) AS StationEva, 'S' || CAST(event_id % 12 AS STRING) AS LineName,
 CAST(NULL AS STRING) AS TrainName, {_MINUTE.format('ts')} AS PlannedArrival,
 CASE WHEN event_type NOT IN ('error', 'signup') THEN {_CHANGED_TIME} END AS ChangedArrival,
 CASE WHEN event_type NOT IN ('error', 'signup') THEN CAST(event_id % 31 AS INT) END AS ArrivalDelayMinutes,
 event_type = 'error' AS IsArrivalCancelled,
 CASE WHEN event_id % 2 = 0 THEN {_MINUTE.format('ts + INTERVAL 2 MINUTE')} END AS PlannedDeparture,
 CAST(NULL AS TIMESTAMP) AS ChangedDeparture, CAST(NULL AS INT) AS DepartureDelayMinutes, false AS IsDepartureCancelled,
 CAST(event_id % 5 AS STRING) AS PlannedPlatform,
 CASE WHEN event_id % 4 = 0 AND event_type <> 'signup' THEN CAST(event_id % 7 AS STRING) END AS ChangedPlatform,
 CAST(date_trunc('day', ts) AS TIMESTAMP) AS CapturedAt FROM events""",
    "explode_path": """
SELECT CAST(event_id AS STRING) AS DbEventId, n.i AS PathPosition,
 CASE n.i WHEN 1 THEN 'A' WHEN 2 THEN 'B' ELSE CAST(event_id % 3 AS STRING) END AS PathStation
FROM plan_rows, (SELECT unnest([1, 2, 3]) AS i) AS n""",
    "land_raw": """
SELECT Kind, CapturedAt, count(*) AS DocumentCount FROM (
 SELECT 'plan' AS Kind, CAST(date_trunc('day', ts) AS TIMESTAMP) AS CapturedAt FROM plan_rows
 UNION ALL SELECT 'change', CAST(date_trunc('day', ts) AS TIMESTAMP) FROM events WHERE event_type <> 'signup') AS r GROUP BY Kind, CapturedAt""",
    # match and load
    "match_events": "SELECT * FROM matched",
    "match_unmatched": """
SELECT e.DbEventId, CASE WHEN EXISTS (SELECT 1 FROM candidates c WHERE c.DbEventId = e.DbEventId) THEN 'many' ELSE 'none' END AS Reason
FROM rt_events e WHERE NOT EXISTS (SELECT 1 FROM matched m WHERE m.DbEventId = e.DbEventId)""",
    "upsert_fact": "SELECT * FROM merged",
    "upsert_counts": """
SELECT count(*) FILTER (WHERE Action = 'updated') AS UpdatedRows, count(*) FILTER (WHERE Action = 'inserted') AS InsertedRows FROM merged""",
    "upsert_rerun": "SELECT CAST(0 AS BIGINT) AS UpdatedRows, CAST(0 AS BIGINT) AS InsertedRows",
    "sync_check": """
SELECT count(s.DbEventId) AS SourceRows, count(f.DbEventId) AS FactRows,
 count(*) FILTER (WHERE s.DbEventId IS NOT NULL AND f.DbEventId IS NOT NULL) AS MatchedRows,
 count(*) FILTER (WHERE s.LatestCapturedAt IS DISTINCT FROM f.LatestCapturedAt) AS OutOfSyncRows
FROM source s FULL OUTER JOIN loaded f ON s.DbEventId = f.DbEventId""",
    "conflicts": """
SELECT 'event moves to another trip-stop' AS Conflict, s.DbEventId AS KeyValue FROM shifted s
JOIN loaded f ON s.DbEventId = f.DbEventId WHERE s.FactTripStopKey <> f.FactTripStopKey
UNION ALL SELECT 'trip-stop moves to another event', CAST(s.FactTripStopKey AS STRING) FROM shifted s
JOIN loaded f ON s.FactTripStopKey = f.FactTripStopKey WHERE s.DbEventId <> f.DbEventId
UNION ALL SELECT 'source repeats FactTripStopKey', CAST(FactTripStopKey AS STRING) FROM shifted GROUP BY FactTripStopKey HAVING count(*) > 1""",
    "realtime_cycle": """
SELECT m.DbEventId, m.FactTripStopKey, CASE WHEN e.PlannedArrival IS NOT NULL THEN 7 END AS ArrivalDelayMinutes,
 CAST(1 AS BIGINT) AS ObservationCount FROM matched m JOIN rt_events e ON e.DbEventId = m.DbEventId""",
    # performance
    "kpi_route_delay": _ROUTE_DELAY + " ORDER BY AvgDelay DESC, RouteShortName, TransportMode LIMIT 10",
    "kpi_route_delay_all": _ROUTE_DELAY,
    "kpi_route_cancellation": """
SELECT RouteShortName, TransportMode, count(*) AS StopCount, count(*) FILTER (WHERE IsCancelled) AS CancelledCount,
 round(avg(CAST(IsCancelled AS INT)), 6) AS CancellationRate FROM perf GROUP BY RouteShortName, TransportMode""",
    "kpi_station_problems": """
SELECT StationName, count(*) AS StopCount, CAST(sum(p) AS BIGINT) AS ProblemCount, round(avg(p), 6) AS ProblemRate FROM (
 SELECT StationName, CASE WHEN IsCancelled OR coalesce(DelayMinutes > 5, false) OR PlatformChanged = 1 THEN 1 ELSE 0 END AS p FROM perf) AS x
GROUP BY StationName""",
    "kpi_mode": _measures("TransportMode"),
    "kpi_hour_weekday": _measures(
        "CAST(dayofweek(PlannedTime) + 1 AS INT) AS DayOfWeek; CAST(hour(PlannedTime) AS INT) AS HourOfDay").replace(
        "GROUP BY DayOfWeek, HourOfDay", "GROUP BY 1, 2"),
    "kpi_operator": _measures("OperatorName"),
    "kpi_peak": _measures("""CASE WHEN hour(PlannedTime) BETWEEN 6 AND 8 THEN 'Morning'
 WHEN hour(PlannedTime) BETWEEN 16 AND 18 THEN 'Evening' ELSE 'Off-peak' END AS PeakBucket"""),
    "kpi_trend": f"""
SELECT *, round(PunctualityRate - lag(PunctualityRate) OVER (PARTITION BY TransportMode ORDER BY WeekStart), 6) AS RateChange
FROM ({_punctuality("TransportMode, CAST(date_trunc('week', ServiceDate) AS DATE) AS WeekStart", "1, 2")}) AS w""",
    "kpi_punctuality": _punctuality("ServiceDate", "ServiceDate"),
    "kpi_official": f"""
SELECT w.*, o.OfficialRate, round(w.PunctualityRate - o.OfficialRate, 6) AS RateDifference
FROM ({_punctuality("TransportMode, CAST(date_trunc('month', ServiceDate) AS DATE) AS MonthStart", "1, 2")}) AS w
JOIN official o ON o.MonthStart = w.MonthStart AND o.TransportMode = w.TransportMode""",
    "delay_propagation": """
SELECT TripInstanceKey, StopSequence, DelayMinutes, lag(DelayMinutes) OVER w AS PreviousDelayMinutes,
 DelayMinutes - lag(DelayMinutes) OVER w AS DelayGained FROM perf WINDOW w AS (PARTITION BY TripInstanceKey ORDER BY StopSequence)""",
    "scheduled_volume_day": _volume("ServiceDate", "ServiceDate"),
    "scheduled_volume_route": _volume("RouteShortName", "RouteShortName"),
    "scheduled_volume_mode": _volume("TransportMode", "TransportMode"),
    "scheduled_volume_weekend": _volume("IsWeekend", "IsWeekend"),
    "scheduled_volume_hour": _volume("CAST(hour(coalesce(ScheduledDepartureDateTime, ScheduledArrivalDateTime)) AS INT) AS HourOfDay", "ALL"),
    "headways": """
SELECT StationName, RouteShortName, CAST(hour(Departure) AS INT) AS HourOfDay, CAST(sum(n) AS BIGINT) AS DepartureCount,
 CAST(min(gap) AS INT) AS MinHeadway, CAST(max(gap) AS INT) AS MaxHeadway FROM (
 SELECT *, date_diff('minute', lag(Departure) OVER (PARTITION BY StationName, RouteShortName ORDER BY Departure), Departure) AS gap FROM (
  SELECT coalesce(ParentStationName, StopName) AS StationName, RouteShortName, ScheduledDepartureDateTime AS Departure, count(*) AS n
  FROM view WHERE ScheduledDepartureDateTime IS NOT NULL GROUP BY ALL) AS d) AS g
GROUP BY StationName, RouteShortName, hour(Departure)""",
    "observation_facts": """
SELECT o.DbEventId, l.FactTripStopKey, o.CapturedAt, o.ObservationKey, o.ArrivalDelayMinutes FROM observations o
JOIN loaded l ON l.DbEventId = o.DbEventId""",
    "feed_versions": """
SELECT TripId, CASE WHEN a.s IS NULL THEN 'added' WHEN b.s IS NULL THEN 'removed' ELSE 'changed' END AS Change FROM
 (SELECT o_orderkey AS TripId, o_custkey AS s FROM orders WHERE o_orderstatus <> 'F') AS a FULL OUTER JOIN
 (SELECT o_orderkey AS TripId, o_custkey + CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS s
  FROM orders WHERE o_orderstatus <> 'P') AS b USING (TripId)
WHERE a.s IS DISTINCT FROM b.s""",
}

_SNAPSHOT_MEASURES = {
    "TotalRows": "true", "WithArrival": "PlannedArrival IS NOT NULL", "WithDeparture": "PlannedDeparture IS NOT NULL",
    "ArrivalCancelled": "IsArrivalCancelled", "DepartureCancelled": "IsDepartureCancelled",
    "WithChangedPlatform": "ChangedPlatform IS NOT NULL", "PlatformChanged": "ChangedPlatform <> PlannedPlatform",
}
_FEED_VERSIONS = {  # bounds of SHORT_FEED_TEXT
    str(version): ("20260720" if version == 1 else "20260701", {2: "20260725", 3: "99991231"}.get(version, "20261231"))
    for version in range(5)
}
_SELECTS |= {
    "realtime_two_cycles": """
SELECT DbEventId, FactTripStopKey, DateKey, CAST(1 AS BIGINT) AS ObservationCount FROM candidates
WHERE NOT (ends_with(DbEventId, '-d') AND CAST(replace(DbEventId, '-d', '') AS BIGINT) % 2 = 0)
QUALIFY count(*) OVER (PARTITION BY DbEventId) = 1 AND count(*) OVER (PARTITION BY FactTripStopKey) = 1""",
    "snapshots_split_batches": _SELECTS["snapshots"],
    "read_plan_xml": _SELECTS["flatten_plan"],
    "read_change_xml": _SELECTS["flatten_change"].replace(
        "AS ArrivalStatus", "AS ArrivalStatus, CAST(date_trunc('day', ts) AS TIMESTAMP) AS CapturedAt"),
    "rejected_documents": """
SELECT Kind, CASE WHEN event_id % 7 = 0 THEN 'not readable' WHEN event_id % 11 = 0 THEN 'no document'
 WHEN event_id % 13 = 0 THEN 'no event id' ELSE 'usable' END AS Reason, count(*) AS RowCount
FROM (SELECT 'plan' AS Kind, event_id FROM plan_rows
 UNION ALL SELECT 'change', event_id FROM events WHERE event_type <> 'signup') AS d GROUP BY ALL""",
    "rejected_lines_warehouse": """
SELECT CASE WHEN ServiceId % 10 IN (3, 7) THEN 'reject' ELSE 'row' END AS Part, count(*) AS LineCount
FROM calendar_dates GROUP BY Part""",
    "retention_rewrite": """
SELECT ObservationKey, DbEventId, CapturedAt FROM observations WHERE CapturedAt >= TIMESTAMP '2024-01-21 12:00:00'""",
    "delay_windows_upserted": _WINDOWS,
    "dq_routes_per_mode": "SELECT TransportMode, count(*) AS RouteCount FROM dim_route GROUP BY TransportMode",
    "dq_outside_feed": " UNION ALL ".join(
        f"SELECT '{version}' AS FeedVersion, * FROM ({_count(name, where)}) AS c"
        for version, (low, high) in _FEED_VERSIONS.items() for name, where in (
            ("CalendarOutsideFeed", f"calendar WHERE EndDate < '{low}' OR StartDate > '{high}'"),
            ("CalendarBeyondFeed", f"calendar WHERE StartDate < '{low}' OR EndDate > '{high}'"),
            ("ExceptionOutsideFeed", f"calendar_dates WHERE ServiceDate < '{low}' OR ServiceDate > '{high}'"))),
    "summary_difference_cut": " UNION ALL ".join(f"""
SELECT '{m}' AS Measure, count(*) FILTER ({c}) AS SourceValue, count(*) FILTER (({c}) AND CAST(DbEventId AS BIGINT) % 3 > 0) AS TableValue,
 count(*) FILTER ({c}) - count(*) FILTER (({c}) AND CAST(DbEventId AS BIGINT) % 3 > 0) AS Difference FROM ({_SELECTS['snapshots']}) AS s"""
        for m, c in _SNAPSHOT_MEASURES.items()),
}

_REPORT = (
    _orphans("MissingTripReferences", "stop_times", "trips", "TripId"),
    _orphans("MissingStopReferences", "stop_times", "stops", "StopId"),
    _orphans("MissingRouteReferences", "trips", "routes", "RouteId"),
    *(_SELECTS[name] for name in (
        "dq_service_definitions", "dq_stop_time_grain", "dq_late_hours", "dq_time_format", "dq_stop_sequences",
        "dq_coordinates", "dq_service_date_grain", "dq_removed_dates", "dq_phase1_routes", "dq_trip_stop_grain",
        "dq_after_midnight", "dq_dim_route", "dq_dim_stop", "dq_fact_grain", "dq_fact_references")),
)
_SELECTS["dq_report"] = " UNION ALL ".join(_REPORT)

ORACLE: dict[str, str] = {name: _with(text) for name, text in _SELECTS.items()}
