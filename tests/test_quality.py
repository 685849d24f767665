"""Every check finds what it is for."""

from __future__ import annotations

from datetime import date

from tripgrain.operators import performance, quality

TIMES = "TripId string, ArrivalTime string, DepartureTime string, StopId string, StopSequence int"


def values(df):
    return {r.Check: r.Value for r in df.collect()}


def test_orphans_count_rows_and_null_keys(rows):
    child = rows([("a",), ("b",), ("b",), (None,)], "TripId string")
    parent = rows([("a",), ("a",)], "TripId string")
    assert values(quality.orphan_count(child, parent, "TripId")) == {"MissingTripId": 3}
    assert values(quality.orphan_count(parent, child, "TripId")) == {"MissingTripId": 0}


def test_uncovered_services(rows):
    trips = rows([("t1", "s1"), ("t2", "s2"), ("t3", "s3")], "TripId string, ServiceId string")
    out = quality.uncovered_services(trips, rows([("s1",)], "ServiceId string"), rows([("s2",)], "ServiceId string"))
    assert values(out) == {"ServiceIdsWithoutCalendarDefinition": 1}


def test_times(rows):
    df = rows([("t", "24:00:00", None, "s", 1), ("t", "9:61:00", "x", "s", 2), ("t", None, "26:00:00", "s", 3),
               ("t", "09:00:00", "09:01:00", "s", 4)], TIMES)
    assert values(quality.late_hours(df)) == {"TimesAfter24": 2}
    assert values(quality.bad_time_formats(df)) == {"InvalidTimeFormat": 1}


def test_sequences(rows):
    df = rows([("t", "10:00:00", "10:05:00", "s", 1), ("t", "10:04:00", "10:06:00", "s", 2), ("u", "09:00:00", None, "s", -1)], TIMES)
    assert values(quality.bad_stop_sequences(df)) == {"NegativeStopSequence": 1, "TimeGoesBackward": 1}


def test_duplicates(rows):
    df = rows([("t", 1), ("t", 1), ("t", 1), ("u", 1)], "TripId string, StopSequence int")
    assert values(quality.duplicate_count(df, ["TripId", "StopSequence"], "d")) == {"d": 1}


def test_removed_dates(rows):
    dates = rows([("s", date(2026, 7, 1))], "ServiceId string, ServiceDate date")
    exceptions = rows([("s", "20260701", 2), ("s", "20260702", 2), ("s", "20260701", 1)],
                      "ServiceId string, ServiceDate string, ExceptionType int")
    assert values(quality.removed_still_present(dates, exceptions)) == {"RemovedServicesStillPresent": 1}


def test_service_ranges(rows):
    calendar = rows([("a", "20260702", "20260701"), ("b", "2026", "20260701"), ("c", "20260701", "20260701")],
                    "ServiceId string, StartDate string, EndDate string")
    exceptions = rows([("a", "20250101"), ("a", "x"), ("a", "20260701")], "ServiceId string, ServiceDate string")
    assert values(quality.bad_service_ranges(calendar, exceptions, "20260701", "20261231")) == {
        "StartAfterEnd": 1, "UnreadableRange": 1, "ExceptionOutsideFeed": 1, "UnreadableExceptionDate": 1}


def test_coordinates(rows):
    df = rows([(50.0, 7.0), (91.0, 7.0), (50.0, -181.0), (None, 7.0)], "StopLat double, StopLon double")
    assert values(quality.bad_coordinates(df)) == {"MissingCoordinates": 1, "InvalidCoordinates": 2}


def test_null_profile(rows):
    out = quality.null_profile(rows([(1, None), (None, None)], "a int, b string"), "t").collect()
    assert {(r.TableName, r.ColumnName, r.NullCount) for r in out} == {("t", "a", 1), ("t", "b", 2)}


def test_fact_references(rows):
    fact = rows([(1, 1, 1), (2, 2, 9), (2, 9, 9)], "DateKey int, RouteKey int, StopKey int")
    known = [rows([(1,), (2,)], f"{k} int") for k in ("DateKey", "RouteKey", "StopKey")]
    assert values(quality.fact_reference_gaps(fact, *known)) == {
        "FactWithoutDate": 0, "FactWithoutRoute": 1, "FactWithoutStop": 2}


def test_dimension_checks(rows):
    routes = rows([(1, None), (2, "x")], "RouteKey int, OperatorName string")
    assert values(quality.dim_route_checks(routes)) == {"RouteCount": 2, "MissingOperatorCount": 1}
    stops = rows([("p", None, None, 1.0), (None, "n", 1.0, 1.0)],
                 "ParentStationId string, StopName string, Latitude double, Longitude double")
    assert values(quality.dim_stop_checks(stops)) == {
        "StopCount": 2, "StopsWithParentStation": 1, "MissingStopNameCount": 1, "MissingCoordinatesCount": 1}


def test_mode_reconciliation(rows):
    work = rows([("RE",), ("RE",), ("RB",)], "TransportMode string")
    view = rows([("RE",), ("S-Bahn",)], "TransportMode string")
    out = {r.TransportMode: r.Difference for r in quality.mode_reconciliation(work, view).collect()}
    assert out == {"RE": 1, "RB": 1, "S-Bahn": -1}


def test_route_delays_are_taken_from_counts_per_minute(rows):
    data = [("RE1", "RE", d) for d in (1, 1, 1, 2, 9, None)] + [("S1", "S", None)] + [("RB2", "RB", d) for d in (-3, 4)]
    out = performance.route_delays(rows(data, "RouteShortName string, TransportMode string, DelayMinutes int"))
    assert sorted(tuple(r) for r in out.collect() if r.DelayCount) == [
        ("RB2", "RB", 2, 0.5, 0.5, 3.3, 4), ("RE1", "RE", 5, 2.8, 1.0, 6.2, 9)]
    assert [tuple(r) for r in out.collect() if not r.DelayCount] == [("S1", "S", 0, None, None, None, None)]
    assert "keys=[RouteShortName" in (plan := out._jdf.queryExecution().executedPlan().toString()) and "_rows" in plan
