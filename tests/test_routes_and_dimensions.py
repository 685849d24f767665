from __future__ import annotations

from tripgrain.operators import routes, stops

ROUTES = "RouteId string, AgencyId string, RouteShortName string, RouteLongName string, RouteType int"


def route_rows(rows):
    named = [(106, "RE1"), (106, "RB2"), (109, "S3"), (109, "110"), (106, None), (106, "re5"), (3, "RE9"), (109, "RE7")]
    return rows([(f"r{i}", "A" if i != 1 else "gone", name, None, kind) for i, (kind, name) in enumerate(named)], ROUTES)


def test_classification(rows):
    out = {r.RouteId: r for r in routes.classify_routes(route_rows(rows)).collect()}
    modes = [out[f"r{i}"].TransportMode for i in (0, 1, 2, 3, 4, 5, 7)]
    assert modes == ["RE", "RB", "S-Bahn", "Other Rail", "Other Rail", "Other Rail", "Other Rail"]
    assert "r6" not in out
    assert [out[f"r{i}"].IsPhase1 for i in range(5)] == [True, True, True, False, False]
    assert out["r2"].ClassificationRule == "RouteType 109 + S prefix"
    assert out["r4"].ClassificationRule == "Excluded from Phase 1 after profiling"


def test_classification_case_switch(rows):
    out = {r.RouteId: r.TransportMode for r in routes.classify_routes(route_rows(rows), case_insensitive=True).collect()}
    assert out["r5"] == "RE"


def test_custom_rules(rows):
    tram = [routes.RouteRule(3, "RE", "Bus", "buses")]
    out = routes.classify_routes(route_rows(rows), tram, ("Rest", "none")).collect()
    assert [(r.RouteId, r.TransportMode, r.IsPhase1) for r in out] == [("r6", "Bus", True)]


def test_dim_route_keeps_routes_without_agency(rows):
    source = route_rows(rows)
    agency = rows([("A", "Operator A")], "AgencyId string, AgencyName string")
    out = {r.RouteId: r for r in routes.build_dim_route(source, routes.classify_routes(source), agency).collect()}
    assert sorted(out) == ["r0", "r1", "r2"]
    assert [out[f"r{i}"].RouteKey for i in range(3)] == [1, 2, 3]
    assert out["r0"].OperatorName == "Operator A" and out["r1"].OperatorName is None


def test_dim_stop_parents_and_used_stops(rows):
    table = rows(
        [("p", "Hbf", None), ("a", "Gleis 1", "p"), ("b", "Solo", None), ("c", "Lost", "missing"), ("unused", "x", "p")],
        "StopId string, StopName string, ParentStation string",
    ).selectExpr("*", "'1' PlatformCode", "50.0bd StopLat", "7.0bd StopLon", "0 LocationType", "0 WheelchairBoarding")
    used = rows([("a",), ("a",), ("b",), ("c",)], "StopId string")
    out = {r.StopId: r for r in stops.build_dim_stop(used, table).collect()}
    assert sorted(out) == ["a", "b", "c"]
    assert [out[s].ParentStationName for s in "abc"] == ["Hbf", None, None]
    assert out["c"].ParentStationId == "missing"
