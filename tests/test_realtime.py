from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tripgrain.operators import realtime
from tripgrain.schemas import RAW_DOCUMENT

CAPTURE = datetime(2026, 8, 22, 11)
PLAN = """<timetable station="Hbf"><s id="e1"><tl c="S" n="32170"/><ar pt="2608221115" pp="4" l="S11" fb="EUR 9411" ppth="A|B"/>
<dp pt="2608221117" pp="4" l="S11"/></s><s id="e2" eva="99"><dp pt="2608221130" pp="7"/></s><s id="e3"><ar pt="2608221140" l="RE7"/></s></timetable>"""
LATER = """<timetable><s id="e1"><ar pt="2608221115" pp="9"/></s></timetable>"""
CHANGE = """<timetable><s id="e1"><ar ct="2608221123" cp="5"/></s><s id="e3"><ar cs="c"/></s><s id="other"><ar ct="2608221123"/></s></timetable>"""


def documents(rows, extra=()):
    return rows([
        ("8", "plan", "11", CAPTURE, PLAN), ("8", "plan", "12", CAPTURE, LATER), ("8", "change", None, CAPTURE, CHANGE),
        ("8", "plan", "12", CAPTURE, "<timetable/>"), *extra], RAW_DOCUMENT)


def test_snapshots(rows):
    out = {r.DbEventId: r for r in realtime.snapshots_from_documents(documents(rows)).collect()}
    assert sorted(out) == ["e1", "e2", "e3"]
    e1, e2, e3 = out["e1"], out["e2"], out["e3"]
    assert (e1.ArrivalDelayMinutes, e1.DepartureDelayMinutes, e1.PlannedPlatform, e1.ChangedPlatform) == (8, None, "4", "5")
    assert (e1.LineName, e1.TrainName, e1.StationEva) == ("S11", "EUR 9411", "8")
    assert (e2.StationEva, e2.PlannedArrival, e2.PlannedPlatform) == ("99", None, "7")
    assert not e2.IsArrivalCancelled and not e2.IsDepartureCancelled and e2.ChangedPlatform is None
    assert e3.IsArrivalCancelled and not e3.IsDepartureCancelled and e3.ChangedArrival is None and e3.ArrivalDelayMinutes is None


def test_history_of_captures_is_kept(rows):
    again = ("8", "plan", "11", CAPTURE + timedelta(minutes=15), PLAN)
    assert realtime.snapshots_from_documents(documents(rows, [again])).count() == 6


def test_path(rows):
    plan = realtime.flatten_plan(documents(rows).filter("Kind = 'plan'")).filter("ArrivalPath is not null")
    assert [(r.PathPosition, r.PathStation) for r in realtime.explode_path(plan, "|", "ArrivalPath").collect()] == [(1, "A"), (2, "B")]


def test_a_document_is_judged_once_and_not_moved_with_its_elements(rows):
    plan = realtime.flatten_plan(documents(rows))._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Generate", 1)
    assert "Document#" not in above and "_doc#" not in above and "from_xml" in below


def test_only_rejected_elements_keep_the_text_around_them(rows):
    text = '<timetable><s id="a"><ar l="1"/></s><s><dp l="2"/></s><s id="c" eva="7"/></timetable>'
    out = realtime.parse_documents(rows([("8", "plan", "11", CAPTURE, text)], RAW_DOCUMENT))
    assert [(r._id, r.Rejected, r.Document) for r in out.collect()] == [("a", None, None), (None, "no event id", text), ("c", None, None)]


TARGET = ("FactTripStopKey long, DateKey int, StationId string, LineName string, "
          "ScheduledArrivalDateTime timestamp_ntz, ScheduledDepartureDateTime timestamp_ntz")
STATE = "DbEventId string, StationEva string, LineName string, PlannedArrival timestamp_ntz, PlannedDeparture timestamp_ntz"


def brute_force(events, targets, stations):
    def line(name):
        return None if name is None else name.replace(" ", "").upper()

    pairs = []
    for e in events:
        for t in targets:
            if stations.get(e[1]) is None or stations[e[1]] != t[2] or line(e[2]) is None or line(e[2]) != line(t[3]):
                continue
            if e[3] is None and e[4] is None:
                continue
            if (e[3] is None or e[3] == t[4]) and (e[4] is None or e[4] == t[5]):
                pairs.append((e[0], t[0]))
    by_event, by_stop = Counter(p[0] for p in pairs), Counter(p[1] for p in pairs)
    matched = {p for p in pairs if by_event[p[0]] == 1 and by_stop[p[1]] == 1}
    found = {p[0] for p in matched}
    return matched, {(e[0], "many" if by_event[e[0]] else "none") for e in events if e[0] not in found}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_match_equals_brute_force(rows, seed):
    rng = random.Random(seed)
    stations = {"1": "a", "2": "b"}

    def moment():
        return rng.choice([None, *[CAPTURE + timedelta(minutes=m) for m in range(6)]])

    targets = [(i, 20260822, rng.choice("ab"), rng.choice(["RE1", "S 2", "S2", None]), moment(), moment()) for i in range(60)]
    events = [(f"e{i}", rng.choice("123"), rng.choice(["re 1", "S2", "S 3", None]), moment(), moment()) for i in range(70)]
    out = realtime.match_events(
        rows(events, STATE), rows(targets, TARGET), rows(list(stations.items()), "StationEva string, ParentStationId string"))
    matched, unmatched = brute_force(events, targets, stations)
    assert {(r.DbEventId, r.FactTripStopKey) for r in out.matched.collect()} == matched
    assert {(r.DbEventId, r.Reason) for r in out.unmatched.collect()} == unmatched


@pytest.mark.parametrize("hot", [1, realtime.HOT_ROWS])
def test_every_event_is_judged_once_and_one_without_id_binds_nothing(rows, monkeypatch, hot):
    monkeypatch.setattr(realtime, "HOT_ROWS", hot)
    late = CAPTURE + timedelta(minutes=5)
    targets = rows([(1, 1, "a", "S1", CAPTURE, late), (2, 1, "a", "S2", CAPTURE, None), (3, 1, "a", "S3", CAPTURE, None),
                    (4, 1, "a", "S4", CAPTURE, late), (5, 1, "a", "S4", CAPTURE, None)], TARGET)
    state = rows([("pair", "1", "S1", CAPTURE, late), (None, "1", "S2", CAPTURE, None), ("x", "1", "S3", CAPTURE, None),
                  ("y", "1", "S3", CAPTURE, None), ("both", "1", "S4", CAPTURE, late), ("shared", "1", "S4", CAPTURE, None),
                  ("far", "9", "S1", CAPTURE, None), ("far too", "9", "S1", CAPTURE, None)], STATE)
    out = realtime.match_events(state, targets, rows([("1", "a")], "StationEva string, ParentStationId string"))
    judged = {r.DbEventId: (r.FactTripStopKey, r.Reason) for r in out.judged.collect()}
    assert out.judged.count() == 8 and judged == {
        "pair": (1, None), None: (None, None), "x": (None, "many"), "y": (None, "many"), "both": (None, "many"),
        "shared": (None, "many"), "far": (None, "none"), "far too": (None, "none")}
    assert {(r.DbEventId, r.FactTripStopKey) for r in out.matched.collect()} == {("pair", 1)}
    assert {r.DbEventId for r in out.unmatched.collect()} == set(judged) - {"pair", None}


def test_counts_per_key_are_added_up_without_sorting(rows, monkeypatch):
    plans = []
    monkeypatch.setattr(realtime, "freeze", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or df)
    realtime.match_events(rows([], STATE), rows([], TARGET), rows([], "StationEva string, ParentStationId string"))
    assert plans and "HashAggregate" in plans[0] and "SortAggregate" not in plans[0]


def test_events_and_trip_stops_are_sent_once_and_not_stored_by_key(rows, monkeypatch):
    stored = []
    monkeypatch.setattr(realtime, "freeze", lambda df: stored.append(df.count()) or df)
    targets = rows([(1, 1, "a", "S1", CAPTURE, CAPTURE), (2, 1, "a", "S2", CAPTURE, None)], TARGET)
    state = rows([("x", "1", "S1", None, CAPTURE), ("y", "1", "S2", CAPTURE, None), ("z", "1", "S2", None, CAPTURE)], STATE)
    out = realtime.match_events(state, targets, rows([("1", "a")], "StationEva string, ParentStationId string"))
    plan = out.judged._jdf.queryExecution().executedPlan().toString()
    assert sum(stored) == 0 and plan.count("REPARTITION_BY_COL") == 1
    after = plan.split("REPARTITION_BY_COL")[0]
    assert "Join" not in after and after.count("Exchange ") == 1
    assert {(r.DbEventId, r.FactTripStopKey) for r in out.matched.collect()} == {("x", 1), ("y", 2)}


def test_a_trip_stop_of_two_rows_counts_the_events_of_both(rows):
    late = CAPTURE + timedelta(minutes=5)
    targets = rows([(1, 1, "a", "S1", CAPTURE, None), (1, 1, "a", "S1", late, None), (2, 1, "a", "S2", late, None)], TARGET)
    state = rows([("x", "1", "S1", CAPTURE, None), ("y", "1", "S1", late, None), ("z", "1", "S2", late, None)], STATE)
    out = realtime.match_events(state, targets, rows([("1", "a")], "StationEva string, ParentStationId string"))
    assert {r.DbEventId for r in out.matched.collect()} == {"z"}
    assert {(r.DbEventId, r.Reason) for r in out.unmatched.collect()} == {("x", "many"), ("y", "many")}


def test_ambiguous_pairs_are_listed_not_loaded(rows):
    arrival = CAPTURE
    targets = rows([(1, 1, "a", "S1", arrival, None), (2, 1, "a", "S1", arrival, None), (3, 1, "b", "S1", arrival, None)], TARGET)
    state = rows([("two stops", "1", "S1", arrival, None), ("one", "2", "S1", arrival, None), ("other", "2", "S1", arrival, None)], STATE)
    out = realtime.match_events(state, targets, rows([("1", "a"), ("2", "b")], "StationEva string, ParentStationId string"))
    assert out.matched.count() == 0
    assert {r.Reason for r in out.unmatched.collect()} == {"many"} and out.unmatched.count() == 3


FACT = "DbEventId string, FactTripStopKey long, LatestCapturedAt timestamp_ntz, ObservationCount long"


def counts(df):
    row = realtime.upsert_counts(df).first()
    return row.UpdatedRows, row.InsertedRows


def test_upsert_is_idempotent_and_never_goes_back(rows):
    fact = rows([("a", 1, CAPTURE, 5), ("b", 2, CAPTURE, 1)], FACT)
    later, earlier = CAPTURE + timedelta(minutes=15), CAPTURE - timedelta(minutes=15)
    source = rows([("a", 1, later, 6), ("b", 2, earlier, 2), ("c", 3, CAPTURE, 1)], FACT)
    merged = realtime.upsert_fact(source, fact)
    assert counts(merged) == (1, 1)
    new = merged.drop("Action")
    stored = {r.DbEventId: r for r in new.collect()}
    assert stored["a"].ObservationCount == 6 and stored["b"].LatestCapturedAt == CAPTURE and stored["b"].ObservationCount == 1
    assert counts(realtime.upsert_fact(source, new)) == (0, 0)


@pytest.mark.parametrize(
    "source", [[("a", 9, CAPTURE, 1)], [("z", 1, CAPTURE, 1)], [("x", 7, CAPTURE, 1), ("y", 7, CAPTURE, 1)],
               [("x", 7, CAPTURE, 1), ("x", 8, CAPTURE, 1)]])
def test_rebinding_fails(rows, source):
    with pytest.raises(realtime.RebindError):
        realtime.assert_no_rebind(rows(source, FACT), rows([("a", 1, CAPTURE, 5)], FACT))


def test_same_binding_passes(rows):
    fact = rows([("a", 1, CAPTURE, 5)], FACT)
    realtime.assert_no_rebind(rows([("a", 1, CAPTURE, 1), ("b", 2, CAPTURE, 1)], FACT), fact)


def test_sync_check(rows):
    fact = rows([("a", 1, CAPTURE, 5), ("b", 2, CAPTURE, 1)], FACT)
    source = fact.unionByName(rows([("c", 3, CAPTURE, 1)], FACT)).withColumn(
        "LatestCapturedAt", F.when(F.col("DbEventId") == "b", F.lit(CAPTURE + timedelta(minutes=1))).otherwise(F.col("LatestCapturedAt")))
    assert tuple(realtime.sync_check(source, fact).first()) == (3, 2, 2, 2)
    assert tuple(realtime.sync_check(fact, fact).first()) == (2, 2, 2, 0)
