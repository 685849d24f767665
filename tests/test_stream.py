from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tripgrain.operators.observations import delay_windows, event_state
from tripgrain.operators.realtime import RebindError, match_events, parse_documents, rejected_documents, snapshots_from_documents
from tripgrain.schemas import RAW_DOCUMENT
from tripgrain.sources import tables
from tripgrain.streaming import realtime as stream
from tripgrain.streaming.windows import dedup_stream, delay_windows_stream

DAY = datetime(2026, 8, 22)
FIRST, SECOND = DAY + timedelta(hours=10), DAY + timedelta(hours=10, minutes=15)


def plan(*events):
    inner = "".join(f'<s id="{i}"><ar pt="260822{t}" l="S1" pp="1"/></s>' for i, t in events)
    return f"<timetable>{inner}</timetable>"


def change(*events):
    inner = "".join(f'<s id="{i}"><ar ct="260822{t}"/></s>' for i, t in events)
    return f"<timetable>{inner}</timetable>"


TARGET = ("FactTripStopKey long, DateKey int, StationId string, LineName string, "
          "ScheduledArrivalDateTime timestamp_ntz, ScheduledDepartureDateTime timestamp_ntz")
CAPTURE_1 = [("8", "plan", "10", FIRST, plan(("e1", "1100"), ("e2", "1200"), ("lost", "1234"))),
             ("8", "plan", "11", FIRST, plan(("e1", "1100"))),
             ("8", "change", None, FIRST, change(("e1", "1103")))]
CAPTURE_2 = [("8", "plan", "10", SECOND, plan(("e1", "1100"), ("e3", "1300"))),
             ("8", "change", None, SECOND, change(("e1", "1109")))]


@pytest.fixture
def warehouse(rows):
    targets = rows(
        [(100 + i, 20260822, "hbf", "S1", DAY + timedelta(hours=11 + i), None) for i in range(3)], TARGET)
    return targets, rows([("8", "hbf")], "StationEva string, ParentStationId string")


@pytest.fixture
def load(spark, rows, tmp_path, warehouse):
    """Load captures as one cycle; ``load.paths`` are its tables."""
    targets, stations = warehouse
    paths = stream.RealtimePaths(str(tmp_path / "rt"))

    def one(documents, batch_id, targets=targets, **settings):
        snapshots = snapshots_from_documents(rows(documents, RAW_DOCUMENT))
        return stream.load_snapshots(snapshots, batch_id, paths, stations, lambda: targets, **settings)

    one.paths = paths
    return one


def bound(spark, paths):
    return {r.DbEventId: r.FactTripStopKey for r in spark.read.parquet(paths.fact).collect()}


def reasons(spark, paths, batch_id):
    return {r.DbEventId: r.Reason for r in spark.read.parquet(paths.unmatched(batch_id)).collect()}


def stored(spark, paths):
    return {r.DbEventId: r for r in spark.read.parquet(paths.fact).collect()}


def test_cycles_history_and_rerun(spark, rows, tmp_path, warehouse):
    targets, stations = warehouse
    raw, paths = str(tmp_path / "raw"), stream.RealtimePaths(str(tmp_path / "rt"))

    def run():
        stream.run_realtime(spark, raw, paths, stations, lambda: targets).awaitTermination()

    tables.land_raw(rows(CAPTURE_1, RAW_DOCUMENT), raw)
    run()
    fact = stored(spark, paths)
    assert {k: v.FactTripStopKey for k, v in fact.items()} == {"e1": 100, "e2": 101}
    assert fact["e1"].ArrivalDelayMinutes == 3 and fact["e1"].ObservationCount == 1
    assert [(r.DbEventId, r.Reason) for r in spark.read.parquet(paths.unmatched("*")).collect()] == [("lost", "none")]

    tables.land_raw(rows(CAPTURE_2, RAW_DOCUMENT), raw)
    run()
    fact = stored(spark, paths)
    assert {k: v.FactTripStopKey for k, v in fact.items()} == {"e1": 100, "e2": 101, "e3": 102}
    assert (fact["e1"].ArrivalDelayMinutes, fact["e1"].ObservationCount) == (9, 2)
    assert (fact["e1"].FirstCapturedAt, fact["e1"].LatestCapturedAt) == (FIRST, SECOND)
    assert fact["e2"].ObservationCount == 1
    states = {r.DbEventId: r.ObservationCount for r in spark.read.parquet(paths.states).collect()}
    assert states == {"e1": 2, "e2": 1, "e3": 1, "lost": 1}

    run()  # nothing new
    assert stored(spark, paths) == fact
    history = tables.read_observations(spark, paths.history).collect()
    assert len(history) == len({r.ObservationKey for r in history}) == 5
    assert spark.read.parquet(paths.rejected).count() == 0 if tables.exists(spark, f"{paths.rejected}/BatchId=0") else True
    assert not tables.exists(spark, paths.staged(1)) and not tables.exists(spark, paths.staged(3))

    # the stream gives what one batch over all documents gives
    everything = snapshots_from_documents(rows(CAPTURE_1 + CAPTURE_2, RAW_DOCUMENT)).withColumn("ObservationKey", F.lit(0))
    batch = match_events(event_state(everything), targets, stations).matched.collect()
    assert {(r.DbEventId, r.FactTripStopKey, r.ArrivalDelayMinutes, r.ObservationCount) for r in batch} == {
        (r.DbEventId, r.FactTripStopKey, r.ArrivalDelayMinutes, r.ObservationCount) for r in fact.values()}


def test_the_first_cycle_looks_for_no_neighbours(spark, load, monkeypatch):
    monkeypatch.setattr(stream, "match_neighbourhood", None)
    load(CAPTURE_1, 0)
    assert bound(spark, load.paths) == {"e1": 100, "e2": 101}
    assert reasons(spark, load.paths, 0) == {"lost": "none"}


def test_a_committed_cycle_is_not_repeated(spark, load):
    load(CAPTURE_1, 0)
    counts = load(CAPTURE_2, 1).first()
    assert (counts.UpdatedRows, counts.InsertedRows, counts.RemovedRows) == (1, 1, 0)
    fact = stored(spark, load.paths)
    assert load(CAPTURE_2, 1).first() == counts
    assert tables.read_observations(spark, load.paths.history).count() == 5
    assert stored(spark, load.paths) == fact


def test_a_rival_takes_the_trip_stop_away_and_gives_it_back(spark, load):
    load(CAPTURE_1, 0)
    rival = [("8", "plan", "10", SECOND, plan(("new", "1100")))]
    counts = load(rival, 1).first()
    assert (counts.InsertedRows, counts.RemovedRows) == (0, 1)
    assert bound(spark, load.paths) == {"e2": 101}
    assert reasons(spark, load.paths, 1) == {"e1": "many", "new": "many"}
    gone = [("8", "plan", "10", SECOND + timedelta(minutes=15), plan(("new", "1300")))]  # the rival is another train's now
    load(gone, 2)
    assert bound(spark, load.paths) == {"e1": 100, "e2": 101, "new": 102}
    assert stored(spark, load.paths)["e1"].ArrivalDelayMinutes == 3


def test_the_last_event_of_a_day_leaves_an_empty_day(spark, rows, load):
    target = rows([(100, 20260822, "hbf", "S1", DAY + timedelta(hours=11), None)], TARGET)
    load([("8", "plan", "10", FIRST, plan(("e1", "1100")))], 0, target)
    load([("8", "plan", "10", SECOND, plan(("e1", "1101")))], 1, target)
    assert tables.partition_folders(spark, load.paths.fact) == {}


def test_moves_raise_or_move(spark, load):
    load(CAPTURE_1, 0)
    before = stored(spark, load.paths)
    swapped = [("8", "plan", "10", SECOND, plan(("e1", "1200"), ("e2", "1100")))]
    with pytest.raises(RebindError):
        load(swapped, 1)
    assert stored(spark, load.paths) == before
    load(swapped, 1, strict=False)
    assert bound(spark, load.paths) == {"e1": 101, "e2": 100}


def test_a_trip_stop_of_an_event_that_is_not_live_stays_held(spark, load):
    load([("8", "plan", "10", FIRST - timedelta(days=9), plan(("old", "1100")))], 0)
    load([("8", "plan", "10", FIRST, plan(("new", "1100")))], 1)
    assert bound(spark, load.paths) == {"old": 100}
    assert reasons(spark, load.paths, 1) == {"new": "held"}


def test_old_states_are_not_read(spark, load):
    load([("8", "plan", "10", FIRST - timedelta(days=9), plan(("old", "1100")))], 0)
    load(CAPTURE_1, 1)
    live = stream.live_states(spark, load.paths, DAY.date() - timedelta(days=7))
    scan = live._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(StateDay" in scan and "StateDay#" in scan.split("PartitionFilters: ")[1].split("]")[0]
    assert {r.DbEventId for r in live.collect()} == {"e1", "e2", "lost"}


@pytest.mark.parametrize("step", ["store_states", "merge_into_fact", "_replace_days"])
def test_a_crash_at_any_step_is_repaired(spark, load, monkeypatch, step):
    load(CAPTURE_1, 0)

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(stream, step, broken)
        with pytest.raises(OSError):
            load(CAPTURE_2, 1)
    assert stored(spark, load.paths)["e1"].ObservationCount == 1
    load(CAPTURE_2, 1)
    assert stored(spark, load.paths)["e1"].ObservationCount == 2
    assert {r.DbEventId: r.ObservationCount for r in spark.read.parquet(load.paths.states).collect()}["e1"] == 2


def test_days_not_in_the_batch_are_not_rewritten(rows, tmp_path, load, spark):
    targets = rows(
        [(100, 20260822, "hbf", "S1", DAY + timedelta(hours=11), None),
         (200, 20260821, "hbf", "S1", DAY + timedelta(hours=12), None)], TARGET)
    load(CAPTURE_1, 0, targets)
    old = sorted(p.name for p in (tmp_path / "rt/fact_realtime_stop_performance/DateKey=20260821").iterdir())
    load(CAPTURE_2, 1, targets)
    assert sorted(p.name for p in (tmp_path / "rt/fact_realtime_stop_performance/DateKey=20260821").iterdir()) == old
    assert bound(spark, load.paths) == {"e1": 100, "e2": 200}


def test_random_cycles_equal_one_match_over_everything(spark, rows, load, warehouse):
    import random

    pick = random.Random(11)
    stops = [(i, 20260822 + i % 2, "hbf", "S1", at, pick.choice([None, at + timedelta(minutes=2)]))
             for i in range(12) for at in [DAY + timedelta(hours=11, minutes=pick.randrange(6))]]
    targets = rows(stops, TARGET)
    _, stations = warehouse
    seen = []
    for cycle in range(4):
        captured = FIRST + timedelta(minutes=15 * cycle)
        documents = []
        for event in pick.sample(range(14), 7):
            minute = pick.randrange(6)
            inner = [f'<ar pt="2608221{100 + minute}" l="S1"/>', f'<dp pt="2608221{102 + minute}" l="s 1"/>']
            chosen = "".join(pick.choice([inner, inner[:1], inner[1:]]))
            documents.append(("8", "plan", "11", captured, f'<timetable><s id="e{event}">{chosen}</s></timetable>'))
        seen += documents
        load(documents, cycle, targets, strict=False)
        everything = snapshots_from_documents(rows(seen, RAW_DOCUMENT)).withColumn("ObservationKey", F.lit(0))
        result = match_events(event_state(everything), targets, stations)
        assert {(r.DbEventId, r.FactTripStopKey, r.DateKey, r.ObservationCount) for r in result.matched.collect()} == {
            (r.DbEventId, r.FactTripStopKey, r.DateKey, r.ObservationCount) for r in stored(spark, load.paths).values()}


def test_days_are_covered_by_few_ranges():
    day = DAY.date()
    days = [day + timedelta(days=i) for i in (0, 1, 2, 9, 10, 400)]
    assert stream.day_ranges(days) == [(days[0], days[2]), (days[3], days[4]), (days[5], days[5])]
    assert stream.day_ranges(days, 2) == [(days[0], days[4]), (days[5], days[5])]
    assert stream.day_ranges([]) == []


def test_plan_and_change_may_land_apart(spark, rows, tmp_path, warehouse):
    targets, stations = warehouse
    raw, paths = str(tmp_path / "raw"), stream.RealtimePaths(str(tmp_path / "rt"))
    pieces = [[d] for d in CAPTURE_1 + CAPTURE_2] + [[("8", "plan", None, SECOND + timedelta(hours=2), "<timetable/>")]]
    pieces[2], pieces[3] = pieces[3], pieces[2]  # the first capture's change comes after a plan of the second
    for piece in pieces:
        tables.land_raw(rows(piece, RAW_DOCUMENT), raw)
        stream.run_realtime(spark, raw, paths, stations, lambda: targets, wait="1 hour").awaitTermination()
    every = snapshots_from_documents(rows(CAPTURE_1 + CAPTURE_2, RAW_DOCUMENT))
    history = tables.read_observations(spark, paths.history)
    assert sorted(map(repr, history.select(*every.columns).collect())) == sorted(map(repr, every.collect()))
    assert {k: (v.FactTripStopKey, v.ArrivalDelayMinutes) for k, v in stored(spark, paths).items()} == {
        "e1": (100, 9), "e2": (101, None), "e3": (102, None)}


def test_captures_wait_on_disk(spark, rows, tmp_path, warehouse):
    targets, stations = warehouse
    key = "spark.sql.streaming.stateStore.providerClass"
    for wait, where in (("1 hour", "RocksDB"), ("0 seconds", "HDFSBacked")):
        raw, paths = str(tmp_path / f"raw {where}"), stream.RealtimePaths(str(tmp_path / where))
        tables.land_raw(rows(CAPTURE_1, RAW_DOCUMENT), raw)
        stream.run_realtime(spark, raw, paths, stations, lambda: targets, wait=wait).awaitTermination()
        assert f"{where}StateStoreProvider" in open(f"{paths.checkpoint('load')}/offsets/0").read()
        assert spark.conf.get(key, None) is None


def test_bad_documents_are_kept_with_a_reason(spark, rows, tmp_path, warehouse):
    targets, stations = warehouse
    raw, paths = str(tmp_path / "raw"), stream.RealtimePaths(str(tmp_path / "rt"))
    bad = [("8", "plan", "10", FIRST, text) for text in (
        "nonsense", "", None, "<html><s id='1'/></html>", "<timetable><s id='1'>", "<timetable><s><ar pt='1'/></s></timetable>")]
    documents = rows(CAPTURE_1 + bad, RAW_DOCUMENT)
    expected = [("no document", ""), ("no document", None), ("no event id", bad[5][4]),
                *[("not readable", bad[i][4]) for i in (0, 3, 4)]]
    assert sorted(((r.Reason, r.Document) for r in rejected_documents(documents).collect()), key=repr) == sorted(expected, key=repr)
    assert parse_documents(documents).count() == 5 + len(bad)
    tables.land_raw(documents, raw)
    stream.run_realtime(spark, raw, paths, stations, lambda: targets).awaitTermination()
    assert sorted(((r.Reason, r.Document) for r in spark.read.parquet(paths.rejected).collect()), key=repr) == sorted(expected, key=repr)
    assert bound(spark, paths) == {"e1": 100, "e2": 101}


def test_stream_deduplication_keeps_history(spark, rows, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "DbEventId string, CapturedAt timestamp_ntz, PlanHour string"
    rows([("e", FIRST, "10"), ("e", FIRST, "11"), ("e", SECOND, "10"), ("f", FIRST, "10")], schema).write.parquet(path)
    query = (
        dedup_stream(spark.readStream.schema(schema).parquet(path)).writeStream.format("parquet")
        .option("path", out).option("checkpointLocation", f"{out}-c").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert {(r.DbEventId, r.CapturedAt) for r in spark.read.parquet(out).collect()} == {("e", FIRST), ("e", SECOND), ("f", FIRST)}


def test_stream_windows_equal_batch_windows(spark, rows, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "StationEva string, LineName string, CapturedAt timestamp_ntz, ArrivalDelayMinutes int"
    data = rows([("8", f"S{i % 2}", FIRST + timedelta(minutes=i), i % 5 or None) for i in range(120)], schema)
    data.coalesce(1).write.parquet(path)
    query = (
        delay_windows_stream(spark.readStream.schema(schema).parquet(path)).writeStream.outputMode("append")
        .format("parquet").option("path", out).option("checkpointLocation", f"{out}-c").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    closed = FIRST + timedelta(minutes=119 - 30)
    expected = delay_windows(data).filter(F.col("WindowEnd") <= F.lit(closed))
    assert sorted(map(tuple, spark.read.parquet(out).collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)
