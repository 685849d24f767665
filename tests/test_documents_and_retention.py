from __future__ import annotations

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tripgrain.operators import observations, performance, quality
from tripgrain.plans.scheduled import Feed
from tripgrain.schemas import FEED, feed_columns
from tripgrain.sources import documents, tables
from tripgrain.sources.feed import split_lines
from tripgrain.streaming import realtime as stream
from tripgrain.streaming import windows
from tripgrain.streaming.retention import apply_retention

DAY = datetime(2026, 8, 22)


def write(folder, path, text):
    target = os.path.join(folder, path)
    os.makedirs(os.path.dirname(target), exist_ok=True)
    with open(target, "w", encoding="utf-8") as file:
        file.write(text)


@pytest.fixture
def folder(tmp_path):
    root = str(tmp_path / "xml folder")
    write(root, "plan/8000207/260822/11/20260822T103000.xml",
          '<?xml version="1.0"?>\n<timetable station="K">\n <s id="e1"><tl c="S" n="1"/><ar pt="2608221100" l="S1" pp="2"/></s>\n'
          ' <s id="e2"><ar pt="2608221130" l="S1"/></s>\n</timetable>\n')
    write(root, "fchg/8000207/20260822T103000.xml", '<timetable><s id="e1"><ar ct="2608221104" cp="3"/></s></timetable>')
    write(root, "fchg/8000207/20260822T104500.xml", "<timetable><s id=")
    write(root, "plan/8000207/260822/11/readme.txt", "not a document")
    return root


def test_a_folder_is_read_with_what_paths_say(spark, folder):
    found = {(r.StationEva, r.Kind, r.PlanHour, r.CapturedAt) for r in documents.read_documents(spark, folder).collect()}
    early, late = DAY + timedelta(hours=10, minutes=30), DAY + timedelta(hours=10, minutes=45)
    assert found == {("8000207", "plan", "11", early), ("8000207", "change", None, early), ("8000207", "change", None, late)}
    plan = {r.DbEventId: (r.StationEva, r.TrainCategory, r.PlannedArrival, r.PlannedPlatform) for r in
            documents.read_plan_xml(spark, folder).collect()}
    assert plan == {"e1": ("8000207", "S", DAY + timedelta(hours=11), "2"), "e2": ("8000207", None, DAY + timedelta(hours=11, minutes=30), None)}
    change = documents.read_change_xml(spark, folder).collect()
    assert [(r.DbEventId, r.ChangedArrival, r.ChangedPlatform) for r in change] == [("e1", DAY + timedelta(hours=11, minutes=4), "3")]


def test_without_a_time_in_the_path_the_file_s_own_counts(spark, tmp_path):
    write(str(tmp_path), "plan/8/now.xml", "<timetable/>")
    row = documents.read_documents(spark, str(tmp_path)).first()
    assert row.Kind == "plan" and row.StationEva == "8" and row.CapturedAt > datetime(2020, 1, 1)


def test_the_realtime_stream_starts_from_a_folder(spark, rows, folder, tmp_path):
    targets = rows([(100, 20260822, "hbf", "S1", DAY + timedelta(hours=11), None)],
                   "FactTripStopKey long, DateKey int, StationId string, LineName string, "
                   "ScheduledArrivalDateTime timestamp_ntz, ScheduledDepartureDateTime timestamp_ntz")
    stations = rows([("8000207", "hbf")], "StationEva string, ParentStationId string")
    paths = stream.RealtimePaths(str(tmp_path / "rt"))
    files = documents.stream_documents(spark, folder)
    stream.run_realtime(spark, files, paths, stations, lambda: targets).awaitTermination()
    fact = spark.read.parquet(paths.fact).collect()
    assert [(r.DbEventId, r.FactTripStopKey, r.ArrivalDelayMinutes, r.ChangedPlatform) for r in fact] == [("e1", 100, 4, "3")]
    assert [r.Reason for r in spark.read.parquet(paths.rejected).collect()] == ["not readable"]


HISTORY = "DbEventId string, CapturedAt timestamp_ntz, ObservationKey long"


def history(spark, rows, tmp_path):
    paths = stream.RealtimePaths(str(tmp_path / "rt"))
    data = [(f"e{i % 3}", DAY + timedelta(hours=6 * i), i) for i in range(20)]  # five days
    for batch in range(3):
        tables.append_observations(rows(data[batch::3], HISTORY), paths.history, batch)
    rows([(f"s{i}", (DAY + timedelta(days=i)).date()) for i in range(5)], "DbEventId string, StateDay date").write.partitionBy(
        "StateDay").parquet(paths.states)
    return paths, data


def test_retention_drops_cuts_and_compacts(spark, rows, tmp_path):
    paths, data = history(spark, rows, tmp_path)
    as_of = DAY + timedelta(days=4, hours=12)
    done = apply_retention(spark, paths, as_of, days=3, live_days=2)
    limit = as_of - timedelta(days=3)
    kept = spark.read.parquet(paths.history)
    assert sorted((r.DbEventId, r.CapturedAt, r.ObservationKey) for r in kept.collect()) == sorted(d for d in data if d[1] >= limit)
    assert done == {"dropped": ["2026-08-22"], "cut": ["2026-08-23"], "compacted": ["2026-08-24", "2026-08-25"],
                    "states": ["2026-08-22", "2026-08-23"]}
    folders = {day: len(tables.partition_folders(spark, f)) for day, f in tables.partition_folders(spark, paths.history).items()}
    assert folders == {"2026-08-23": 1, "2026-08-24": 1, "2026-08-25": 1, "2026-08-26": 3}
    assert apply_retention(spark, paths, as_of, days=3, live_days=2) == {
        "dropped": [], "cut": ["2026-08-23"], "compacted": [], "states": []}
    assert not tables.exists(spark, f"{paths.root}/staged/retention")


def test_a_lost_retention_run_is_continued(spark, rows, tmp_path, monkeypatch):
    from tripgrain.streaming import retention

    paths, data = history(spark, rows, tmp_path)
    as_of, removed = DAY + timedelta(days=4, hours=12), []

    def lost(spark, path):
        removed.append(path)
        tables.remove(spark, path)
        if "CaptureDate=" in path:
            raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(retention, "remove", lost)
        with pytest.raises(OSError):
            apply_retention(spark, paths, as_of, days=3)
    apply_retention(spark, paths, as_of, days=3)
    kept = [(r.DbEventId, r.CapturedAt, r.ObservationKey) for r in spark.read.parquet(paths.history).collect()]
    assert sorted(kept) == sorted(d for d in data if d[1] >= as_of - timedelta(days=3))


def test_open_windows_come_out_and_are_corrected(spark, rows, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "windows")
    schema = "StationEva string, LineName string, CapturedAt timestamp_ntz, ArrivalDelayMinutes int"
    data = [("8", None if i % 4 == 0 else f"S{i % 2}", DAY + timedelta(minutes=i), i % 5 or None) for i in range(120)]
    late = [("8", "S1", DAY + timedelta(minutes=100), 9), ("8", None, DAY + timedelta(minutes=125), 1)]
    for part in (data, late):
        rows(part, schema).coalesce(1).write.mode("append").parquet(path)
        windows.run_delay_windows(spark.readStream.schema(schema).parquet(path), out).awaitTermination()
    expected = observations.delay_windows(rows(data + late, schema))
    stored = spark.read.parquet(out).select(*expected.columns)
    assert sorted(map(repr, stored.collect())) == sorted(map(repr, expected.collect()))


def feed_folder(tmp_path, **lines):
    folder = tmp_path / "feed"
    folder.mkdir()
    for name in FEED:
        (folder / f"{name}.txt").write_text(
            "\n".join([",".join(feed_columns(name)), *lines.get(name, [])]) + "\n", encoding="utf-8")
    return str(folder)


def test_rows_and_rejects_are_all_lines(spark, tmp_path):
    lines = ['s1,20260701,1', 's2,20260702,x', 's3,20260703', 's4,20260704,1,more', '"s,5",20260705,2', 's6,,']
    folder = feed_folder(tmp_path, calendar_dates=lines)
    rows, rejects = split_lines(spark, folder, "calendar_dates")
    assert {r.ServiceId for r in rows.collect()} == {"s1", "s,5", "s6"}
    assert {(r.TableName, r.Line) for r in rejects.collect()} == {("calendar_dates", line) for line in lines[1:4]}
    feed, every = Feed.read_split(spark, folder)
    assert feed.calendar_dates.count() == 3 and every.count() == 3 and feed.trips.count() == 0


def test_measures_without_their_column_raise(rows):
    df = rows([(1, None, None)], "ObservationKey long, ChangedPlatform string, PlannedPlatform string")
    assert observations.observation_summary(df, ["TotalRows", "PlatformChanged"]).first() == (1, 0)
    with pytest.raises(ValueError, match="IsArrivalCancelled"):
        observations.observation_summary(df)


def test_a_measure_that_one_side_lacks_is_listed(rows):
    one, two = rows([(1,)], "a long"), rows([(1, 2)], "a long, b long")
    found = quality.summary_difference(one, two, lambda df: df.agg(*[F.sum(c).alias(c) for c in df.columns]))
    assert {(r.Measure, r.SourceValue, r.TableValue, r.Difference) for r in found.collect()} == {("a", 1, 1, 0), ("b", None, 2, -2)}


def test_ranges_outside_the_feed_are_counted(rows):
    calendar = rows([("a", "20260601", "20260630"), ("b", "20260630", "20260701"), ("c", "20260801", "20260901"), ("d", "x", "20260801")],
                    "ServiceId string, StartDate string, EndDate string")
    dates = rows([("a", "20260630", 1), ("b", "20260731", 1), ("c", None, 1)], "ServiceId string, ServiceDate string, ExceptionType int")
    info = rows([("v", "20260701", "20260731"), ("w", "bad", None)], "FeedVersion string, FeedStartDate string, FeedEndDate string")
    found = {tuple(r)[:2]: tuple(r)[2] for r in quality.outside_feed(calendar, dates, info).collect()}
    assert found == {("v", "CalendarOutsideFeed"): 2, ("v", "CalendarBeyondFeed"): 4, ("v", "ExceptionOutsideFeed"): 1,
                     ("w", "CalendarOutsideFeed"): 0, ("w", "CalendarBeyondFeed"): 0, ("w", "ExceptionOutsideFeed"): 0}


def test_reports_read_the_facts_days_of_the_schedule_only(spark, rows, tmp_path):
    schedule = rows([(day * 10 + i, day, 1, i, DAY.date(), "S1", "S-Bahn", "op", None, f"stop{i}") for day in (20260821, 20260822, 20260823)
                     for i in range(3)], "FactTripStopKey long, DateKey int, TripInstanceKey long, StopSequence int, ServiceDate date, "
                    "RouteShortName string, TransportMode string, OperatorName string, ParentStationName string, StopName string")
    schedule.write.partitionBy("DateKey").parquet(str(tmp_path / "view"))
    fact = rows([("e", 202608220 + 1, 20260822, DAY, None, 3, None, False, False, "1", "2")],
                "DbEventId string, FactTripStopKey long, DateKey int, PlannedArrival timestamp_ntz, PlannedDeparture timestamp_ntz, "
                "ArrivalDelayMinutes int, DepartureDelayMinutes int, IsArrivalCancelled boolean, IsDepartureCancelled boolean, "
                "PlannedPlatform string, ChangedPlatform string")
    perf = performance.performance_view(fact, spark.read.parquet(str(tmp_path / "view")))
    plan = perf._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(DateKey" in plan and "(DateKey#" in plan.split("PartitionFilters: ")[1].split("]")[0]
    assert [(r.StationName, r.DelayMinutes) for r in perf.collect()] == [("stop1", 3)]


def test_one_trip_is_found_in_a_bounded_number_of_row_groups(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    fact = spark.range(0, 400_000, 1, 8).select(
        (F.col("id") % 20_000).alias("TripInstanceKey"), (F.col("id") / 20_000).cast("int").alias("StopSequence"),
        F.sha2(F.col("id").cast("string"), 256).alias("Filler"))
    path = str(tmp_path / "by_trip")
    stored = tables.write_by_trip(fact, path, group_bytes=1 << 20)
    groups = []
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        column = meta.schema.names.index("TripInstanceKey")
        groups += [meta.row_group(g).column(column).statistics for g in range(meta.num_row_groups)]
    assert len(groups) >= 8
    for key in (0, 7, 9_999, 19_999):
        assert sum(g.min <= key <= g.max for g in groups) <= 2
    found = stored.filter(F.col("TripInstanceKey") == 7)
    assert "EqualTo(TripInstanceKey,7)" in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.StopSequence for r in found.collect()) == list(range(20))
