"""Every operator as a query over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgrain.functions.times import date_key, platform_changed, wall_literal
from tripgrain.operators import (
    aggregates,
    calendar,
    facts,
    keys,
    observations,
    performance,
    quality,
    realtime,
    routes,
    trips,
)
from tripgrain.plans import adapter
from tripgrain.plans.adapter import load, view
from tripgrain.plans.scheduled import ScheduledPlan
from tripgrain.schemas import FEED, feed_columns
from tripgrain.session import scratch_path
from tripgrain.sources import documents
from tripgrain.sources import feed as feed_source
from tripgrain.sources import tables
from tripgrain.streaming import realtime as stream
from tripgrain.streaming import windows
from tripgrain.streaming.retention import apply_retention

SHORT_FEED_TEXT = """
SELECT FeedVersion, CASE FeedVersion WHEN '1' THEN '20260720' ELSE FeedStartDate END AS FeedStartDate,
 CASE FeedVersion WHEN '2' THEN '20260725' WHEN '3' THEN 'open' ELSE FeedEndDate END AS FeedEndDate FROM {feed_info}"""

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


def _plan(spark: SparkSession, sf: str) -> ScheduledPlan:
    return ScheduledPlan(adapter.feed(spark, sf))


def _on_plan(name: str, function: Callable[[ScheduledPlan], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf: function(_plan(spark, sf))


def _on_view(name: str, table: str, function: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf: function(view(spark, sf, table))


def _on_table(name: str, table: str, function: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf: function(load(spark, sf, table))


# ---------------------------------------------------------------- feed files


def _round_trip(table: str) -> Query:
    """Write a view as a feed file, read it back with the declared schema."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        folder = scratch_path(spark, "feed")
        source = view(spark, sf, table)
        names = feed_columns(table)
        present = set(source.columns)
        columns = [F.col(c) if c in present else F.lit(None).cast("string").alias(c) for c in names]
        source.select(*columns).write.option("header", True).option("escape", '"').csv(f"{folder}/{table}.txt")
        return feed_source.read_feed(spark, folder, table)

    return run


for _table in FEED:
    QUERIES[f"read_{_table}"] = _round_trip(_table)


@query("load_stamp")
def _load_stamp(spark: SparkSession, sf: str) -> DataFrame:
    """Stamp and store a table; the stamp itself differs per run, so it is only tested for presence."""
    stored = tables.write_table(
        feed_source.with_load_stamp(view(spark, sf, "routes")), scratch_path(spark, "stg")
    )
    return stored.select("RouteId", F.col("LoadDateTime").isNotNull().alias("HasLoadStamp"))


@query("table_counts")
def _table_counts(spark: SparkSession, sf: str) -> DataFrame:
    return quality.staged_counts(adapter.feed(spark, sf))


# ---------------------------------------------------------------- scheduled side

_on_view("regular_dates", "calendar", calendar.regular_dates)
_on_plan("service_dates", lambda p: p.service_dates)
_on_plan("trip_instances", lambda p: p.trip_instances)
_on_plan("route_classification", lambda p: p.classification)
_on_plan("classification_summary", lambda p: routes.classification_summary(p.classification))
_on_plan("trip_stops", lambda p: p.trip_stops)
_on_plan("trip_stops_normalized", lambda p: p.normalized)
_on_plan("after_midnight", lambda p: trips.after_midnight(p.normalized))
_on_plan("dim_date", lambda p: p.dim_date)
_on_plan("dim_route", lambda p: p.dim_route)
_on_plan("dim_stop", lambda p: p.dim_stop)


def _fact(spark: SparkSession, sf: str) -> DataFrame:
    return _plan(spark, sf).store_calls(scratch_path(spark, "wrk")).fact


QUERIES["fact_trip_stop"] = _fact


@query("classification_ignore_case")
def _classification_ignore_case(spark: SparkSession, sf: str) -> DataFrame:
    return routes.classify_routes(view(spark, sf, "routes"), case_insensitive=True)


@query("trip_stop_analytics")
def _trip_stop_analytics(spark: SparkSession, sf: str) -> DataFrame:
    return _plan(spark, sf).store_star(scratch_path(spark, "dw")).analytics


@query("fact_layout")
def _fact_layout(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per date read back from the partitioned fact."""
    fact = tables.write_fact(_fact(spark, sf), scratch_path(spark, "dw"))
    return fact.groupBy(F.col("DateKey").cast("int").alias("DateKey")).agg(
        F.count("*").alias("RowCount"), F.count_distinct("TripInstanceKey").alias("TripCount")
    )


@query("trip_itinerary")
def _trip_itinerary(spark: SparkSession, sf: str) -> DataFrame:
    """The stops of the first trip instance that stops anywhere in scope."""
    fact = tables.write_by_trip(_fact(spark, sf), scratch_path(spark, "fact"))
    first = fact.agg(F.min("TripInstanceKey")).first()[0]
    return facts.trip_itinerary(fact, first)


_days = "ServiceDays"
_on_plan("volume_by_mode", lambda p: aggregates.volume_by_mode(p.packed_view, _days))
_on_plan("volume_by_route", lambda p: aggregates.volume_by_route(p.packed_view, _days))
_on_plan("volume_by_station", lambda p: aggregates.volume_by_station(p.packed_view, _days))
_on_plan("top_routes", lambda p: aggregates.top_k(
    aggregates.volume_by_route(p.packed_view, _days), "ScheduledStopCount", 10,
    ["RouteShortName", "TransportMode", "OperatorName"]))
_on_plan("top_stations", lambda p: aggregates.top_k(
    aggregates.volume_by_station(p.packed_view, _days), "ScheduledStopCount", 10, ["StationName"]))
_on_plan("preview_instances", lambda p: aggregates.preview(
    p.trip_instances.select("TripInstanceKey", "TripId", "ServiceDate", "RouteId", "ServiceId"),
    ["ServiceDate", "TripInstanceKey"], 20))
_on_plan("preview_stops", lambda p: aggregates.preview(
    p.dim_stop.select("StopKey", "StopId", "StopName", "ParentStationName"),
    [aggregates.station_name(), "StopName", "StopId"], 30))

_on_plan("estimate_trip_stops", lambda p: trips.estimate_trip_stops(
    p.feed.trips, p.service_dates, p.feed.stop_times))
_on_plan("estimate_scope", lambda p: trips.estimate_trip_stops(
    p.feed.trips, p.service_dates, p.feed.stop_times, routes.in_scope(p.classification)))
_on_plan("estimate_rail_types", lambda p: trips.estimate_trip_stops(
    p.feed.trips, p.service_dates, p.feed.stop_times, p.classification))

# ---------------------------------------------------------------- generic aggregates and keys

_on_table("row_count", "lineitem", aggregates.row_count)
_on_table("duplicates", "lineitem", lambda df: keys.duplicates(df, ["l_orderkey", "l_linenumber"]))
_on_table("coverage", "orders", lambda df: aggregates.coverage(
    df.withColumn("OrderDay", F.to_date("o_orderdate")), "o_custkey", "OrderDay"))
_on_table("distribution", "part", lambda df: aggregates.distribution(df, "p_type"))
_on_table("length_profile", "part", lambda df: aggregates.length_profile(df, "p_name"))
_on_table("dense_key", "customer", lambda df: keys.add_dense_key(
    df.select("c_custkey", "c_mktsegment"), ["c_mktsegment", "c_custkey"], "DenseKey"))
_on_table("dense_key_distributed", "customer", lambda df: keys.add_dense_key(
    df.select("c_custkey", "c_mktsegment"), ["c_mktsegment", "c_custkey"], "DenseKey", one_task_bytes=0))
_on_table("running_total_distributed", "orders", lambda df: keys.running_total(
    df.select("o_orderkey", (F.col("o_custkey") % 7).alias("Weight")), ["o_orderkey"], "Weight", "Before",
    one_task_bytes=0))


@query("reconcile_counts")
def _reconcile_counts(spark: SparkSession, sf: str) -> DataFrame:
    p = _plan(spark, sf).store_calls(scratch_path(spark, "wrk"))
    return aggregates.reconcile_counts(p.trip_stops, p.fact)


@query("require_unique")
def _require_unique(spark: SparkSession, sf: str) -> DataFrame:
    return keys.require_unique(_plan(spark, sf).service_dates, ["ServiceId", "ServiceDate"], "service_dates")


# ---------------------------------------------------------------- data quality


def _keyless_trip_stops(p: ScheduledPlan) -> DataFrame:
    packed = trips.trip_calendars(p.feed.trips, p.service_dates, False, p.date_rows, p.calendars)
    return trips.build_trip_stops(packed, p.classification, p.feed.stop_times)


_on_plan("dq_trip_references", lambda p: quality.orphan_count(p.feed.stop_times, p.feed.trips, "TripId"))
_on_plan("dq_stop_references", lambda p: quality.orphan_count(p.feed.stop_times, p.feed.stops, "StopId"))
_on_plan("dq_route_references", lambda p: quality.orphan_count(p.feed.trips, p.feed.routes, "RouteId"))
_on_plan("dq_agency_references", lambda p: quality.orphan_count(p.feed.routes, p.feed.agency, "AgencyId"))
_on_plan("dq_service_definitions", lambda p: quality.uncovered_services(
    p.feed.trips, p.feed.calendar, p.feed.calendar_dates))
_on_table("dq_line_grain", "lineitem", lambda df: quality.duplicate_count(
    df, ["l_orderkey", "l_linenumber"], "LineDuplicates"))
_on_view("dq_stop_time_grain", "stop_times", lambda df: quality.duplicate_count(
    df, ["TripId", "StopSequence"], "StopTimesDuplicates"))
_on_view("dq_late_hours", "stop_times", quality.late_hours)
_on_view("dq_time_format", "stop_times", quality.bad_time_formats)
_on_plan("dq_service_date_grain", lambda p: quality.duplicate_count(
    p.service_dates, ["ServiceId", "ServiceDate"], "ServiceDatesDuplicates"))
_on_plan("dq_service_date_coverage", lambda p: aggregates.coverage(p.service_dates, "ServiceId"))
_on_plan("dq_removed_dates", lambda p: quality.removed_still_present(p.service_dates, p.feed.calendar_dates))
_on_plan("dq_removed_dates_raw", lambda p: quality.removed_still_present(
    calendar.regular_dates(p.feed.calendar), p.feed.calendar_dates))
_on_plan("dq_instance_coverage", lambda p: aggregates.coverage(
    trips.expand_trips(p.feed.trips, p.service_dates, False, p.date_rows, p.calendars), "TripId"))
_on_view("dq_trip_id_length", "trips", lambda df: aggregates.length_profile(df, "TripId"))
_on_view("dq_route_types", "routes", lambda df: aggregates.distribution(df, "RouteType"))
_on_plan("dq_phase1_routes", lambda p: quality.phase1_route_count(p.classification))
_on_plan("dq_trip_stop_modes", lambda p: aggregates.volume_by_mode(
    _keyless_trip_stops(p)))
_on_plan("dq_trip_stop_grain", lambda p: quality.duplicate_count(
    p.trip_stops, ["TripInstanceKey", "StopSequence"], "TripStopDuplicates"))
_on_plan("dq_trip_stop_coverage", lambda p: aggregates.coverage(
    _keyless_trip_stops(p),
    "RouteId"))
_on_plan("dq_after_midnight", lambda p: quality.after_midnight_count(p.normalized))
_on_plan("dq_dim_date_coverage", lambda p: aggregates.coverage(p.dim_date, "DateKey", "FullDate"))
_on_plan("dq_dim_route", lambda p: quality.dim_route_checks(p.dim_route))
_on_plan("dq_dim_stop", lambda p: quality.dim_stop_checks(p.dim_stop))
QUERIES["dq_fact_grain"] = lambda spark, sf: quality.duplicate_count(
    _fact(spark, sf), ["TripInstanceKey", "StopSequence"], "FactDuplicates")
_on_plan("dq_mode_totals", lambda p: quality.mode_reconciliation(
    _keyless_trip_stops(p),
    p.view))
_on_plan("dq_null_profile", lambda p: quality.staged_null_profile(p.feed))
_on_view("dq_coordinates", "stops", quality.bad_coordinates)
_on_view("dq_stop_sequences", "stop_times", quality.bad_stop_sequences)


@query("dq_fact_references")
def _dq_fact_references(spark: SparkSession, sf: str) -> DataFrame:
    p = _plan(spark, sf).store_star(scratch_path(spark, "dw"))
    return quality.fact_reference_gaps(p.fact, p.dim_date, p.dim_route, p.dim_stop)


@query("dq_service_ranges")
def _dq_service_ranges(spark: SparkSession, sf: str) -> DataFrame:
    return quality.bad_service_ranges(
        view(spark, sf, "calendar"), view(spark, sf, "calendar_dates"), "20260701", "20260915"
    )


@query("dq_outside_feed")
def _dq_outside_feed(spark: SparkSession, sf: str) -> DataFrame:
    """Ranges and exceptions against the feed's own bounds, and against versions that end earlier or begin later."""
    info = spark.sql(SHORT_FEED_TEXT, feed_info=view(spark, sf, "feed_info"))
    return quality.outside_feed(view(spark, sf, "calendar"), view(spark, sf, "calendar_dates"), info)


_on_plan("dq_routes_per_mode", lambda p: quality.routes_per_mode(p.dim_route))


@query("dq_feed_duplicates")
def _dq_feed_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return quality.feed_duplicates({n: view(spark, sf, n) for n in quality.FEED_KEYS})


@query("dq_report")
def _dq_report(spark: SparkSession, sf: str) -> DataFrame:
    """All scalar checks in one table, over a stored star."""
    feed = adapter.feed(spark, sf)
    p = ScheduledPlan(feed).store_star(scratch_path(spark, "dw"))
    p.trip_stops = tables.write_table(p.trip_stops, scratch_path(spark, "wrk"))
    return quality.run_checks(feed, p)


# ---------------------------------------------------------------- observations

_CUT = datetime(2024, 1, 2)

_on_view("latest_per_event", "observations", observations.latest_per_event)
_on_view("event_state", "observations", observations.event_state)
_KNOWN = ("TotalRows", "ArrivalCancelled", "WithChangedPlatform", "PlatformChanged")  # the view has the columns of these
_on_view("observation_summary", "observations", lambda df: observations.observation_summary(df, _KNOWN))
_on_view("delay_evolution", "observations", observations.delay_evolution)
_on_view("first_change", "observations", observations.first_change)
_on_view("change_frequency", "observations", observations.change_frequency)
_on_view("platform_changed", "observations", lambda df: df.select(
    "ObservationKey",
    platform_changed(F.col("PlannedPlatform"), F.col("ChangedPlatform")).alias("PlatformChanged")))
_on_view("retention", "observations", lambda df: observations.retain(df, 10, datetime(2024, 1, 31)).select(
    "ObservationKey", "DbEventId", "CapturedAt"))
_on_view("delay_windows", "observations", lambda df: observations.delay_windows(
    df, "15 minutes", ["PlannedPlatform"]))


@query("append_observations")
def _append_observations(spark: SparkSession, sf: str) -> DataFrame:
    """Two batches appended, the second twice: the replay must not add rows."""
    path = scratch_path(spark, "history")
    obs = view(spark, sf, "observations")
    later = obs.filter(F.col("CapturedAt") >= wall_literal(_CUT))
    tables.append_observations(obs.filter(F.col("CapturedAt") < wall_literal(_CUT)), path, 0)
    tables.append_observations(later, path, 1)
    tables.append_observations(later, path, 1)
    return tables.read_observations(spark, path).select(*obs.columns)


@query("summary_difference")
def _summary_difference(spark: SparkSession, sf: str) -> DataFrame:
    obs = view(spark, sf, "observations")
    path = scratch_path(spark, "history")
    tables.append_observations(obs, path, 0)
    return quality.summary_difference(
        obs, tables.read_observations(spark, path), lambda df: observations.observation_summary(df, _KNOWN)
    )


@query("summary_difference_cut")
def _summary_difference_cut(spark: SparkSession, sf: str) -> DataFrame:
    """All measures of the observations built from documents, against a table that lacks some of them."""
    snapshots = realtime.snapshots_from_documents(_documents(spark, sf))
    stored = tables.write_table(snapshots, scratch_path(spark, "snapshots"))
    return quality.summary_difference(stored, stored.filter("CAST(DbEventId AS BIGINT) % 3 > 0"), observations.observation_summary)


@query("retention_rewrite")
def _retention_rewrite(spark: SparkSession, sf: str) -> DataFrame:
    """The history, written in three batches, after days have been dropped, one has been cut and others compacted."""
    paths = stream.RealtimePaths(scratch_path(spark, "realtime"))
    obs = view(spark, sf, "observations")
    for batch in range(3):
        tables.append_observations(obs.filter(F.col("ObservationKey") % 3 == batch), paths.history, batch)
    apply_retention(spark, paths, datetime(2024, 1, 31, 12), 10)
    return tables.read_observations(spark, paths.history).select("ObservationKey", "DbEventId", "CapturedAt")


@query("delay_windows_upserted")
def _delay_windows_upserted(spark: SparkSession, sf: str) -> DataFrame:
    """Open and closed windows that a stream keeps up to date."""
    path = scratch_path(spark, "windows")
    events = (
        spark.readStream.schema(load(spark, sf, "events").schema)
        .option("pathGlobFilter", "events.parquet").parquet(sf)
    )
    obs = events.select(
        F.col("ts").alias("CapturedAt"),
        F.when(F.col("event_type") != "error", (F.col("event_id") % 31).cast("int")).alias("ArrivalDelayMinutes"),
        (F.col("event_id") % 5).cast("string").alias("PlannedPlatform"),
    )
    windows.run_delay_windows(obs, path, "15 minutes", "30 minutes", ["PlannedPlatform"]).awaitTermination()
    return spark.read.parquet(path).drop("WindowDay")


@query("delay_windows_stream")
def _delay_windows_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The streaming form, run over the events table until its input ends."""
    out = scratch_path(spark, "windows")
    events = (
        spark.readStream.schema(load(spark, sf, "events").schema)
        .option("pathGlobFilter", "events.parquet").parquet(sf)
    )
    obs = events.select(
        F.col("ts").alias("CapturedAt"),
        F.when(F.col("event_type") != "error", (F.col("event_id") % 31).cast("int")).alias("ArrivalDelayMinutes"),
        (F.col("event_id") % 5).cast("string").alias("PlannedPlatform"),
    )
    run = (
        windows.delay_windows_stream(obs, "15 minutes", "30 minutes", ["PlannedPlatform"])
        .writeStream.outputMode("append").format("parquet")
        .option("path", f"{out}/rows").option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True).start()
    )
    run.awaitTermination()
    return spark.read.parquet(f"{out}/rows")


# ---------------------------------------------------------------- documents

# Every event as a plan and a change document; overlapping plan windows give the second copy.
_PLAN_XML = """
SELECT CAST(user_id AS STRING) AS StationEva, 'plan' AS Kind, {hour} AS PlanHour, date_trunc('DAY', ts) AS CapturedAt,
 concat('<timetable station="S"><s id="', event_id, '"><tl c="', event_type, '" n="', user_id, '"/>',
  '<ar pt="', date_format(ts, 'yyMMddHHmm'), '" pp="', event_id % 5 + {shift}, '" l="S', event_id % 12, '" ppth="A|B|', event_id % 3, '"/>',
  CASE WHEN event_id % 2 = 0 THEN concat('<dp pt="', date_format(ts + INTERVAL 2 MINUTES, 'yyMMddHHmm'), '" ppth="C|D', event_id % 4, '"/>') ELSE '' END,
  '</s></timetable>') AS Document FROM {{events}}"""
_CHANGE_XML = """
SELECT CAST(user_id AS STRING) AS StationEva, 'change' AS Kind, CAST(NULL AS STRING) AS PlanHour, date_trunc('DAY', ts) AS CapturedAt,
 concat('<timetable station="S"><s id="', event_id, '"><ar',
  CASE WHEN event_type = 'error' THEN ' cs="c"'
   ELSE concat(' ct="', date_format(ts + make_dt_interval(0, 0, CAST(event_id % 31 AS INT)), 'yyMMddHHmm'), '"') END,
  CASE WHEN event_id % 4 = 0 THEN concat(' cp="', event_id % 7, '"') ELSE '' END,
  '/></s></timetable>') AS Document FROM {events} WHERE event_type <> 'signup'"""


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    events = load(spark, sf, "events")
    parts = [
        spark.sql(_PLAN_XML.format(hour="'01'", shift=0), events=events),
        spark.sql(_PLAN_XML.format(hour="'02'", shift=1), events=events),
        spark.sql(_CHANGE_XML, events=events),
    ]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rows.withColumn("CapturedAt", F.col("CapturedAt").cast("timestamp_ntz"))


@query("flatten_plan")
def _flatten_plan(spark: SparkSession, sf: str) -> DataFrame:
    return realtime.flatten_plan(_documents(spark, sf).filter("Kind = 'plan'")).select(
        "DbEventId", "StationEva", "TrainCategory", "TrainNumber", "LineName", "PlannedArrival",
        "PlannedDeparture", "PlannedPlatform", "PlanHour",
    )


@query("flatten_change")
def _flatten_change(spark: SparkSession, sf: str) -> DataFrame:
    return realtime.flatten_change(_documents(spark, sf).filter("Kind = 'change'")).select(
        "DbEventId", "ChangedArrival", "ChangedPlatform", "ArrivalStatus"
    )


@query("dedup_events")
def _dedup_events(spark: SparkSession, sf: str) -> DataFrame:
    plan = realtime.flatten_plan(_documents(spark, sf).filter("Kind = 'plan'"))
    return realtime.dedup_events(plan).select("DbEventId", "CapturedAt", "PlanHour", "PlannedPlatform")


@query("snapshots")
def _snapshots(spark: SparkSession, sf: str) -> DataFrame:
    return realtime.snapshots_from_documents(_documents(spark, sf))


@query("explode_path")
def _explode_path(spark: SparkSession, sf: str) -> DataFrame:
    plan = realtime.flatten_plan(_documents(spark, sf).filter("Kind = 'plan'"))
    return realtime.explode_path(plan, "|", "ArrivalPath").select(
        "DbEventId", "PathPosition", "PathStation"
    )


#: Elements of one file, near enough: Spark's XML parser copies the list of a document's elements with each of them.
_FILE_ELEMENTS = 4_000


def _folder_documents(spark: SparkSession, sf: str) -> str:
    """A folder with files of some thousand elements each, for each kind, hour and day."""
    folder = scratch_path(spark, "xml")
    inner = F.regexp_extract("Document", "(?s)<timetable[^>]*>(.*)</timetable>", 1)
    named = F.concat(F.lit('<s eva="'), F.col("StationEva"), F.lit('" '), F.substring(inner, 4, 1 << 20))
    every, capture = _documents(spark, sf), ["Kind", "PlanHour", "CapturedAt"]
    pieces = every.groupBy(*(F.col(c).alias(f"_{c}") for c in capture)).agg(
        F.ceil(F.count("*") / _FILE_ELEMENTS).alias("_pieces"))  # one row per kind, hour and day
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in capture))
    piece = F.pmod(F.xxhash64("StationEva", "Document"), "_pieces").alias("Piece")
    whole = every.join(F.broadcast(pieces), same).groupBy(*capture, piece).agg(
        F.concat(F.lit("<timetable>"), F.array_join(F.collect_list(named), ""), F.lit("</timetable>")).alias("value"))
    whole.withColumn("Captured", F.date_format("CapturedAt", "yyyyMMdd'T'HHmmss")).drop("CapturedAt").write.partitionBy(
        "Kind", "PlanHour", "Captured", "Piece").text(folder)
    return folder


@query("read_plan_xml")
def _read_plan_xml(spark: SparkSession, sf: str) -> DataFrame:
    return documents.read_plan_xml(spark, _folder_documents(spark, sf), documents.PARTITIONS).select(
        "DbEventId", "StationEva", "TrainCategory", "TrainNumber", "LineName", "PlannedArrival",
        "PlannedDeparture", "PlannedPlatform", "PlanHour")


@query("read_change_xml")
def _read_change_xml(spark: SparkSession, sf: str) -> DataFrame:
    return documents.read_change_xml(spark, _folder_documents(spark, sf), documents.PARTITIONS).select(
        "DbEventId", "ChangedArrival", "ChangedPlatform", "ArrivalStatus", "CapturedAt")


@query("rejected_documents")
def _rejected_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of which every 7th is cut, every 11th empty and every 13th without an id: usable elements and rejects."""
    number = F.regexp_extract("Document", 's id="([0-9]+)"', 1).cast("long")
    text = F.col("Document")
    spoiled = F.when(number % 7 == 0, F.substring(text, 1, 40)).when(number % 11 == 0, "").when(
        number % 13 == 0, F.regexp_replace(text, ' id="[0-9]+"', "")).otherwise(text)
    parsed = realtime.parse_documents(_documents(spark, sf).withColumn("Document", spoiled))
    return parsed.groupBy("Kind", F.coalesce("Rejected", F.lit("usable")).alias("Reason")).agg(F.count("*").alias("RowCount"))


@query("rejected_lines_warehouse")
def _rejected_lines_warehouse(spark: SparkSession, sf: str) -> DataFrame:
    """Exception lines of the feed written as CSV, some with a type that is no number: kept and rejected lines."""
    folder = scratch_path(spark, "feed")
    kind, key = F.col("ExceptionType").cast("string"), F.col("ServiceId") % 10
    spoiled = F.when(key == 3, F.concat(kind, F.lit("x"))).when(key == 7, F.concat(kind, F.lit(",1"))).otherwise(kind)
    view(spark, sf, "calendar_dates").withColumn("ExceptionType", spoiled).write.option("header", True).csv(
        f"{folder}/calendar_dates.txt")
    rows, rejects = feed_source.split_lines(spark, folder, "calendar_dates")
    return rows.select(F.lit("row").alias("Part")).unionByName(rejects.select(F.lit("reject").alias("Part"))).groupBy(
        "Part").agg(F.count("*").alias("LineCount"))


@query("land_raw")
def _land_raw(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "raw")
    tables.land_raw(_documents(spark, sf), path)
    return spark.read.parquet(path).groupBy("Kind", "CapturedAt").agg(F.count("*").alias("DocumentCount"))


# ---------------------------------------------------------------- match and load

_STATION_MAP = """
SELECT DISTINCT CAST(coalesce(ParentStation, StopId) AS STRING) || 'E' AS StationEva,
 coalesce(ParentStation, StopId) AS ParentStationId FROM {stops}"""

# Every trip-stop becomes an event: most as they are, some with another line, some without one of
# the times, some twice.
EVENTS_TEXT = """
SELECT CAST(FactTripStopKey AS STRING) || Suffix AS DbEventId, CAST(StationId AS STRING) || 'E' AS StationEva,
 CASE WHEN FactTripStopKey % 5 = 0 THEN LineName || 'X' WHEN FactTripStopKey % 3 = 0 THEN lower(LineName)
  ELSE left(LineName, 1) || ' ' || substring(LineName, 2) END AS LineName,
 CASE WHEN FactTripStopKey % 7 = 1 THEN NULL ELSE ScheduledArrivalDateTime END AS PlannedArrival,
 CASE WHEN FactTripStopKey % 7 = 2 THEN NULL ELSE ScheduledDepartureDateTime END AS PlannedDeparture
FROM (SELECT *, '' AS Suffix FROM {targets}
 UNION ALL SELECT *, '-d' AS Suffix FROM {targets} WHERE FactTripStopKey % 11 = 0) AS t"""


def _targets(spark: SparkSession, sf: str) -> DataFrame:
    """Stored comparison rows: what ``match_targets`` gives for the star, straight from the packed calls."""
    rows = _plan(spark, sf).keyed_view.select(
        "FactTripStopKey", date_key(F.col("ServiceDate")).alias("DateKey"),
        F.coalesce("ParentStation", "StopId").alias("StationId"), F.col("RouteShortName").alias("LineName"),
        "ScheduledArrivalDateTime", "ScheduledDepartureDateTime",
    )
    return tables.write_table(rows, scratch_path(spark, "targets"))


def _match(spark: SparkSession, sf: str) -> realtime.Match:
    targets = _targets(spark, sf)
    state = spark.sql(EVENTS_TEXT, targets=targets)
    station_map = spark.sql(_STATION_MAP, stops=view(spark, sf, "stops"))
    return realtime.match_events(state, targets, station_map)


@query("match_events")
def _match_events(spark: SparkSession, sf: str) -> DataFrame:
    return _match(spark, sf).matched.select("DbEventId", "FactTripStopKey", "DateKey")


@query("match_unmatched")
def _match_unmatched(spark: SparkSession, sf: str) -> DataFrame:
    return _match(spark, sf).unmatched


def _loads(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Load source over all observations, and a fact loaded when only the first day was known."""
    obs = view(spark, sf, "observations")

    def source(rows: DataFrame) -> DataFrame:
        return observations.event_state(rows).select(
            "DbEventId", F.col("DbEventId").cast("long").alias("FactTripStopKey"), "ArrivalDelayMinutes",
            "FirstCapturedAt", "LatestCapturedAt", "ObservationCount",
        )

    return source(obs), source(obs.filter(F.col("CapturedAt") < wall_literal(_CUT)))


@query("upsert_fact")
def _upsert_fact(spark: SparkSession, sf: str) -> DataFrame:
    return realtime.upsert_fact(*_loads(spark, sf))


@query("upsert_counts")
def _upsert_counts(spark: SparkSession, sf: str) -> DataFrame:
    return realtime.upsert_counts(realtime.upsert_fact(*_loads(spark, sf)))


@query("upsert_rerun")
def _upsert_rerun(spark: SparkSession, sf: str) -> DataFrame:
    source, fact = _loads(spark, sf)
    merged = realtime.upsert_fact(source, fact).drop("Action")
    return realtime.upsert_counts(realtime.upsert_fact(source, merged))


@query("sync_check")
def _sync_check(spark: SparkSession, sf: str) -> DataFrame:
    return realtime.sync_check(*_loads(spark, sf))


@query("conflicts")
def _conflicts(spark: SparkSession, sf: str) -> DataFrame:
    """Source with shifted bindings for every third event, against the stored fact."""
    source, fact = _loads(spark, sf)
    key = F.col("FactTripStopKey")
    return realtime.find_conflicts(
        source.withColumn("FactTripStopKey", F.when(key % 3 == 0, key + 1).otherwise(key)), fact
    )


@query("snapshots_split_batches")
def _snapshots_split_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The history that the stream writes when plan and change of a capture land in different batches."""
    root = scratch_path(spark, "realtime")
    paths, every = stream.RealtimePaths(root), _documents(spark, sf)
    middle = every.agg(F.expr("timestampadd(DAY, cast(datediff(max(CapturedAt), min(CapturedAt)) / 2 as int), min(CapturedAt))")).first()[0]
    early = F.col("CapturedAt") < wall_literal(middle)
    plan = F.col("Kind") == "plan"
    landings = [every.filter(early & plan), every.filter(early & ~plan | ~early & plan), every.filter(~early & ~plan)]
    close = every.agg((F.max("CapturedAt") + F.expr("INTERVAL 1000 DAYS")).alias("CapturedAt")).select(
        F.lit("0").alias("StationEva"), F.lit("plan").alias("Kind"), F.lit("00").alias("PlanHour"), "CapturedAt",
        F.lit("<timetable/>").alias("Document"))
    nowhere = spark.createDataFrame([], "FactTripStopKey long, DateKey int, StationId string, LineName string, "
                                    "ScheduledArrivalDateTime timestamp_ntz, ScheduledDepartureDateTime timestamp_ntz")
    stations = spark.createDataFrame([], "StationEva string, ParentStationId string")
    for landing in (*landings, close):
        tables.land_raw(landing, f"{root}/raw")
        stream.run_realtime(spark, f"{root}/raw", paths, stations, lambda: nowhere, wait="500 days").awaitTermination()
    return tables.read_observations(spark, paths.history).select(*realtime.SNAPSHOT_COLUMNS)


@query("realtime_two_cycles")
def _realtime_two_cycles(spark: SparkSession, sf: str) -> DataFrame:
    """Events that gain and lose rivals between cycles, loaded cycle by cycle; the fact comes back.

    First come the events of all trip-stops that have no copy, then the copies, which are rivals; then every
    second copy is planned for another time, which is no trip-stop's, and so stops being a rival.
    """
    root = scratch_path(spark, "realtime")
    paths, targets = stream.RealtimePaths(root), _targets(spark, sf)
    events = tables.write_table(spark.sql(EVENTS_TEXT, targets=targets), f"{root}/events")
    copy = F.col("DbEventId").endswith("-d")
    away = F.expr("INTERVAL 13 SECONDS")
    gone = events.filter(copy & (F.col("DbEventId").substr(F.lit(1), F.length("DbEventId") - 2).cast("long") % 2 == 0)).withColumns(
        {c: F.col(c) + away for c in ("PlannedArrival", "PlannedDeparture")})
    stations = spark.sql(_STATION_MAP, stops=view(spark, sf, "stops"))
    absent = {
        **{c: F.lit(None).cast("string") for c in ("TrainName", "PlannedPlatform", "ChangedPlatform")},
        **{c: F.lit(None).cast("timestamp_ntz") for c in ("ChangedArrival", "ChangedDeparture")},
        **{c: F.lit(None).cast("int") for c in ("ArrivalDelayMinutes", "DepartureDelayMinutes")},
        **{c: F.lit(False) for c in ("IsArrivalCancelled", "IsDepartureCancelled")},
    }
    for batch, rows in enumerate((events.filter(~copy), events.filter(copy), gone)):
        captured = wall_literal(datetime(2026, 7, 1, 12 + batch))
        snapshots = rows.withColumns({**absent, "CapturedAt": captured}).select(*realtime.SNAPSHOT_COLUMNS)
        stream.load_snapshots(snapshots, batch, paths, stations, lambda: targets, strict=False)
    return spark.read.parquet(paths.fact).select("DbEventId", "FactTripStopKey", "DateKey", "ObservationCount")


@query("realtime_cycle")
def _realtime_cycle(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of every trip-stop event through the stream: history, match, upsert; the fact comes back."""
    root = scratch_path(spark, "realtime")
    targets = _targets(spark, sf)
    events = spark.sql(EVENTS_TEXT, targets=targets)
    arrival = F.date_format("PlannedArrival", "yyMMddHHmm")
    departure = F.date_format("PlannedDeparture", "yyMMddHHmm")
    changed = F.date_format(F.col("PlannedArrival") + F.expr("INTERVAL 7 MINUTES"), "yyMMddHHmm")

    def document(*inner) -> F.Column:
        parts = [F.lit('<timetable><s id="'), F.col("DbEventId"), F.lit('">'), *inner, F.lit("</s></timetable>")]
        return F.concat(*[F.coalesce(p, F.lit("")) for p in parts]).alias("Document")

    def call(tag: str, name: str, value: F.Column) -> F.Column:
        line = F.concat(F.lit('" l="'), F.col("LineName"))
        return F.concat(F.lit(f'<{tag} {name}="'), value, line, F.lit('"/>'))

    captured = wall_literal(datetime(2026, 7, 1, 12)).alias("CapturedAt")
    common = ["StationEva", F.lit("01").alias("PlanHour"), captured]
    plan = events.select(*common, F.lit("plan").alias("Kind"),
                         document(call("ar", "pt", arrival), call("dp", "pt", departure)))
    change = events.select(*common, F.lit("change").alias("Kind"), document(call("ar", "ct", changed)))
    tables.land_raw(plan.unionByName(change), f"{root}/raw")
    station_map = spark.sql(_STATION_MAP, stops=view(spark, sf, "stops"))
    paths = stream.RealtimePaths(root)
    stream.run_realtime(spark, f"{root}/raw", paths, station_map, lambda: targets).awaitTermination()
    return spark.read.parquet(paths.fact).select(
        "DbEventId", "FactTripStopKey", "ArrivalDelayMinutes", "ObservationCount"
    )


# ---------------------------------------------------------------- performance

PERFORMANCE_TEXT = """
SELECT CAST(FactTripStopKey AS STRING) AS DbEventId, FactTripStopKey,
 ScheduledArrivalDateTime AS PlannedArrival, ScheduledDepartureDateTime AS PlannedDeparture,
 CASE WHEN FactTripStopKey % 13 = 0 THEN NULL ELSE CAST(FactTripStopKey % 31 - 4 AS INT) END AS ArrivalDelayMinutes,
 CASE WHEN FactTripStopKey % 13 = 0 THEN NULL ELSE CAST(FactTripStopKey % 29 - 3 AS INT) END AS DepartureDelayMinutes,
 FactTripStopKey % 17 = 0 AS IsArrivalCancelled, FactTripStopKey % 19 = 0 AS IsDepartureCancelled,
 CAST(FactTripStopKey % 4 AS STRING) AS PlannedPlatform,
 CASE WHEN FactTripStopKey % 3 = 0 THEN CAST(FactTripStopKey % 5 AS STRING) END AS ChangedPlatform
FROM {view}"""

# Official rates per month and mode.
OFFICIAL_TEXT = """
SELECT CAST('2026-' || lpad(CAST(7 + n_nationkey % 4 AS STRING), 2, '0') || '-01' AS DATE) AS MonthStart,
 CASE n_nationkey % 3 WHEN 0 THEN 'RE' WHEN 1 THEN 'RB' ELSE 'S-Bahn' END AS TransportMode,
 max((80 + n_nationkey % 15) / 100.0E0) AS OfficialRate FROM {nation} GROUP BY 1, 2"""


def _performance(spark: SparkSession, sf: str) -> DataFrame:
    """Every trip-stop as an event with arithmetic delays, joined to its schedule attributes."""
    wanted = [  # what the events and the schedule side of the measures are made of
        "FactTripStopKey", "TripInstanceKey", "StopSequence", "ServiceDate", "RouteShortName", "TransportMode",
        "OperatorName", "StopName", "ParentStationName", "ScheduledArrivalDateTime", "ScheduledDepartureDateTime",
    ]
    stored = tables.write_table(_plan(spark, sf).keyed_view.select(*wanted), scratch_path(spark, "view"))
    return performance.performance_view(spark.sql(PERFORMANCE_TEXT, view=stored), stored)


def _on_performance(name: str, function: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf: function(_performance(spark, sf))


PEAKS = {"Morning": (6, 9), "Evening": (16, 19)}

_on_performance("kpi_route_delay", lambda df: aggregates.top_k(
    performance.route_delays(df), "AvgDelay", 10, ["RouteShortName", "TransportMode"]))
_on_performance("kpi_route_delay_all", performance.route_delays)
_on_performance("kpi_route_cancellation", performance.route_cancellations)
_on_performance("kpi_station_problems", performance.station_problems)
_on_performance("kpi_mode", performance.mode_comparison)
_on_performance("kpi_hour_weekday", performance.hour_weekday)
_on_performance("kpi_trend", performance.reliability_trend)
_on_performance("kpi_punctuality", lambda df: performance.punctuality(df, ["ServiceDate"]))
_on_performance("kpi_operator", performance.operator_performance)
_on_performance("kpi_peak", lambda df: performance.peak_reliability(df, PEAKS))
_on_performance("delay_propagation", performance.delay_propagation)


@query("kpi_official")
def _kpi_official(spark: SparkSession, sf: str) -> DataFrame:
    official = spark.sql(OFFICIAL_TEXT, nation=load(spark, sf, "nation"))
    return performance.compare_official(_performance(spark, sf), official)


_on_plan("scheduled_volume_route", lambda p: performance.scheduled_volume(p.packed_view, "route", _days))
_on_plan("scheduled_volume_mode", lambda p: performance.scheduled_volume(p.packed_view, "mode", _days))
_on_plan("scheduled_volume_day", lambda p: performance.scheduled_volume(trips.fan_out(p.packed_view), "day"))
_on_plan("scheduled_volume_weekend", lambda p: performance.scheduled_volume(trips.fan_out(p.packed_view), "weekend"))
_on_plan("scheduled_volume_hour", lambda p: performance.scheduled_volume(p.view, "hour"))
_on_plan("headways", lambda p: performance.headways(p.view))


@query("observation_facts")
def _observation_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Captures of all events that the first day bound to a trip-stop."""
    obs = view(spark, sf, "observations")
    return performance.observation_facts(obs, _loads(spark, sf)[1]).select(
        "DbEventId", "FactTripStopKey", "CapturedAt", "ObservationKey", "ArrivalDelayMinutes"
    )


@query("feed_versions")
def _feed_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Trips of two feed versions: pending orders left, fulfilled ones came, urgent ones changed service."""
    orders = load(spark, sf, "orders")
    columns = [F.col("o_orderkey").alias("TripId"), F.col("o_orderpriority").alias("TripHeadsign")]
    old = orders.filter("o_orderstatus <> 'F'").select(*columns, F.col("o_custkey").alias("ServiceId"))
    urgent = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_custkey") + 1).otherwise(F.col("o_custkey"))
    new = orders.filter("o_orderstatus <> 'P'").select(*columns, urgent.alias("ServiceId"))
    return performance.compare_versions(old, new, ["TripId"])
