"""The scheduled side: from feed tables to the star schema."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgrain.functions.times import date_key, service_seconds
from tripgrain.operators import calendar, facts, routes, stops, trips
from tripgrain.operators.joins import estimated_bytes, lookup_join
from tripgrain.operators.keys import require_unique, trip_stop_key
from tripgrain.operators.realtime import match_targets
from tripgrain.schemas import FEED
from tripgrain.session import freeze
from tripgrain.sources.feed import read_feed, split_lines
from tripgrain.sources.tables import write_fact, write_table


@dataclass(frozen=True)
class Feed:
    """Staged feed tables."""

    agency: DataFrame
    routes: DataFrame
    trips: DataFrame
    stops: DataFrame
    stop_times: DataFrame
    calendar: DataFrame
    calendar_dates: DataFrame
    feed_info: DataFrame | None = None

    @classmethod
    def read(cls, spark: SparkSession, folder: str, strict: bool = False) -> Feed:
        return cls(**{name: read_feed(spark, folder, name, strict=strict) for name in FEED})

    @classmethod
    def read_split(cls, spark: SparkSession, folder: str) -> tuple[Feed, DataFrame]:
        """The lines that fit their schema, and the others (TableName, Line); each file is parsed once."""
        parts = {name: split_lines(spark, folder, name) for name in FEED}
        return cls(**{name: rows for name, (rows, _) in parts.items()}), reduce(
            DataFrame.unionByName, [rejects for _, rejects in parts.values()])


class ScheduledPlan:
    """Lazy tables of the scheduled side.

    Dimension values are attached where the data is small (routes to trips, stops to stop times)
    and the service dates stay packed in an array, so the trip-stop fan-out is never shuffled.
    """

    def __init__(self, feed: Feed, case_insensitive: bool = False) -> None:
        self.feed = feed
        self.case_insensitive = case_insensitive

    @cached_property
    def service_dates(self) -> DataFrame:
        return calendar.resolve_service_dates(self.feed.calendar, self.feed.calendar_dates)

    @cached_property
    def calendars(self) -> DataFrame:
        """The packed dates of each service, stored: resolved once, however many steps read them."""
        return freeze(calendar.service_calendars(self.service_dates))

    @cached_property
    def date_rows(self) -> int:
        """The rows of :attr:`service_dates`, from the stored calendars."""
        return self.calendars.agg(F.coalesce(F.sum(F.size("ServiceDates")), F.lit(0))).first()[0]

    @cached_property
    def classification(self) -> DataFrame:
        return routes.classify_routes(self.feed.routes, case_insensitive=self.case_insensitive)

    @cached_property
    def keyed_calendars(self) -> DataFrame:
        return trips.trip_calendars(self.feed.trips, self.service_dates, True, self.date_rows, self.calendars)

    @cached_property
    def trip_instances(self) -> DataFrame:
        return trips.expand_trips(self.feed.trips, self.service_dates, True, self.date_rows, self.calendars)

    @cached_property
    def trip_stops(self) -> DataFrame:
        return trips.build_trip_stops(self.keyed_calendars, self.classification, self.feed.stop_times)

    @cached_property
    def normalized(self) -> DataFrame:
        return trips.normalize_times(self.trip_stops)

    @cached_property
    def calls(self) -> DataFrame:
        """In-scope trips at their stops, one row per trip and stop, dates packed.

        Dimensions and fact all derive from it; :meth:`store_calls` keeps it from being computed again.
        """
        return self._calls(routes.in_scope(self.classification), None, with_key=True)

    def store_calls(self, folder: str) -> ScheduledPlan:
        self.calls = write_table(self.calls, f"{folder}/calls")
        return self

    @cached_property
    def dim_date(self) -> DataFrame:
        """Every date from the first to the last trip-stop."""
        bounds = self.calls.agg(
            F.min(F.array_min("ServiceDates")).alias("FirstDate"),
            F.max(F.array_max("ServiceDates")).alias("LastDate"),
        )
        return calendar.build_dim_date(bounds)

    @cached_property
    def dim_route(self) -> DataFrame:
        return routes.build_dim_route(self.feed.routes, self.classification, self.feed.agency)

    @cached_property
    def dim_stop(self) -> DataFrame:
        return stops.build_dim_stop(self.calls, self.feed.stops)

    def _calls(self, route_values: DataFrame, stop_values: DataFrame | None, with_key: bool) -> DataFrame:
        """One row per in-scope trip and stop, dates packed, with route and stop values attached.

        Routes and stops are unique lookups: they cannot have more rows than the staged tables. Stop values come
        after the trips, so that only calls of trips that are kept move by stop, and no stop value moves by trip.
        """
        feed = self.feed
        timed = feed.stop_times.select(
            "TripId",
            "StopId",
            "StopSequence",
            service_seconds(F.col("ArrivalTime")).alias("_arr"),
            service_seconds(F.col("DepartureTime")).alias("_dep"),
        )
        in_scope = lookup_join(
            feed.trips.select("TripId", "RouteId", "ServiceId"), route_values, ["RouteId"], ["TripId"],
            size=estimated_bytes(feed.routes),
        )
        trip_rows = trips.pack_dates(in_scope, self.service_dates, feed.trips, self.date_rows, self.calendars)
        if with_key:
            trip_rows = trip_rows.join(trips.first_instance_keys(feed.trips, self.service_dates, self.calendars), "TripId")
        rows = trip_rows.join(timed, "TripId")
        if stop_values is None:
            return rows
        named = lookup_join(
            rows, stop_values, ["StopId"], ["TripId", "StopSequence"],
            size=estimated_bytes(feed.stops), heat=feed.stop_times,
        )
        return named.select(*rows.columns, *(c for c in stop_values.columns if c != "StopId"))

    def _named_calls(self, with_key: bool) -> DataFrame:
        """Calls with the attributes of the analytical view, straight from the staged tables."""
        feed = self.feed
        route_values = routes.build_dim_route(feed.routes, self.classification, feed.agency, with_key=False)
        names = feed.stops.select(
            F.col("StopId").alias("ParentStation"), F.col("StopName").alias("ParentStationName")
        )
        stop_values = lookup_join(
            feed.stops.select(
                "StopId", "StopName", "ParentStation", "PlatformCode",
                F.col("StopLat").alias("Latitude"), F.col("StopLon").alias("Longitude"),
            ),
            names, ["ParentStation"], ["StopId"], "left",
        )
        return self._calls(route_values.drop("AgencyId", "SourceRouteType"), stop_values, with_key)

    @cached_property
    def packed_view(self) -> DataFrame:
        """The analytical view without surrogate keys and before the fan-out.

        ``ServiceDays`` is the number of dates a row stands for; counting reports sum it.
        """
        return self._named_calls(with_key=False).withColumn("ServiceDays", F.size("ServiceDates"))

    @cached_property
    def view(self) -> DataFrame:
        """The analytical view without surrogate keys, one row per trip-stop."""
        return trips.wall_times(trips.fan_out(self._named_calls(with_key=False)))

    @cached_property
    def keyed_view(self) -> DataFrame:
        """As :attr:`view`, with the trip instance and trip-stop keys."""
        rows = trips.wall_times(trips.fan_out(self._named_calls(with_key=True)))
        return rows.withColumn("FactTripStopKey", trip_stop_key())

    @cached_property
    def fact(self) -> DataFrame:
        """The fact, with keys attached before the fan-out; equal to ``resolve_keys`` on ``normalized``.

        ``dim_date`` spans exactly the dates of these rows, so its join only computes the key.
        """
        spread = ["TripId", "StopSequence"]
        calls = lookup_join(
            self.calls, self.dim_route.select("RouteId", "RouteKey"), ["RouteId"], spread,
            size=estimated_bytes(self.feed.routes),
        )
        calls = lookup_join(
            calls, self.dim_stop.select("StopId", "StopKey"), ["StopId"], spread,
            size=estimated_bytes(self.feed.stops), heat=self.calls,
        )
        rows = trips.wall_times(trips.fan_out(calls))
        keys = {"DateKey": date_key(F.col("ServiceDate")), "FactTripStopKey": trip_stop_key()}
        return rows.withColumns(keys).select(*facts.FACT_COLUMNS)

    def store_star(self, folder: str) -> ScheduledPlan:
        """Write dimensions and fact below ``folder``; later work on this plan reads the stored tables."""
        self.store_calls(folder)
        self.dim_date = write_table(self.dim_date, f"{folder}/dim_date")
        self.dim_route = write_table(self.dim_route, f"{folder}/dim_route")
        self.dim_stop = write_table(self.dim_stop, f"{folder}/dim_stop")
        self.fact = write_table(self.fact, f"{folder}/fact_trip_stop")
        return self

    @cached_property
    def analytics(self) -> DataFrame:
        """The star join; meant for stored tables (see :meth:`store_star`)."""
        return facts.trip_stop_analytics(self.fact, self.dim_date, self.dim_route, self.dim_stop)


def build_warehouse(
    spark: SparkSession, feed: Feed, folder: str, check_keys: bool = True, rejects: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Write every table of the scheduled side below ``folder`` and return the stored tables.

    Each stage reads the stored result of the one before, so sizes are known when joins are planned.
    ``rejects`` (see :meth:`Feed.read_split`) become the table ``stg/rejected_lines``. ``match_targets`` is what the
    realtime side compares events with.
    """

    def store(name: str, df: DataFrame) -> DataFrame:
        return write_table(df, f"{folder}/{name}")

    staged = Feed(**{
        name: store(f"stg/{name}", getattr(feed, name)) for name in FEED if getattr(feed, name) is not None
    })
    if check_keys:
        require_unique(staged.trips, ["TripId"], "trips")
        require_unique(staged.stop_times, ["TripId", "StopSequence"], "stop_times")
    plan = ScheduledPlan(staged)
    plan.service_dates = store("wrk/service_dates", plan.service_dates)
    plan.calendars = store("wrk/service_calendars", calendar.service_calendars(plan.service_dates))
    plan.classification = store("wrk/route_classification", plan.classification)
    plan.trip_instances = store("wrk/trip_instances", plan.trip_instances)
    plan.trip_stops = store("wrk/trip_stops", plan.trip_stops)
    plan.dim_date = store("dw/dim_date", calendar.build_dim_date(calendar.date_bounds(plan.trip_stops)))
    plan.dim_route = store("dw/dim_route", plan.dim_route)
    plan.dim_stop = store("dw/dim_stop", stops.build_dim_stop(plan.trip_stops, staged.stops))
    fact = facts.resolve_keys(trips.normalize_times(plan.trip_stops), plan.dim_date, plan.dim_route, plan.dim_stop)
    plan.fact = write_fact(fact, f"{folder}/dw/fact_trip_stop")
    extra = {"match_targets": store("dw/match_targets", match_targets(plan.fact, plan.dim_route, plan.dim_stop))}
    if rejects is not None:
        extra["rejected_lines"] = store("stg/rejected_lines", rejects)
    return {
        **extra,
        "service_dates": plan.service_dates,
        "route_classification": plan.classification,
        "trip_instances": plan.trip_instances,
        "trip_stops": plan.trip_stops,
        "dim_date": plan.dim_date,
        "dim_route": plan.dim_route,
        "dim_stop": plan.dim_stop,
        "fact_trip_stop": plan.fact,
    }
