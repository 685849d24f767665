"""Delay, cancellation and punctuality measures on the realtime fact, and schedule comparisons.

NULL delays are left out of averages and rates and never count as punctual.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripgrain.functions.times import platform_changed
from tripgrain.operators.aggregates import station_name
from tripgrain.operators.joins import lookup_join
from tripgrain.operators.observations import with_previous
from tripgrain.session import freeze

# Minutes of delay up to which a stop counts as punctual.
PUNCTUAL_MINUTES = 5


def performance_view(realtime_fact: DataFrame, view: DataFrame) -> DataFrame:
    """Realtime facts with the schedule attributes the reports group by.

    Where both have ``DateKey``, only the facts' days of the schedule are read: they are literals, one per day,
    so that a schedule in folders by day is pruned, and the day is part of the join key.
    """
    on = ["FactTripStopKey"]
    if "DateKey" in realtime_fact.columns and "DateKey" in view.columns:
        days = [row[0] for row in realtime_fact.select("DateKey").distinct().dropna().collect()]
        view = view.filter(F.col("DateKey").isin(days))
        on = ["DateKey", *on]
    facts = realtime_fact.select(
        "DbEventId",
        *on,
        F.coalesce("PlannedArrival", "PlannedDeparture").alias("PlannedTime"),
        F.coalesce("ArrivalDelayMinutes", "DepartureDelayMinutes").alias("DelayMinutes"),
        (F.col("IsArrivalCancelled") | F.col("IsDepartureCancelled")).alias("IsCancelled"),
        platform_changed(F.col("PlannedPlatform"), F.col("ChangedPlatform")).alias("PlatformChanged"),
    )
    schedule = view.select(
        *on, "TripInstanceKey", "StopSequence", "ServiceDate", "RouteShortName",
        "TransportMode", "OperatorName", station_name().alias("StationName"),
    )
    return facts.join(schedule, on).drop(*on[:-1])


def _rate(condition: Column) -> Column:
    """Share of rows where ``condition`` holds, among those where it is known."""
    return F.round(F.avg(condition.cast("int")), 6)


def _punctual(minutes: int) -> Column:
    return F.col("DelayMinutes") <= minutes


def measures(perf: DataFrame, by: Sequence[Column | str], punctual_minutes: int = PUNCTUAL_MINUTES) -> DataFrame:
    """The common measures per group: volume, delay, cancellation, punctuality, platform changes."""
    return perf.groupBy(*by).agg(
        F.count("*").alias("StopCount"),
        F.count("DelayMinutes").alias("DelayCount"),
        F.round(F.avg("DelayMinutes"), 6).alias("AvgDelay"),
        F.count_if("IsCancelled").alias("CancelledCount"),
        _rate(F.col("IsCancelled")).alias("CancellationRate"),
        _rate(_punctual(punctual_minutes)).alias("PunctualityRate"),
        F.sum("PlatformChanged").alias("PlatformChangeCount"),
    )


def route_delays(perf: DataFrame) -> DataFrame:
    """Delay per route: mean, median, 90th percentile (exact, from counts per distinct minute), maximum."""
    route, delay = ["RouteShortName", "TransportMode"], F.col("DelayMinutes")
    minutes = perf.groupBy(*route, "DelayMinutes").agg(F.count("*").alias("_rows"))
    known = F.sum(F.when(delay.isNotNull(), F.col("_rows")))
    return minutes.groupBy(*route).agg(
        F.coalesce(known, F.lit(0)).alias("DelayCount"),
        F.round(F.sum(delay * F.col("_rows")) / known, 6).alias("AvgDelay"),
        F.round(F.percentile(delay, 0.5, F.col("_rows")), 6).alias("MedianDelay"),
        F.round(F.percentile(delay, 0.9, F.col("_rows")), 6).alias("P90Delay"),
        F.max("DelayMinutes").alias("MaxDelay"),
    )


def route_cancellations(perf: DataFrame) -> DataFrame:
    return perf.groupBy("RouteShortName", "TransportMode").agg(
        F.count("*").alias("StopCount"),
        F.count_if("IsCancelled").alias("CancelledCount"),
        _rate(F.col("IsCancelled")).alias("CancellationRate"),
    )


def station_problems(perf: DataFrame, punctual_minutes: int = PUNCTUAL_MINUTES) -> DataFrame:
    """Stops that were cancelled, late or moved to another platform, per station."""
    late = F.coalesce(F.col("DelayMinutes") > punctual_minutes, F.lit(False))
    problem = F.col("IsCancelled") | late | (F.col("PlatformChanged") == 1)
    return perf.groupBy("StationName").agg(
        F.count("*").alias("StopCount"),
        F.count_if(problem).alias("ProblemCount"),
        _rate(problem).alias("ProblemRate"),
    )


def mode_comparison(perf: DataFrame) -> DataFrame:
    return measures(perf, ["TransportMode"])


def operator_performance(perf: DataFrame) -> DataFrame:
    return measures(perf, ["OperatorName"])


def hour_weekday(perf: DataFrame) -> DataFrame:
    planned = F.col("PlannedTime")
    return measures(perf, [F.dayofweek(planned).alias("DayOfWeek"), F.hour(planned).alias("HourOfDay")])


def punctuality(perf: DataFrame, by: Sequence[Column | str], punctual_minutes: int = PUNCTUAL_MINUTES) -> DataFrame:
    return perf.groupBy(*by).agg(
        F.count("DelayMinutes").alias("DelayCount"),
        F.count_if(_punctual(punctual_minutes)).alias("PunctualCount"),
        _rate(_punctual(punctual_minutes)).alias("PunctualityRate"),
    )


def peak_reliability(perf: DataFrame, peaks: Mapping[str, tuple[int, int]]) -> DataFrame:
    """Measures per named range of hours ``(from, to)``, ``to`` excluded; the rest is "Off-peak"."""
    hour = F.hour("PlannedTime")
    name = F
    for label, (start, end) in peaks.items():
        name = name.when((hour >= start) & (hour < end), label)
    return measures(perf, [name.otherwise("Off-peak").alias("PeakBucket")])


def reliability_trend(perf: DataFrame, punctual_minutes: int = PUNCTUAL_MINUTES) -> DataFrame:
    """Weekly rates and their change from the week before; the window sees one row per week and mode."""
    week = F.date_trunc("WEEK", F.col("ServiceDate")).cast("date").alias("WeekStart")
    weekly = punctuality(perf, ["TransportMode", week], punctual_minutes)
    before = F.lag("PunctualityRate").over(Window.partitionBy("TransportMode").orderBy("WeekStart"))
    return weekly.withColumn("RateChange", F.round(F.col("PunctualityRate") - before, 6))


def delay_propagation(perf: DataFrame) -> DataFrame:
    """Delay at each stop of a trip instance against the stop before on the same trip."""
    along = Window.partitionBy("TripInstanceKey").orderBy("StopSequence")
    before = F.lag("DelayMinutes").over(along)
    return perf.select(
        "TripInstanceKey",
        "StopSequence",
        "DelayMinutes",
        before.alias("PreviousDelayMinutes"),
        (F.col("DelayMinutes") - before).alias("DelayGained"),
    )


def compare_official(
    perf: DataFrame, official: DataFrame, punctual_minutes: int = PUNCTUAL_MINUTES
) -> DataFrame:
    """Own monthly punctuality per mode beside ``official`` (MonthStart, TransportMode, OfficialRate)."""
    month = F.date_trunc("MONTH", F.col("ServiceDate")).cast("date").alias("MonthStart")
    own = punctuality(perf, ["TransportMode", month], punctual_minutes)
    return own.join(official, ["MonthStart", "TransportMode"]).withColumn(
        "RateDifference", F.round(F.col("PunctualityRate") - F.col("OfficialRate"), 6)
    )


def observation_facts(obs: DataFrame, matches: DataFrame) -> DataFrame:
    """All captures of matched events with their trip-stop: the history behind the latest-state fact."""
    links = matches.select("DbEventId", "FactTripStopKey")
    return lookup_join(obs, links, ["DbEventId"], ["CapturedAt", "ObservationKey"])


def compare_versions(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows added, removed or changed between two versions of a table that is unique on ``key``."""
    values = [c for c in old.columns if c not in key]
    left = old.select(*key, F.struct(*values).alias("_old"))
    right = new.select(*key, F.struct(*values).alias("_new"))
    change = (
        F.when(F.col("_old").isNull(), "added")
        .when(F.col("_new").isNull(), "removed")
        .when(~F.col("_old").eqNullSafe(F.col("_new")), "changed")
    )
    return left.join(right, list(key), "full_outer").select(*key, change.alias("Change")).dropna(subset=["Change"])


def headways(view: DataFrame) -> DataFrame:
    """Departures per station, route and hour, and the minutes since the departure before."""
    departures = view.filter(F.col("ScheduledDepartureDateTime").isNotNull()).select(
        station_name().alias("StationName"),
        "RouteShortName",
        F.col("ScheduledDepartureDateTime").alias("Departure"),
    )
    keys = ["StationName", "RouteShortName"]
    # Departures at the same minute are one entry with a count. Stored, because it is read twice.
    times = freeze(departures.groupBy(*keys, "Departure").agg(F.count("*").alias("_n")))
    day = F.to_date("Departure")
    rows = with_previous(times, keys, ["Departure"], day, ["Departure"], "_previous")
    gap = (F.col("Departure") - F.col("_previous.Departure")).cast("interval minute").cast("int")
    return (
        rows.withColumn("_gap", gap)
        .groupBy(*keys, F.hour("Departure").alias("HourOfDay"))
        .agg(
            F.sum("_n").alias("DepartureCount"),
            F.min("_gap").alias("MinHeadway"),
            F.max("_gap").alias("MaxHeadway"),
        )
    )


def scheduled_volume(view: DataFrame, by: str, weight: str | None = None) -> DataFrame:
    """Scheduled stops by "day", "route", "mode", "weekend" or "hour"."""
    groups = {
        "day": F.col("ServiceDate"),
        "route": F.col("RouteShortName"),
        "mode": F.col("TransportMode"),
        "weekend": F.dayofweek("ServiceDate").isin(1, 7).alias("IsWeekend"),
        "hour": F.hour(F.coalesce("ScheduledDepartureDateTime", "ScheduledArrivalDateTime")).alias("HourOfDay"),
    }
    amount = F.count("*") if weight is None else F.sum(F.col(weight).cast("long"))
    return view.groupBy(groups[by]).agg(amount.alias("ScheduledStopCount"))
