"""Service calendars resolved to dates, and the date dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgrain.functions.times import date_key, runs_on_weekday, text_date

ADDED, REMOVED = 1, 2


def explode_range(df: DataFrame, start: str, end: str, name: str = "ServiceDate") -> DataFrame:
    """One row per day from ``start`` to ``end``. An inverted or open range gives no rows."""
    days = F.when(F.col(start) <= F.col(end), F.sequence(F.col(start), F.col(end)))
    return df.withColumn(name, F.explode(days))


def regular_dates(calendar: DataFrame) -> DataFrame:
    """Dates of the weekly pattern, before exceptions."""
    ranged = calendar.withColumn("_from", text_date(F.col("StartDate"))).withColumn(
        "_to", text_date(F.col("EndDate"))
    )
    return (
        explode_range(ranged, "_from", "_to")
        .filter(runs_on_weekday(F.col("ServiceDate")))
        .select("ServiceId", "ServiceDate")
    )


def resolve_service_dates(calendar: DataFrame, calendar_dates: DataFrame) -> DataFrame:
    """(regular dates union added dates) minus removed dates; a removal beats an addition.

    Union and difference are one aggregation on (ServiceId, ServiceDate): one shuffle with map-side
    combine, and a service with many rows is spread over its dates.
    """
    exceptions = calendar_dates.filter(F.col("ExceptionType").isin(ADDED, REMOVED)).select(
        "ServiceId",
        text_date(F.col("ServiceDate")).alias("ServiceDate"),
        (F.col("ExceptionType") == REMOVED).alias("_removed"),
    )
    marked = regular_dates(calendar).withColumn("_removed", F.lit(False)).unionByName(exceptions)
    return (
        marked.filter(F.col("ServiceDate").isNotNull())
        .groupBy("ServiceId", "ServiceDate")
        .agg(F.bool_or("_removed").alias("_removed"))
        .filter(~F.col("_removed"))
        .select("ServiceId", "ServiceDate")
    )


def service_calendars(service_dates: DataFrame) -> DataFrame:
    """One row per service with its sorted dates.

    A service holds each date once, so the array is bounded by the days of the feed.
    """
    return service_dates.groupBy("ServiceId").agg(
        F.array_sort(F.collect_list("ServiceDate")).alias("ServiceDates")
    )


def _date_columns(days: DataFrame) -> DataFrame:
    day = F.col("FullDate")
    return days.select(
        date_key(day).alias("DateKey"),
        day,
        F.dayofmonth(day).alias("DayNumber"),
        F.date_format(day, "EEEE").alias("DayName"),
        F.dayofweek(day).alias("DayOfWeek"),
        F.weekofyear(day).alias("WeekNumber"),
        F.month(day).alias("MonthNumber"),
        F.date_format(day, "MMMM").alias("MonthName"),
        F.quarter(day).alias("QuarterNumber"),
        F.year(day).alias("YearNumber"),
        F.dayofweek(day).isin(1, 7).alias("IsWeekend"),
    )


def build_dim_date(bounds: DataFrame, start: str = "FirstDate", end: str = "LastDate") -> DataFrame:
    """Date dimension for the range in the one-row table ``bounds``; Sunday is day 1, weeks are ISO."""
    return _date_columns(explode_range(bounds, start, end, "FullDate").select("FullDate"))


def date_bounds(df: DataFrame, column: str = "ServiceDate") -> DataFrame:
    return df.agg(F.min(column).alias("FirstDate"), F.max(column).alias("LastDate"))
