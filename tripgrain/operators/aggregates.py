"""Counts, profiles and ranked reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame, name: str = "RowCount") -> DataFrame:
    return df.agg(F.count("*").alias(name))


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One labelled count per table."""
    parts = [
        row_count(df).select(F.lit(name).alias("TableName"), "RowCount") for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def coverage(df: DataFrame, key: str, date: str = "ServiceDate") -> DataFrame:
    """Rows, distinct keys, first and last date, distinct dates; all exact.

    Rows are combined per key and, beside it, per date: a task holds its keys and its dates, not their pairs.
    """
    types = {field.name: field.dataType for field in df.select(key, date).schema}
    keys = F.struct(F.col(key).alias("_key"), F.lit(None).cast(types[date]).alias("_date"), F.lit(False).alias("_dated"))
    dates = F.struct(F.lit(None).cast(types[key]).alias("_key"), F.col(date).alias("_date"), F.lit(True).alias("_dated"))
    groups = df.select(F.inline(F.array(keys, dates))).groupBy("_key", "_date", "_dated").agg(F.count("*").alias("_rows"))
    return groups.agg(
        F.coalesce(F.sum(F.when(F.col("_dated"), F.col("_rows"))), F.lit(0)).alias("RowCount"),
        F.count("_key").alias("DistinctKeys"),
        F.min("_date").alias("FirstDate"),
        F.max("_date").alias("LastDate"),
        F.count("_date").alias("DayCount"),
    )


def distribution(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("RowCount"))


def length_profile(df: DataFrame, column: str) -> DataFrame:
    size = F.char_length(F.col(column).cast("string"))
    return df.agg(
        F.min(size).alias("MinLength"),
        F.max(size).alias("MaxLength"),
        F.round(F.avg(size), 6).alias("AvgLength"),
    )


def reconcile_counts(work: DataFrame, fact: DataFrame) -> DataFrame:
    """Two row counts side by side."""
    return row_count(work, "WorkRowCount").crossJoin(row_count(fact, "FactRowCount"))


def volume(view: DataFrame, by: Sequence[Column | str], weight: str | None = None) -> DataFrame:
    """Scheduled stops per group. ``weight`` names the number of stops a row stands for."""
    amount = F.count("*") if weight is None else F.sum(F.col(weight).cast("long"))
    return view.groupBy(*by).agg(amount.alias("ScheduledStopCount"))


def volume_by_mode(view: DataFrame, weight: str | None = None) -> DataFrame:
    return volume(view, ["TransportMode"], weight)


def volume_by_route(view: DataFrame, weight: str | None = None) -> DataFrame:
    """Routes without an operator form a group of their own."""
    return volume(view, ["RouteShortName", "TransportMode", "OperatorName"], weight)


def station_name() -> Column:
    return F.coalesce("ParentStationName", "StopName")


def volume_by_station(view: DataFrame, weight: str | None = None) -> DataFrame:
    return volume(view, [station_name().alias("StationName")], weight)


def top_k(df: DataFrame, by: str, k: int, ties: Sequence[str]) -> DataFrame:
    """The k largest rows by ``by``; ``ties`` makes the choice among equals definite."""
    return df.orderBy(F.desc(by), *ties).limit(k)


def preview(df: DataFrame, order: Sequence[Column | str], n: int = 20) -> DataFrame:
    """The first n rows in ``order``."""
    return df.orderBy(*order).limit(n)
