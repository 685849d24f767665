"""The stop dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgrain.operators.joins import lookup_join
from tripgrain.operators.keys import add_key


def used_stops(trip_stops: DataFrame) -> DataFrame:
    """Distinct stop ids; combined before the shuffle, so a busy stop costs nothing extra."""
    return trip_stops.select("StopId").distinct()


def build_dim_stop(trip_stops: DataFrame, stops: DataFrame, with_key: bool = True) -> DataFrame:
    """Stops that ``trip_stops`` uses, each with the name of its parent station when that is known."""
    members = stops.join(used_stops(trip_stops), "StopId", "left_semi")
    if with_key:
        members = add_key(members, ["StopId"], "StopKey")
    parents = stops.select(
        F.col("StopId").alias("ParentStation"), F.col("StopName").alias("ParentStationName")
    )
    return lookup_join(members, parents, ["ParentStation"], ["StopId"], "left", heat=stops).select(
        *(["StopKey"] if with_key else []),
        "StopId",
        "StopName",
        F.col("ParentStation").alias("ParentStationId"),
        "ParentStationName",
        "PlatformCode",
        F.col("StopLat").alias("Latitude"),
        F.col("StopLon").alias("Longitude"),
        "LocationType",
        "WheelchairBoarding",
    )
