"""Feed-shaped views of the TPC-H-like test tables.

The texts read the same in Spark SQL and DuckDB. ``{name}`` is replaced by the source table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tripgrain.plans.scheduled import Feed
from tripgrain.schemas import FEED

SOURCES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

VIEWS: dict[str, str] = {
    "agency": """
SELECT CAST(n_nationkey AS BIGINT) AS AgencyId, n_name AS AgencyName FROM {nation}""",
    "routes": """
SELECT p_partkey AS RouteId, p_partkey % 30 AS AgencyId,
 CASE p_partkey % 5 WHEN 0 THEN 106 WHEN 1 THEN 106 WHEN 2 THEN 109 WHEN 3 THEN 109 ELSE 3 END AS RouteType,
 CASE p_partkey % 7 WHEN 0 THEN 'RE' || CAST(p_partkey AS STRING) WHEN 1 THEN 'RB' || CAST(p_partkey AS STRING)
  WHEN 2 THEN 'S' || CAST(p_partkey AS STRING) WHEN 3 THEN CAST(p_partkey AS STRING)
  WHEN 4 THEN NULL WHEN 5 THEN 're' || CAST(p_partkey AS STRING) ELSE 'IC1' END AS RouteShortName,
 p_name AS RouteLongName FROM {part}""",
    "calendar": """
SELECT c_custkey AS ServiceId,
 CASE WHEN (c_custkey & 1) > 0 THEN 1 ELSE 0 END AS Monday, CASE WHEN (c_custkey & 2) > 0 THEN 1 ELSE 0 END AS Tuesday,
 CASE WHEN (c_custkey & 4) > 0 THEN 1 ELSE 0 END AS Wednesday, CASE WHEN (c_custkey & 8) > 0 THEN 1 ELSE 0 END AS Thursday,
 CASE WHEN (c_custkey & 16) > 0 THEN 1 ELSE 0 END AS Friday, CASE WHEN (c_custkey & 32) > 0 THEN 1 ELSE 0 END AS Saturday,
 CASE WHEN (c_custkey & 64) > 0 THEN 1 ELSE 0 END AS Sunday,
 replace(CAST(DATE '2026-07-01' + CAST(c_custkey % 40 AS INT) AS STRING),'-','') AS StartDate,
 replace(CAST(DATE '2026-07-01' + CAST(c_custkey % 40 + c_custkey % 28 AS INT) AS STRING),'-','') AS EndDate
 FROM {customer}""",
    "calendar_dates": """
SELECT DISTINCT o_custkey AS ServiceId,
 replace(CAST(DATE '2026-07-01' + CAST(o_orderkey % 90 AS INT) AS STRING),'-','') AS ServiceDate,
 CAST(1 + o_orderkey % 2 AS INT) AS ExceptionType FROM {orders}
 UNION SELECT o_custkey, replace(CAST(DATE '2026-07-01' + CAST(o_orderkey % 90 AS INT) AS STRING),'-',''),
 CAST(2 - o_orderkey % 2 AS INT) FROM {orders} WHERE o_orderstatus = 'P'""",
    "trips": """
SELECT o_orderkey AS TripId, o_orderkey % 200 AS RouteId, o_custkey AS ServiceId,
 CAST(o_orderkey % 2 AS INT) AS DirectionId, o_orderpriority AS TripHeadsign FROM {orders}""",
    "stop_times": """
SELECT l_orderkey AS TripId, l_linenumber AS StopSequence, min(l_suppkey) AS StopId,
 lpad(CAST(min(l_partkey) % 28 AS STRING),2,'0') || ':' || lpad(CAST(l_linenumber * 7 AS STRING),2,'0') || ':00' AS ArrivalTime,
 lpad(CAST(min(l_partkey) % 28 AS STRING),2,'0') || ':' || lpad(CAST(l_linenumber * 7 + 2 AS STRING),2,'0') || ':00' AS DepartureTime
 FROM {lineitem} GROUP BY l_orderkey, l_linenumber""",
    "stops": """
SELECT s_suppkey AS StopId, s_name AS StopName,
 CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE s_suppkey - s_suppkey % 4 END AS ParentStation,
 CAST(s_suppkey % 4 AS STRING) AS PlatformCode,
 CAST(s_suppkey * 37 % 191 - 95 AS DECIMAL(9,6)) AS StopLat, CAST(s_suppkey * 53 % 371 - 185 AS DECIMAL(9,6)) AS StopLon,
 CAST(s_suppkey % 2 AS INT) AS LocationType, CAST(s_suppkey % 3 AS INT) AS WheelchairBoarding FROM {supplier}""",
    "feed_info": """
SELECT r_name AS FeedPublisherName, 'https://example.org/' || lower(r_name) AS FeedPublisherUrl, 'de' AS FeedLang,
 '20260701' AS FeedStartDate, '20261231' AS FeedEndDate, CAST(r_regionkey AS STRING) AS FeedVersion FROM {region}""",
    "observations": """
SELECT event_id AS ObservationKey, CAST(user_id AS STRING) AS DbEventId, ts AS CapturedAt,
 CASE WHEN event_type = 'error' THEN NULL ELSE CAST(event_id % 31 AS INT) END AS ArrivalDelayMinutes,
 event_type = 'error' AS IsArrivalCancelled,
 CAST(event_id % 5 AS STRING) AS PlannedPlatform,
 CASE WHEN event_id % 4 = 0 THEN CAST(event_id % 7 AS STRING) END AS ChangedPlatform FROM {events}""",
}


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str, dealt: str | None = None) -> DataFrame:
    """One feed-shaped view over the tables in ``sf_dir``; ``dealt`` names a column its rows are dealt by first."""
    text = VIEWS[name]
    used = sorted(set(re.findall(r"\{(\w+)\}", text)))
    tables = {table: load(spark, sf_dir, table) for table in used}
    return spark.sql(text, **{t: df.repartition(dealt) if dealt in df.columns else df for t, df in tables.items()})


#: Stop times are grouped by line and then joined by trip: dealt by trip once, they are not moved again for the join.
_DEALT = {"stop_times": "l_orderkey"}


class AdapterFeed(Feed):
    """The feed over test tables; a view is built when it is first used."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.__dict__.update(_spark=spark, _sf_dir=sf_dir)

    def __getattribute__(self, name: str):
        if name not in FEED:
            return super().__getattribute__(name)
        built = self.__dict__
        if name not in built:
            built[name] = view(self._spark, self._sf_dir, name, _DEALT.get(name))
        return built[name]


def feed(spark: SparkSession, sf_dir: str) -> Feed:
    return AdapterFeed(spark, sf_dir)


def duckdb_text(name: str) -> str:
    """The view as DuckDB reads it, where the sources are registered under their own names."""
    return re.sub(r"\{(\w+)\}", r"\1", VIEWS[name])
