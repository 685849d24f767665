"""Queries against their DuckDB equivalents; TRIPGRAIN_ALL=1 runs every one, TRIPGRAIN_SF picks the tables."""

from __future__ import annotations

import os

import pytest
from compare import connect, difference

import __spark_entry__ as entry
from tripgrain.plans.catalog import QUERIES

SF = os.environ.get("TRIPGRAIN_SF", "/root/testdata/sf0.001")
QUICK = (
    "read_stops", "service_dates", "trip_instances", "trip_stops_normalized", "fact_trip_stop", "trip_stop_analytics",
    "volume_by_mode", "top_routes", "top_stations", "estimate_scope", "dense_key_distributed", "coverage",
    "dq_stop_sequences", "dq_feed_duplicates", "latest_per_event", "delay_evolution", "change_frequency", "snapshots",
    "match_events", "conflicts", "upsert_fact", "delay_windows_stream", "kpi_route_delay", "kpi_trend", "headways",
    "feed_versions",
)
NAMES = sorted(entry.oracle_sql()) if os.environ.get("TRIPGRAIN_ALL") else QUICK


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_an_equivalent():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    assert difference(entry.queries()[name](spark, SF), duck, entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 3
