"""The whole scheduled side on the small test tables, and the shape of its physical plans."""

from __future__ import annotations

import pytest

from tripgrain.operators import aggregates, keys, trips
from tripgrain.plans import adapter
from tripgrain.plans.scheduled import Feed, ScheduledPlan, build_warehouse
from tripgrain.schemas import WEEKDAYS

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plan(spark):
    return ScheduledPlan(adapter.feed(spark, SF))


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def same(left, right):
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    assert left.select(columns).exceptAll(right.select(columns)).isEmpty()
    assert right.select(columns).exceptAll(left.select(columns)).isEmpty()


def test_warehouse_equals_lazy_plan(spark, plan, tmp_path):
    stored = build_warehouse(spark, adapter.feed(spark, SF), str(tmp_path / "dw"))
    for name, lazy in (("service_dates", plan.service_dates), ("trip_instances", plan.trip_instances),
                       ("trip_stops", plan.trip_stops), ("dim_date", plan.dim_date), ("dim_route", plan.dim_route),
                       ("dim_stop", plan.dim_stop), ("fact_trip_stop", plan.fact)):
        same(stored[name], lazy)
    assert stored["fact_trip_stop"].count() == stored["trip_stops"].count()


def test_row_grain_and_packed_trip_stops_agree(plan):
    by_rows = trips.build_trip_stops(plan.trip_instances, plan.classification, plan.feed.stop_times)
    same(by_rows, plan.trip_stops)


def test_volume_without_fan_out_equals_volume_with(plan):
    same(aggregates.volume_by_mode(plan.view), aggregates.volume_by_mode(plan.packed_view, "ServiceDays"))
    same(aggregates.volume_by_station(plan.view), aggregates.volume_by_station(plan.packed_view, "ServiceDays"))


def test_fact_grain(plan):
    assert keys.duplicates(plan.fact, ["TripInstanceKey", "StopSequence"]).isEmpty()
    assert keys.duplicates(plan.fact, ["FactTripStopKey"]).isEmpty()


def test_scope_join_is_broadcast_and_columns_are_pruned(plan):
    text = executed(aggregates.volume_by_mode(plan.packed_view, "ServiceDays"))
    assert "BroadcastHashJoin [RouteId" in text
    assert "explode(ServiceDates" not in text
    assert "p_name" not in text and "o_orderpriority" not in text


def test_estimate_never_builds_the_fan_out(plan):
    text = executed(trips.estimate_trip_stops(plan.feed.trips, plan.service_dates, plan.feed.stop_times))
    assert "explode(ServiceDates" not in text and "Generate posexplode" not in text


def test_large_keys_need_no_single_partition_window(spark, plan):
    keyed = keys.add_dense_key(spark.range(1000), ["id"], "n", one_task_bytes=0)
    text = executed(keyed)
    # the only single-partition step numbers the stored partitions, not the rows
    assert "windowspecdefinition(_part" in text and "row_number" not in text


def test_fan_out_is_not_shuffled(plan):
    text = executed(plan.view)
    fan_out = text.index("explode(ServiceDates")
    assert "Exchange hashpartitioning" not in text[:fan_out]


def test_service_dates_are_resolved_once_for_all_steps(rows):
    """The calendar is read by the stored calendars alone; trips without dates and services without a key drop out."""
    empty = {"agency": None, "stops": None, "routes": None, "feed_info": None}
    feed = Feed(
        trips=rows([(1, 5, "a"), (2, 5, "b"), (3, 5, None)], "TripId long, RouteId long, ServiceId string").selectExpr(
            "*", "0 AS DirectionId", "'x' AS TripHeadsign"),
        stop_times=None,
        calendar=rows([], "ServiceId string, StartDate string, EndDate string, " + ", ".join(f"{d} int" for d in WEEKDAYS)),
        calendar_dates=rows(
            [("a", "20260701", 1), ("a", "20260703", 1), ("a", "20260703", 2), ("a", "20260702", 1), (None, "20260701", 1)],
            "ServiceId string, ServiceDate string, ExceptionType int"),
        **empty)
    lazy = ScheduledPlan(feed)
    assert "ExceptionType" not in lazy.trip_instances._jdf.queryExecution().optimizedPlan().toString()
    assert [(r.TripInstanceKey, r.TripId, str(r.ServiceDate)) for r in lazy.trip_instances.orderBy("TripInstanceKey").collect()] == [
        (1, 1, "2026-07-01"), (2, 1, "2026-07-02")]
    assert lazy.date_rows == 3


def test_coverage_does_not_hold_pairs(rows):
    df = rows([("a", 1), ("a", 1), ("a", 2), ("b", 2), (None, 3), ("c", None)], "Key string, Day int")
    out = aggregates.coverage(df, "Key", "Day")
    assert tuple(out.first()) == (6, 3, 1, 3, 3)
    assert tuple(aggregates.coverage(df.limit(0), "Key", "Day").first()) == (0, 0, None, None, 0)
    assert "Expand" not in executed(out) and "keys=[Key" not in executed(out)


def test_calls_move_by_trip_once_and_without_stop_values(spark, tmp_path):
    """Lines are grouped where the join by trip needs them; stop values are looked up for kept calls only."""
    tables = {
        "customer": ([(i,) for i in range(4)], "c_custkey long"),
        "nation": ([(i, f"N{i}") for i in range(30)], "n_nationkey int, n_name string"),
        "part": ([(i, f"p{i}") for i in range(40)], "p_partkey long, p_name string"),
        "supplier": ([(i, f"s{i}") for i in range(9)], "s_suppkey long, s_name string"),
        "orders": ([(i, i % 4, "O", "1-URGENT") for i in range(40)] + [(None, 1, "P", "x")],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string"),
        "lineitem": ([(i, n, i * n, (i + n) % 10) for i in range(40) for n in (1, 2, 2)] + [(None, 1, 1, 1), (3, None, None, None)],
                     "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    feed = adapter.feed(spark, str(tmp_path))
    assert sorted(feed.stop_times.collect(), key=str) == sorted(adapter.view(spark, str(tmp_path), "stop_times").collect(), key=str)
    view = ScheduledPlan(feed).keyed_view
    assert view.columns[0] == "TripId" and view.where("StopName IS NOT NULL").count()
    plan = view._jdf.queryExecution().optimizedPlan().toString()
    stop_join, trip_join, grouped = (plan.index(x) for x in ("Join Inner, (StopId#", "Join Inner, (TripId#", "Aggregate [l_orderkey#"))
    assert stop_join < trip_join < grouped  # the outer node is printed first
    assert "RepartitionByExpression [l_orderkey#" in plan[grouped:]
