from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripgrain.operators.joins import hot_keys, lookup_join, mark_pieces
from tripgrain.operators.keys import trip_stop_key
from tripgrain.operators.observations import with_previous
from tripgrain.operators.realtime import merge_plan_change


def test_previous_of_a_null_group_crosses_buckets(rows):
    df = rows([(None, 1, 10), (None, 2, 20), ("a", 1, 30), ("a", 2, 40)], "name string, day int, v int")
    out = with_previous(df, ["name"], ["v"], F.col("day"), ["v"], "before").collect()
    assert {(r.name, r.day): r.before and r.before.v for r in out} == {
        (None, 1): None, (None, 2): 10, ("a", 1): None, ("a", 2): 30}


def test_hot_null_keys_are_cut(rows, spark):
    big = rows([(None, i) for i in range(40)] + [("k", i) for i in range(40)] + [("x", 1)], "k string, i int")
    marked = mark_pieces(big, hot_keys(big, ["k"], 10), ["k"], ["i"])
    pieces = {r.k: r.n for r in marked.groupBy("k").agg(F.count_distinct("_piece").alias("n")).collect()}
    assert pieces[None] > 1 and pieces["k"] > 1 and pieces["x"] == 1
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = lookup_join(big, rows([("k", 5)], "k string, w int"), ["k"], ["i"], how="left", hot_rows=10)
        assert out.count() == 81 and out.where("w = 5").count() == 40
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_change_rows_of_one_capture_are_merged(rows):
    at = dt.datetime(2026, 1, 1, 11)
    plan = rows([("e", at)], "DbEventId string, CapturedAt timestamp_ntz")
    change = rows([("e", at, 7, None), ("e", at, None, "c")],
                  "DbEventId string, CapturedAt timestamp_ntz, ChangedArrival int, DepartureStatus string")
    row = merge_plan_change(plan, change).first()
    assert (row.ChangedArrival, row.DepartureStatus) == (7, "c")


def test_trip_stop_keys_are_distinct_or_raise(rows):
    fine = rows([(1, 5), (1, -3), (2, -3), (2, 900_000), (3, -60_000)], "TripInstanceKey long, StopSequence int")
    assert fine.select(trip_stop_key().alias("k")).distinct().count() == 5
    wide = rows([(1, 1_048_581), (2, 5)], "TripInstanceKey long, StopSequence int")
    with pytest.raises(Exception, match="stop sequence"):
        wide.select(trip_stop_key().alias("k")).collect()
