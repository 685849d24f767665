from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tripgrain.functions import times
from tripgrain.operators.trips import after_midnight, normalize_times

DAY = date(2026, 7, 1)
DAY_TIME = datetime(2026, 3, 8, 2, 30)


def normalize(rows, texts):
    df = rows([(i, DAY, t, t) for i, t in enumerate(texts)],
              "n int, ServiceDate date, ScheduledArrival string, ScheduledDeparture string")
    return normalize_times(df).orderBy("n").collect()


def test_service_times(rows):
    texts = ["00:00:00", "23:59:59", "24:00:00", "25:10:00", None, "8:05:00", "aa:00:00", "10:75:00", "49:00:00"]
    out = normalize(rows, texts)
    assert [r.ArrivalDayOffset for r in out] == [0, 0, 1, 1, None, 0, None, None, 2]
    assert out[2].ScheduledArrivalDateTime == datetime(2026, 7, 2)
    assert out[3].ScheduledDepartureDateTime == datetime(2026, 7, 2, 1, 10)
    assert out[5].ScheduledArrivalDateTime == datetime(2026, 7, 1, 8, 5)
    assert [r.ScheduledArrival for r in out] == texts
    assert {r.ServiceDate for r in out} == {DAY}


def test_after_midnight_counts_either_side(rows):
    df = rows([(DAY, "23:59:00", "24:01:00"), (DAY, "24:00:00", None), (DAY, "10:00:00", "10:01:00")],
              "ServiceDate date, ScheduledArrival string, ScheduledDeparture string")
    assert after_midnight(normalize_times(df)).count() == 2


def test_compact_time(rows):
    df = rows([(1, "2608221303"), (2, ""), (3, None), (4, " 2608221303 "), (5, "2613221303"), (6, "26082213")], "n int, t string")
    out = [r.v for r in df.select("n", times.compact_timestamp(F.col("t")).alias("v")).orderBy("n").collect()]
    assert out == [datetime(2026, 8, 22, 13, 3), None, None, datetime(2026, 8, 22, 13, 3), None, None]


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin"])
def test_delay_is_wall_clock_in_any_session_zone(spark, rows, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = rows([("2608221115", "2608221123"), ("2608221115", None), ("2603290150", "2603290310"), ("2608221115", "2608221110")],
                  "p string, c string")
        planned, changed = (times.compact_timestamp(F.col(c)) for c in "pc")
        out = [r[0] for r in df.select(times.delay_minutes(planned, changed)).collect()]
        assert out == [8, None, 80, -5]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_platform_changed(rows):
    df = rows([("4", "5"), ("4", "4"), ("4", None), (None, "5")], "p string, c string")
    assert [r[0] for r in df.select(times.platform_changed(F.col("p"), F.col("c"))).collect()] == [1, 0, 0, 0]


def test_wall_clock_round_trip(spark, rows):
    moment = datetime(2026, 3, 29, 2, 30, 15)
    df = rows([(moment,)], "t timestamp_ntz")
    assert df.select(times.as_wall_clock(times.as_utc_instant(F.col("t")))).first()[0] == moment


def test_literals_do_not_move_with_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert spark.range(1).select(times.wall_literal(DAY_TIME)).first()[0] == DAY_TIME
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
