from __future__ import annotations

import pytest

from tripgrain.sources import feed, tables


def put(folder, name, text):
    (folder / f"{name}.txt").write_text(text, encoding="utf-8")
    return str(folder)


def test_dialect(spark, tmp_path):
    folder = put(
        tmp_path, "routes",
        'route_id,agency_id,short,long,type,color,text,x\n'
        'r1,a,"RE1","Süd, Hbf ""Ost""",106,,,\n'
        '"r2",,"",Essen,109,FF0000,,\n',
    )
    out = feed.read_feed(spark, folder, "routes").orderBy("RouteId").collect()
    assert out[0].RouteLongName == 'Süd, Hbf "Ost"' and out[0].RouteType == 106
    assert out[0].RouteColor is None and out[1].AgencyId is None and out[1].RouteShortName is None
    assert out[1].RouteColor == "FF0000"


def test_columns_by_position_not_by_name(spark, tmp_path):
    folder = put(tmp_path, "calendar_dates", "exception_type,foo,bar\ns1,20260701,2\n")
    row = feed.read_feed(spark, folder, "calendar_dates").first()
    assert (row.ServiceId, row.ServiceDate, row.ExceptionType) == ("s1", "20260701", 2)


def test_malformed_lines(spark, tmp_path):
    folder = put(tmp_path, "calendar_dates", "a,b,c\ns1,20260701,1\ns2,20260702\ns3,20260703,x\n")
    out = {r.ServiceId: r.ExceptionType for r in feed.read_feed(spark, folder, "calendar_dates").collect()}
    assert out == {"s1": 1, "s2": None, "s3": None}
    assert {r.ServiceId for r in feed.rejected_lines(spark, folder, "calendar_dates").collect()} == {"s2", "s3"}
    with pytest.raises(Exception):
        feed.read_feed(spark, folder, "calendar_dates", strict=True).collect()


def test_line_breaks_inside_quotes(spark, tmp_path):
    folder = put(tmp_path, "calendar_dates", 'a,b,c\n"s\n1",20260701,1\n')
    assert feed.read_feed(spark, folder, "calendar_dates", multi_line=True).first().ServiceId == "s\n1"


def test_full_refresh_and_load_stamp(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    tables.write_table(rows([(1,), (2,)], "a int"), path)
    stored = tables.write_table(feed.with_load_stamp(rows([(3, "x")], "a int, b string")), path)
    assert stored.columns == ["a", "b", "LoadDateTime"] and stored.count() == 1
    assert stored.first().LoadDateTime is not None and stored.schema["LoadDateTime"].dataType.simpleString() == "timestamp_ntz"


def test_fact_layout_prunes_partitions(spark, tmp_path, rows):
    df = rows([(20260701 + i % 3, i % 5, i % 7, i, 1) for i in range(200)],
              "DateKey int, RouteKey int, StopKey int, TripInstanceKey int, StopSequence int")
    fact = tables.write_fact(df, str(tmp_path / "fact"))
    assert fact.count() == 200
    plan = fact.filter("DateKey = 20260702 AND RouteKey = 3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(DateKey" in plan and "EqualTo(RouteKey,3)" in plan
