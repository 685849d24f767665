from __future__ import annotations

from datetime import date

import pytest

from tripgrain.operators import calendar

WEEK = "ServiceId string, Monday int, Tuesday int, Wednesday int, Thursday int, Friday int, Saturday int, Sunday int, StartDate string, EndDate string"
EXC = "ServiceId string, ServiceDate string, ExceptionType int"
MON_WED = ("a", 1, 0, 1, 0, 0, 0, 0, "20260701", "20260708")
BASE = {date(2026, 7, 1), date(2026, 7, 6), date(2026, 7, 8)}


def resolve(rows, weeks, exceptions):
    out = calendar.resolve_service_dates(rows(weeks, WEEK), rows(exceptions, EXC)).collect()
    assert len({tuple(r) for r in out}) == len(out)
    return {r.ServiceDate for r in out}


@pytest.mark.parametrize(
    "weeks, exceptions, expected",
    [
        ([MON_WED], [], BASE),
        ([MON_WED], [("a", "20260704", 1)], BASE | {date(2026, 7, 4)}),
        ([MON_WED], [("a", "20260706", 2)], BASE - {date(2026, 7, 6)}),
        ([MON_WED], [("a", "20260704", 1), ("a", "20260704", 2)], BASE),
        ([MON_WED], [("a", "20260701", 1)], BASE),
        ([("a", *[0] * 7, "20260701", "20260708")], [("a", "20260702", 1), ("a", "20260703", 1)],
         {date(2026, 7, 2), date(2026, 7, 3)}),
        ([("a", *[1] * 7, "20260708", "20260701")], [], set()),
        ([("a", *[1] * 7, "2026-07-1", "20260701")], [("a", "nonsense", 1)], set()),
        ([], [("only", "20260709", 1)], {date(2026, 7, 9)}),
    ],
)
def test_resolution(rows, weeks, exceptions, expected):
    assert resolve(rows, weeks, exceptions) == expected


def test_dim_date_iso_weeks_and_weekend(rows):
    bounds = rows([(date(2026, 12, 31), date(2027, 1, 4))], "FirstDate date, LastDate date")
    out = {r.FullDate: r for r in calendar.build_dim_date(bounds).collect()}
    assert [out[d].WeekNumber for d in (date(2026, 12, 31), date(2027, 1, 1), date(2027, 1, 4))] == [53, 53, 1]
    assert out[date(2027, 1, 3)].IsWeekend and out[date(2027, 1, 3)].DayOfWeek == 1
    first = out[date(2026, 12, 31)]
    assert (first.DateKey, first.DayName, first.MonthName, first.QuarterNumber) == (20261231, "Thursday", "December", 4)


def test_long_range_is_not_cut(rows):
    bounds = rows([(date(2000, 1, 1), date(2030, 12, 31))], "FirstDate date, LastDate date")
    assert calendar.build_dim_date(bounds).count() == 11323
