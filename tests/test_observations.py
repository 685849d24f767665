from __future__ import annotations

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tripgrain.operators import observations as obs

SCHEMA = ("ObservationKey long, DbEventId string, CapturedAt timestamp_ntz, ArrivalDelayMinutes int, "
          "IsArrivalCancelled boolean, PlannedPlatform string, ChangedPlatform string")
START = datetime(2026, 8, 22, 13)


def history(rows):
    data = [
        (1, "e", START, 2, False, "4", None),
        (2, "e", START + timedelta(minutes=5), 5, False, "4", "5"),
        (3, "e", START + timedelta(hours=3), None, True, "4", "5"),
        (4, "e", START + timedelta(hours=3, minutes=5), None, True, "4", "5"),
        (5, "f", START, 0, False, None, "5"),
    ]
    return rows(data, SCHEMA)


def test_latest_and_state(rows):
    latest = {r.DbEventId: r.ObservationKey for r in obs.latest_per_event(history(rows)).collect()}
    assert latest == {"e": 4, "f": 5}
    state = {r.DbEventId: r for r in obs.event_state(history(rows)).collect()}
    assert (state["e"].FirstCapturedAt, state["e"].LatestCapturedAt, state["e"].ObservationCount) == (
        START, START + timedelta(hours=3, minutes=5), 4)
    assert state["e"].IsArrivalCancelled and "CapturedAt" not in state["e"].asDict()


def test_evolution_crosses_buckets(rows):
    out = {r.ObservationKey: (r.PreviousDelayMinutes, r.DelayChange) for r in obs.delay_evolution(history(rows)).collect()}
    assert out == {1: (None, None), 2: (2, 3), 3: (5, None), 4: (None, None), 5: (None, None)}


def test_previous_equals_plain_window(rows):
    rng = random.Random(5)
    data = [(i, "hot" if i % 3 else f"e{i % 7}", START + timedelta(minutes=rng.randrange(3000)), rng.choice([None, 1, 2, 3]),
             False, None, None) for i in range(400)]
    out = {r.ObservationKey: r.PreviousDelayMinutes for r in obs.delay_evolution(rows(data, SCHEMA)).collect()}
    expected = {}
    for event in {d[1] for d in data}:
        mine = sorted((d for d in data if d[1] == event), key=lambda d: (d[2], d[0]))
        for before, now in zip([None, *mine], mine):
            expected[now[0]] = before[3] if before else None
    assert out == expected


def test_changes(rows):
    first = {r.DbEventId: r for r in obs.first_change(history(rows)).collect()}
    assert first["e"].FirstCancelledAt == START + timedelta(hours=3)
    assert first["e"].FirstPlatformChangeAt == START + timedelta(minutes=5)
    assert first["f"].FirstCancelledAt is None and first["f"].FirstPlatformChangeAt is None
    counts = {r.DbEventId: (r.ObservationCount, r.ChangeCount) for r in obs.change_frequency(history(rows)).collect()}
    assert counts == {"e": (4, 2), "f": (1, 0)}


def test_summary(rows):
    row = obs.observation_summary(history(rows), ("TotalRows", "ArrivalCancelled", "WithChangedPlatform", "PlatformChanged")).first()
    assert (row.TotalRows, row.ArrivalCancelled, row.WithChangedPlatform, row.PlatformChanged) == (5, 2, 4, 3)


def test_retention_bound_is_kept(rows):
    kept = obs.retain(history(rows), 1, START + timedelta(days=1))
    assert kept.count() == 5
    kept = obs.retain(history(rows).withColumn("CaptureDate", F.to_date("CapturedAt")), 1, START + timedelta(days=1, hours=1))
    assert {r.ObservationKey for r in kept.collect()} == {3, 4}


def test_observation_keys_are_stable(rows):
    snaps = history(rows).drop("ObservationKey")
    one = {(r.DbEventId, r.CapturedAt): r.ObservationKey for r in obs.number_observations(snaps, 3).collect()}
    two = {(r.DbEventId, r.CapturedAt): r.ObservationKey for r in obs.number_observations(snaps.repartition(3), 3).collect()}
    assert one == two and len(set(one.values())) == 5 and min(one.values()) > 3 * obs.BATCH_SPAN


def test_null_delays_do_not_count_as_zero(rows):
    out = obs.delay_windows(history(rows), "1 hour", ["DbEventId"]).filter("DbEventId = 'e'").orderBy("WindowStart").collect()
    assert [(r.ObservationCount, r.DelayCount, r.DelaySum) for r in out] == [(2, 2, 7), (2, 0, None)]


def test_merged_states_equal_state_of_whole_history(rows):
    whole = history(rows)
    early = obs.event_state(whole.filter("ObservationKey <= 2")).withColumn("StateDay", F.to_date("FirstCapturedAt"))
    for first, second in ((early, obs.event_state(whole.filter("ObservationKey > 2"))),
                          (obs.event_state(whole.filter("ObservationKey > 2")).withColumn("StateDay", F.to_date("FirstCapturedAt")),
                           obs.event_state(whole.filter("ObservationKey <= 2")))):
        merged = obs.merge_states(first, second).drop("StateDay")
        expected = obs.event_state(whole).select(merged.columns)
        assert sorted(map(str, merged.collect())) == sorted(map(str, expected.collect()))
