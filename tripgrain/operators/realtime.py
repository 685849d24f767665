"""Plan and change documents to snapshots, matching to the schedule, and the realtime fact."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripgrain.functions.times import compact_timestamp, delay_minutes, is_cancelled
from tripgrain.operators.joins import HOT_ROWS, broadcast_limit, estimated_bytes, hot_keys, lookup_join
from tripgrain.schemas import TIMETABLE
from tripgrain.session import freeze

# Columns of an observation row.
SNAPSHOT_COLUMNS = (
    "DbEventId", "StationEva", "LineName", "TrainName", "PlannedArrival", "ChangedArrival",
    "ArrivalDelayMinutes", "IsArrivalCancelled", "PlannedDeparture", "ChangedDeparture",
    "DepartureDelayMinutes", "IsDepartureCancelled", "PlannedPlatform", "ChangedPlatform", "CapturedAt",
)


class RebindError(ValueError):
    """A load would give an event another trip-stop, or a trip-stop another event."""


# ---------------------------------------------------------------- documents


REASONS = ("no document", "not readable", "no event id", "no capture time")


def parse_documents(documents: DataFrame) -> DataFrame:
    """One row per ``s`` element, with ``Rejected`` where something cannot be used.

    A document without text or capture time, or that is no timetable, gives one row with the reason and no event, and an element
    without an id a row with that reason, so nothing disappears. A timetable without elements gives one row
    with neither.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    parsed = documents.withColumn("_doc", F.from_xml("Document", f"{TIMETABLE}, _corrupt string", options))
    broken = F.col("_doc").isNull() | F.col("_doc._corrupt").isNotNull() | ~F.col("Document").rlike(_TIMETABLE_START)
    unreadable = F.when(F.coalesce(F.trim("Document"), F.lit("")) == "", REASONS[0]).when(broken, REASONS[1]).when(
        F.col("CapturedAt").isNull(), REASONS[3])
    kept = [c for c in documents.columns if c not in ("StationEva", "Document")]
    # Judged once per document. The generator moves no text and no document with its elements, only with rejected ones.
    judged = parsed.select(
        *kept, "Document", F.col("StationEva").alias("_station"), unreadable.alias("_unreadable"),
        F.when(unreadable.isNotNull(), F.col("Document")).alias("_text"), F.col("_doc.s").alias("_elements"),
    )
    element = ("_id", "_eva", "tl", "ar", "dp")

    def with_reason(s: Column) -> Column:
        has_event = s["tl"].isNotNull() | s["ar"].isNotNull() | s["dp"].isNotNull() | s["_eva"].isNotNull()
        nameless = s["_id"].isNull() & has_event
        return F.struct(
            *(s[c].alias(c) for c in element),
            F.when(nameless, REASONS[2]).alias("_nameless"), F.when(nameless, F.col("Document")).alias("_around"))

    rows = judged.select(
        *kept, "_station", "_unreadable", "_text",
        F.inline_outer(F.when(F.col("_unreadable").isNull(), F.transform("_elements", with_reason))),
    )
    return rows.select(
        *kept, F.coalesce("_text", "_around").alias("Document"), "_station", *element,
        F.coalesce("_unreadable", "_nameless").alias("Rejected"),
    )


# Declarations and comments, then the root element.
_TIMETABLE_START = r"^\s*(<\?[^>]*\?>\s*|<!--(?s:.*?)-->\s*)*<timetable[\s/>]"


def rejected_documents(documents: DataFrame) -> DataFrame:
    """What :func:`parse_documents` cannot use: station, kind, hour, capture, the reason and the document's text."""
    return rejected_rows(parse_documents(documents))


def rejected_rows(parsed: DataFrame) -> DataFrame:
    return parsed.filter("Rejected IS NOT NULL").select(
        F.col("_station").alias("StationEva"), "Kind", "PlanHour", "CapturedAt", F.col("Rejected").alias("Reason"), "Document")


def _events(documents: DataFrame) -> DataFrame:
    """The usable ``s`` elements; absent attributes and children are NULL."""
    return parse_documents(documents).filter("Rejected IS NULL AND _id IS NOT NULL")


def plan_columns() -> dict[str, Column]:
    """Columns of a planned event, from a parsed element."""
    return {
        "StationEva": F.coalesce("_eva", "_station"),
        "TrainCategory": F.col("tl._c"),
        "TrainNumber": F.col("tl._n"),
        "LineName": F.coalesce("ar._l", "dp._l"),
        "TrainName": F.coalesce("ar._fb", "dp._fb"),
        "PlannedArrival": compact_timestamp(F.col("ar._pt")),
        "PlannedDeparture": compact_timestamp(F.col("dp._pt")),
        "PlannedPlatform": F.coalesce("ar._pp", "dp._pp"),
        "ArrivalPath": F.col("ar._ppth"),
        "DeparturePath": F.col("dp._ppth"),
    }


def change_columns() -> dict[str, Column]:
    """Columns of a changed event, from a parsed element."""
    return {
        "ChangedArrival": compact_timestamp(F.col("ar._ct")),
        "ChangedDeparture": compact_timestamp(F.col("dp._ct")),
        "ChangedPlatform": F.coalesce("ar._cp", "dp._cp"),
        "ArrivalStatus": F.col("ar._cs"),
        "DepartureStatus": F.col("dp._cs"),
    }


def _named(columns: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]


def flatten_plan(documents: DataFrame) -> DataFrame:
    """Planned events of plan documents."""
    return _events(documents).select(F.col("_id").alias("DbEventId"), *_named(plan_columns()), "PlanHour", "CapturedAt")


def flatten_change(documents: DataFrame) -> DataFrame:
    """Changed times, platforms and status of change documents."""
    return _events(documents).select(F.col("_id").alias("DbEventId"), *_named(change_columns()), "CapturedAt")


def _one_per_capture(events: DataFrame, *first: str) -> DataFrame:
    keys = ("DbEventId", "CapturedAt")
    rest = [*first, *[c for c in events.columns if c not in keys and c not in first]]
    kept = events.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    return kept.select("DbEventId", "CapturedAt", "_row.*")


def _merged_changes(change: DataFrame) -> DataFrame:
    """One change row per event and capture: of each column the value of the first row that has one."""
    keys = ("DbEventId", "CapturedAt")
    rest = [c for c in change.columns if c not in keys]
    first = [F.min_by(c, F.when(F.col(c).isNotNull(), F.struct(*rest))).alias(c) for c in rest]
    return change.groupBy(*keys).agg(*first)


def dedup_events(plan: DataFrame) -> DataFrame:
    """One row per event and capture; of overlapping plan windows the earlier hour wins."""
    return _one_per_capture(plan, "PlanHour")


def merge_plan_change(plan: DataFrame, change: DataFrame) -> DataFrame:
    """Planned events with the changes of the same capture; events without a change row stay."""
    return plan.join(_merged_changes(change), ["DbEventId", "CapturedAt"], "left")


def build_snapshots(plan: DataFrame, change: DataFrame) -> DataFrame:
    """Complete observation rows from planned and changed events."""
    return observed(merge_plan_change(dedup_events(plan), change))


def observed(merged: DataFrame) -> DataFrame:
    """Observation rows from planned events beside their changes."""
    return merged.withColumns({
        "ArrivalDelayMinutes": delay_minutes(F.col("PlannedArrival"), F.col("ChangedArrival")),
        "DepartureDelayMinutes": delay_minutes(F.col("PlannedDeparture"), F.col("ChangedDeparture")),
        "IsArrivalCancelled": is_cancelled(F.col("ArrivalStatus")),
        "IsDepartureCancelled": is_cancelled(F.col("DepartureStatus")),
    }).select(*SNAPSHOT_COLUMNS)


def snapshots_from_documents(documents: DataFrame) -> DataFrame:
    plan = flatten_plan(documents.filter("Kind = 'plan'"))
    change = flatten_change(documents.filter("Kind = 'change'"))
    return build_snapshots(plan, change)


def complete_captures(parsed: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """Observation rows from parsed elements of both kinds: one aggregation, so that a stream can keep it as its state.

    Equal to :func:`snapshots_from_documents`: the plan row of the earliest hour, and of each changed column the
    value of the first change row that has one. Events without a plan row in their capture give none. ``also``
    names further columns of the key (a watermarked time).
    """
    plan, change = plan_columns(), change_columns()
    is_plan, is_change = F.col("Kind") == "plan", F.col("Kind") == "change"
    usable = F.expr("Rejected IS NULL AND _id IS NOT NULL AND Kind IN ('plan', 'change')")
    for key in also:  # a condition on the watermarked time is not moved below the watermark, which must see all rows
        usable = F.when(usable, F.col(key)).isNotNull()
    rows = parsed.filter(usable).select(
        F.col("_id").alias("DbEventId"), "CapturedAt", "Kind", *also,
        F.when(is_plan, F.struct("PlanHour", *_named(plan))).alias("_plan"),
        F.when(is_change, F.struct(*_named(change))).alias("_change"),
    )
    first = [F.min_by(f"_change.{c}", F.when(F.col(f"_change.{c}").isNotNull(), F.col("_change"))).alias(c) for c in change]
    done = rows.groupBy("DbEventId", "CapturedAt", *also).agg(F.min("_plan").alias("_plan"), *first)
    return observed(done.filter("_plan IS NOT NULL").select("DbEventId", "CapturedAt", "_plan.*", *change))


def explode_path(plan: DataFrame, separator: str, path: str = "DeparturePath") -> DataFrame:
    """One row per station on the planned path, in order, counting from 1."""
    stations = F.split(F.col(path), F.concat(F.lit("\\Q"), F.lit(separator), F.lit("\\E")))
    return plan.select(
        "DbEventId", "CapturedAt", F.posexplode(stations).alias("_at", "PathStation")
    ).select("DbEventId", "CapturedAt", (F.col("_at") + 1).alias("PathPosition"), "PathStation")


# ---------------------------------------------------------------- matching

# The times come first: they differ most, so sorts by the key seldom compare the texts.
_KEY = ["_t1", "_t2", "_station", "_line", "_kind"]
_BOTH, _ARRIVAL, _DEPARTURE, _STOP, _LOST = range(5)
_RULE = "station + line + planned times"


def _line(name: Column) -> Column:
    return F.upper(F.replace(name, F.lit(" "), F.lit("")))


class Match(NamedTuple):
    matched: DataFrame
    unmatched: DataFrame
    judged: DataFrame  # every event, with its trip-stop or the reason why it has none


def match_targets(fact: DataFrame, dim_route: DataFrame, dim_stop: DataFrame) -> DataFrame:
    """Trip-stops with what an event is compared to: station, line and scheduled times."""
    stations = dim_stop.select("StopKey", F.coalesce("ParentStationId", "StopId").alias("StationId"))
    rows = lookup_join(
        fact, dim_route.select("RouteKey", F.col("RouteShortName").alias("LineName")),
        ["RouteKey"], ["FactTripStopKey"],
    )
    return lookup_join(rows, stations, ["StopKey"], ["FactTripStopKey"]).select(
        "FactTripStopKey", "DateKey", "StationId", "LineName",
        "ScheduledArrivalDateTime", "ScheduledDepartureDateTime",
    )


def _keyed_events(state: DataFrame, station_map: DataFrame) -> DataFrame:
    """Event states with their comparison key: the times that are present decide its kind."""
    arrival, departure = F.col("PlannedArrival"), F.col("PlannedDeparture")
    stations = station_map.select("StationEva", F.col("ParentStationId").alias("_station"))
    kind = (
        F.when(arrival.isNotNull() & departure.isNotNull(), _BOTH)
        .when(arrival.isNotNull(), _ARRIVAL)
        .when(departure.isNotNull(), _DEPARTURE)
    )
    return lookup_join(state, stations, ["StationEva"], ["DbEventId"], "left").withColumns({
        "_kind": kind,
        "_line": _line(F.col("LineName")),
        "_t1": F.coalesce(arrival, departure),
        "_t2": F.coalesce(departure, arrival),
    })


def _target_keys(targets: DataFrame) -> DataFrame:
    """The keys under which a trip-stop can be found: by both times, by arrival, by departure."""
    arr, dep = F.col("_arr"), F.col("_dep")

    def kind(number: int, first: Column, second: Column) -> Column:
        present = first.isNotNull() & second.isNotNull()
        return F.when(present, F.struct(F.lit(number).alias("_kind"), first.alias("_t1"), second.alias("_t2")))

    kinds = F.array(kind(_BOTH, arr, dep), kind(_ARRIVAL, arr, arr), kind(_DEPARTURE, dep, dep))
    found = targets.withColumn("_k", F.explode(kinds)).filter(F.col("_k").isNotNull())
    return found.select(*targets.columns, "_k.*")


def _stops(targets: DataFrame) -> DataFrame:
    return targets.select(
        "FactTripStopKey", "DateKey", F.col("StationId").alias("_station"),
        _line(F.col("LineName")).alias("_line"),
        F.col("ScheduledArrivalDateTime").alias("_arr"), F.col("ScheduledDepartureDateTime").alias("_dep"),
    )


def match_neighbourhood(
    changed: list[DataFrame], others: DataFrame, targets: DataFrame, station_map: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """What must be matched again when events change: (rows of ``others``, rows of ``targets``).

    ``changed`` are the events' states before and after. A result can only change at trip-stops that have one of
    their comparison keys; of these all keys count, since rivals are counted over them. So the neighbours
    are the other events with such a key, and the trip-stops are all with such a key. Matching them together with
    the changed events gives for each what matching everything would give.
    """
    keys = [_keyed_events(state, station_map).select(*_KEY).dropna() for state in changed]
    touched = freeze(reduce(DataFrame.unionByName, keys).distinct())
    held = freeze(_target_keys(_stops(targets)).select("FactTripStopKey", *_KEY))
    spread = ["FactTripStopKey"]
    even = hot_keys(held, _KEY).isEmpty()

    def holders(some: DataFrame, size: int) -> DataFrame:
        """The trip-stops that have one of some keys."""
        return _at_keys(held, some, spread, "left_semi", even, size).select(*spread).distinct()

    near = holders(touched, estimated_bytes(touched))
    near_keys = freeze(held.join(near, spread, "left_semi").select(*_KEY).distinct())
    size = estimated_bytes(near_keys)
    events = lookup_join(_keyed_events(others, station_map), near_keys, _KEY, ["DbEventId"], "left_semi", size=size)
    return events.select(*others.columns), targets.join(holders(near_keys, size), spread, "left_semi")


def _at_keys(rows: DataFrame, keyed: DataFrame, spread_by: list[str], how: str, even: bool, size: int) -> DataFrame:
    """``rows`` joined by comparison key; where they are known to be ``even``, no key is looked for that has many."""
    if size > broadcast_limit(keyed) and even:
        return rows.join(keyed, _KEY, how)
    return lookup_join(rows, keyed, _KEY, spread_by, how, size=size)


def match_events(state: DataFrame, targets: DataFrame, station_map: DataFrame) -> Match:
    """One-to-one match of events to trip-stops.

    A pair is a candidate when station and line agree and every planned time on the event equals the
    scheduled time of the same kind. It is kept when it is the only candidate on both sides. Candidates are counted,
    never enumerated in pairs. Events and trip-stops are sent once, to the task of their station and line; where one
    of these has too many rows for a task, or a trip-stop has several rows, the counts are taken per comparison key.
    """
    events = _keyed_events(state, station_map)
    stops = _stops(targets)
    places = events.select("_station", "_line").distinct()
    if estimated_bytes(places) <= broadcast_limit(places):
        stops = stops.join(F.broadcast(places), ["_station", "_line"], "left_semi")
    at_places = _dealt_events(events, state.columns), stops.dropna(subset=["_station", "_line"])
    if _is_crowded(*at_places) or _is_repeated(stops):
        return _match_by_key(events, stops, state.columns)
    found = _match_at_places(*at_places, state.columns)
    named, paired = F.col("DbEventId").isNotNull(), F.col("_stop").isNotNull()
    reason = F.when(F.col("_seen"), "many").otherwise("none")
    matched = found.filter(named & paired).select(*state.columns, "_stop.FactTripStopKey", "_stop.DateKey", F.lit(_RULE).alias("MatchRule"))
    judged = found.select(
        *state.columns, *(F.when(named, F.col(f"_stop.{c}")).alias(c) for c in ("FactTripStopKey", "DateKey")),
        F.when(named & paired, F.lit(_RULE)).alias("MatchRule"), F.when(named & ~paired, reason).alias("Reason"))
    return Match(matched, found.filter(~paired).select("DbEventId", reason.alias("Reason")), judged)


def _dealt_events(events: DataFrame, columns: list[str]) -> DataFrame:
    """Events with station, line, kind and times; those that cannot match are spread over lines of no station."""
    usable = F.col("_station").isNotNull() & F.col("_line").isNotNull() & F.col("_kind").isNotNull()
    return events.select(
        *columns, F.when(usable, F.col("_kind")).otherwise(_LOST).alias("_kind"),
        F.when(usable, F.col("_station")).alias("_station"),
        F.when(usable, F.col("_line")).otherwise(F.xxhash64(*columns).cast("string")).alias("_line"),
        F.col("PlannedArrival").alias("_arr"), F.col("PlannedDeparture").alias("_dep"),
    )


def _is_crowded(events: DataFrame, stops: DataFrame) -> bool:
    """Whether a station and line has more than HOT_ROWS rows; looked for at stations that have so many only."""
    place = ["_station", "_line"]
    rows = events.select(*place).unionByName(stops.select(*place))
    full = freeze(hot_keys(rows, place[:1], HOT_ROWS))
    if full.isEmpty():
        return False
    named = F.broadcast(full.select(F.col("_station").alias("_full")))
    inside = rows.join(named, F.col("_station").eqNullSafe(F.col("_full")), "left_semi")
    return not hot_keys(inside, place, HOT_ROWS).isEmpty()


def _is_repeated(stops: DataFrame) -> bool:
    return not stops.groupBy("FactTripStopKey").agg(F.count("*").alias("_n")).filter("_n > 1").isEmpty()


def _match_at_places(events: DataFrame, stops: DataFrame, columns: list[str]) -> DataFrame:
    """Events with ``_seen``, whether a trip-stop has their comparison key, and the trip-stop they are paired with.

    All is done inside the tasks that events and trip-stops are dealt to. A trip-stop has one row: it meets the
    events that have both its times, its arrival and its departure in three windows.
    """
    place = ["_station", "_line"]
    both, arrival, departure = (
        Window.partitionBy(*times, *place, *then) for times, then in ((["_arr"], ["_dep"]), (["_arr"], []), (["_dep"], [])))
    windows = {_BOTH: both, _ARRIVAL: arrival, _DEPARTURE: departure}
    by_arrival, by_departure = ["_arr", *place, "_dep"], ["_dep", *place]
    is_stop = F.col("_kind") == _STOP

    def counts(*kinds: int) -> dict[str, Column]:
        """Events of a kind, and trip-stops, that have the key of the row."""
        return {f"_{name}{k}": F.count_if(test).over(windows[k]) for k in kinds for name, test in (
            ("events", F.col("_kind") == k), ("stops", is_stop))}

    def free(*kinds: int) -> dict[str, Column]:
        """The trip-stop with the key of the row that has no other event."""
        return {f"_free{k}": F.max("_free").over(windows[k]) for k in kinds}

    rows = events.unionByName(stops.withColumn("_kind", F.lit(_STOP)), allowMissingColumns=True).repartition(*place)
    # Rows in this order serve the windows over both times and over the arrival.
    rows = rows.sortWithinPartitions(*by_arrival).withColumns(counts(_BOTH)).withColumns(counts(_ARRIVAL))
    rows = rows.sortWithinPartitions(*by_departure).withColumns(counts(_DEPARTURE))
    met = reduce(Column.__add__, (F.col(f"_events{k}") for k in windows))
    stop = F.struct("FactTripStopKey", "DateKey")
    rows = rows.withColumn("_free", F.when(is_stop & (met == 1) & F.col("FactTripStopKey").isNotNull(), stop))
    rows = rows.withColumns(free(_DEPARTURE)).filter(~is_stop | F.col("_free").isNotNull())
    rows = rows.sortWithinPartitions(*by_arrival).withColumns(free(_BOTH)).withColumns(free(_ARRIVAL)).filter(~is_stop)

    def of_kind(name: str) -> Column:
        return reduce(lambda found, k: found.when(F.col("_kind") == k, F.col(f"_{name}{k}")), windows, F)

    have = F.coalesce(of_kind("stops"), F.lit(0))
    return rows.select(*columns, (have > 0).alias("_seen"), F.when(have == 1, of_kind("free")).alias("_stop"))


def _match_by_key(events: DataFrame, stops: DataFrame, columns: list[str]) -> Match:
    """:func:`match_events` for keys of any number of rows, and trip-stops of several.

    All work is on counts per comparison key. The counts are stored once, because later steps read them; they hold
    numbers and times only, so that Spark adds them up in a hash table. The event of a pair is the one that has its key.
    """
    stop_values = ["FactTripStopKey", "DateKey", "_arr", "_dep"]
    event_side = events.select(*_KEY, F.lit(1).alias("_e"), F.lit(0).alias("_s"))
    stop_side = _target_keys(stops).select(*_KEY, F.lit(0).alias("_e"), F.lit(1).alias("_s"), *stop_values)
    counted = freeze(
        event_side.unionByName(stop_side, allowMissingColumns=True)
        .groupBy(*_KEY)
        .agg(
            F.sum("_e").alias("_events"), F.sum("_s").alias("_stops"),
            *[F.min(c).alias(c) for c in stop_values],  # the stop where there is one
        )
        .filter((F.col("_events") > 0) & ((F.col("_stops") > 0) | (F.col("_events") > HOT_ROWS)))
    )
    most = counted.agg(F.max("_events").alias("events"), F.max("_stops").alias("stops")).first()
    even_events, even_stops = (n is None or n <= HOT_ROWS for n in most)
    live = counted.filter("_stops > 0").dropna(subset=_KEY)
    paired = _pairs(live, even_stops)
    bound = estimated_bytes(live)  # the tables below have no more rows
    matched = _at_keys(
        events.filter("DbEventId IS NOT NULL"), paired, ["DbEventId"], "inner", even_events, bound,
    ).select(*columns, "FactTripStopKey", "DateKey", F.lit(_RULE).alias("MatchRule"))
    seen = live.select(*_KEY, F.lit(True).alias("_seen")).join(paired.withColumn("_paired", F.lit(True)), _KEY, "left")
    every = _at_keys(events, seen, ["DbEventId"], "left", even_events, bound)
    named, free = F.col("DbEventId").isNotNull(), F.col("_paired").isNull()
    reason = F.when(F.col("_seen"), "many").otherwise("none")
    judged = every.select(
        *columns, *(F.when(named, F.col(c)).alias(c) for c in ("FactTripStopKey", "DateKey")),
        F.when(named & ~free, F.lit(_RULE)).alias("MatchRule"), F.when(named & free, reason).alias("Reason"))
    return Match(matched, every.filter(free).select("DbEventId", reason.alias("Reason")), judged)


def _pairs(live: DataFrame, even: bool) -> DataFrame:
    """Of the counts per key, the keys of one event and one trip-stop that have no other candidate, with the trip-stop.

    A trip-stop's events are those at the keys that it has alone, which are added up, and those at keys that it
    shares with other trip-stops: it must not have any of these, so only the shared keys are looked up.
    """
    single = live.filter("_stops = 1")
    events = single.groupBy("FactTripStopKey").agg(F.sum("_events").alias("_rivals"))
    alone = freeze(
        single.filter("_events = 1").join(events.filter("_rivals = 1").select("FactTripStopKey"), "FactTripStopKey")
        .drop("_events", "_stops"))
    shared = freeze(live.filter("_stops > 1").select(*_KEY))
    others = _target_keys(alone.select("FactTripStopKey", "_station", "_line", "_arr", "_dep"))
    rivalled = _at_keys(others, shared, ["FactTripStopKey"], "left_semi", even, estimated_bytes(shared))
    return alone.join(rivalled.select("FactTripStopKey"), "FactTripStopKey", "left_anti").select(
        *_KEY, "FactTripStopKey", "DateKey")


# ---------------------------------------------------------------- load


def find_conflicts(source: DataFrame, fact: DataFrame) -> DataFrame:
    """Rows of ``source`` that would break the one-to-one relation, with the kind of conflict."""
    new = source.select("DbEventId", "FactTripStopKey")
    old = fact.select("DbEventId", "FactTripStopKey")
    parts = []
    for key, other, kind in (
        ("DbEventId", "FactTripStopKey", "event moves to another trip-stop"),
        ("FactTripStopKey", "DbEventId", "trip-stop moves to another event"),
    ):
        known = old.select(key, F.col(other).alias("_known"))
        parts.append(
            new.join(known, key).filter(F.col(other) != F.col("_known"))
            .select(F.lit(kind).alias("Conflict"), F.col(key).cast("string").alias("KeyValue"))
        )
        parts.append(
            new.groupBy(key).agg(F.count("*").alias("_n")).filter("_n > 1")
            .select(F.lit(f"source repeats {key}").alias("Conflict"), F.col(key).cast("string").alias("KeyValue"))
        )
    first, *others = parts
    for part in others:
        first = first.unionByName(part)
    return first


def assert_no_rebind(source: DataFrame, fact: DataFrame) -> None:
    """Raise before anything is written when ``source`` conflicts with ``fact`` or with itself."""
    found = find_conflicts(source, fact).limit(5).collect()
    if found:
        raise RebindError("; ".join(f"{row.Conflict}: {row.KeyValue}" for row in found))


def upsert_fact(source: DataFrame, fact: DataFrame) -> DataFrame:
    """The new fact with an ``Action`` per row: inserted, updated or unchanged.

    A stored row changes only when the source has a later capture.
    """
    columns = fact.columns
    old = fact.select("DbEventId", F.struct(*columns).alias("_old"))
    new = source.select("DbEventId", F.struct(*columns).alias("_new"))
    later = F.col("_new.LatestCapturedAt") > F.col("_old.LatestCapturedAt")
    action = (
        F.when(F.col("_old").isNull(), "inserted")
        .when(F.coalesce(later, F.lit(False)), "updated")
        .otherwise("unchanged")
    )
    return (
        old.join(new, "DbEventId", "full_outer")
        .select(action.alias("Action"), "_old", "_new")
        .withColumn("_row", F.when(F.col("Action") == "unchanged", F.col("_old")).otherwise(F.col("_new")))
        .select("_row.*", "Action")
    )


def upsert_counts(merged: DataFrame) -> DataFrame:
    return merged.agg(
        F.count_if(F.col("Action") == "updated").alias("UpdatedRows"),
        F.count_if(F.col("Action") == "inserted").alias("InsertedRows"),
    )


def sync_check(source: DataFrame, fact: DataFrame) -> DataFrame:
    """Rows of source and fact, rows in both, and rows whose latest capture differs or that lack a partner."""
    left = source.select("DbEventId", F.col("LatestCapturedAt").alias("_s"))
    right = fact.select("DbEventId", F.col("LatestCapturedAt").alias("_f"))
    both = left.join(right, "DbEventId", "full_outer")
    in_source, in_fact = F.col("_s").isNotNull(), F.col("_f").isNotNull()
    return both.agg(
        F.count_if(in_source).alias("SourceRows"),
        F.count_if(in_fact).alias("FactRows"),
        F.count_if(in_source & in_fact).alias("MatchedRows"),
        F.count_if(~F.col("_s").eqNullSafe(F.col("_f"))).alias("OutOfSyncRows"),
    )
