"""The realtime cycle as a stream: landed documents to history to realtime fact."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, datetime, time, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tripgrain.functions.times import as_utc_instant, wall_literal
from tripgrain.operators.observations import event_state, merge_states, new_states, number_observations
from tripgrain.operators.realtime import (
    RebindError,
    complete_captures,
    match_events,
    match_neighbourhood,
    parse_documents,
    rejected_rows,
    upsert_counts,
    upsert_fact,
)
from tripgrain.schemas import RAW_DOCUMENT
from tripgrain.session import freeze, remove, scratch
from tripgrain.sources.tables import (
    append_observations,
    drop_partitions,
    exists,
    is_complete,
    replace_partitions,
    stored_once,
    write_table,
)

# Columns of the realtime fact.
FACT_COLUMNS = (
    "DbEventId", "FactTripStopKey", "DateKey", "ObservationKey", "StationEva", "LineName", "TrainName",
    "PlannedArrival", "ChangedArrival", "ArrivalDelayMinutes", "IsArrivalCancelled",
    "PlannedDeparture", "ChangedDeparture", "DepartureDelayMinutes", "IsDepartureCancelled",
    "PlannedPlatform", "ChangedPlatform", "FirstCapturedAt", "LatestCapturedAt", "ObservationCount",
    "MatchRule",
)
#: Days after its first capture that an event is known and can be matched anew.
LIVE_DAYS = 7
#: How captures that wait are kept: on the executors' disks and in bounded memory, whatever their number.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
#: Ranges of days that a scan of the trip-stops is limited by, at most.
DAY_RANGES = 64


@dataclass(frozen=True)
class RealtimePaths:
    """Where the realtime side keeps its tables, below one folder."""

    root: str

    @property
    def history(self) -> str:
        return f"{self.root}/observations"

    @property
    def states(self) -> str:
        return f"{self.root}/event_states"

    @property
    def fact(self) -> str:
        return f"{self.root}/fact_realtime_stop_performance"

    @property
    def parsed(self) -> str:
        return f"{self.root}/parsed"

    @property
    def rejected(self) -> str:
        return f"{self.root}/rejected"

    def staged(self, batch_id: int, kind: str = "") -> str:
        return f"{self.root}/staged/{batch_id}/{kind}".rstrip("/")

    def committed(self, batch_id: int) -> str:
        return f"{self.root}/cycles/{batch_id}"

    def unmatched(self, batch_id: int) -> str:
        return f"{self.root}/unmatched/{batch_id}"

    def checkpoint(self, step: str) -> str:
        return f"{self.root}/checkpoint/{step}"


# ---------------------------------------------------------------- trip-stops near a batch


def day_ranges(days: list[date], most: int = DAY_RANGES) -> list[tuple[date, date]]:
    """Ranges (first, last) that cover ``days``; where there are more than ``most``, the nearest are joined."""
    ranges: list[tuple[date, date]] = []
    for day in sorted(set(days)):
        if ranges and (day - ranges[-1][1]).days <= 1:
            ranges[-1] = (ranges[-1][0], day)
        else:
            ranges.append((day, day))
    if len(ranges) > most:
        gaps = sorted(range(1, len(ranges)), key=lambda i: ranges[i - 1][1] - ranges[i][0])[: most - 1]
        cuts = [0, *sorted(gaps), len(ranges)]
        ranges = [(ranges[a][0], ranges[b - 1][1]) for a, b in zip(cuts, cuts[1:])]
    return ranges


def near_planned_times(targets: DataFrame, *states: DataFrame) -> DataFrame:
    """Trip-stops on the days of the events' planned times; others cannot match.

    The bounds are literals, so the scan skips files by their statistics. An outlier adds its day only.
    """
    planned = [state.select(F.explode(F.array("PlannedArrival", "PlannedDeparture")).alias("_at")) for state in states]
    found = planned[0]
    for other in planned[1:]:
        found = found.unionByName(other)
    days = [row[0] for row in found.select(F.to_date("_at")).distinct().dropna().collect()]  # one row per day
    near = F.lit(False)
    for first, last in day_ranges(days):
        low, high = (wall_literal(datetime.combine(d, time())) for d in (first, last + timedelta(days=1)))
        for name in ("ScheduledArrivalDateTime", "ScheduledDepartureDateTime"):
            near = near | ((F.col(name) >= low) & (F.col(name) < high))
    return targets.filter(near)


# ---------------------------------------------------------------- states and matches


def live_states(spark: SparkSession, paths: RealtimePaths, since: date) -> DataFrame | None:
    """Stored states of events first captured on ``since`` or later; older partitions are not read."""
    if not exists(spark, paths.states):
        return None
    return spark.read.parquet(paths.states).filter(F.col("StateDay") >= F.lit(since))


def rematch(
    batch_state: DataFrame, live: DataFrame | None, stored_fact: DataFrame | None, targets: DataFrame,
    station_map: DataFrame,
) -> DataFrame:
    """Every event whose state or match the batch may change, with its new state and its old and new trip-stop.

    The events' counts per comparison key change by the batch's events, which take their old keys back and add
    their new ones; the trip-stops with such keys, and all events at these, are matched again. So an event
    loses its trip-stop when a rival comes and gets it when the last rival goes, and the result is that of matching
    all live events at once. ``Reason`` says why an event has none: "none", "many", or "held" where a
    trip-stop belongs to an event that is no longer live.
    """
    batch_state = freeze(batch_state)
    old = {"FactTripStopKey": "OldStop", "DateKey": "OldDay"}
    if live is None:  # no other event can be a rival, so the trip-stops need no narrowing
        merged = new_states(batch_state).withColumns({"OldStop": F.lit(None).cast("long"), "OldDay": F.lit(None).cast("int")})
        events, stops = merged.withColumn("InBatch", F.lit(True)), near_planned_times(targets, merged)
    else:
        live = live.withColumnsRenamed(old)
        ids = batch_state.select("DbEventId")  # an event has one state on either side
        known = freeze(live.join(ids, "DbEventId", "left_semi"))
        merged = freeze(
            merge_states(known.drop(*old.values()), batch_state)
            .join(known.select("DbEventId", *old.values()), "DbEventId", "left"))
        near = near_planned_times(targets, known, merged)
        neighbours, stops = match_neighbourhood([known, merged], live.join(ids, "DbEventId", "left_anti"), near, station_map)
        events = freeze(merged.withColumn("InBatch", F.lit(True)).unionByName(neighbours.withColumn("InBatch", F.lit(False))))
    judged = match_events(events, stops, station_map).judged
    if stored_fact is None:
        return judged
    judged = freeze(judged)
    days = [r[0] for r in judged.select("DateKey").distinct().dropna().collect()]  # one row per day
    kept = stored_fact.filter(F.col("DateKey").isin(days)).select("DbEventId", "FactTripStopKey")
    kept = kept.join(events.select("DbEventId"), "DbEventId", "left_anti").select("FactTripStopKey", F.lit(True).alias("_held"))
    held = F.coalesce("_held", F.lit(False))
    return judged.join(kept, "FactTripStopKey", "left").withColumns({
        "Reason": F.when(held, "held").otherwise(F.col("Reason")),
        **{c: F.when(~held, F.col(c)) for c in ("FactTripStopKey", "DateKey", "MatchRule")},
    }).drop("_held")


def assert_no_moves(cycle: DataFrame) -> None:
    """Raise when an event gets another trip-stop than it had, or a trip-stop another event than it had."""
    both = F.col("OldStop").isNotNull() & F.col("FactTripStopKey").isNotNull()
    moved = cycle.filter(both & (F.col("OldStop") != F.col("FactTripStopKey"))).select(
        F.lit("event moves to another trip-stop").alias("Conflict"), F.col("DbEventId").alias("KeyValue"))
    was = cycle.filter("OldStop IS NOT NULL").select(F.col("OldStop").alias("FactTripStopKey"), F.col("DbEventId").alias("_was"))
    taken = cycle.join(was, "FactTripStopKey").filter("_was <> DbEventId").select(
        F.lit("trip-stop moves to another event"), F.col("FactTripStopKey").cast("string"))
    found = moved.union(taken).limit(5).collect()
    if found:
        raise RebindError("; ".join(f"{row.Conflict}: {row.KeyValue}" for row in found))


def _days(cycle: DataFrame, *names: str) -> list:
    """The distinct values of day columns, at most one per day of the tables."""
    return [row[0] for row in cycle.select(F.explode(F.array(*names)).alias("d")).dropna().distinct().collect()]


def _replace_days(spark: SparkSession, content: DataFrame, path: str, column: str, days: list) -> None:
    """Overwrite the given days of a table partitioned by day; those without rows go."""
    replace_partitions(content, path, [column])
    have = {str(row[0]) for row in content.select(column).distinct().collect()}
    drop_partitions(spark, path, lambda value: value in {str(d) for d in days} - have)


def store_states(spark: SparkSession, cycle: DataFrame, paths: RealtimePaths, batch_id: int) -> None:
    """Put the states of a cycle, with their trip-stops, into the stored ones; only their days are rewritten."""
    days = _days(cycle, "StateDay")

    def build() -> DataFrame:
        new = cycle.drop("OldStop", "OldDay", "InBatch", "MatchRule", "Reason")
        if not exists(spark, paths.states):
            return new
        beside = spark.read.parquet(paths.states).filter(F.col("StateDay").isin(days))
        return new.unionByName(beside.join(cycle.select("DbEventId"), "DbEventId", "left_anti"))

    staged = stored_once(spark, paths.staged(batch_id, "states"), lambda: build().repartitionByRange("StateDay", "DbEventId"))
    _replace_days(spark, staged, paths.states, "StateDay", days)


def merge_into_fact(spark: SparkSession, cycle: DataFrame, paths: RealtimePaths, batch_id: int) -> DataFrame:
    """Upsert the matched rows of a cycle and remove those whose event lost or changed its trip-stop; returns counts.

    Only the service days of old and new trip-stops are read and rewritten.
    """
    days = _days(cycle, "DateKey", "OldDay")
    gone = cycle.filter("OldStop IS NOT NULL AND NOT (OldStop <=> FactTripStopKey)").select("DbEventId")

    def build() -> DataFrame:
        source = cycle.filter("FactTripStopKey IS NOT NULL").select(*FACT_COLUMNS)
        if not exists(spark, paths.fact):
            return upsert_fact(source, source.limit(0))
        stored = spark.read.parquet(paths.fact).filter(F.col("DateKey").isin(days)).select(*FACT_COLUMNS)
        return upsert_fact(source, stored.join(gone, "DbEventId", "left_anti"))

    staged = stored_once(spark, paths.staged(batch_id, "fact"), lambda: build().repartitionByRange("DateKey", "DbEventId"))
    _replace_days(spark, staged.drop("Action"), paths.fact, "DateKey", days)
    return upsert_counts(staged).withColumn("RemovedRows", F.lit(gone.count()).cast("long"))


def load_snapshots(
    snapshots: DataFrame,
    batch_id: int,
    paths: RealtimePaths,
    station_map: DataFrame,
    targets: Callable[[], DataFrame],
    strict: bool = True,
    live_days: int = LIVE_DAYS,
) -> DataFrame | None:
    """One realtime cycle: append the snapshots, then match again what they touch and load it; returns the counts.

    What a cycle decides is stored first and copied afterwards, so a lost cycle repeats the copy; a cycle that
    has come to its end is not repeated. The folder and the stream checkpoint in it belong together: batch
    numbers must not start again over an old folder. With ``strict`` a load that would give a bound event another
    trip-stop, or a bound trip-stop another event, raises before states or fact change; without it they move.
    """
    spark = snapshots.sparkSession
    done = paths.committed(batch_id)
    if is_complete(spark, done):
        return spark.read.parquet(done)
    with scratch(spark):
        numbered = stored_once(
            spark, paths.staged(batch_id, "snapshots"), lambda: number_observations(snapshots, batch_id))
        first = numbered.agg(F.min(F.to_date("CapturedAt"))).first()[0]
        if first is None:
            remove(spark, paths.staged(batch_id))
            return None
        append_observations(numbered, paths.history, batch_id)

        def decide() -> DataFrame:
            fact = spark.read.parquet(paths.fact) if exists(spark, paths.fact) else None
            live = live_states(spark, paths, first - timedelta(days=live_days))
            return rematch(event_state(numbered), live, fact, targets(), station_map)

        cycle = stored_once(spark, paths.staged(batch_id, "cycle"), decide)
        if strict:
            try:
                assert_no_moves(cycle)
            except RebindError:
                remove(spark, paths.staged(batch_id, "cycle"))
                raise
        write_table(cycle.filter("FactTripStopKey IS NULL").select("DbEventId", "Reason", "InBatch"), paths.unmatched(batch_id))
        store_states(spark, cycle, paths, batch_id)
        counts = write_table(merge_into_fact(spark, cycle, paths, batch_id), done)
        remove(spark, paths.staged(batch_id))
    return counts


# ---------------------------------------------------------------- the stream


def complete_stream(parsed: DataFrame, wait: str) -> DataFrame:
    """Observation rows of a stream of parsed documents, one per event and capture.

    Plan and change may come in different batches. A capture is closed, and its rows come out, when a document
    has been captured ``wait`` or more after it; documents for a closed capture come too late. A document without
    events, such as an empty timetable, moves the time on as well.
    """
    timed = parsed.withColumn("_instant", as_utc_instant(F.col("CapturedAt"))).withWatermark("_instant", wait)
    return complete_captures(timed, ("_instant",))


@contextmanager
def _state_settings(spark: SparkSession, wait: str) -> Iterator[None]:
    """A stream started inside keeps captures that ``wait`` as STATE_SETTINGS say, unless the session says otherwise.

    A stream that has a checkpoint stays with the provider it began with.
    """
    waits = any(digit in wait for digit in "123456789")
    unset = [key for key in STATE_SETTINGS if waits and spark.conf.get(key, None) is None]
    for key in unset:
        spark.conf.set(key, STATE_SETTINGS[key])
    try:
        yield
    finally:
        for key in unset:
            spark.conf.unset(key)


def run_realtime(
    spark: SparkSession,
    documents: DataFrame | str,
    paths: RealtimePaths,
    station_map: DataFrame,
    targets: Callable[[], DataFrame],
    processing_time: str | None = None,
    wait: str = "0 seconds",
    strict: bool = True,
    live_days: int = LIVE_DAYS,
) -> StreamingQuery:
    """Start the realtime stream over documents: a streaming table of them, or the folder where they land.

    Documents are parsed once. What cannot be used goes to ``paths.rejected`` with its reason; elements wait, for
    ``wait`` of capture time, until their capture is complete (:func:`complete_stream`) and are loaded
    (:func:`load_snapshots`). With ``processing_time`` (say "15 minutes") both steps keep running; without it they take
    what is there and end, and the first step has ended when this returns.
    """
    if isinstance(documents, str):
        documents = spark.readStream.schema(RAW_DOCUMENT).parquet(documents)
    trigger = {"processingTime": processing_time} if processing_time else {"availableNow": True}
    schema = parse_documents(documents).drop("Document").schema

    def parse(batch: DataFrame, batch_id: int) -> None:
        with scratch(spark):
            parsed = freeze(parse_documents(batch))
            number = F.lit(batch_id).cast("long")
            replace_partitions(rejected_rows(parsed).withColumn("BatchId", number), paths.rejected, ["BatchId"])
            parsed.drop("Document").write.mode("overwrite").parquet(f"{paths.parsed}/{batch_id}")

    def cycle(batch: DataFrame, batch_id: int) -> None:
        load_snapshots(batch, batch_id, paths, station_map, targets, strict, live_days)

    first = (
        documents.writeStream.foreachBatch(parse)
        .option("checkpointLocation", paths.checkpoint("parse")).trigger(**trigger).start()
    )
    if not processing_time:
        first.awaitTermination()
    write_table(spark.createDataFrame([], schema), f"{paths.parsed}/empty")  # the folder is there from the start
    parsed = spark.readStream.schema(schema).parquet(f"{paths.parsed}/*")
    with _state_settings(spark, wait):
        return (
            complete_stream(parsed, wait).writeStream.outputMode("append").foreachBatch(cycle)
            .option("checkpointLocation", paths.checkpoint("load")).trigger(**trigger).start()
        )
