"""Batch administration: filters, states, sweeps, summaries, timelines. `now` is always a parameter."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benchbook.operators.ordered import places, runs, two_best

# States, their groups, and thresholds in minutes and days.
ACTIVE = ("QUEUED", "RUNNING")
GROUPS = {
    "running": ACTIVE, "completed": ("COMPLETED",), "cancelled": ("CANCELLED",),
    "stopped": ("FAILED", "RATE_LIMITED", "SOURCE_BLOCKED", "SOURCE_UNAVAILABLE", "STRUCTURE_CHANGED"),
}
QUEUED_MINUTES, RUNNING_MINUTES, LOG_DAYS, FAILURE_RUN = 15, 5, 7, 5


def at(moment: str) -> Column:
    return F.lit(moment).cast("timestamp_ntz")


def minutes(n: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(n))


def batch_filter(batches: DataFrame, courts: DataFrame, now: str, court_ids: tuple[int, ...] = (), hours: int | None = None, q: str = "", started_by: str | None = None) -> DataFrame:
    """Batches of courts, asked for in the last hours, found by q (digits, maybe after #: id prefix; else court name or code), by actor."""
    out = batches.join(F.broadcast(courts), "court_id", "left")
    if court_ids:
        out = out.where(F.col("court_id").isin(*court_ids))
    if hours is not None:
        out = out.where(F.col("requested_at") >= at(now) - F.make_dt_interval(F.lit(0), F.lit(hours)))
    q = q.strip().removeprefix("#")
    if q.isdigit():
        out = out.where(F.startswith(F.col("batch_id").cast("string"), F.lit(q)))
    elif q:
        out = out.where(F.col("court_name").ilike(f"%{q}%") | F.coalesce(F.col("court_code").ilike(q), F.lit(False)))
    if started_by == "none":
        out = out.where("started_by is null")
    elif started_by:
        out = out.where(F.col("started_by") == int(started_by))
    return out


def overlapping_active(batches: DataFrame) -> DataFrame:
    """batch_id of batches whose date range meets that of another active batch of their court.

    A sweep per court: active batches stand at their first day, every batch asks at its last day. Of the active ones that
    began by then it's enough to know the latest end, and the latest of another batch, as a batch doesn't meet itself. Rows
    are sorted once, and a court with a third of all batches lies over many tasks. Without a court or a day nothing meets.
    """
    known = batches.where("court_id is not null and from_date is not null and to_date is not null")
    ends = F.struct(F.col("to_date").alias("until"), F.col("batch_id").alias("of"))
    active = known.where(F.col("status").isin(*ACTIVE)).select("court_id", F.col("from_date").alias("day"), F.lit(0).alias("asks"), "batch_id", ends.alias("value"), F.lit(None).cast("date").alias("since"))
    asking = known.select("court_id", F.col("to_date").alias("day"), F.lit(1).alias("asks"), "batch_id", F.lit(None).cast(active.schema["value"].dataType).alias("value"), F.col("from_date").alias("since"))
    swept = two_best(active.unionByName(asking), ["court_id"], ["day", "asks", "batch_id"], F.col("value")).where("asks = 1")
    other = F.when(F.col("best.of") == F.col("batch_id"), F.col("second.until")).otherwise(F.col("best.until"))
    return swept.where(other >= F.col("since")).select("batch_id").distinct()


def resumable(batches: DataFrame, items: DataFrame, adapter_resumable: Column) -> DataFrame:
    """Batches with a flag: ended, of a resumable source, and undiscovered without being complete, or with open items."""
    open_items = items.where("status in ('PENDING', 'FAILED')").select("batch_id", F.lit(True).alias("has_open")).distinct()
    ended = ~F.col("status").isin(*ACTIVE)
    todo = (~F.col("discovered") & (F.col("status") != "COMPLETED")) | F.coalesce("has_open", F.lit(False))
    return batches.join(open_items, "batch_id", "left").withColumn("resumable", ended & adapter_resumable & todo).drop("has_open")


def stale_sweep(batches: DataFrame, now: str) -> DataFrame:
    """batch_id, status, new_status, event: queued too long or without a heartbeat; cancelled if that was asked for."""
    late = ((F.col("status") == "QUEUED") & (F.col("requested_at") < at(now) - minutes(QUEUED_MINUTES))) | (
        (F.col("status") == "RUNNING") & (F.coalesce("heartbeat_at", "requested_at") < at(now) - minutes(RUNNING_MINUTES))
    )
    return batches.where(late).select("batch_id", "status", F.when(F.col("cancel_requested"), "CANCELLED").otherwise("FAILED").alias("new_status"), F.lit("INTERRUPTED").alias("event"))


def daily_counts(rows: DataFrame, moment: str, last_day: str, days: int) -> DataFrame:
    """day, n: rows per day in India (UTC and five and a half hours) for the last days, empty days included."""
    spine = rows.sparkSession.range(1).select(F.explode(F.sequence(F.date_sub(F.lit(last_day).cast("date"), days - 1), F.lit(last_day).cast("date"))).alias("day"))
    day = (F.col(moment) + F.make_dt_interval(F.lit(0), F.lit(5), F.lit(30))).cast("date")
    counts = rows.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return spine.join(counts, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n"))


def summary(flagged: DataFrame) -> DataFrame:
    """status, n, promoted, resumable: counts per status of batches that resumable() has flagged."""
    return flagged.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("promoted"), F.lit(0)).alias("promoted"), F.count(F.when(F.col("resumable"), 1)).alias("resumable"))


def group_totals(by_status: DataFrame) -> DataFrame:
    """The summary rolled up to groups of states; states in no group are `other`."""
    group = F.coalesce(*[F.when(F.col("status").isin(*states), name) for name, states in GROUPS.items()], F.lit("other"))
    return by_status.groupBy(group.alias("group_name")).agg(F.sum("n").alias("n"), F.sum("promoted").alias("promoted"), F.sum("resumable").alias("resumable"))


def court_overview(courts: DataFrame, batches: DataFrame, now: str) -> DataFrame:
    """Per court: batches, promoted cases, batches of the last 24 hours, last request; zeros and null where there are none."""
    per = batches.groupBy("court_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("promoted").alias("promoted"), F.count(F.when(F.col("requested_at") >= at(now) - F.make_dt_interval(F.lit(1)), 1)).alias("recent"), F.max("requested_at").alias("last_requested_at")
    )
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return courts.join(per, "court_id", "left").select("court_id", "court_name", zero("n"), zero("promoted"), zero("recent"), "last_requested_at")


def timeline(batches: DataFrame, events: DataFrame) -> DataFrame:
    """batch_id, event, at, place: events by time and id; a batch without any gets one for its request and one for its end."""
    own = events.where("kind <> 'LOG'").select("batch_id", F.col("kind").alias("event"), "at", "log_id")
    bare = batches.join(own.select("batch_id").distinct(), "batch_id", "left_anti")
    made = bare.select("batch_id", F.explode(F.array(F.struct(F.lit("STARTED").alias("event"), F.col("requested_at").alias("at"), F.lit(0).cast("long").alias("log_id")), F.struct(F.col("status").alias("event"), F.col("finished_at").alias("at"), F.lit(1).cast("long").alias("log_id")))).alias("e")).select("batch_id", "e.*").where("at is not null")
    return places(own.union(made), ["batch_id"], ["at", "log_id"]).select("batch_id", "event", "at", F.col("place").cast("int").alias("place"))


# The state machine: event -> states it may come from -> new state.
TRANSITIONS = {
    "STARTED": (("QUEUED", "NEW"), "RUNNING"), "COMPLETED": (("RUNNING",), "COMPLETED"), "FAILED": (("QUEUED", "RUNNING"), "FAILED"), "CANCELLED": (("QUEUED", "RUNNING"), "CANCELLED"),
    "RESUMED": (("FAILED", "CANCELLED", "COMPLETED", "RATE_LIMITED", "SOURCE_BLOCKED", "SOURCE_UNAVAILABLE", "STRUCTURE_CHANGED"), "QUEUED"),
}


STATES = ("NEW", "RUNNING", *dict.fromkeys(x for come, to in TRANSITIONS.values() for x in (*come, to) if x not in ("NEW", "RUNNING")))


def _transition_maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (batch_id, kind, place) in order to one row per run of a batch: per starting state the end and the number of events that fit."""
    moves: dict[str | None, list[int | None]] = {kind: [STATES.index(to) if s in come else None for s in STATES] for kind, (come, to) in TRANSITIONS.items()}
    moves["HEARTBEAT"] = [i if s == "RUNNING" else None for i, s in enumerate(STATES)]
    stays: list[int | None] = [None] * len(STATES)
    key, first, ends, applied, n, done, types = None, None, [], [], 0, [], None
    names = ["batch_id", "place", "ends", "applied", "n"]

    def out() -> pa.RecordBatch:
        kinds = (types, pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names)

    for batch in batches:
        types = batch.schema.field("batch_id").type
        for b, kind, place in zip(*(batch.column(c).to_pylist() for c in ("batch_id", "kind", "place")), strict=True):
            if first is None or b != key:
                if first is not None:
                    done.append((key, first, ends, applied, n))
                key, first, ends, applied, n = b, place, list(range(len(STATES))), [0] * len(STATES), 0
            n += 1
            move = moves.get(kind, stays)
            for start, now in enumerate(ends):
                to = move[now]
                if to is not None:
                    ends[start] = to
                    applied[start] += 1
        if len(done) >= 10_000:
            yield out()
            done = []
    if first is not None:
        done.append((key, first, ends, applied, n))
    if done:
        yield out()


def fold_states(events: DataFrame) -> DataFrame:
    """batch_id, state, applied, ignored: each batch's events in order through the state machine; events that don't fit are ignored.

    Events are ranged by batch and time, so a batch with many events lies over several tasks. Each task
    folds its run of a batch, one event after another, into a map from every starting state to its end and
    the number of events that fit; the few maps of a batch are then applied in order. No batch's events are held together.
    """
    kind = events.schema["batch_id"].dataType.simpleString()
    ordered = events.where("kind <> 'LOG'").select("batch_id", "kind", "at", "log_id").repartitionByRange("batch_id", "at", "log_id").sortWithinPartitions("batch_id", "at", "log_id")
    placed = ordered.select("batch_id", "kind", F.monotonically_increasing_id().alias("place"))
    maps = placed.mapInArrow(_transition_maps, f"batch_id {kind}, place long, ends array<int>, applied array<long>, n long")
    joined = maps.groupBy("batch_id").agg(F.array_sort(F.collect_list(F.struct("place", "ends", "applied", "n"))).alias("maps"))
    start = F.struct(F.lit(0).alias("state"), F.lit(0).cast("long").alias("applied"), F.lit(0).cast("long").alias("ignored"))

    def step(s: Column, m: Column) -> Column:
        fits = F.get(m["applied"], s["state"])
        return F.struct(F.get(m["ends"], s["state"]).alias("state"), (s["applied"] + fits).alias("applied"), (s["ignored"] + m["n"] - fits).alias("ignored"))

    end = joined.select("batch_id", F.aggregate("maps", start, step).alias("end"))
    return end.select("batch_id", F.get(F.array(*[F.lit(x) for x in STATES]), F.col("end.state")).alias("state"), F.col("end.applied").cast("int").alias("applied"), F.col("end.ignored").cast("int").alias("ignored"))


def failure_stop(items: DataFrame, run: int = FAILURE_RUN) -> DataFrame:
    """batch_id, stopped_at: the place of the item with which the run-th failure in a row happened, if it did.

    items: batch_id, place, status. Runs are counted in sorted pieces and carried over their ends, so a batch with many
    items lies over many tasks.
    """
    return runs(items.select("batch_id", "place", "status"), ["batch_id"], ["place"], F.col("status") == "FAILED").where(F.col("nth") == run).groupBy("batch_id").agg(F.min("place").alias("stopped_at"))


def route(missing: Column, saves_metadata: Column, save_failed: Column, duplicate: Column, crashed: Column, case_id: Column, final: Column) -> Column:
    """struct(status, reason) of a record's way through the run.

    missing: why there is no judgment, or null; final: the ingestion's state if no case came of it.
    """
    out = lambda status, reason: F.struct(F.lit(status).alias("status"), reason.cast("string").alias("reason"))
    said = F.lit
    without = (
        F.when(~saves_metadata, out("SKIPPED", missing)).when(save_failed, out("FAILED", said("couldn't save case details")))
        .when(case_id.isNull(), out("DONE", said("already in database"))).otherwise(out("NO_JUDGMENT", missing))
    )
    return (
        F.when(missing.isNotNull(), without).when(save_failed, out("FAILED", said("couldn't save the judgment PDF"))).when(duplicate, out("DONE", said("duplicate PDF")))
        .when(crashed, out("FAILED", said("unhandled pipeline error"))).when(case_id.isNotNull(), out("DONE", said(None)))
        .when(final == "NEEDS_REVIEW", out("DONE", said("needs review"))).otherwise(out("FAILED", F.lower(final)))
    )
