"""Streams over logs and events: tail, daily counts, stale batches, state machine. Each equals its batch twin on all data;
the state machine needs events in the order of time, which replay() gives."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import IntegerType, StructField, StructType

from benchbook.operators.batches import QUEUED_MINUTES, RUNNING_MINUTES, STATES, TRANSITIONS
from benchbook.sources.landing import land, shared_folder


def run_available(stream: DataFrame, mode: str = "append", folder: str | None = None, once: bool = False) -> DataFrame:
    """Runs a stream over everything that is there now; the rows that it wrote to the shared folder. With the folder of a
    run before it goes on from there. once: in a single micro-batch, for streams with timers, which always have a next one."""
    spark = stream.sparkSession
    folder = folder or shared_folder(spark)

    def write(batch: DataFrame, number: int) -> None:
        # A batch that is run again after a failure overwrites its own folder.
        batch.write.mode("overwrite").parquet(f"{folder}/rows/batch={number}")

    query = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint").trigger(**({"once": True} if once else {"availableNow": True})).foreachBatch(write).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema.add("batch", "long")).parquet(f"{folder}/rows")


#: Rows of a replayed piece, about; what one micro-batch takes.
REPLAY_ROWS = 2_000_000
#: Tasks that write and read a piece, at most.
PIECE_TASKS = 8


def replay(events: DataFrame, use: Callable[[DataFrame], DataFrame], mode: str = "update", rows: int = REPLAY_ROWS) -> DataFrame:
    """Runs use() as a stream over a whole table in the order of `at`, however its files are cut; the rows that it wrote.

    The table is cut at quantiles of the time and written by pieces once. A piece lands only when the stream has taken the one before, so each
    piece is one micro-batch, and none holds a row older than the piece before. Rows without a time come first.
    """
    spark = events.sparkSession
    source, folder = shared_folder(spark), shared_folder(spark)
    pieces = max(1, -(-events.count() // rows))
    micros = F.unix_micros(F.col("at").cast("timestamp"))
    cuts = sorted(set(events.agg(F.percentile_approx(micros, [i / pieces for i in range(1, pieces)], 100 * pieces)).first()[0] or [])) if pieces > 1 else []
    # The table is read once more, to be written by pieces: landing one then reads no other.
    piece = sum((F.coalesce(micros > c, F.lit(False)).cast("int") for c in cuts), F.lit(0))
    cut = shared_folder(spark)
    events.withColumn("piece", piece).repartition("piece", F.pmod(F.xxhash64("at"), F.lit(PIECE_TASKS))).write.partitionBy("piece").parquet(f"{cut}/pieces")
    held = spark.read.schema(StructType([*events.schema, StructField("piece", IntegerType())])).parquet(f"{cut}/pieces")
    out = None
    for k in range(len(cuts) + 1):
        land(held.where(F.col("piece") == k).drop("piece"), source)
        out = run_available(use(spark.readStream.schema(events.schema).parquet(source)), mode, folder)
    return out


def final(changes: DataFrame, key: list[str]) -> DataFrame:
    """Of an update stream's rows the last per key."""
    values = [c for c in changes.columns if c not in (*key, "batch")]
    return changes.groupBy(*key).agg(F.max_by(F.struct(*values), "batch").alias("x")).select(*key, "x.*")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream, as log lines: batch_id, log_id, event_type, at, details."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return log_lines(spark.readStream.schema(schema).option("maxFilesPerTrigger", 4).parquet(f"{sf_dir}/events.parquet*"))


def log_lines(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("user_id").alias("batch_id"), F.col("event_id").alias("log_id"), "event_type", F.col("ts").cast("timestamp").alias("at"), F.col("props").alias("details"))


def tail(lines: DataFrame, cursor: int = -1) -> DataFrame:
    """Lines behind the cursor. A stream's source offsets are the cursor from then on; nothing is told twice."""
    return lines.where(F.col("log_id") > cursor)


def follow(lines: Callable[[], DataFrame], finished: Callable[[], bool], folder: str, pause: Callable[[], None] = lambda: None) -> Iterator[DataFrame]:
    """The new lines of each look at a log, until it's over: lines() is the log's stream, finished() tells its batch's state.

    The state is read before the lines. Lines that were written before the batch was finished are therefore seen in the same
    look at the latest; the log is over after a look that began with a finished batch and brought nothing. The folder keeps
    the cursor, so a follower that starts again goes on where it was.
    """
    last = -1
    while True:
        done = finished()
        seen = run_available(lines(), folder=folder)
        new = seen.where(F.col("batch") > last)
        top = new.agg(F.max("batch")).first()[0]
        if top is not None:
            last = top
            yield new.drop("batch")
        elif done:
            return
        pause()


def daily(lines: DataFrame, late: str | None = None) -> DataFrame:
    """day, n: lines per day in India, in a tumbling window. Every line counts, however late, and the state is one row
    per day; with a bound (late) days behind it are closed and lines that come after that are lost."""
    shifted = lines.withColumn("local", F.col("at") + F.expr("interval 5 hours 30 minutes"))
    shifted = shifted.withWatermark("local", late) if late else shifted
    return shifted.groupBy(F.window("local", "1 day")).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").cast("date").alias("day"), "n")


#: Buckets of batches. One holds its batches as one packed list, so their number is to grow with that of batches; it stays
#: what it was when a checkpoint was made.
STATE_BUCKETS = 512
#: What a bucket holds of a batch, in the order of ids; told: it was told as STALE and nothing was heard of it since.
HELD = np.dtype([("id", "i8"), ("state", "i1"), ("last", "i8"), ("told", "?")])
STATE = "held binary"
OUT = "batch_id long, state string, last long"
KINDS = tuple(TRANSITIONS)
#: Per kind of event the state that follows each state, by the table of the batch fold; events that don't fit change nothing.
MOVES = np.array([[STATES.index(to) if s in come else i for i, s in enumerate(STATES)] for come, to in TRANSITIONS.values()], dtype=np.uint8)
NAMES = np.array([*STATES, "STALE"], dtype=object)
RUNNING, STALE = STATES.index("RUNNING"), len(STATES)
NEVER = -(1 << 63)


def _composed(group: np.ndarray, maps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Groups, and per group the map from each state to the one after all its events. group: ascending, a row per event; maps:
    the events' own maps, in order. Neighbours are put together in pairs, round after round, so a batch with n events takes log n."""
    while True:
        begins = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        nth = np.arange(len(group)) - np.repeat(begins, np.diff(np.r_[begins, len(group)]))
        left = nth % 2 == 0
        pairs = np.flatnonzero(left[:-1] & ~left[1:])
        if not len(pairs):
            return group, maps
        maps[pairs] = np.take_along_axis(maps[pairs + 1], maps[pairs], axis=1)
        group, maps = group[left], maps[left]


def _states(limit_ms: int) -> Callable:
    def fold(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = np.frombuffer(state.get[0], HELD) if state.exists else np.empty(0, HELD)
        # Heartbeats only move the last sight; of a bucket's rows no more than the events that may change a state are held.
        seen, told = [], []
        for frame in () if state.hasTimedOut else frames:
            i, micros, kind, log = (frame[c].to_numpy() for c in ("batch_id", "micros", "kind", "log_id"))
            ids, which = np.unique(i, return_inverse=True)
            last = np.zeros(len(ids), "i8")
            np.maximum.at(last, which, micros)
            seen.append((ids, last))
            fits = kind >= 0
            told.append((i[fits], micros[fits], log[fits], kind[fits]))
        all_ids = np.unique(np.concatenate([held["id"], *(ids for ids, _ in seen)]))
        now = np.zeros(len(all_ids), HELD)
        now["id"] = all_ids
        now[np.searchsorted(all_ids, held["id"])] = held
        heard = np.zeros(len(all_ids), bool)
        for ids, last in seen:
            at = np.searchsorted(all_ids, ids)
            now["last"][at] = np.maximum(now["last"][at], last)
            heard[at] = True
        if any(len(t[0]) for t in told):
            i, micros, log, kind = (np.concatenate(c) for c in zip(*told, strict=True))
            order = np.lexsort((log, micros, i))
            group, maps = _composed(np.searchsorted(all_ids, i[order]), MOVES[kind[order]])
            now["state"][group] = maps[np.arange(len(group)), now["state"][group]]
        # A silent batch's state stays, so that a batch that is heard of again goes on from it.
        mark, due = state.getCurrentWatermarkMs(), now["last"] // 1000 + limit_ms
        running = now["state"] == RUNNING
        silent = running & (due < mark)
        out = heard | (silent & ~now["told"])
        now["told"] = silent
        state.update((now.tobytes(),))
        if (running & ~silent).any():
            state.setTimeoutTimestamp(int(due[running & ~silent].min()))
        if out.any():
            ids = pd.array(now["id"][out], dtype="Int64")
            if key[0] < 0:
                ids[:] = pd.NA
            # Nullable integers: the rows that Spark fills up a batch with would else make floats of ids.
            yield pd.DataFrame({"batch_id": ids, "state": NAMES[np.where(silent, STALE, now["state"])[out]], "last": pd.array(now["last"][out], dtype="Int64")})

    return fold


def batch_states(events: DataFrame, late: str = "1 hour", minutes: int = RUNNING_MINUTES, buckets: int = STATE_BUCKETS) -> DataFrame:
    """batch_id, state, last_seen per batch as events come (batch_id, log_id, kind, at); a running batch that is silent for so
    long in event time is told as STALE. State is four values per batch, in packed lists by bucket of ids: a bucket's list is
    read, folded with its events at once and written once a micro-batch, with one timer at the earliest due time. Events must come
    in about the order of time: those older than the watermark are lost, and micro-batches are applied as they come; replay() puts
    a whole table in order. Events without a time come first, as in the batch fold."""
    kind = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)]), F.col("kind")), F.lit(-1))
    # Batches without an id are one batch, in a bucket of its own.
    bucket = F.when(F.col("batch_id").isNull(), -1).otherwise(F.pmod(F.xxhash64("batch_id"), F.lit(buckets)))
    never = lambda c: F.coalesce(c, F.lit(NEVER))
    marked = events.withWatermark("at", late).select(
        bucket.cast("int").alias("bucket"), F.coalesce("batch_id", F.lit(0)).alias("batch_id"), never(F.col("log_id")).alias("log_id"), kind.alias("kind"),
        never(F.unix_micros(F.col("at").cast("timestamp"))).alias("micros"), "at",
    )
    states = marked.groupBy("bucket").applyInPandasWithState(_states(minutes * 60_000), OUT, STATE, "update", GroupStateTimeout.EventTimeTimeout)
    return states.select("batch_id", "state", F.timestamp_micros("last").alias("last_seen"))


__all__ = ["QUEUED_MINUTES", "batch_states", "daily", "events_stream", "final", "follow", "log_lines", "replay", "run_available", "tail"]
