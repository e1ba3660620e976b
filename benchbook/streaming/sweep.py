"""The sweep of batches that nobody hears of any more, as a stream: timers in place of a look at all of them."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from benchbook.operators.batches import QUEUED_MINUTES, RUNNING_MINUTES

SWEPT = "batch_id long, status string, new_status string, event string"
HELD = "batch_id long, status string, due long, cancel boolean"
COLUMNS = ["batch_id", "status", "due", "cancel"]
#: Minutes after which a batch of a state is given up.
LIMITS = {"QUEUED": QUEUED_MINUTES, "RUNNING": RUNNING_MINUTES}
#: Buckets of batches. One holds its open batches as one list, so it's to grow with their number.
BUCKETS = 1024


class Sweep(StatefulProcessor):
    """Holds, per bucket of batches, the state, due time and wish to cancel of its open ones; one timer per bucket, at the
    earliest due time. A bucket's list is read and written once a micro-batch, whatever number of batches is told of.

    behind: milliseconds by which the clock of the data is behind the cluster's (0: the same clock).
    """

    def __init__(self, behind: int = 0):
        self.behind = behind

    def init(self, handle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", HELD)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        told = pd.concat([frame[["batch_id", "status", "seen", "cancel"]] for frame in rows], ignore_index=True)
        limit = told["status"].map(LIMITS).fillna(0).astype("int64") * 60_000
        told = told.assign(due=told["seen"] + limit, told=1)
        held = self._held()
        held = held.assign(seen=held["due"] - held["status"].map(LIMITS).fillna(0).astype("int64") * 60_000, told=0)
        # The latest word of a batch counts, whatever the order in which its rows come; of equally late ones the last that came.
        both = (pd.concat([held, told], ignore_index=True) if len(held) else told).sort_values(["batch_id", "seen"], kind="stable")
        # Words older than the held one count for nothing. A wish to cancel stays.
        reached = both.assign(is_held=both["told"] == 0).groupby("batch_id")["is_held"]
        both = both[reached.cummax() | ~reached.transform("max")].copy()
        both["cancel"] = both.groupby("batch_id")["cancel"].cummax()
        last = both.drop_duplicates("batch_id", keep="last")
        yield from self._settle(last[last["status"].isin(list(LIMITS))], timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._settle(self._held(), timerValues)

    def _held(self) -> pd.DataFrame:
        return pd.DataFrame(list(self.held.get()) if self.held.exists() else [], columns=COLUMNS).astype({"batch_id": "int64", "due": "int64", "cancel": "bool"})

    def _settle(self, open_: pd.DataFrame, timerValues) -> Iterator[pd.DataFrame]:
        """Tells of what is due, keeps the rest, and has the bucket's timer at the next due time."""
        late = open_["due"] + 1 + self.behind <= timerValues.getCurrentProcessingTimeInMs()
        rest, swept = open_[~late], open_[late]
        for due in list(self.handle.listTimers()):
            self.handle.deleteTimer(due)
        if len(rest):
            self.held.put([(int(i), s, int(d), bool(c)) for i, s, d, c in rest[COLUMNS].itertuples(index=False)])
            self.handle.registerTimer(int(rest["due"].min()) + 1 + self.behind)
        else:
            self.held.clear()
        if len(swept):
            yield pd.DataFrame({"batch_id": swept["batch_id"].to_numpy(), "status": swept["status"].to_numpy(), "new_status": ["CANCELLED" if c else "FAILED" for c in swept["cancel"]], "event": "INTERRUPTED"})

    def close(self) -> None:
        pass


@contextmanager
def stateful(spark: SparkSession) -> Iterator[None]:
    """Timers need the state store that keeps its rows on disk."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def sweep(batches: DataFrame, behind: int = 0, buckets: int = BUCKETS) -> DataFrame:
    """batch_id, status, new_status, event as batches fall silent. batches: a stream of their rows as they change (batch_id,
    status, requested_at, heartbeat_at, cancel_requested). Queued and running ones have thresholds of their own; what was asked
    to be cancelled is cancelled. State is four values per open batch, in lists by bucket of ids; ended
    ones are forgotten. The number of buckets stays what it was when a checkpoint was made."""
    seen = F.unix_millis(F.when(F.col("status") == "RUNNING", F.coalesce("heartbeat_at", "requested_at")).otherwise(F.col("requested_at")).cast("timestamp"))
    told = batches.select("batch_id", "status", seen.alias("seen"), F.coalesce("cancel_requested", F.lit(False)).alias("cancel")).where("seen is not null")
    return told.withColumn("bucket", F.pmod(F.xxhash64("batch_id"), F.lit(buckets))).groupBy("bucket").transformWithStateInPandas(Sweep(behind), SWEPT, "append", "processingTime")
