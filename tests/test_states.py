"""The state machine's stream: batches share state by bucket; states, last sights and silent batches as counted by hand."""

import random

import numpy as np
from pyspark.sql import functions as F

from benchbook.operators.batches import RUNNING_MINUTES, STATES, TRANSITIONS
from benchbook.sources import landing
from benchbook.streaming import logs

EVENT = "batch_id long, log_id long, kind string, s double"
HOUR = 3600


def timed(rows):
    return rows.select("batch_id", "log_id", "kind", F.timestamp_micros((F.col("s") * 1_000_000).cast("long")).alias("at"))


def by_hand(made):
    """batch_id -> state and last sight in seconds, events without a time first; the end is the watermark's."""
    mark = max(s for *_, s in made if s is not None) - HOUR
    state, last = {}, {}
    for b, _, kind, s in sorted(made, key=lambda r: (r[3] is not None, r[3] or 0, r[1])):
        come, to = TRANSITIONS.get(kind, ((), None))
        state[b] = to if state.setdefault(b, "NEW") in come else state[b]
        last[b] = max(last.get(b, 0), s or 0)
    return {b: ("STALE" if state[b] == "RUNNING" and last[b] + RUNNING_MINUTES * 60 < mark else state[b], last[b]) for b in state}


def found(rows):
    return {r["batch_id"]: (r["state"], r["s"]) for r in rows.select("batch_id", "state", (F.unix_micros("last_seen") / 1_000_000).alias("s")).collect()}


def test_many_batches_are_few_states(spark):
    source = landing.shared_folder(spark)
    landing.land(timed(spark.range(3000).selectExpr("id as batch_id", "id as log_id", "'STARTED' as kind", "cast(1000000 + id as double) as s")), source)
    stream = logs.batch_states(landing.landed_stream(spark, source, "batch_id long, log_id long, kind string, at timestamp"))
    query = stream.writeStream.outputMode("update").format("noop").option("checkpointLocation", landing.shared_folder(spark)).trigger(availableNow=True).start()
    query.awaitTermination()
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) < 1000


def test_states_by_hand(spark):
    rng = random.Random(11)
    top = 1 << 62  # ids that no float holds
    ids = [None, 0, 7, *(top + i for i in range(300))]
    kinds = [*TRANSITIONS, "STARTED", "STARTED", "RESUMED", "HEARTBEAT"]
    made = [(7 if rng.random() < 0.3 else rng.choice(ids), i, rng.choice(kinds), None if rng.random() < 0.02 else 1e6 + rng.randrange(40 * HOUR)) for i in range(4000)]
    # Silent for good, heard of again after that, and never seen at any time.
    made += [(1, 5000, "STARTED", 1e6 + 5), (2, 5001, "STARTED", 1e6 + 6), (2, 5002, "COMPLETED", 1e6 + 39 * HOUR), (3, 5003, "STARTED", None), (4, 5004, "STARTED", 1e6 + 40 * HOUR - 1)]
    rng.shuffle(made)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")  # a bucket's rows come in several frames
    try:
        for rows, buckets in ((1000, 3), (700, logs.STATE_BUCKETS)):
            out = logs.replay(timed(spark.createDataFrame(made, EVENT).repartition(3)), lambda s, n=buckets: logs.batch_states(s, buckets=n), rows=rows)
            got, want = found(logs.final(out, ["batch_id"])), by_hand(made)
            assert got == want
            assert {"STALE", "RUNNING", "QUEUED", "COMPLETED", "FAILED"} <= {s for s, _ in got.values()} and got[1][0] == got[3][0] == "STALE" and got[2][0] == "COMPLETED" and got[4][0] == "RUNNING"
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_composed_maps_equal_one_step_after_another():
    rng = np.random.default_rng(5)
    sizes = [1, 2, 3, 8, 700, 1]
    group = np.repeat(np.arange(len(sizes)), sizes)
    kinds = rng.integers(0, len(TRANSITIONS), len(group))
    want = []
    for g in range(len(sizes)):
        ends = list(range(len(STATES)))
        for k in kinds[group == g]:
            ends = [int(logs.MOVES[k][s]) for s in ends]
        want.append(ends)
    groups, maps = logs._composed(group, logs.MOVES[kinds])
    assert groups.tolist() == list(range(len(sizes))) and maps.tolist() == want
