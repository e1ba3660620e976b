"""The sweep by timers against its batch twin and over a restart; a log that is followed to its end."""

import time

from pyspark.sql import functions as F

from benchbook.sources import landing
from benchbook.streaming import logs, sweep

BATCH = "batch_id long, status string, requested_at timestamp, heartbeat_at timestamp, cancel_requested boolean"


def batch(spark, *rows):
    made = spark.createDataFrame(rows, "batch_id long, status string, asked double, beat double, cancel_requested boolean")
    at = lambda c: F.timestamp_millis((F.col(c) * 1000).cast("long"))
    return made.select("batch_id", "status", at("asked").alias("requested_at"), at("beat").alias("heartbeat_at"), "cancel_requested")


def test_timers_fire_over_a_restart(spark):
    source, folder, now = landing.shared_folder(spark), landing.shared_folder(spark), time.time()
    # 1 falls silent in some seconds, 2 is late already, 3 has ended, 4 is queued for long and to be cancelled, 5 is heard of again.
    landing.land(batch(spark, (1, "RUNNING", now - 900, now - 300 + 30, False), (2, "RUNNING", now - 900, None, False), (3, "FAILED", now - 9000, None, False), (4, "QUEUED", now - 1000, None, True), (5, "RUNNING", now - 900, now - 300 + 30, False)), source)
    run = lambda: {(r["batch_id"], r["status"], r["new_status"]) for r in logs.run_available(sweep.sweep(landing.landed_stream(spark, source, BATCH)), folder=folder, once=True).collect()}
    with sweep.stateful(spark):
        assert run() == {(2, "RUNNING", "FAILED"), (4, "QUEUED", "CANCELLED")}
        landing.land(batch(spark, (5, "RUNNING", now - 900, now, False), (1, "RUNNING", now - 900, now - 400, False)), source)  # the older word of 1 changes nothing
        time.sleep(max(0, now + 31 - time.time()))
        # Started anew from the checkpoint: the timer of 1 has run out, 5 is alive.
        assert run() == {(2, "RUNNING", "FAILED"), (4, "QUEUED", "CANCELLED"), (1, "RUNNING", "FAILED")}


def test_lines_behind_the_status_are_told(spark):
    source, folder = landing.shared_folder(spark), landing.shared_folder(spark)
    line = lambda *ids: landing.land(spark.createDataFrame([(i,) for i in ids], "log_id long"), source)
    line(1, 2)
    looks = iter([(False, [3]), (True, [4, 5]), (True, []), (True, [])])

    def finished():
        done, late = next(looks)
        if late:
            line(*late)  # written after the state was read and before the lines are
        return done

    told = [sorted(r["log_id"] for r in new.collect()) for new in logs.follow(lambda: landing.landed_stream(spark, source, "log_id long"), finished, folder)]
    assert told == [[1, 2, 3], [4, 5]] and next(looks) == (True, [])
    line(6)
    again = [sorted(r["log_id"] for r in new.collect()) for new in logs.follow(lambda: landing.landed_stream(spark, source, "log_id long"), lambda: True, folder)]
    assert [6] in again or again == [[1, 2, 3, 4, 5, 6]]


def test_batches_of_one_bucket_share_a_list_and_a_timer(spark):
    """With a single bucket: all batches in one list, later words and wishes to cancel per batch, and one timer, at the first due time."""
    source, folder, now = landing.shared_folder(spark), landing.shared_folder(spark), time.time()
    many = [(i, "RUNNING", now - 900, now - 300 + (25 if i % 2 else 3000), i % 3 == 0) for i in range(10, 40)]
    landing.land(batch(spark, *many, (1, "QUEUED", now - 5000, None, False), (2, "COMPLETED", now - 5000, None, True)), source)
    run = lambda: sorted((r["batch_id"], r["new_status"]) for r in logs.run_available(sweep.sweep(landing.landed_stream(spark, source, BATCH), buckets=1), folder=folder, once=True).collect())
    with sweep.stateful(spark):
        assert run() == [(1, "FAILED")]
        landing.land(batch(spark, (11, "FAILED", now - 900, None, False), (13, "COMPLETED", now + 1, None, False), (15, "RUNNING", now - 900, now + 3000, False)), source)
        time.sleep(max(0, now + 26 - time.time()))
        # 11's word is older than its heartbeat, 13 has ended, 15 is heard of again.
        due = [i for i in range(11, 40, 2) if i not in (13, 15)]
        assert run() == [(1, "FAILED")] + [(i, "CANCELLED" if i % 3 == 0 else "FAILED") for i in due]
