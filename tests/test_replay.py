from benchbook.streaming import logs


def test_replay_reads_its_table_as_often_however_many_pieces(spark):
    read = spark.sparkContext.accumulator(0)

    def told(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    made = spark.range(60).selectExpr("id", "if(id = 0, null, timestamp_seconds(id)) as at")
    out = logs.replay(made.mapInPandas(told, "id long, at timestamp"), lambda s: s, "append", rows=15)
    rows = out.collect()
    assert sorted(r["id"] for r in rows) == list(range(60)) and {r["batch"] for r in rows} == {0, 1, 2, 3}
    assert [r["id"] for r in sorted(rows, key=lambda r: (r["batch"], r["id"]))] == list(range(60))
    assert read.value <= 3 * 60
