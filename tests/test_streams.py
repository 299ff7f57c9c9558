"""Streaming dedup: late first deliveries and replays."""

import datetime as dt

from pyspark.sql.classic.dataframe import DataFrame

from tidewater.streaming import dedup_stream, ingest, write_landing

SCHEMA = "event_id long, ts timestamp_ntz, value long"


def test_dedup_keeps_late_first_deliveries(spark, scratch):
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    deliveries = [[(1, day(0), 10), (2, day(20), 20), (None, day(20), 0)],
                  [(2, day(20), 20), (4, day(25), 40)],
                  [(3, day(1), 30), (3, day(1), 30), (1, day(0), 10), (None, day(20), 0)],      # 3 comes first 24 days behind
                  [(3, day(1), 30), (5, day(2), 50)]]
    frames = [spark.createDataFrame(d, SCHEMA) for d in deliveries]
    args = (["event_id"], f"{scratch}/sink", f"{scratch}/ckpt")
    want = {(1, 10), (2, 20), (3, 30), (4, 40), (None, 0)}

    def rows():
        return sorted(((r["event_id"], r["value"]) for r in spark.read.parquet(f"{scratch}/sink").collect()), key=str)

    write_landing(frames[:3], f"{scratch}/landing")
    dedup_stream(spark, f"{scratch}/landing", frames[0].schema, *args, files_per_trigger=1)
    assert rows() == sorted(want, key=str)
    write_landing(frames[3:], f"{scratch}/landing", start=3)
    dedup_stream(spark, f"{scratch}/landing", frames[0].schema, *args, files_per_trigger=1)
    assert rows() == sorted(want | {(5, 50)}, key=str)
    # all batches once more, as after a lost checkpoint
    dedup_stream(spark, f"{scratch}/landing", frames[0].schema, *args[:-1], f"{scratch}/ckpt2", files_per_trigger=1)
    assert rows() == sorted(want | {(5, 50)}, key=str)


def test_dedup_sends_neither_keys_nor_filters_through_the_driver(spark, scratch, monkeypatch):
    """Tables this small would be broadcast, as would large ones whose files look small"""
    plans = []
    materialize, collect = ingest.materialize, DataFrame.collect

    def noted(df):
        plans.append(df._jdf.queryExecution())
        return collect(df)

    monkeypatch.setattr(ingest, "materialize", lambda df: noted(df) and materialize(df))
    monkeypatch.setattr(DataFrame, "collect", noted)
    event = lambda i: (i, dt.datetime(2024, 1, 1), i)
    first, second = [*map(event, range(50)), (None, None, 0)], [*map(event, range(40, 90)), (None, None, 0)]
    frames = [spark.createDataFrame(d, SCHEMA) for d in (first, second)]
    write_landing(frames, f"{scratch}/landing")
    dedup_stream(spark, f"{scratch}/landing", frames[0].schema, ["event_id"], f"{scratch}/sink", f"{scratch}/ckpt", files_per_trigger=1)
    monkeypatch.undo()
    seen = [p.executedPlan().toString() for p in plans]
    joined = [p for p in seen if "Join" in p]
    assert any("LeftAnti" in p for p in joined) and any("Inner" in p for p in joined)      # the keys, the filters
    assert not any("Broadcast" in p for p in seen)
    assert sorted(((r["event_id"], r["value"]) for r in spark.read.parquet(f"{scratch}/sink").collect()), key=str) == \
        sorted([(i, i) for i in range(90)] + [(None, 0)], key=str)
