"""Buckets that grow with the bytes, states in any order, refused duplicates, commit files that are whole."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tidewater.jobs import Scd2Load, WatermarkLoad
from tidewater.operators.loads import upsert
from tidewater.operators.scd2 import check_contiguous, check_one_current, scd2_merge
from tidewater.sources.batches import BatchLedger, write_batches
from tidewater.sources.buckets import BucketDirectory
from tidewater.sources.publish import Catalog, CommitConflict
from tidewater.streaming import dedup_stream, read_target, scd2_stream, upsert_stream, write_landing


def test_directory_moves_rows_of_split_buckets_only(spark):
    keys = spark.range(3000)
    for n, m in [(1, 2), (1, 7), (3, 5), (4, 16), (5, 6), (7, 1000)]:
        old, (new, split) = BucketDirectory(n), BucketDirectory(n).grown_to(m)
        rows = keys.select(old.bucket("id").alias("a"), new.bucket("id").alias("b")).distinct().collect()
        assert {r.a for r in rows} <= set(range(n)) and {r.b for r in rows} <= set(range(m))
        assert {r.a for r in rows if r.a != r.b} <= split and all(r.b >= n for r in rows if r.a != r.b)
    sizes = [r["count"] for r in keys.groupBy(BucketDirectory(24).bucket("id")).count().collect()]
    assert len(sizes) == 24 and max(sizes) < 3000 / 24 * 2.5
    d, split = BucketDirectory(4).for_bytes(held=400, coming=100, target_bytes=50)
    assert d.n == 10 and split == {0, 1, 2, 3}
    assert BucketDirectory(4).for_bytes(held=4000, coming=1, target_bytes=50, most_splits=3)[0].n == 7
    assert BucketDirectory(9).for_bytes(held=10, coming=0, target_bytes=50) == (BucketDirectory(9), set())


def rows(spark, lo, hi, day, tag):
    return spark.range(lo, hi).select(F.col("id"), F.lit(dt.datetime(2026, 1, day)).cast("timestamp_ntz").alias("updated_at"),
                                      F.concat(F.lit(tag), F.sha2(F.col("id").cast("string"), 512)).alias("v"))


def test_small_increment_rewrites_few_bytes(spark, scratch):
    """A table of 1,000 buckets: an increment of 100 keys rewrites less than 5 % of its bytes"""
    job = WatermarkLoad(spark, scratch, "t", key="id", ts_col="updated_at", update_cols=["v", "updated_at"], n_buckets=1000, target_bytes=1 << 30)
    job.run(rows(spark, 0, 20_000, 1, "a"))
    before = job.catalog.current("t")["tables"]["rows"]
    # keys of forty buckets
    near = spark.range(20_000).where(job._directory(job.catalog.current("t"), "rows").bucket("id") < 40).limit(100)
    job.run(rows(spark, 0, 20_000, 2, "b").join(near, "id", "left_semi"))
    after = job.catalog.current("t")["tables"]["rows"]
    fresh = [b for b, p in after["partitions"].items() if before["partitions"][b] != p]
    assert len(before["partitions"]) == 1000 and sum(after["bytes"][b] for b in fresh) < 0.05 * sum(after["bytes"].values())
    assert job.target().where("v LIKE 'b%'").count() == 100 and job.target().count() == 20_000


def test_directory_grows_with_the_table(spark, scratch):
    job = WatermarkLoad(spark, scratch, "t", key="id", ts_col="updated_at", update_cols=["v", "updated_at"], target_bytes=100_000)
    n = []
    for day, (lo, hi) in enumerate([(0, 500), (300, 6000), (5000, 20_000), (0, 10)], start=1):
        job.run(rows(spark, lo, hi, day, f"d{day}-"))
        doc = job.catalog.current("t")
        n.append(doc["meta"]["buckets"]["rows"])
        assert {int(b) for b in doc["tables"]["rows"]["partitions"]} <= set(range(n[-1]))
        assert max(doc["tables"]["rows"]["bytes"].values()) < 4 * 100_000
    assert n[0] < n[1] < n[2] <= n[3]
    got = job.target()
    assert got.count() == got.select("id").distinct().count() == 20_000
    assert {r.tag: r["count"] for r in got.groupBy(F.left("v", F.lit(2)).alias("tag")).count().collect()} == {"d1": 290, "d2": 4700, "d3": 15_000, "d4": 10}
    assert job.watermark().first()["watermark_value"] == dt.datetime(2026, 1, 4)


STATE = "k long, ts timestamp_ntz, tier string, born timestamp_ntz"


def states(rng, n_keys=6, n=60):
    at = lambda d: dt.datetime(2026, 1, 1) + dt.timedelta(hours=d)
    return [(rng.randrange(n_keys), at(rng.randrange(1, 40)), rng.choice("abc"), at(0)) for _ in range(n)]


def versions_by_hand(seen):
    out = []
    for k in {s[0] for s in seen}:
        best = {}
        for _, ts, tier, born in (s for s in seen if s[0] == k):
            best[ts] = max(best.get(ts, (tier, born)), (tier, born))
        opens = []
        for ts in sorted(best):
            if not opens or opens[-1][1] != best[ts][0]:
                opens.append((ts if opens else best[ts][1], best[ts][0]))
        for (lo, tier), (hi, _) in zip(opens, [*opens[1:], (None, None)]):
            out.append((k, tier, lo, hi, hi is None))
    return sorted(out, key=str)


def dimension(job):
    return sorted(((r.k, r.tier, r.valid_from, r.valid_to, r.is_current) for r in job.read().collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_late_states_in_any_order(spark, scratch, seed):
    rng = random.Random(seed)
    seen = states(rng)
    job = Scd2Load(spark, scratch, "dim", "k", ["tier"], change_time_col="ts", first_time_col="born")
    done = []
    for part in (seen[:25], seen[25:45], seen[40:], [seen[0]]):
        job.run(spark.createDataFrame(part, STATE))
        done += part
        assert dimension(job) == versions_by_hand(done)
        dim = job.read()
        assert check_one_current(dim, "k").first().violations == 0 and check_contiguous(dim, "k").first().violations == 0
        sk = [r.sk for r in dim.collect()]
        assert len(set(sk)) == len(sk)
    assert job.run(spark.createDataFrame(seen, STATE).limit(0)) == {"changed_buckets": 0}
    # a version whose opening state did not change keeps its key
    keep = {(r.k, r.valid_from): r.sk for r in job.read().collect()}
    job.run(spark.createDataFrame([(99, dt.datetime(2026, 1, 5), "a", dt.datetime(2026, 1, 5))], STATE))
    assert {(r.k, r.valid_from): r.sk for r in job.read().where("k <> 99").collect()} == keep


def test_stream_of_states_in_any_order(spark, scratch):
    seen = states(random.Random(7))
    write_landing([spark.createDataFrame(seen[i::3], STATE) for i in (2, 0, 1)], f"{scratch}/landing")
    job = Scd2Load(spark, f"{scratch}/wh", "dim", "k", ["tier"], change_time_col="ts", first_time_col="born")
    schema = spark.createDataFrame([], STATE).schema
    scd2_stream(spark, f"{scratch}/landing", schema, job, f"{scratch}/ckpt", files_per_trigger=1)
    assert dimension(job) == versions_by_hand(seen)
    # the last batch again, as after a crash between its commit and the stream's note
    seq = job.catalog.current("dim")["seq"]
    last = max(int(n) for n in os.listdir(f"{scratch}/ckpt/commits") if n.isdigit())
    for n in (f"{last}", f".{last}.crc"):
        if os.path.exists(f"{scratch}/ckpt/commits/{n}"):
            os.remove(f"{scratch}/ckpt/commits/{n}")
    scd2_stream(spark, f"{scratch}/landing", schema, job, f"{scratch}/ckpt", files_per_trigger=1)
    assert job.catalog.current("dim")["seq"] == seq and dimension(job) == versions_by_hand(seen)


def test_states_sent_again_write_nothing(spark, scratch):
    """Old states, not just the latest of a key, are known: a run of them alone commits nothing, beside new ones they touch no bucket"""
    at = lambda h: dt.datetime(2026, 1, 1) + dt.timedelta(hours=h)
    seen = [(k, at(h), t, at(0)) for k in range(5) for h, t in [(1, "a"), (2, "b"), (3, None), (4, "a")]]
    job = Scd2Load(spark, scratch, "dim", "k", ["tier"], change_time_col="ts", first_time_col="born", n_buckets=16)
    job.run(spark.createDataFrame(seen, STATE))
    before = job.catalog.current("dim")
    assert job.run(spark.createDataFrame(seen[:3] + seen[5:15], STATE)) == {"changed_buckets": 0}
    assert job.catalog.current("dim") == before
    news = [(3, at(1), "z", at(0)), (3, at(9), None, at(0))]
    assert job.run(spark.createDataFrame(seen + news, STATE))["meta"]["changed_buckets"] == 1
    assert dimension(job) == versions_by_hand(seen + news)
    states_seen = job.catalog.read("dim", "seen")
    assert states_seen.count() == states_seen.distinct().count() == len(seen + news)


def test_a_stream_batch_is_a_delivery_in_many_files(spark, scratch, monkeypatch):
    """The queries' streams run as many batches as there are deliveries, in however many files each comes"""
    from tidewater.plans import streams

    runs = []
    land = streams.write_landing
    monkeypatch.setattr(streams, "write_landing", lambda parts, *a, **kw: land([p.repartition(5) for p in parts], *a, **kw))
    monkeypatch.setattr(streams, "_root", lambda spark, tag: runs.append(f"{scratch}/{tag}") or runs[-1])
    e = spark.range(300).select(F.col("id").alias("event_id"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(id % 31, 0, 0, id)").alias("ts"),
                                (F.col("id") % 7).alias("user_id"), F.expr("element_at(array('a', 'b', 'c'), cast(id % 3 as int) + 1)").alias("event_type"),
                                F.col("id").cast("double").alias("value"))
    e.write.parquet(f"{scratch}/in/events.parquet")
    for query, batches, n in [(streams.stream_append, 4, 300), (streams.stream_upsert, 4, 7), (streams.stream_dedup, 5, 300), (streams.stream_scd2, 3, None)]:
        got = query(spark, f"{scratch}/in")
        assert len([f for f in os.listdir(f"{runs[-1]}/ckpt/commits") if f.isdigit()]) == batches
        assert n is None or got.count() == n


def test_snapshots_out_of_order_are_refused(spark, scratch):
    at = lambda d: dt.datetime(2026, 1, d)
    dim = spark.createDataFrame([(1, 1, "a", at(5), None, True)], "sk long, k long, tier string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean")
    older = spark.createDataFrame([(1, at(3), "b", at(1))], STATE)
    with pytest.raises(Exception, match="older than the version"):
        scd2_merge(dim, older, "k", ["tier"], change_time_col="ts").collect()
    twice = spark.createDataFrame([(1, at(8), "b", at(1)), (1, at(9), "c", at(1))], STATE)
    with pytest.raises(Exception, match="duplicate key in snapshot"):
        scd2_merge(dim, twice, "k", ["tier"], change_time_col="ts").collect()
    job = Scd2Load(spark, scratch, "dim", "k", ["tier"])
    job.run(older, load_time="2026-02-01 00:00:00")
    with pytest.raises(ValueError, match="before that of the last load"):
        job.run(twice, load_time="2026-01-01 00:00:00")


def test_duplicate_keys_change_nothing(spark, scratch):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    twice = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z")], "k long, v string")
    with pytest.raises(Exception, match="duplicate key in source: 1"):
        upsert(target, twice, "k", ["v"]).collect()
    write_batches({1: twice}, f"{scratch}/deltas")
    led = BatchLedger(spark, f"{scratch}/wh", f"{scratch}/deltas", "t", "k")
    led.initialise(target)
    with pytest.raises(Exception, match="duplicate key in source: 1"):
        led.apply_next()
    assert led.status() == (1, [1]) and sorted(map(tuple, led.read().collect())) == [(1, "a", 0), (2, "b", 0)]


def test_commit_files_are_whole_or_absent(spark, scratch, monkeypatch):
    cat = Catalog(spark, scratch)
    cat.publish("t", {"rows": spark.range(2)})
    monkeypatch.setattr(os, "link", lambda a, b: (_ for _ in ()).throw(OSError("power cut")))
    with pytest.raises(OSError):
        cat.publish("t", {"rows": spark.range(9)})
    monkeypatch.undo()
    assert cat.read("t", "rows").count() == 2
    cat.publish("t", {"rows": spark.range(3)})
    assert [json.loads(open(f"{scratch}/t/_commits/{f}").read())["seq"] for f in sorted(os.listdir(f"{scratch}/t/_commits")) if f.endswith(".json")] == [1, 2]
    with pytest.raises(CommitConflict):
        cat.fs.create_new(f"{scratch}/t/_commits/{1:012d}.json", "{}")
    tx = cat.begin("t")
    tx.write("rows", spark.range(5))                     # a load still running
    assert cat.vacuum("t", keep=1, older_than=3600) == []
    tx.commit()
    assert cat.read("t", "rows").count() == 5


def test_stream_upsert_rewrites_touched_buckets(spark, scratch):
    schema = "k long, ts timestamp_ntz, v string"
    t = dt.datetime(2026, 1, 1)
    big = spark.range(4000).select(F.col("id").alias("k"), F.lit(t).cast("timestamp_ntz").alias("ts"), F.sha2(F.col("id").cast("string"), 512).alias("v"))
    write_landing([big.coalesce(1), spark.createDataFrame([(7, t + dt.timedelta(days=1), "new")], schema).coalesce(1)], f"{scratch}/landing")
    cat = Catalog(spark, f"{scratch}/wh")
    upsert_stream(spark, f"{scratch}/landing", big.schema, cat, "t", "k", ["ts"], ["ts", "v"], f"{scratch}/ckpt", files_per_trigger=1, target_bytes=20_000)
    one, two = cat.history("t")
    first, last = (d["tables"]["rows"]["partitions"] for d in (one, two))
    grown = two["meta"]["buckets"]["rows"] - one["meta"]["buckets"]["rows"]          # each split rewrites one bucket as two
    assert len(first) > 10 and sum(first.get(b) != p for b, p in last.items()) <= 1 + 2 * grown < len(last)
    got = read_target(cat, "t")
    assert got.count() == 4000 and got.where("v = 'new'").first().k == 7


def test_dedup_reads_only_slices_that_can_hold_its_keys(spark, scratch):
    deliveries = [spark.range(k * 1000, k * 1000 + 1000).coalesce(1).withColumnRenamed("id", "event_id") for k in range(5)]
    deliveries.append(spark.range(1500, 1600).unionByName(spark.range(9000, 9100)).coalesce(1).withColumnRenamed("id", "event_id"))
    write_landing(deliveries, f"{scratch}/landing")
    dedup_stream(spark, f"{scratch}/landing", deliveries[0].schema, ["event_id"], f"{scratch}/sink", f"{scratch}/ckpt", files_per_trigger=1)
    got = spark.read.parquet(f"{scratch}/sink")
    assert got.count() == got.distinct().count() == 5100
    notes = [json.load(open(f"{scratch}/sink/_slices/{f}")) for f in sorted(os.listdir(f"{scratch}/sink/_slices")) if f.endswith(".json")]
    assert [n["rows"] for n in notes] == [1000] * 5 + [100]
    held = len(notes[1]["files"])
    empty = notes[0]["read"]                              # the sink's first, empty file has no filter and is always read
    assert held <= notes[-1]["read"] - empty < sum(len(n["files"]) for n in notes[:-1])
