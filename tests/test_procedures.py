"""Procedural tests: re-runs change nothing, each batch applies once,
tampered inputs are refused, replayed stream batches are skipped."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidewater.jobs import Scd2Load
from tidewater.operators.scd2 import check_contiguous, check_one_current
from tidewater.sources.batches import BatchLedger, StepGap, write_batches
from tidewater.sources.publish import Catalog
from tidewater.sources.verified import DigestMismatch, build_manifest, verified_load
from tidewater.streaming import upsert_stream, write_landing

SNAP = "customer_id long, tier string, status string, updated_at timestamp_ntz, registered_at timestamp_ntz"


def snap(spark, rows):
    ts = dt.datetime.fromisoformat
    return spark.createDataFrame([(k, t, s, ts(u), ts(r)) for k, t, s, u, r in rows], SNAP)


def test_scd2_source_time_procedure(spark, scratch):
    job = Scd2Load(spark, scratch, "dim", "customer_id", ["tier", "status"],
                   change_time_col="updated_at", first_time_col="registered_at")
    s1 = [(1, "bronze", "active", "2026-01-05 10:00", "2026-01-01 09:00"),
          (2, "silver", "active", "2026-01-06 10:00", "2026-01-02 09:00")]
    job.run(snap(spark, s1))
    job.run(snap(spark, s1))                                    # re-run: nothing new
    assert job.read().count() == 2
    first = {r.customer_id: r.valid_from for r in job.read().collect()}
    assert first[1] == dt.datetime(2026, 1, 1, 9)               # first version from registered_at
    # updated_at moves but tier/status do not: no version
    s2 = [(1, "bronze", "active", "2026-02-01 10:00", "2026-01-01 09:00"),
          (2, "gold", "active", "2026-02-03 12:00", "2026-01-02 09:00"),
          (3, "bronze", "active", "2026-02-04 08:00", "2026-02-04 08:00")]
    job.run(snap(spark, s2))
    dim = job.read()
    assert dim.count() == 4
    v2 = dim.filter("customer_id = 2").orderBy("valid_from").collect()
    assert v2[0].valid_to == v2[1].valid_from == dt.datetime(2026, 2, 3, 12)   # closed at the source time
    assert check_one_current(dim, "customer_id").first().violations == 0
    assert check_contiguous(dim, "customer_id").first().violations == 0


def test_batches_apply_exactly_once(spark, scratch):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    write_batches({1: spark.createDataFrame([(2, "B"), (3, "c")], "k long, v string"),
                   2: spark.createDataFrame([(1, "A")], "k long, v string")}, f"{scratch}/deltas")
    led = BatchLedger(spark, f"{scratch}/wh", f"{scratch}/deltas", "t", "k", n_buckets=4)
    led.initialise(base)
    assert led.apply_next() == 1
    assert led.apply_next() == 2
    assert led.apply_next() is None                             # exhausted: a no-op
    got = {r.k: (r.v, r.applied_step) for r in led.read().collect()}
    assert got == {1: ("A", 2), 2: ("B", 1), 3: ("c", 1)}
    # a late batch is picked up next, the applied ones never again
    write_batches({3: spark.createDataFrame([(4, "d")], "k long, v string")}, f"{scratch}/deltas")
    assert led.apply_next() == 3 and led.apply_next() is None
    assert led.read().count() == 4
    # step 5 must wait for step 4
    write_batches({5: spark.createDataFrame([(4, "e")], "k long, v string")}, f"{scratch}/deltas")
    with pytest.raises(StepGap):
        led.apply_next()
    assert led.status() == (4, [5])
    write_batches({4: spark.createDataFrame([(4, "f")], "k long, v string")}, f"{scratch}/deltas")
    assert led.apply_next() == 4 and led.apply_next() == 5 and {r.k: r.v for r in led.read().collect()}[4] == "e"


def test_verified_load_refuses_tampered_file(spark, scratch):
    src = f"{scratch}/data"
    spark.range(10).write.parquet(src)
    build_manifest(spark, [src], f"{scratch}/manifest")
    df, rep = verified_load(spark, src, f"{scratch}/manifest")
    assert df.count() == 10 and rep["matched"] >= 1
    victim = sorted(f for f in os.listdir(src) if f.endswith(".parquet"))[0]
    spark.range(3).coalesce(1).write.parquet(f"{scratch}/other")
    other = [f for f in os.listdir(f"{scratch}/other") if f.endswith(".parquet")][0]
    os.replace(f"{scratch}/other/{other}", f"{src}/{victim}")   # content changed behind the manifest
    crc = f"{src}/.{victim}.crc"
    if os.path.exists(crc):
        os.remove(crc)                                          # local FS checksum of the old content
    with pytest.raises(DigestMismatch):
        verified_load(spark, src, f"{scratch}/manifest")


def test_stream_upsert_skips_replayed_batch(spark, scratch):
    ts = dt.datetime.fromisoformat
    schema = "k long, ts timestamp_ntz, v string"
    d0 = spark.createDataFrame([(1, ts("2026-01-01 00:00"), "a"), (1, ts("2026-01-01 01:00"), "b")], schema)
    d1 = spark.createDataFrame([(2, ts("2026-01-02 00:00"), "c"), (1, ts("2026-01-02 00:00"), "z")], schema)
    write_landing([d0, d1], f"{scratch}/landing")
    cat = Catalog(spark, f"{scratch}/wh")
    upsert_stream(spark, f"{scratch}/landing", d0.schema, cat, "t", "k", ["ts"], ["ts", "v"],
                  f"{scratch}/ckpt", files_per_trigger=1)
    first = {r.k: r.v for r in cat.read("t", "rows").collect()}
    assert first == {1: "z", 2: "c"}
    seq = cat.current("t")["seq"]
    # a crash after the commit but before the stream noted the batch as done:
    # the same checkpoint runs batch 1 again, which must not commit again
    os.remove(f"{scratch}/ckpt/commits/1")
    if os.path.exists(f"{scratch}/ckpt/commits/.1.crc"):
        os.remove(f"{scratch}/ckpt/commits/.1.crc")
    upsert_stream(spark, f"{scratch}/landing", d0.schema, cat, "t", "k", ["ts"], ["ts", "v"],
                  f"{scratch}/ckpt", files_per_trigger=1)
    assert cat.current("t")["seq"] == seq


def test_stream_upsert_keeps_newer_rows_and_takes_other_streams(spark, scratch):
    ts = dt.datetime.fromisoformat
    schema = "k long, ts timestamp_ntz, v string"
    rows = [[(1, ts("2026-01-02 00:00"), "new")], [(1, ts("2026-01-01 00:00"), "stale"), (2, ts("2026-01-01 00:00"), "x")]]
    write_landing([spark.createDataFrame(r, schema) for r in rows], f"{scratch}/landing")
    cat = Catalog(spark, f"{scratch}/wh")
    args = (spark.createDataFrame([], schema).schema, cat, "t", "k", ["ts"], ["ts", "v"])
    upsert_stream(spark, f"{scratch}/landing", *args, f"{scratch}/ckpt", files_per_trigger=1)
    assert {r.k: r.v for r in cat.read("t", "rows").collect()} == {1: "new", 2: "x"}
    # another stream into the same table counts its batches from 0 again
    write_landing([spark.createDataFrame([(9, ts("2026-01-03 00:00"), "y")], schema)], f"{scratch}/other")
    upsert_stream(spark, f"{scratch}/other", *args, f"{scratch}/ckpt-other")
    assert {r.k: r.v for r in cat.read("t", "rows").collect()} == {1: "new", 2: "x", 9: "y"}
    with pytest.raises(ValueError):
        upsert_stream(spark, f"{scratch}/other", args[0], cat, "t", "k", ["ts"], ["v"], f"{scratch}/ckpt-3")
