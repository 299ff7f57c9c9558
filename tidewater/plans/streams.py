"""Streaming keys: the events table is landed as numbered
deliveries (split by event time), consumed by a stream, and the sink is read
back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidewater.functions import money
from tidewater.jobs import Scd2Load
from tidewater.plans.loads import SCD2_EVENTS_SQL
from tidewater.plans.registry import register
from tidewater.session import scratch_root
from tidewater.sources import Tables
from tidewater.sources.publish import Catalog
from tidewater.streaming import append_stream, dedup_stream, scd2_stream, upsert_stream, write_landing

# Delivery boundaries (event time) of the landed files.
CUTS = ("2024-01-08 00:00:00", "2024-01-16 00:00:00", "2024-01-24 00:00:00")


def _deliveries(events):
    e = events.select("event_id", "ts", "user_id", "event_type", "value")
    edges = [None, *CUTS, None]
    out = []
    for lo, hi in zip(edges[:-1], edges[1:]):
        d = e
        if lo:
            d = d.filter(F.col("ts") >= F.lit(lo).cast("timestamp_ntz"))
        if hi:
            d = d.filter(F.col("ts") < F.lit(hi).cast("timestamp_ntz"))
        out.append(d)
    return out


def _root(spark, tag):
    return f"{scratch_root(spark)}/{tag}-{uuid.uuid4().hex[:10]}"


def _each_landed(parts, landing, run, start=0):
    """Land one delivery after another and run the stream on each: a batch is a delivery, in however many files it comes.

    With a batch per file the number of batches grows with the table, and each meets the whole target again.
    """
    for k, part in enumerate(parts, start=start):
        write_landing([part], landing, start=k)
        run()


@register("stream_append", "SELECT event_id, ts, user_id, event_type, value FROM events")
def stream_append(spark, sf_dir):
    """Each landed row once: a run for each delivery, and a last one without new files, which runs no batch."""
    ev = Tables(spark, sf_dir).events
    root = _root(spark, "stream-append")
    parts = _deliveries(ev)
    schema = parts[0].schema
    _each_landed(parts, f"{root}/landing", lambda: append_stream(spark, f"{root}/landing", schema, f"{root}/sink", f"{root}/ckpt"))
    idle = append_stream(spark, f"{root}/landing", schema, f"{root}/sink", f"{root}/ckpt")
    assert idle == 0, "a run without new files must not process rows"
    return spark.read.schema(schema).parquet(f"{root}/sink")


@register("stream_upsert", """
SELECT user_id, event_type, ts, CAST(value AS DECIMAL(18,2)) AS amount FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) x
WHERE rn = 1
""")
def stream_upsert(spark, sf_dir):
    """foreachBatch upsert of the latest row per user, batch id committed with the data."""
    ev = Tables(spark, sf_dir).events
    root = _root(spark, "stream-upsert")
    parts = [p.select("user_id", "event_id", "ts", "event_type", money("value").alias("amount")) for p in _deliveries(ev)]
    cat = Catalog(spark, f"{root}/warehouse")
    _each_landed(parts, f"{root}/landing", lambda: upsert_stream(
        spark, f"{root}/landing", parts[0].schema, cat, "users", "user_id", ["ts", "event_id"],
        ["event_id", "ts", "event_type", "amount"], f"{root}/ckpt"))
    return cat.read("users", "rows").select("user_id", "event_type", "ts", "amount")


@register("stream_dedup", "SELECT event_id, ts, user_id, event_type, value FROM events")
def stream_dedup(spark, sf_dir):
    """Every delivery is sent twice (a retry in the next file); the dedup
    emits each event once, however late its first delivery comes."""
    ev = Tables(spark, sf_dir).events
    root = _root(spark, "stream-dedup")
    parts = _deliveries(ev)
    resent = [parts[0]] + [p.unionByName(q) for p, q in zip(parts[1:], parts[:-1])] + [parts[-1]]
    _each_landed(resent, f"{root}/landing", lambda: dedup_stream(
        spark, f"{root}/landing", parts[0].schema, ["event_id"], f"{root}/sink", f"{root}/ckpt"))
    return spark.read.schema(parts[0].schema).parquet(f"{root}/sink")


@register("stream_scd2", SCD2_EVENTS_SQL)
def stream_scd2(spark, sf_dir):
    """Every event is a state of its user; they come shuffled, some twice, and the
    dimension is the one that the events in source order give."""
    ev = Tables(spark, sf_dir).events.select("user_id", "event_id", "ts", "event_type")
    states = ev.withColumn("tier", F.col("event_type")).drop("event_type")
    root = _root(spark, "stream-scd2")
    shuffled = F.pmod(F.xxhash64("event_id"), F.lit(3))
    parts = [states.where(shuffled == k) for k in (2, 0, 1)]
    resent = parts[1].unionByName(parts[0].where(F.col("event_id") % 5 == 0))
    job = Scd2Load(spark, f"{root}/warehouse", "dim_user", "user_id", ["tier"], change_time_col="ts")
    _each_landed([parts[0], resent, parts[2]], f"{root}/landing", lambda: scd2_stream(
        spark, f"{root}/landing", parts[0].schema, job, f"{root}/ckpt"))
    return job.read().drop("sk")
