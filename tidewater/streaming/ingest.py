"""Structured Streaming twins of the incremental loads.

* :func:`append_stream` - each landed row exactly once: file source +
  checkpoint; ``availableNow`` processes what is there and stops, and a run
  with no new file runs no batch.
* :func:`upsert_stream` - ``foreachBatch``: dedup the micro-batch to the
  latest row per key, upsert the buckets it touches of the published target
  and record the batch id *in the same commit*, so a replayed batch after a
  crash is skipped.
* :func:`scd2_stream` - ``foreachBatch``: states of the source in any order,
  spliced into a slowly changing dimension, with the batch id in the commit.
* :func:`dedup_stream` - repeated deliveries: ``foreachBatch``: each key once,
  however late its first delivery comes; a batch reads only those slices of
  the sink that can hold its keys.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.jobs import Scd2Load, _Bucketed
from tidewater.operators.loads import latest_per_key, upsert
from tidewater.operators.sequence import materialize, written
from tidewater.sources.buckets import TARGET_BYTES
from tidewater.sources.publish import Catalog, _FS


def write_landing(batches: list[DataFrame], landing: str, start: int = 0) -> None:
    """Land numbered files (one folder per delivery) for a file-source stream."""
    for i, df in enumerate(batches, start=start):
        df.write.mode("overwrite").parquet(f"{landing}/delivery={i:04d}")


def _reader(spark: SparkSession, landing: str, schema, files_per_trigger: int | None):
    r = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return r.parquet(landing)


def _batches_done(spark: SparkSession, checkpoint: str) -> int:
    return len([n for n in _FS(spark).children(f"{checkpoint}/commits") if n.isdigit()])


def append_stream(spark: SparkSession, landing: str, schema, sink: str, checkpoint: str,
                  files_per_trigger: int | None = None) -> int:
    """Run until the landed files are consumed; returns the number of batches run, as the checkpoint counts them."""
    before = _batches_done(spark, checkpoint)
    q = (_reader(spark, landing, schema, files_per_trigger).writeStream.format("parquet")
         .option("path", sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return _batches_done(spark, checkpoint) - before


def _run_batches(spark: SparkSession, landing: str, schema, checkpoint: str, files_per_trigger: int | None, apply) -> None:
    q = (_reader(spark, landing, schema, files_per_trigger).writeStream.foreachBatch(apply)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def _noted(tx, stream: str, batch_id: int) -> dict | None:
    """The meta that records the batch, or None if a commit has it: a replay is already applied."""
    streams = tx.meta.get("streams", {})
    return None if batch_id <= streams.get(stream, -1) else {"streams": {**streams, stream: batch_id}}


class _StreamTarget(_Bucketed):
    def __init__(self, catalog: Catalog, dataset: str, key: str, target_bytes: int):
        self._open(catalog.spark, catalog.root, dataset, key, 1, target_bytes)


def upsert_stream(spark: SparkSession, landing: str, schema, catalog: Catalog, dataset: str, key: str,
                  order_cols: list[str], update_cols: list[str], checkpoint: str,
                  files_per_trigger: int | None = None, target_bytes: int = TARGET_BYTES) -> None:
    """The target, in hash buckets of the key; read it with :func:`read_target`."""
    missing = [c for c in order_cols if c not in update_cols]
    if missing:
        raise ValueError(f"order columns {missing} must be updated too: later batches are compared with them")
    stream = checkpoint.rstrip("/")     # batch numbers count within one checkpoint
    target = _StreamTarget(catalog, dataset, key, target_bytes)

    def apply(batch: DataFrame, batch_id: int) -> None:
        tx = catalog.begin(dataset)
        note = _noted(tx, stream, batch_id)
        if note is None:
            return
        latest, path = written(latest_per_key(batch, key, order_cols))
        now, then, split = target._grow(tx.base, "rows", catalog.fs.size(path))
        touched = target._hit(latest, now) | split
        cur = target._read("rows", tx.base, touched)
        if cur is not None:
            # a version older than the target's comes late: the target stays
            have = cur.select(F.col(key).alias("__key"), F.struct(*order_cols).alias("__have"))
            latest = (latest.join(have, F.col(key) == F.col("__key"), "left")
                      .where(F.col("__have").isNull() | (F.struct(*order_cols) > F.col("__have"))).select(*cur.columns))
        if touched:
            target._write(tx, "rows", latest if cur is None else upsert(cur, latest, key, update_cols), now, then, touched)
        tx.commit({"op": "stream_upsert"} | note)

    _run_batches(spark, landing, schema, checkpoint, files_per_trigger, apply)


def scd2_stream(spark: SparkSession, landing: str, schema, job: Scd2Load, checkpoint: str,
                files_per_trigger: int | None = None) -> None:
    """Splice each micro-batch of source states, in whatever order they come, into the job's dimension."""
    if not job.change_time_col:
        raise ValueError("a stream of states needs their source time")
    stream = checkpoint.rstrip("/")

    def apply(batch: DataFrame, batch_id: int) -> None:
        tx = job.catalog.begin(job.dataset)
        note = _noted(tx, stream, batch_id)
        if note is None:
            return
        job.prepare(batch, tx)
        tx.commit({"op": "scd2_stream"} | note)

    _run_batches(spark, landing, schema, checkpoint, files_per_trigger, apply)


#: Hash classes of a slice's key filter; about ten bits a key keep one in a hundred foreign keys.
_PROBES = 4


def _bits_of(id_cols: list[str], bits: int) -> Column:
    """Places of a key in a filter of ``bits`` bits."""
    return F.array(*[F.pmod(F.xxhash64(F.lit(i), *[F.col(c) for c in id_cols]), F.lit(bits)) for i in range(_PROBES)])


def _bits_for(n: int) -> int:
    return max(1 << 10, 1 << (10 * max(1, n)).bit_length())


def key_filter(rows: DataFrame, id_cols: list[str], bits: int) -> DataFrame:
    """(word, mask): the set bits of the rows' keys, 64 to a word; a frame of at most bits / 64 rows."""
    at = rows.select(F.explode(F.array_distinct(_bits_of(id_cols, bits))).alias("at"))
    return at.select(F.expr("at div 64").alias("word"), F.expr("shiftleft(1L, cast(at % 64 as int))").alias("mask")) \
        .groupBy("word").agg(F.bit_or("mask").alias("mask"))


def dedup_stream(spark: SparkSession, landing: str, schema, id_cols: list[str],
                 sink: str, checkpoint: str, files_per_trigger: int | None = None) -> None:
    """Each key of ``id_cols`` once, its first delivery, however late.

    The sink is a plain Parquet folder; the files that a batch adds are a
    slice, and beside the files (``_filters``, ``_slices``) lies a filter of
    hashed key bits for each slice.  A batch first tests its keys against the
    filters; only slices of which a key passes are read, and only their key
    columns, for the exact anti-join.  Resent keys lie in few slices and new
    keys pass few filters by chance, so a batch's cost follows its own size
    and the filters' (about a byte a key), not the sink's.  Keys and filters
    are shuffled, never broadcast.

    Files without a filter (of an attempt that failed, or of an older sink)
    are always read, so a replayed batch finds its own rows and adds only
    what is missing.
    """
    fs = _FS(spark)
    if fs.exists(f"{sink}/_spark_metadata"):
        raise ValueError(f"{sink} was written by a file sink, whose log would hide new rows")

    def files() -> set[str]:
        return {n for n in fs.children(sink) if n.endswith(".parquet")}

    def apply(batch: DataFrame, batch_id: int) -> None:
        rows = materialize(batch.dropDuplicates(id_cols))
        slices = {n[:-len(".json")]: json.loads(fs.read_text(f"{sink}/_slices/{n}"))
                  for n in fs.children(f"{sink}/_slices") if n.endswith(".json")}
        before = files()
        suspects = _suspect_slices(spark, sink, slices, rows, id_cols)
        unread = before.difference(*[s["files"] for s in slices.values()])
        paths = [f"{sink}/{f}" for f in sorted(unread.union(*[slices[s]["files"] for s in suspects]))]
        if paths:
            have = spark.read.schema(schema).parquet(*paths).select(*[F.col(c).alias(f"__{c}") for c in id_cols])
            same = F.lit(True)
            for c in id_cols:
                same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
            # keys and filters grow with the sink, and files look smaller than their rows: neither goes through the driver
            rows = materialize(rows.join(have.hint("merge"), same, "left_anti"))
        n = rows.count()
        if n:
            rows.write.mode("append").parquet(sink)
            name, bits = f"{len(slices):08d}-{uuid.uuid4().hex[:8]}", _bits_for(n)
            key_filter(rows, id_cols, bits).write.parquet(f"{sink}/_filters/{name}")
            fs.create_new(f"{sink}/_slices/{name}.json", json.dumps({"bits": bits, "rows": n, "read": len(paths), "files": sorted(files() - before)}))

    spark.createDataFrame([], schema).write.mode("append").parquet(sink)     # a sink also if nothing lands
    _run_batches(spark, landing, schema, checkpoint, files_per_trigger, apply)


def _suspect_slices(spark: SparkSession, sink: str, slices: dict, rows: DataFrame, id_cols: list[str]) -> set[str]:
    """Slices whose filter lets a key of the rows pass: one name per slice reaches the driver."""
    keys = rows.select(*id_cols, F.monotonically_increasing_id().alias("__row"))
    found = None
    for bits in sorted({s["bits"] for s in slices.values()}):             # filters of one size are tested together
        paths = [f"{sink}/_filters/{name}" for name, s in slices.items() if s["bits"] == bits]
        own = spark.read.schema("word bigint, mask bigint").parquet(*paths).select(
            "word", "mask", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2).alias("slice"))
        at = (keys.select("__row", F.posexplode(_bits_of(id_cols, bits)).alias("nth", "at"))
              .select("__row", F.expr("at div 64").alias("word"), F.expr("shiftleft(1L, cast(at % 64 as int))").alias("bit")))
        hit = at.join(own.hint("merge"), "word").where(F.col("mask").bitwiseAND(F.col("bit")) != 0)
        passed = hit.groupBy("__row", "slice").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == _PROBES).select("slice").distinct()
        found = passed if found is None else found.unionByName(passed)
    return {r[0] for r in found.distinct().collect()} if found is not None else set()


def read_target(catalog: Catalog, dataset: str) -> DataFrame:
    """The rows of a stream's target, without their bucket."""
    return catalog.read(dataset, "rows").drop("__bucket")
