"""Exactly-once application of numbered change batches.

Batches land as ``<deltas>/step=NN/`` Parquet folders.  The warehouse keeps a
ledger of applied steps *in the same commit* as the data, so a batch and its
ledger row become visible together; the next call picks the lowest step not
in the ledger, and returns ``None`` (writing nothing) once all are applied.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.jobs import _Bucketed
from tidewater.operators.loads import one_per_key, upsert
from tidewater.operators.sequence import written
from tidewater.sources.buckets import TARGET_BYTES
from tidewater.sources.publish import _FS

LEDGER_SCHEMA = "step int, n_rows bigint, run_id string"


def write_batches(batches: dict[int, DataFrame], deltas_root: str) -> None:
    for step, df in sorted(batches.items()):
        df.write.mode("overwrite").parquet(f"{deltas_root}/step={step:02d}")


class StepGap(RuntimeError):
    """The next step is missing while later ones are there."""


class BatchLedger(_Bucketed):
    """A table in hash buckets of its key, and the ledger of the steps applied to it."""

    def __init__(self, spark: SparkSession, warehouse: str, deltas_root: str, dataset: str, key: str,
                 update_cols: list[str] | None = None, n_buckets: int = 1, target_bytes: int = TARGET_BYTES):
        self._open(spark, warehouse, dataset, key, n_buckets, target_bytes)
        self.deltas = deltas_root.rstrip("/")
        self.update_cols = update_cols

    def initialise(self, base: DataFrame) -> dict:
        """Publish the base table in hash buckets of the key, with an empty ledger."""
        rows, path = written(one_per_key(base, self.key, "base table").withColumn("applied_step", F.lit(0).cast("int")))
        tx = self.catalog.begin(self.dataset)
        now, then, _ = self._grow(None, "rows", self.catalog.fs.size(path))
        self._write(tx, "rows", rows, now, then, set(range(then.n)))
        tx.write("ledger", self.spark.createDataFrame([], LEDGER_SCHEMA))
        return tx.commit({"op": "initialise"})

    def available(self) -> list[int]:
        names = _FS(self.spark).children(self.deltas)
        return sorted(int(n.split("=")[1]) for n in names if n.startswith("step="))

    def status(self, snapshot: dict | None = None) -> tuple[int, list[int]]:
        """The step that is next, and the later or equal steps that are there."""
        snapshot = snapshot or self.catalog.begin(self.dataset).base
        last = self.catalog.read(self.dataset, "ledger", snapshot).agg(F.max("step")).first()[0] or 0
        return last + 1, [s for s in self.available() if s > last]

    def apply_next(self) -> int | None:
        """Apply the step after the last one; a step that is missing must not be jumped.

        A step with two rows of one key fails and changes nothing.
        """
        tx = self.catalog.begin(self.dataset)
        snap = tx.base
        step, waiting = self.status(snap)
        if not waiting:
            return None
        if waiting[0] != step:
            raise StepGap(f"step {step} is next but not there; {waiting} wait")
        folder = f"{self.deltas}/step={step:02d}"
        batch = self.spark.read.parquet(folder).withColumn("applied_step", F.lit(step).cast("int"))
        # only the buckets this batch touches, and those its bytes split, are read and rewritten
        now, then, split = self._grow(snap, "rows", self.catalog.fs.size(folder))
        stats = batch.agg(F.count(F.lit(1)).alias("n"), F.collect_set(now.bucket(self.key)).alias("b")).first()
        touched = set(stats["b"]) | split
        if touched:
            rows = self._read("rows", snap, touched)
            upd = self.update_cols or [c for c in rows.columns if c != self.key]
            self._write(tx, "rows", upsert(rows, batch.select(*rows.columns), self.key, upd), now, then, touched)
        tx.append("ledger", self.spark.createDataFrame([(step, stats["n"], tx.run_id)], LEDGER_SCHEMA))
        tx.commit({"op": "apply_batch", "step": step})
        return step

    def read(self) -> DataFrame:
        return self.catalog.read(self.dataset, "rows").drop("__bucket")
