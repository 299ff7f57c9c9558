"""Re-runnable load jobs that publish.

Every job reads its state (watermark, log, target) from the last commit of
its dataset, computes the new state as DataFrames and publishes target, log
and watermark in **one** commit.  A failure anywhere before the commit leaves
the previous version current and a retry recomputes from it; an immediate
re-run finds nothing new and logs 0 / 0.

Targets of upserting jobs are stored in hash buckets of the key (one
partition per bucket): a run reads and rewrites only the buckets its delta
touches and carries the others over by reference.  The number of buckets grows
with the table's bytes, so that the rewritten share falls as a table grows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.loads import change_counts, latest_per_key, one_per_key, slice_lower, upsert
from tidewater.operators.quality import gate, suite
from tidewater.operators.rewrite import apply_deltas, validate_transfer
from tidewater.operators.scd2 import changed_keys, empty_dimension, scd2_merge, splice, states, unknown_states, unseen_states
from tidewater.operators.sequence import materialize, written
from tidewater.sources.buckets import TARGET_BYTES, BucketDirectory
from tidewater.sources.publish import Catalog, CommitConflict

EPOCH = "1970-01-01 00:00:00"
LOG_SCHEMA = ("load_id bigint, table_name string, wm_from timestamp_ntz, wm_to timestamp_ntz, "
              "rows_new bigint, rows_changed bigint, run_id string")
WM_SCHEMA = "table_name string, watermark_value timestamp_ntz"
#: Buckets that a load splits beyond those its own rows call for, when it brings less than the table holds.
MOST_SPLITS = 64


class _Bucketed:
    """A target in hash buckets of its key, whose directory grows with its bytes (``sources.buckets``).

    ``n_buckets`` is the number to begin with.
    """

    def _open(self, spark: SparkSession, root: str, dataset: str, key: str, n_buckets: int, target_bytes: int) -> None:
        self.spark, self.catalog = spark, Catalog(spark, root)
        self.dataset, self.key, self.n_buckets, self.target_bytes = dataset, key, n_buckets, target_bytes

    def _directory(self, snap: dict | None, table: str) -> BucketDirectory:
        return BucketDirectory((snap or {}).get("meta", {}).get("buckets", {}).get(table, self.n_buckets))

    def _grow(self, snap: dict | None, rows: str, coming: int) -> tuple[BucketDirectory, BucketDirectory, set[int]]:
        """The directory of the last commit, the one to write by, and the buckets that it splits."""
        now = self._directory(snap, rows)
        held = sum(snap["tables"][rows].get("bytes", {}).values()) if snap and rows in snap["tables"] else 0
        then, split = now.for_bytes(held, coming, self.target_bytes, None if coming >= held else MOST_SPLITS)
        return now, then, split

    def _hit(self, df: DataFrame, directory: BucketDirectory) -> set[int]:
        """The buckets that the rows fall into: at most as many numbers as the table has buckets."""
        return {r[0] for r in df.select(directory.bucket(self.key).alias("b")).distinct().collect()}

    def _read(self, table: str, snap: dict | None, buckets: set[int] | None = None) -> DataFrame | None:
        df = self.catalog.read(self.dataset, table, snap, partitions=buckets) if snap else None
        return df.drop("__bucket") if df is not None else None

    def _write(self, tx, table: str, df: DataFrame, now: BucketDirectory, then: BucketDirectory, touched: set[int]) -> None:
        replaced = touched | set(range(now.n, then.n))
        tx.write_partitions(table, df.withColumn("__bucket", then.bucket(self.key)), "__bucket", replace=set(map(str, replaced)))
        tx.meta = tx.meta | {"buckets": tx.meta.get("buckets", {}) | {table: then.n}}


class WatermarkLoad(_Bucketed):
    """``(wm_from - lookback, wm_to]`` slice of a mutable source, upserted.

    The slice is read once and written aside, which freezes it: ``wm_to`` is
    its maximum, so rows that land during the load belong to the next run.
    ``rows_changed`` counts only rows whose values differ from the target, so
    a lookback that re-reads loaded rows reports 0.
    """

    def __init__(self, spark: SparkSession, root: str, table: str, key: str, ts_col: str,
                 update_cols: list[str], lookback: str | None = None, n_buckets: int = 1,
                 target_bytes: int = TARGET_BYTES, dataset: str | None = None):
        """``dataset``: a dataset shared with other loads, in which the tables bear the load's name."""
        self._open(spark, root, dataset or table, key, n_buckets, target_bytes)
        self.table, self.ts_col, self.update_cols, self.lookback = table, ts_col, update_cols, lookback
        self._rows, self._log = (table, f"{table}_log") if dataset else ("rows", "log")

    def prepare(self, source: DataFrame, tx) -> dict | None:
        """Write the load's result into ``tx``; None if the source is empty."""
        snap = tx.base if tx.base and self.table in tx.base["meta"].get("loads", {}) else None
        done = snap["meta"]["loads"][self.table] if snap else {"load_id": 0, "watermark": EPOCH}
        wm_from = dt.datetime.fromisoformat(done["watermark"])
        # several versions of one key in the slice: keep the latest (an upsert
        # with duplicate keys would be order-dependent); combined map-side
        part = source.where(F.col(self.ts_col) > slice_lower(wm_from, self.lookback))
        delta, path = written(latest_per_key(part, self.key, [self.ts_col]))
        now, then, split = self._grow(snap, self._rows, self.catalog.fs.size(path))
        stats = delta.agg(F.max(self.ts_col).alias("wm_to"), F.collect_set(now.bucket(self.key)).alias("b")).first()
        wm_to, touched = stats["wm_to"], set(stats["b"])
        if wm_to is None:                              # nothing in the slice: is there anything at all?
            wm_to = source.agg(F.max(self.ts_col)).first()[0]
            if wm_to is None:
                return None
            then, split = now, set()
        touched |= split
        old = self._read(self._rows, snap, touched)
        if old is None:
            old = self.spark.createDataFrame([], delta.schema)
        counts = change_counts(old, delta, self.key, self.update_cols).first()
        if touched:
            self._write(tx, self._rows, upsert(old.select(*delta.columns), delta, self.key, self.update_cols), now, then, touched)
        run = {"load_id": done["load_id"] + 1, "wm_from": wm_from, "wm_to": wm_to,
               "rows_new": counts["rows_new"], "rows_changed": counts["rows_changed"]}
        row = [(run["load_id"], self.table, wm_from, wm_to, run["rows_new"], run["rows_changed"], tx.run_id)]
        tx.append(self._log, self.spark.createDataFrame(row, LOG_SCHEMA))
        tx.meta = tx.meta | {"loads": tx.meta.get("loads", {}) | {
            self.table: {"load_id": run["load_id"], "watermark": wm_to.isoformat(sep=" ")}}}
        return run

    def run(self, source: DataFrame) -> dict:
        tx = self.catalog.begin(self.dataset)
        run = self.prepare(source, tx)
        if run is None:                                # empty source: keep the mark
            return {"skipped": True}
        tx.commit({"op": "watermark_load"})
        return run

    def target(self, snapshot: dict | None = None) -> DataFrame:
        return self.catalog.read(self.dataset, self._rows, snapshot).drop("__bucket")

    def log(self, snapshot: dict | None = None) -> DataFrame:
        return self.catalog.read(self.dataset, self._log, snapshot)

    def watermark(self) -> DataFrame:
        """One row (table_name, watermark_value)."""
        mark = self.catalog.current(self.dataset)["meta"]["loads"][self.table]["watermark"]
        return self.spark.createDataFrame([(self.table, dt.datetime.fromisoformat(mark))], WM_SCHEMA)


class RangeReload:
    """Delete a closed date range and insert the recomputed rows, as
    one commit.

    The fact is stored in partitions of ``grain`` ("day", "month" or "year")
    of the date column.  A reload reads only the partitions overlapping the
    range, keeps their rows outside the range, adds the fresh rows and
    replaces exactly those partitions; the others are carried over by
    reference.  Days of the range without fresh rows disappear, as with the
    reference's DELETE.  Pick the grain so that one partition is a few
    hundred MB or more: "day" for a large fact, "month" for a small one.
    """

    def __init__(self, spark: SparkSession, root: str, table: str, date_col: str, grain: str = "day"):
        if grain not in ("day", "month", "year"):
            raise ValueError(grain)
        self.catalog = Catalog(spark, root)
        self.table, self.date_col, self.grain = table, date_col, grain

    def _part(self):
        d = F.col(self.date_col).cast("date")
        if self.grain == "day":
            return d.cast("string")
        return F.date_trunc(self.grain, d).cast("date").cast("string")

    def _grains(self, lo: dt.date, hi: dt.date) -> set[str]:
        out, d = set(), lo
        while d <= hi:
            if self.grain == "day":
                out.add(d.isoformat())
                d += dt.timedelta(days=1)
            elif self.grain == "month":
                out.add(d.replace(day=1).isoformat())
                d = (d.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
            else:
                out.add(d.replace(month=1, day=1).isoformat())
                d = d.replace(year=d.year + 1, month=1, day=1)
        return out

    def run(self, fresh: DataFrame, date_from: str | None = None, date_to: str | None = None) -> dict:
        tx = self.catalog.begin(self.table)
        if date_from is None:                        # initial / full load
            rows = fresh.withColumn("__grain", self._part())
            replace = lambda v: True
        else:
            lo, hi = dt.date.fromisoformat(date_from), dt.date.fromisoformat(date_to)
            in_range = F.col(self.date_col).between(F.lit(lo), F.lit(hi))
            touched = self._grains(lo, hi)
            rows = fresh.filter(in_range).withColumn("__grain", self._part())
            old = self.catalog.read(self.table, "rows", tx.base, partitions=touched)
            if old is not None:
                rows = old.filter(~in_range).unionByName(rows)
            replace = touched
        tx.write_partitions("rows", rows, "__grain", replace=replace)
        return tx.commit({"op": "range_reload", "from": date_from, "to": date_to, "grain": self.grain})

    def read(self) -> DataFrame:
        return self.catalog.read(self.table, "rows").drop("__grain")


class Scd2Load(_Bucketed):
    """P9/P10 as a published job.

    By source time (``change_time_col``) the dataset holds the dimension and
    the states seen, both in hash buckets of the key.  A load first compares
    only the latest known state of each key with the snapshot; what is not known
    so is met with the states seen, in the buckets it falls into.  States not
    seen yet are spliced in, and the buckets of their keys rewritten.
    States may come in any order, also several of one key.

    By load time, snapshots must come in order and have one row per key.

    Surrogate keys continue from the maximum kept in the commit.  A run that
    changes nothing writes nothing.
    """

    def __init__(self, spark: SparkSession, root: str, table: str, key: str, tracked: list[str],
                 attrs: list[str] | None = None, change_time_col: str | None = None,
                 first_time_col: str | None = None, n_buckets: int = 1, target_bytes: int = TARGET_BYTES,
                 dataset: str | None = None):
        """``dataset``: a dataset shared with other loads, in which the tables bear the load's name."""
        self._open(spark, root, dataset or table, key, n_buckets, target_bytes)
        self.table = table
        self._dim, self._seen = (table, f"{table}_seen") if dataset else ("dim", "seen")
        self.tracked, self.attrs = tracked, attrs or tracked
        self.change_time_col, self.first_time_col = change_time_col, first_time_col

    def run(self, snapshot: DataFrame, load_time=None) -> dict:
        tx = self.catalog.begin(self.dataset)
        changed = self.prepare(snapshot, tx, load_time)
        if not changed:
            return {"changed_buckets": 0}
        return tx.commit({"op": "scd2", "load_time": str(load_time), "changed_buckets": changed})

    def prepare(self, snapshot: DataFrame, tx, load_time=None) -> int:
        """Write the load's result into ``tx``; the number of buckets rewritten."""
        return self._by_source_time(snapshot, tx) if self.change_time_col else self._by_load_time(snapshot, tx, load_time)

    def _by_source_time(self, snapshot: DataFrame, tx) -> int:
        base, columns = tx.base, [self.key, *self.attrs, "seen_at", "first_at"]
        news = states(snapshot, self.key, self.attrs, self.change_time_col, self.first_time_col)
        dim = self._read(self._dim, base)
        if dim is not None:
            news = unknown_states(dim, news, self.key, self.attrs)
        news, path = written(news.select(*columns))
        seen = self._read(self._seen, base, self._hit(news, self._directory(base, self._seen))) if base else None
        if seen is not None:                               # a state sent again, older than the latest: nothing to splice
            news, path = written(unseen_states(seen.select(*columns), news))
        # both tables are dealt by one directory, the one of the states seen: it is the larger table
        now, then, split = self._grow(base, self._seen, self.catalog.fs.size(path))
        touched = self._hit(news, now)
        if not touched:
            return 0
        touched |= split
        part, seen = self._read(self._dim, base, touched), self._read(self._seen, base, touched)
        if part is None:
            kinds = {f.name: f.dataType.simpleString() for f in news.schema}
            part = self.spark.createDataFrame([], ", ".join(
                ["sk bigint", *[f"`{c}` {kinds[c]}" for c in [self.key, *self.attrs]], "opened_at timestamp_ntz", "valid_from timestamp_ntz",
                 "valid_to timestamp_ntz", "is_current boolean", "last_seen timestamp_ntz"]))
            seen = self.spark.createDataFrame([], news.schema)
        sk_start = self._last_sk(base)
        dim, seen = splice(part, seen, news, self.key, self.tracked, self.attrs, sk_start=sk_start)
        self._write(tx, self._dim, dim, now, then, touched)
        self._write(tx, self._seen, seen, now, then, touched)
        self._note(tx, base, then, touched)
        return len(touched)

    def _by_load_time(self, snapshot: DataFrame, tx, load_time) -> int:
        base = tx.base
        last = base["meta"].get("last_load_time") if base else None
        if last is not None and str(load_time) < last:
            raise ValueError(f"load time {load_time} is before that of the last load, {last}")
        now = self._directory(base, self._dim)
        dim = self._read(self._dim, base)
        if dim is None:
            dim = empty_dimension(self.spark, snapshot, self.key, self.attrs, "sk")
        hits, path = written(changed_keys(dim, snapshot, self.key, self.tracked))
        touched = self._hit(hits, now)
        if not touched:
            return 0
        now, then, split = self._grow(base, self._dim, self.catalog.fs.size(path))
        touched |= split
        part = self._read(self._dim, base, touched)
        new = scd2_merge(dim if part is None else part, hits, self.key, self.tracked, sk="sk", attrs=self.attrs, load_time=load_time,
                         sk_start=self._last_sk(base))
        self._write(tx, self._dim, new, now, then, touched)
        self._note(tx, base, then, touched)
        tx.meta = tx.meta | {"last_load_time": str(load_time)}
        return len(touched)

    def _last_sk(self, base: dict | None) -> int:
        return (base or {}).get("meta", {}).get("max_sk", {}).get(self._dim, 0)

    def _note(self, tx, base, then: BucketDirectory, touched: set[int]) -> None:
        rewritten = touched | set(range(self._directory(base, self._dim).n, then.n))
        top = self.catalog.read(self.dataset, self._dim, {"tables": tx.tables}, partitions=rewritten).agg(F.max("sk")).first()[0] or 0
        tx.meta = tx.meta | {"max_sk": tx.meta.get("max_sk", {}) | {self._dim: max(self._last_sk(base), top)}}

    def read(self, snapshot: dict | None = None) -> DataFrame:
        dim = self.catalog.read(self.dataset, self._dim, snapshot)
        return dim.select("sk", self.key, *self.attrs, "valid_from", "valid_to", "is_current")


class GatedJob:
    """Several loads and their checks, published together or not at all.

    The loads write their new tables aside; the checks run on these candidates;
    only when all pass do the tables, the load log and the check results become
    visible, in one commit of one dataset.  When a check fails,
    :class:`QualityGateFailed` is raised and the last version stays current.
    """

    def __init__(self, catalog: Catalog, dataset: str, results: str = "dq_results"):
        self.catalog, self.dataset, self.results = catalog, dataset, results

    def run(self, parts: list, checks, run_at) -> list:
        """``parts``: (load, its arguments); ``checks(candidate)`` returns check frames on a snapshot document."""
        tx = self.catalog.begin(self.dataset)
        for load, *args in parts:
            if load.dataset != self.dataset:
                raise ValueError(f"{load.table} does not belong to {self.dataset}")
            load.prepare(args[0], tx, *args[1:])
        found = materialize(suite(checks({"tables": tx.tables}), run_at))       # a row per check
        gate(found)
        tx.append(self.results, found)
        tx.commit({"op": "gated", "run_at": str(run_at)})
        return found.collect()

    def read(self, table: str) -> DataFrame:
        return self.catalog.read(self.dataset, table)


class BalanceTable(_Bucketed):
    """A published table of balances, changed by whole transfers only.

    A transfer (signed changes per key) is checked against the version it will
    replace: every key is there, the changes sum to zero, no balance falls
    below ``floor``.  Otherwise :class:`TransferRejected` is raised and nothing
    is published.  If another writer commits first, the transfer is checked and
    applied again on that writer's version, so both take effect.
    """

    def __init__(self, spark: SparkSession, root: str, dataset: str, key: str, col: str, floor=None,
                 n_buckets: int = 1, target_bytes: int = TARGET_BYTES):
        self._open(spark, root, dataset, key, n_buckets, target_bytes)
        self.col, self.floor = col, floor

    def initialise(self, df: DataFrame) -> dict:
        rows, path = written(one_per_key(df, self.key, "balances"))
        tx = self.catalog.begin(self.dataset)
        now, then, _ = self._grow(None, "rows", self.catalog.fs.size(path))
        self._write(tx, "rows", rows, now, then, set(range(then.n)))
        return tx.commit({"op": "initialise"})

    def transfer(self, deltas: DataFrame, attempts: int = 5, before_commit=lambda: None) -> dict:
        moves = materialize(deltas.groupBy(self.key).agg(F.sum("delta").alias("delta")))
        for last in range(attempts - 1, -1, -1):
            tx = self.catalog.begin(self.dataset)
            now = self._directory(tx.base, "rows")
            touched = self._hit(moves, now)
            if not touched:
                return {"moved": 0}
            rows = self._read("rows", tx.base, touched)
            after = apply_deltas(rows, self.key, self.col, moves)
            report = validate_transfer(rows, after, self.key, self.col, moves, self.floor)
            self._write(tx, "rows", after, now, now, touched)
            before_commit()
            try:
                tx.commit({"op": "transfer"})
                return report
            except CommitConflict:
                if not last:
                    raise

    def read(self) -> DataFrame:
        return self.catalog.read(self.dataset, "rows").drop("__bucket")
