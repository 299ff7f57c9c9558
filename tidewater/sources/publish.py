"""Atomic publication of warehouse tables (P1) without a transactional format.

A *dataset* is a folder holding one or more tables.  Data is always written to
a fresh run folder that no reader uses; the new state becomes visible by
linking in one small commit file ``_commits/<seq>.json`` that lists, for every
table of the dataset, the folders that make up its current version.  The file is
written aside and put under its name only if that is free, whole or not at
all, so:

* readers resolve a dataset once (the highest commit) and never see a half
  load, and all tables of one commit (e.g. target + load log + watermark)
  change together;
* a job that dies before its commit leaves the previous version current; a
  retry recomputes from the previous state;
* two writers racing for the same sequence number cannot both win.

Tables are either *whole* (one folder per version) or *partitioned*: a map
partition value -> folder, so that a range reload or an upsert rewrites only
the partitions it touches and carries the others over by reference.
"""

from __future__ import annotations

import json
import os
import shutil
import time
import urllib.parse
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

COMMITS = "_commits"


class CommitConflict(RuntimeError):
    pass


def _link_new(path: str, text: str) -> None:
    """A whole local file under a name that must be free: written aside, then linked (atomic, never over another)."""
    aside = f"{path}.{uuid.uuid4().hex}.tmp"
    with open(aside, "w", encoding="utf-8") as f:
        f.write(text)
        f.flush()
        os.fsync(f.fileno())
    try:
        os.link(aside, path)
    except FileExistsError as e:
        raise CommitConflict(f"{path} already exists") from e
    finally:
        os.remove(aside)


class _LocalFS:
    """Fallback for sessions without a JVM gateway (Spark Connect clients):
    plain local paths only."""

    @staticmethod
    def _path(path: str) -> str:
        if "://" in path and not path.startswith("file://"):
            raise ValueError(f"{path}: without a JVM only local files can be reached")
        return path[len("file:"):] if path.startswith("file:") else path

    def exists(self, path: str) -> bool:
        return os.path.exists(self._path(path))

    def create_new(self, path: str, text: str) -> None:
        p = self._path(path)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        _link_new(p, text)

    def read_text(self, path: str) -> str:
        with open(self._path(path), encoding="utf-8") as f:
            return f.read()

    def children(self, path: str) -> list[str]:
        p = self._path(path)
        return sorted(os.listdir(p)) if os.path.isdir(p) else []

    def modified(self, path: str) -> float:
        return os.path.getmtime(self._path(path))

    def size(self, path: str) -> int:
        p = self._path(path)
        if os.path.isfile(p):
            return os.path.getsize(p)
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(p) for f in fs)

    def delete(self, path: str) -> None:
        p = self._path(path)
        if os.path.isdir(p):
            shutil.rmtree(p)
        elif os.path.exists(p):
            os.remove(p)


class _FS:
    """Thin access to the Hadoop FileSystem of a path (works for any scheme)."""

    def __new__(cls, spark: SparkSession):
        if getattr(spark, "_jvm", None) is None:
            return _LocalFS()
        return super().__new__(cls)

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.jvm = spark._jvm
        self.conf = spark._jsc.hadoopConfiguration()

    def _p(self, path: str):
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._p(path)
        return fs.exists(p)

    def create_new(self, path: str, text: str) -> None:
        """Written aside, then renamed without overwriting: readers never see a part of it."""
        fs, p = self._p(path)
        fs.mkdirs(p.getParent())
        if fs.getUri().getScheme() == "file":
            _link_new(p.toUri().getPath(), text)
            return
        aside = self.jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
        out = fs.create(aside, False)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        keep = self.spark.sparkContext._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 1)
        keep[0] = self.jvm.org.apache.hadoop.fs.Options.Rename.NONE
        try:
            self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.conf).rename(aside, p, keep)
        except Exception as e:  # noqa: BLE001  (FileAlreadyExistsException via py4j)
            fs.delete(aside, False)
            raise CommitConflict(f"{path} already exists") from e

    def read_text(self, path: str) -> str:
        fs, p = self._p(path)
        stream = fs.open(p)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def children(self, path: str) -> list[str]:
        fs, p = self._p(path)
        if not fs.exists(p):
            return []
        return [s.getPath().getName() for s in fs.listStatus(p)]

    def delete(self, path: str) -> None:
        fs, p = self._p(path)
        if fs.exists(p):
            fs.delete(p, True)

    def modified(self, path: str) -> float:
        """Seconds since the epoch at which ``path`` itself last changed."""
        fs, p = self._p(path)
        return fs.getFileStatus(p).getModificationTime() / 1000

    def size(self, path: str) -> int:
        """Bytes under ``path`` (metadata only)."""
        fs, p = self._p(path)
        return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def new_run_id() -> str:
    return time.strftime("%Y%m%dT%H%M%S") + "-" + uuid.uuid4().hex[:8]


class Transaction:
    """Writes for one dataset, made visible together by :meth:`commit`."""

    def __init__(self, catalog: "Catalog", name: str, run_id: str):
        self.catalog = catalog
        self.name = name
        self.run_id = run_id
        self.base = catalog.current(name)
        self.base_seq = self.base["seq"] if self.base else 0
        self.tables = dict(self.base["tables"]) if self.base else {}
        self.meta = dict(self.base["meta"]) if self.base else {}      # carried on from commit to commit
        used = {json.dumps(self.base.get("run_id"))} if self.base else set()
        if json.dumps(run_id) in used:
            raise CommitConflict(f"run {run_id} is already the current version of {name}")

    def _run_dir(self, table: str) -> str:
        return f"{self.catalog.root}/{self.name}/{table}/run={self.run_id}"

    def append(self, table: str, df: DataFrame) -> None:
        """Add rows to a whole table; its files stay, by reference."""
        old = self.tables.get(table)
        self.write(table, df)
        if old:
            self.tables[table] = dict(self.tables[table], paths=[*old["paths"], *self.tables[table]["paths"]])

    def write(self, table: str, df: DataFrame) -> None:
        """Replace the whole table."""
        path = self._run_dir(table)
        df.write.mode("overwrite").parquet(path)
        self.tables[table] = {"kind": "whole", "paths": [path], "schema": df.schema.json()}

    def write_partitions(self, table: str, df: DataFrame, part_col: str, replace) -> None:
        """Replace the partitions ``replace`` (a set of values or a predicate on
        the value string) by the rows of ``df``; partitions of the old version
        outside ``replace`` are kept by reference.  A replaced partition with no
        new rows disappears (the DELETE of a range reload clears it)."""
        path = self._run_dir(table)
        # cluster rows by partition value so each task writes few partitions
        # (few files); REBALANCE lets AQE split an oversized partition (one
        # hot day) over several tasks and merge small ones, without sampling
        clustered = df.withColumn("__part", F.col(part_col).cast("string")).hint("rebalance", "__part")
        clustered.write.mode("overwrite").partitionBy("__part").parquet(path)
        written, sizes = {}, {}
        for child in self.catalog.fs.children(path):
            if child.startswith("__part="):
                value = urllib.parse.unquote(child[len("__part="):])
                written[value] = f"{path}/{child}"
                sizes[value] = self.catalog.fs.size(written[value])
        old = self.tables.get(table, {}).get("partitions", {})
        bytes_ = {v: n for v, n in self.tables.get(table, {}).get("bytes", {}).items() if v in old}
        hit = replace if callable(replace) else (lambda v, s=set(map(str, replace)): v in s)
        parts = {v: p for v, p in old.items() if not hit(v)}
        stray = [v for v in written if not hit(v)]
        if stray:
            raise ValueError(f"rows outside the replaced partitions: {stray[:5]}")
        parts.update(written)
        bytes_ = {v: n for v, n in bytes_.items() if v in parts} | sizes
        self.tables[table] = {"kind": "partitioned", "partition_col": part_col,
                              "partitions": dict(sorted(parts.items())), "bytes": bytes_, "schema": df.schema.json()}

    def commit(self, meta: dict | None = None) -> dict:
        doc = {"seq": self.base_seq + 1, "run_id": self.run_id, "committed_at": time.time(),
               "tables": self.tables, "meta": self.meta | (meta or {})}
        path = f"{self.catalog.root}/{self.name}/{COMMITS}/{doc['seq']:012d}.json"
        self.catalog.fs.create_new(path, json.dumps(doc))
        return doc


class Catalog:
    """Versioned datasets under ``root`` (a shared folder on a cluster)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fs = _FS(spark)

    def _commit_files(self, name: str) -> list[str]:
        return sorted(c for c in self.fs.children(f"{self.root}/{name}/{COMMITS}") if c.endswith(".json"))

    def current(self, name: str) -> dict | None:
        files = self._commit_files(name)
        if not files:
            return None
        return json.loads(self.fs.read_text(f"{self.root}/{name}/{COMMITS}/{files[-1]}"))

    def history(self, name: str) -> list[dict]:
        return [json.loads(self.fs.read_text(f"{self.root}/{name}/{COMMITS}/{f}"))
                for f in self._commit_files(name)]

    def begin(self, name: str, run_id: str | None = None) -> Transaction:
        return Transaction(self, name, run_id or new_run_id())

    def read(self, name: str, table: str, snapshot: dict | None = None,
             partitions=None) -> DataFrame | None:
        """The table of the current (or given) commit; ``partitions`` restricts a
        partitioned table to those values, so only their folders are listed."""
        doc = snapshot or self.current(name)
        if not doc or table not in doc["tables"]:
            return None
        t = doc["tables"][table]
        schema = StructType.fromJson(json.loads(t["schema"]))
        if t["kind"] == "whole":
            paths = t["paths"]
        else:
            wanted = None if partitions is None else set(map(str, partitions))
            paths = [p for v, p in t["partitions"].items() if wanted is None or v in wanted]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def publish(self, name: str, tables: dict[str, DataFrame], run_id: str | None = None,
                meta: dict | None = None) -> dict:
        """Full reload of one or more tables, one atomic swap."""
        tx = self.begin(name, run_id)
        for t, df in tables.items():
            tx.write(t, df)
        return tx.commit(meta)

    def vacuum(self, name: str, keep: int = 2, older_than: float = 0.0) -> list[str]:
        """Drop run folders not referenced by the last ``keep`` commits.

        ``older_than`` (seconds) spares younger folders: those of a load that
        is still running are in no commit yet.
        """
        born = time.time() - older_than
        live = set()
        for doc in self.history(name)[-keep:]:
            for t in doc["tables"].values():
                paths = t["paths"] if t["kind"] == "whole" else list(t["partitions"].values())
                live.update(p.split("/run=")[0] + "/run=" + p.split("/run=")[1].split("/")[0] for p in paths)
        dropped = []
        for table in self.fs.children(f"{self.root}/{name}"):
            if table.startswith("_"):
                continue
            for run in self.fs.children(f"{self.root}/{name}/{table}"):
                path = f"{self.root}/{name}/{table}/{run}"
                if run.startswith("run=") and path not in live and (not older_than or self.fs.modified(path) <= born):
                    self.fs.delete(path)
                    dropped.append(path)
        return dropped
