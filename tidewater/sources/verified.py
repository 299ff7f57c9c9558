"""Verified bulk load (S7): check content digests against a manifest, then load.

The rows are dealt to blocks by a hash of their content.  A block's digest is
its row count and sums of slices of the rows' SHA-256, which do not depend on
order or on how rows lie in files; a root digest stands over the blocks.  So
the writer of the data makes the manifest from the rows it means to write, not
from the files; any number of tasks check one file, however large; and a
mismatch names the blocks.  Only the block table, of a size set by ``blocks``,
is joined; no path or content reaches the driver.

The files listed when the load begins are the ones checked and returned, so
what lands later is not read.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BLOCKS = 1024
#: Hex digits of a slice of SHA-256; two slices are summed, so a sum of 2^64 rows fits in DECIMAL(38).
_SLICE = 15


class DigestMismatch(RuntimeError):
    pass


def block_digests(df: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """(block, n_rows, a, b) of the rows, columns by name in alphabetical order, nulls included."""
    row = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns)]), {"ignoreNullFields": "false"}), 256)
    part = lambda i: F.conv(F.substring("h", 1 + i * _SLICE, _SLICE), 16, 10).cast("decimal(38,0)")
    hashed = df.select(row.alias("h"))
    return (hashed.select(F.pmod(F.xxhash64("h"), F.lit(blocks)).cast("int").alias("block"), part(0).alias("a"), part(1).alias("b"))
            .groupBy("block").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("a").alias("a"), F.sum("b").alias("b")))


def root_digest(digests: DataFrame) -> str:
    """One digest over the block table (at most ``blocks`` rows)."""
    line = F.concat_ws(":", "block", "n_rows", F.col("a").cast("string"), F.col("b").cast("string"))
    return digests.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\n"), 256)).first()[0]


def write_with_manifest(df: DataFrame, path: str, manifest_path: str, blocks: int = BLOCKS) -> str:
    """Write the rows and, beside them, the manifest made from the rows themselves; returns the root digest."""
    _write_manifest(df, manifest_path, blocks)
    df.write.mode("overwrite").parquet(path)
    return root_digest(df.sparkSession.read.parquet(manifest_path))


def build_manifest(spark: SparkSession, paths: list[str], out: str, blocks: int = BLOCKS) -> None:
    """A manifest of files that are there already."""
    _write_manifest(spark.read.parquet(*paths), out, blocks)


def _write_manifest(df: DataFrame, out: str, blocks: int) -> None:
    block_digests(df, blocks).withColumn("blocks", F.lit(blocks)).withColumn("columns", F.lit(df.schema.json())).write.mode("overwrite").parquet(out)


def verified_load(spark: SparkSession, path: str, manifest_path: str, root: str | None = None) -> tuple[DataFrame, dict]:
    """The rows under ``path`` if they are those of the manifest, and a report by blocks; else :class:`DigestMismatch`.

    ``root``, when known from elsewhere, guards the manifest itself.
    """
    manifest = spark.read.parquet(manifest_path)
    head = manifest.select("blocks", "columns").first()
    if head is None:
        raise DigestMismatch("the manifest has no block")
    if root is not None and root_digest(manifest) != root:
        raise DigestMismatch("the manifest is not the one of the root digest")
    df = spark.read.parquet(path)                    # lists the files once
    told = StructType.fromJson(json.loads(head["columns"]))
    if sorted((f.name, f.dataType.simpleString()) for f in told) != sorted((f.name, f.dataType.simpleString()) for f in df.schema):
        raise DigestMismatch(f"columns {df.schema.simpleString()} are not {told.simpleString()}")
    j = block_digests(df, head["blocks"]).alias("a").join(manifest.alias("m"), F.col("a.block") == F.col("m.block"), "full_outer")
    same = (F.col("a.n_rows") == F.col("m.n_rows")) & (F.col("a.a") == F.col("m.a")) & (F.col("a.b") == F.col("m.b"))
    found = j.agg(F.count_if(same).alias("matched"), F.count_if(~same).alias("mismatched"),
                  F.count_if(F.col("a.block").isNull()).alias("missing"), F.count_if(F.col("m.block").isNull()).alias("unlisted"),
                  F.sort_array(F.collect_set(F.when(~F.coalesce(same, F.lit(False)), F.coalesce("a.block", "m.block")))).alias("blocks")).first().asDict()
    if found["mismatched"] or found["missing"] or found["unlisted"] or not found["matched"]:
        raise DigestMismatch(str(found))
    return df, found
