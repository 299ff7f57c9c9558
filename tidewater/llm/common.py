"""Helpers shared by the corpus operators: reading, staged tables, let, prefix sums."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F

from tidewater.session import ensure_checkpoint_dir
from tidewater.sources.tables import read_table

#: Words are runs of anything but ASCII white space.
SPACE = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents", *columns)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()`` but computes the plan once, stores
    compressed columns, and survives lost executors.  The folder goes when
    the session's JVM ends.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder, removed at the end of the session."""
    path = f"{ensure_checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}/{name}"
    jvm = spark.sparkContext._jvm
    parent = jvm.org.apache.hadoop.fs.Path(path).getParent()
    parent.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(parent)
    return path


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` bound: evaluated once per row however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The text's words; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def running_total(df: DataFrame, key: list[str], order: str, value: str, out: str, width: int) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows of the same key with a smaller ``order``.

    ``order`` is a non-negative integer, unique within a key.  It is cut into
    blocks of ``width``: one window runs inside each block and another over
    the block totals, so no task gets more than a block of rows or one row
    per block, and rows of one key spread over many tasks.
    """
    part = df.withColumn("__blk", F.floor(F.col(order) / width))
    blocks = part.groupBy(*key, "__blk").agg(F.sum(value).alias("__tot"))
    before = W.partitionBy(*key).orderBy("__blk").rowsBetween(W.unboundedPreceding, -1)
    offsets = blocks.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(key)], F.col("__blk").alias("__b"),
                            F.coalesce(F.sum("__tot").over(before), F.lit(0)).alias("__off"))
    inner = W.partitionBy(*key, "__blk").orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    part = part.withColumn("__in", F.coalesce(F.sum(value).over(inner), F.lit(0)))
    cond = F.col("__blk") == F.col("__b")
    for i, k in enumerate(key):
        cond = cond & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    return (part.join(offsets, cond, "inner")
            .withColumn(out, (F.col("__in") + F.col("__off")).cast("long"))
            .select(*df.columns, out))
