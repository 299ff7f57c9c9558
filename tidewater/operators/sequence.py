"""Distributed numbering and neighbours: global row number, NTILE, LAG / LEAD,
carried values and surrogate keys, by one plan at every size.

Rows are range-partitioned on a total sort order, so sampled bounds split even
one hot key over many tasks, sorted inside each range and written to the checkpoint
folder, so that a lost executor cannot move a row to another range.  What a range must know of
the ones before it is one small row per range: its count (numbers), its last
rows (LAG / LEAD) or its last state (carried values), handed on by a scan over
one row per range.  No task gets more rows than a range holds; the number of
ranges is the session's ``spark.sql.shuffle.partitions`` (fewer where AQE
merges small ones) or the argument.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.session import ensure_checkpoint_dir

RANGE, PLACE = "__range", "__place"


def written(df: DataFrame) -> tuple[DataFrame, str]:
    """Write the rows once as a table in the shared checkpoint folder: the table, and its folder.

    The folder goes when the session's JVM ends.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    if getattr(spark, "_jvm", None) is not None:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage: the rows from a table written once (:func:`written`)."""
    return written(df)[0]


def in_ranges(df: DataFrame, order_cols: list, num_partitions: int | None = None) -> DataFrame:
    """The rows with ``__range`` (rising along the order) and ``__place`` (rising inside a range)."""
    ranged = df.repartitionByRange(num_partitions, *order_cols) if num_partitions else df.repartitionByRange(*order_cols)
    return materialize(ranged.sortWithinPartitions(*order_cols).withColumn(RANGE, F.spark_partition_id())
                       .withColumn(PLACE, F.monotonically_increasing_id()))


def _numbered(ranged: DataFrame, name: str) -> DataFrame:
    """Add the 1-based number along the order to rows of :func:`in_ranges`."""
    counts = ranged.groupBy(RANGE).agg(F.count(F.lit(1)).alias("__n"), F.min(PLACE).alias("__first"))
    # one row per range
    before = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(RANGE, (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first") + 1).alias("__shift"))
    return (ranged.join(F.broadcast(offsets), RANGE)
            .withColumn(name, F.col(PLACE) + F.col("__shift")).drop("__shift"))


def global_row_number(df: DataFrame, order_cols: list, name: str = "rn",
                      num_partitions: int | None = None) -> DataFrame:
    """Add a 1-based row number in ``order_cols`` order.

    ``order_cols`` must define a total order (end with a unique key), as for
    any deterministic ROW_NUMBER.  Entries may be column names or sort
    expressions (e.g. ``F.col("x").desc()``).
    """
    return _numbered(in_ranges(df, order_cols, num_partitions), name).drop(RANGE, PLACE)


def ntile(df: DataFrame, buckets: int, order_cols: list, name: str = "ntile",
          num_partitions: int | None = None) -> DataFrame:
    """SQL NTILE(buckets) over ``order_cols`` computed from the global row number.

    With N rows, q = N div k and r = N mod k: the first r buckets hold q + 1 rows.
    """
    numbered = _numbered(in_ranges(df, order_cols, num_partitions), "__rn")
    total = numbered.agg(F.count(F.lit(1))).scalar()
    x = numbered.withColumn("__total", total)
    k = F.lit(buckets)
    q = F.floor(F.col("__total") / k)
    r = F.col("__total") % k
    rn = F.col("__rn")
    big = r * (q + 1)
    bucket = F.when(rn <= big, F.floor((rn - 1) / (q + 1)) + 1).otherwise(
        r + F.floor((rn - big - 1) / F.greatest(q, F.lit(1))) + 1)
    return x.withColumn(name, bucket.cast("bigint")).drop("__rn", "__total", RANGE, PLACE)


def _same(keys: list[str], left: str, right: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}{k}").eqNullSafe(F.col(f"{right}{k}")) for k in keys], F.lit(True))


def neighbour(ranged: DataFrame, key_cols: list[str], value_cols: list[str], prefix: str, ahead: bool = False) -> DataFrame:
    """Add the values of the row before (``ahead``: after) each row within its key, to rows of :func:`in_ranges`.

    The rows may be some of those ranged; ``__range`` and ``__place`` stay, so
    that further neighbours are found without ranging again.  A range's edge
    row is the neighbour of the next range's first (or last) row.
    """
    pick, shift = (F.min_by, F.lead) if ahead else (F.max_by, F.lag)
    inside = Window.partitionBy(RANGE, *key_cols).orderBy(PLACE)
    rows = ranged.select("*", *[shift(v).over(inside).alias(f"{prefix}{v}") for v in value_cols],
                         shift(PLACE).over(inside).isNotNull().alias("__found"))
    edge = ranged.groupBy(RANGE).agg(pick(F.struct(*[F.col(k).alias(f"k_{k}") for k in key_cols], *[F.col(v).alias(f"v_{v}") for v in value_cols]), PLACE).alias("__edge"))
    # one row per range
    beyond = edge.select(RANGE, shift("__edge").over(Window.orderBy(RANGE)).alias("__edge"))
    out = rows.join(F.broadcast(beyond), RANGE)
    same = reduce(lambda a, b: a & b, [F.col(f"__edge.k_{k}").eqNullSafe(F.col(k)) for k in key_cols], ~F.col("__found") & F.col("__edge").isNotNull())
    return out.select(*ranged.columns, *[F.when(same, F.col(f"__edge.v_{v}")).otherwise(F.col(f"{prefix}{v}")).alias(f"{prefix}{v}") for v in value_cols])


def lag_within(df: DataFrame, key_cols: list, order_cols: list, value_cols: list,
               prefix: str = "prev_", offset: int = 1, num_partitions: int | None = None) -> DataFrame:
    """LAG(value, offset) OVER (PARTITION BY key ORDER BY order), safe for hot keys; a negative ``offset`` is LEAD.

    The neighbour is looked up inside the range; for the ``offset`` rows at a
    range's edge it is one of the last (LEAD: first) ``offset`` rows of the
    ranges beyond it, a table of ``offset`` rows per range, found by number.
    """
    n = abs(offset)
    ranged = in_ranges(df, [*key_cols, *order_cols], num_partitions)
    if n == 1:
        return neighbour(ranged, key_cols, value_cols, prefix, ahead=offset < 0).drop(RANGE, PLACE)
    rows = _numbered(ranged, "__rn")
    inside = Window.partitionBy(RANGE, *key_cols).orderBy("__rn")
    shift = F.lag if offset > 0 else F.lead
    rows = rows.select("*", *[shift(v, n).over(inside).alias(f"{prefix}{v}") for v in value_cols],
                       shift("__rn", n).over(inside).isNotNull().alias("__found"))
    # the rows next to a range's edge, with the number of the row that looks for them
    edge = Window.partitionBy(RANGE).orderBy(F.col("__rn").desc() if offset > 0 else F.col("__rn"))
    border = (rows.select(RANGE, "__rn", *key_cols, *value_cols).withColumn("__nth", F.row_number().over(edge)).where(F.col("__nth") <= n)
              .select((F.col("__rn") + offset).alias("__rn"), *[F.col(k).alias(f"__k_{k}") for k in key_cols],
                      *[F.col(v).alias(f"__v_{v}") for v in value_cols]))
    out = rows.join(F.broadcast(border), "__rn", "left")
    beyond = ~F.col("__found") & _same(key_cols, "", "__k_")
    for v in value_cols:
        out = out.withColumn(f"{prefix}{v}", F.when(beyond, F.col(f"__v_{v}")).otherwise(F.col(f"{prefix}{v}")))
    return out.select(*df.columns, *[f"{prefix}{v}" for v in value_cols])


def lead_within(df: DataFrame, key_cols: list, order_cols: list, value_cols: list,
                prefix: str = "next_", num_partitions: int | None = None) -> DataFrame:
    """LEAD(value) OVER (PARTITION BY key ORDER BY order), skew-safe like :func:`lag_within`."""
    return lag_within(df, key_cols, order_cols, value_cols, prefix=prefix, offset=-1, num_partitions=num_partitions)


def carry_last(df: DataFrame, key_cols: list[str], order_cols: list, value: str, name: str,
               num_partitions: int | None = None) -> DataFrame:
    """Add ``name``: the last non-null ``value`` up to the row, within its key.

    Inside a range this is a running window; a range's last state, one row of
    key and value, is handed on over ranges, so a key that fills many ranges
    is known to all of them.
    """
    rows = in_ranges(df, [*key_cols, *order_cols], num_partitions)
    upto = Window.partitionBy(RANGE, *key_cols).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn(name, F.last(value, ignorenulls=True).over(upto))
    # the key at a range's end, its last value there, and whether the range begins with another key
    ends = rows.groupBy(RANGE).agg(F.max_by(F.struct(*key_cols, F.col(name).alias("__value")), PLACE).alias("last"),
                                   F.min_by(F.struct(*key_cols), PLACE).alias("first"))
    key = F.struct(*[F.col(f"last.{k}") for k in key_cols])
    # ranges that end in one key stand side by side: the last of them that has a value knows it
    run = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)          # one row per range
    known = F.when(F.col("last.__value").isNotNull(), F.struct(key.alias("k"), F.col("last.__value").alias("v")))
    given = ends.select(RANGE, F.last(known, ignorenulls=True).over(run).alias("__given"), F.col("first").alias("__first"))
    out = rows.join(F.broadcast(given.select(RANGE, "__given")), RANGE, "left")
    same = reduce(lambda a, b: a & b, [F.col(f"__given.k.{k}").eqNullSafe(F.col(k)) for k in key_cols], F.col("__given").isNotNull())
    return (out.withColumn(name, F.coalesce(F.col(name), F.when(same, F.col("__given.v"))))
            .select(*df.columns, name))


def assign_sk(existing: DataFrame | None, new_rows: DataFrame, order_cols: list, sk: str = "sk",
              start: int | None = None) -> DataFrame:
    """Surrogate keys for ``new_rows`` continuing from ``max(existing.sk)``
    (or from ``start`` when the caller already knows the maximum).

    Dense and gap-free in ``order_cols`` order; the maximum is one scalar.
    """
    if start is not None:
        base = F.lit(start).cast("bigint")
    else:
        base = existing.agg(F.coalesce(F.max(sk), F.lit(0)).cast("bigint")).scalar()
    numbered = global_row_number(new_rows, order_cols, name="__rn")
    return numbered.withColumn(sk, (base + F.col("__rn")).cast("bigint")).drop("__rn")
