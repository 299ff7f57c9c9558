"""Load-pattern transforms as pure functions old -> new.

Only ``tidewater.sources.publish`` writes; everything here takes and returns
DataFrames so that a load can be composed, tested and explained before it is
published.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import CANCELLED, line_total


#: Rows that one task of a large join is to hold; its sorts and aggregates take some 1 kB a row.
TASK_ROWS = 250_000


def dealt(df: DataFrame, key: str, rows: int, task_rows: int = TASK_ROWS) -> DataFrame:
    """The frame by hash of ``key``, over as many partitions as its ``rows`` call for.

    As it is where the session's shuffle partitions suffice: the planner then deals (or broadcasts) as it sees fit.
    """
    n = -(-rows // task_rows)
    return df.repartition(n, key) if n > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def daily_category_sales(orders: DataFrame, lineitem: DataFrame, part: DataFrame,
                         date_from: str | None = None, date_to: str | None = None,
                         excluded_status=(CANCELLED,), task_rows: int = TASK_ROWS) -> DataFrame:
    """Fact: (sales_date, top_category) -> orders, units, revenue.

    The date range is applied to the bare ``o_orderdate`` column as a
    half-open range, so it reaches the Parquet reader of ``orders``.  The
    shuffles of the lines have one partition per ``task_rows`` of them, if the
    session has fewer, so that a task's memory does not grow with the table.
    """
    o = orders.filter(~F.col("o_orderstatus").isin(*excluded_status))
    if date_from is not None:
        o = o.filter(F.col("o_orderdate") >= F.lit(date_from).cast("timestamp_ntz"))
    if date_to is not None:
        o = o.filter(F.col("o_orderdate") < F.lit(date_to).cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY"))
    o = o.select("o_orderkey", F.col("o_orderdate").cast("date").alias("sales_date"))
    li = lineitem.select("l_orderkey", "l_partkey", "l_quantity", line_total().alias("amt"))
    p = part.select("p_partkey", F.col("p_type").alias("top_category"))
    rows = lineitem.count()                             # from the Parquet footers
    with_part = lambda x: dealt(x, "l_partkey", rows, task_rows).join(p, F.col("l_partkey") == F.col("p_partkey"))
    with_order = lambda x: dealt(x, "l_orderkey", rows, task_rows).join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    if date_from is None and date_to is None:
        j = with_order(with_part(li))
    else:                                               # the range leaves few lines for the second join
        j = dealt(with_part(with_order(li)), "l_orderkey", rows, task_rows)
    # an order's lines lie together: it is counted once per day and category before the fact's groups are formed
    per_order = j.groupBy("l_orderkey", "sales_date", "top_category").agg(F.sum("l_quantity").alias("units"), F.sum("amt").alias("amt"))
    return (per_order.groupBy("sales_date", "top_category")
             .agg(F.count("l_orderkey").alias("orders"),
                  F.sum("units").cast("bigint").alias("units"),
                  F.sum("amt").cast("decimal(38,2)").alias("revenue")))


def any_differs(cols: list[str], left: str = "t", right: str = "s") -> Column:
    """True when any tracked column differs, NULL transitions included."""
    return reduce(lambda a, b: a | b,
                  [~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in cols], F.lit(False))


def one_per_key(df: DataFrame, key: str | list[str], what: str = "source") -> DataFrame:
    """The rows, or a failing job if two of them share a key.

    Counted by an aggregate on the key, which is combined map-side and whose
    partitioning the join after it uses; the check runs with the plan.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    told = F.concat(F.lit(f"duplicate key in {what}: "), F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]))
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *[F.first(c).alias(c) for c in rest])
    return g.where(F.assert_true(F.col("__n") == 1, told).isNull()).select(*df.columns)


def upsert(target: DataFrame, source: DataFrame, key: str | list[str], update_cols: list[str]) -> DataFrame:
    """INSERT ... ON DUPLICATE KEY UPDATE as a DataFrame rewrite.

    Columns in ``update_cols`` take the source value when the key is in the
    source; every other column keeps its *first* value (the target's).  The
    source must be unique on the key (run :func:`latest_per_key` first); if it
    is not, the job fails instead of multiplying target rows.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cols = target.columns
    t = target.alias("t")
    s = one_per_key(source, keys).alias("s")
    cond = reduce(lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys])
    j = t.join(s, cond, "full_outer")
    in_src = reduce(lambda a, b: a & b, [F.col(f"s.{k}").isNotNull() for k in keys])
    in_tgt = reduce(lambda a, b: a & b, [F.col(f"t.{k}").isNotNull() for k in keys])
    out = []
    for c in cols:
        if c in keys:
            out.append(F.coalesce(F.col(f"t.{c}"), F.col(f"s.{c}")).alias(c))
        elif c in update_cols:
            out.append(F.when(in_src, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.when(in_tgt, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c))
    return j.select(*out)


def change_counts(target: DataFrame, source: DataFrame, key: str | list[str], compare_cols: list[str]) -> DataFrame:
    """One row: rows_new, rows_changed, rows_unchanged of ``source`` against ``target``.

    "Changed" means a tracked value really differs, so a lookback window that
    re-reads rows already loaded counts them as unchanged.
    """
    keys = [key] if isinstance(key, str) else list(key)
    t = target.select(*keys, *compare_cols).alias("t")
    s = source.select(*keys, *compare_cols).alias("s")
    cond = reduce(lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys])
    j = s.join(t, cond, "left")
    is_new = F.col(f"t.{keys[0]}").isNull()
    diff = any_differs(compare_cols)
    return j.agg(F.count_if(is_new).cast("bigint").alias("rows_new"),
                 F.count_if(~is_new & diff).cast("bigint").alias("rows_changed"),
                 F.count_if(~is_new & ~diff).cast("bigint").alias("rows_unchanged"))


def slice_lower(wm_from, lookback: str | None = None) -> Column:
    """The exclusive lower bound of a watermark slice: ``wm_from [- lookback]``."""
    lo = F.lit(_ts_text(wm_from)).cast("timestamp_ntz")
    return lo - F.expr(f"INTERVAL {lookback}") if lookback else lo


def watermark_slice(source: DataFrame, ts_col: str, wm_from, wm_to, lookback: str | None = None) -> DataFrame:
    """Rows with ``wm_from [- lookback] < ts <= wm_to`` on the bare column."""
    hi = F.lit(_ts_text(wm_to)).cast("timestamp_ntz")
    return source.filter((F.col(ts_col) > slice_lower(wm_from, lookback)) & (F.col(ts_col) <= hi))


def _ts_text(v):
    """Timestamps travel as ISO text so no driver time zone is applied."""
    return v.isoformat(sep=" ") if hasattr(v, "isoformat") else v


def latest_per_key(df: DataFrame, key: str | list[str], order_cols: list[str]) -> DataFrame:
    """Keep the whole latest row per key by ``order_cols`` (then the other columns).

    ``max(struct(order..., rest...))`` is an ordinary aggregate, so it is
    combined map-side before the shuffle: a key holding a third of the rows
    ships one partial row per task, not all of its rows.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys and c not in order_cols]
    packed = F.struct(*[F.col(c) for c in order_cols + rest])
    g = df.groupBy(*keys).agg(F.max(packed).alias("__r"))
    return g.select(*keys, *[F.col(f"__r.{c}").alias(c) for c in order_cols + rest]).select(*df.columns)


def first_per_key(df: DataFrame, key: str | list[str], order_cols: list[str]) -> DataFrame:
    """Earliest row per key (ascending ``order_cols``), combined map-side like :func:`latest_per_key`."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys and c not in order_cols]
    packed = F.struct(*[F.col(c) for c in order_cols + rest])
    g = df.groupBy(*keys).agg(F.min(packed).alias("__r"))
    return g.select(*keys, *[F.col(f"__r.{c}").alias(c) for c in order_cols + rest]).select(*df.columns)


def append_new(target: DataFrame, source: DataFrame, id_col: str) -> DataFrame:
    """Append-only load: source rows whose rising id is above the target's maximum."""
    last = target.agg(F.coalesce(F.max(id_col), F.lit(-1)).cast("bigint")).scalar()
    return source.filter(F.col(id_col) > last)


def detect_deletes(target: DataFrame, source_keys: DataFrame, key: str) -> DataFrame:
    """Target keys that vanished from the full source key set (hard deletes)."""
    keys = source_keys.select(F.col(key).alias("__k")).distinct()     # combined map-side
    return target.join(keys, F.col(key) == F.col("__k"), "left_anti")


def key_digests(keys: DataFrame, key: str, bucket: Column) -> DataFrame:
    """(bucket, n, x, s) per bucket of keys: count, xor and sum of key hashes, whatever their order."""
    h = F.xxhash64(key)
    return keys.groupBy(bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("x"), F.sum(F.xxhash64(F.lit(1), F.col(key)).cast("decimal(38,0)")).alias("s"))


def differing_buckets(target: DataFrame, source: DataFrame) -> set[int]:
    """Buckets whose digests differ, of those the target has: at most one number per bucket."""
    s = source.select(F.col("bucket").alias("__b"), *[F.col(c).alias(f"__{c}") for c in ("n", "x", "s")])
    same = (F.col("n") == F.col("__n")) & (F.col("x") == F.col("__x")) & (F.col("s") == F.col("__s"))
    j = target.join(s, F.col("bucket") == F.col("__b"), "left").where(~F.coalesce(same, F.lit(False)))
    return {r[0] for r in j.select("bucket").collect()}


def detect_deletes_in_buckets(read_target, source_keys: DataFrame, key: str, bucket: Column) -> tuple[DataFrame, set[int]]:
    """Vanished target keys, found bucket by bucket: (the rows, the buckets compared in full).

    Both sides are reduced to a digest per bucket first; only the target's
    buckets whose digest differs are read again (``read_target(buckets)``
    reads those partitions alone) and met with the source's keys of the same
    buckets.  Source keys that repeat, or are new, make a bucket differ, which
    costs its comparison and changes nothing.
    """
    source = source_keys.select(F.col(key))
    found = differing_buckets(key_digests(read_target(None).select(key), key, bucket), key_digests(source, key, bucket))
    return detect_deletes(read_target(found), source.where(bucket.isin(found) if found else F.lit(False)), key), found


def replace_range(current: DataFrame, fresh: DataFrame, date_col: str, date_from: str, date_to: str) -> DataFrame:
    """DELETE the closed date range, INSERT the recomputed rows: one new frame.

    Days inside the range that have no fresh rows disappear, as the DELETE
    of the reference clears them.
    """
    lo = F.lit(date_from).cast("date")
    hi = F.lit(date_to).cast("date")
    kept = current.filter(~F.col(date_col).between(lo, hi))
    return kept.unionByName(fresh.filter(F.col(date_col).between(lo, hi)))
