"""Source and sink keys: bulk append, CTAS, full overwrite,
verified load, exactly-once change batches, named views and the table
inventory.  Keys that write use a fresh folder under the shared scratch
root, publish through :class:`~tidewater.sources.publish.Catalog` and return
what a reader sees afterwards.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import functions as F

from tidewater.functions import COMPLETED, money
from tidewater.plans.registry import register
from tidewater.session import scratch_root
from tidewater.sources import Tables
from tidewater.sources.batches import BatchLedger, write_batches
from tidewater.sources.publish import Catalog
from tidewater.sources.tables import TABLES
from tidewater.sources.verified import DigestMismatch, verified_load, write_with_manifest


def _catalog(spark, tag: str) -> Catalog:
    return Catalog(spark, f"{scratch_root(spark)}/{tag}-{uuid.uuid4().hex[:10]}")


@register("append_select", """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount, o_orderdate
FROM orders
""")
def append_select(spark, sf_dir):
    """INSERT INTO t SELECT ... twice (two date slices) into an empty table."""
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey", "o_orderstatus",
                                            money("o_totalprice").alias("total_amount"), "o_orderdate")
    cat = _catalog(spark, "append")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    for part in (o.filter(F.col("o_orderdate") < cut), o.filter(F.col("o_orderdate") >= cut)):
        # an append is a new partition of the table; existing ones are kept by reference
        tx = cat.begin("stg_orders")
        tx.write_partitions("rows", part.withColumn("__batch", F.lit(tx.run_id)), "__batch", replace={tx.run_id})
        tx.commit({"op": "append"})
    return cat.read("stg_orders", "rows").drop("__batch")


@register("ctas", f"""
SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount
FROM orders WHERE o_orderstatus = '{COMPLETED}'
""")
def ctas(spark, sf_dir):
    """CREATE TABLE AS SELECT: the schema comes from the query, no constraint is carried."""
    o = Tables(spark, sf_dir).orders.filter(F.col("o_orderstatus") == COMPLETED)
    q = o.select("o_orderkey", "o_custkey", money("o_totalprice").alias("total_amount"))
    cat = _catalog(spark, "ctas")
    cat.publish("perf_orders", {"rows": q})
    return cat.read("perf_orders", "rows")


@register("full_overwrite", """
SELECT p.p_partkey AS product_id, p.p_type AS top_category, p.p_brand AS brand_name,
       CAST(p.p_retailprice AS DECIMAL(18,2)) AS unit_price
FROM part p
""")
def full_overwrite(spark, sf_dir):
    """TRUNCATE + reload, twice: the second load replaces the first completely,
    and it is written next to (never over) the version being read."""
    p = Tables(spark, sf_dir).part
    dim = p.select(F.col("p_partkey").alias("product_id"), F.col("p_type").alias("top_category"),
                   F.col("p_brand").alias("brand_name"), money("p_retailprice").alias("unit_price"))
    cat = _catalog(spark, "overwrite")
    cat.publish("dim_product", {"rows": dim.limit(0)})
    cat.publish("dim_product", {"rows": dim})
    current = cat.read("dim_product", "rows")
    cat.publish("dim_product", {"rows": current})   # reload from itself: reads the old version safely
    return cat.read("dim_product", "rows")


@register("verified_load", "SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount, o_orderdate FROM orders")
def verified_load_q(spark, sf_dir):
    """The writer makes the manifest from its rows and the files beside it; the
    loader computes every block's digest from the files and loads if all agree.
    The same files with one price changed are refused."""
    cat = _catalog(spark, "verified")
    rows = Tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey", "o_orderstatus", money("o_totalprice").alias("total_amount"), "o_orderdate")
    root = write_with_manifest(rows, f"{cat.root}/orders", f"{cat.root}/manifest")
    first = rows.agg(F.min("o_orderkey")).scalar()
    tampered = F.when(F.col("o_orderkey") == first, F.col("total_amount") + 1).otherwise(F.col("total_amount")).cast("decimal(18,2)")
    rows.withColumn("total_amount", tampered).write.parquet(f"{cat.root}/tampered")
    try:
        verified_load(spark, f"{cat.root}/tampered", f"{cat.root}/manifest", root)
    except DigestMismatch:
        df, _ = verified_load(spark, f"{cat.root}/orders", f"{cat.root}/manifest", root)
        return df
    raise AssertionError("a changed price must be refused")


@register("apply_next_batch", """
SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount,
       CAST(CASE WHEN o_orderdate < TIMESTAMP '1998-01-01 00:00:00' THEN 0
                 WHEN o_orderdate < TIMESTAMP '2000-01-01 00:00:00' THEN 1
                 WHEN o_orderdate < TIMESTAMP '2001-01-01 00:00:00' THEN 2 ELSE 3 END AS INT) AS applied_step
FROM orders
""")
def apply_next_batch(spark, sf_dir):
    """Base table, then change batches step=01..03 applied exactly once each;
    the call after the last batch is a no-op."""
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderstatus", money("o_totalprice").alias("total_amount"),
                                            "o_orderdate")
    root = f"{scratch_root(spark)}/batches-{uuid.uuid4().hex[:10]}"
    d = F.col("o_orderdate")
    ts = lambda s: F.lit(s).cast("timestamp_ntz")
    base = o.filter(d < ts("1998-01-01")).drop("o_orderdate")
    steps = {1: o.filter((d >= ts("1998-01-01")) & (d < ts("2000-01-01"))),
             2: o.filter((d >= ts("2000-01-01")) & (d < ts("2001-01-01"))),
             3: o.filter(d >= ts("2001-01-01"))}
    write_batches({k: v.drop("o_orderdate") for k, v in steps.items()}, f"{root}/deltas")
    ledger = BatchLedger(spark, f"{root}/warehouse", f"{root}/deltas", dataset="orders", key="o_orderkey")
    ledger.initialise(base)
    while ledger.apply_next() is not None:
        pass
    assert ledger.apply_next() is None  # exhausted: nothing applied, nothing written
    return ledger.read()


@register("v_order_summary", f"""
WITH paid AS (SELECT o_custkey, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders WHERE o_orderstatus = '{COMPLETED}')
SELECT c_mktsegment AS segment, count(price) AS orders, CAST(sum(price) AS DECIMAL(38,2)) AS sales
FROM customer JOIN paid ON o_custkey = c_custkey GROUP BY c_mktsegment
""")
def v_order_summary(spark, sf_dir):
    """A view under a name: the plan is stored, not the rows, so the summary over
    it reads the tables again each time, and the price filter of a query reaches
    their scans."""
    t = Tables(spark, sf_dir)
    who = t.customer.select(F.col("c_custkey").alias("buyer"), F.col("c_mktsegment").alias("segment"))
    sale = t.orders.select(F.col("o_custkey").alias("buyer"), F.col("o_orderstatus").alias("state"), money("o_totalprice").alias("price"))
    sale.join(who, "buyer").createOrReplaceTempView("v_order_summary")
    return (spark.table("v_order_summary").where(F.col("state") == COMPLETED).groupBy("segment")
            .agg(F.count("price").alias("orders"), F.sum("price").cast("decimal(38,2)").alias("sales")))


@register("table_inventory", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES))
def table_inventory(spark, sf_dir):
    """Exact row counts of every table side by side, in one job."""
    t = Tables(spark, sf_dir)
    counts = [getattr(t, n).select(F.lit(1).alias("x")).agg(F.count(F.lit(1)).alias("n_rows"))
              .select(F.lit(n).alias("table_name"), "n_rows") for n in TABLES]
    return reduce(lambda a, b: a.unionByName(b), counts).orderBy(F.col("n_rows").desc())
