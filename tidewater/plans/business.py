"""Composite business questions and the whole incremental job."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.functions import CANCELLED, line_total, money, month_key, pct
from tidewater.jobs import GatedJob, Scd2Load, WatermarkLoad
from tidewater.operators import quality as Q
from tidewater.operators.sequence import materialize
from tidewater.plans.loads import (_M1, _M2, _M3, FINAL_TARGET_SQL, ROUNDS, SCD2_SOURCE_SQL, SNAPS_SQL, UPDATE_COLS, _log_round,
                                   user_state)
from tidewater.plans.quality import (STAGING_RULES, VERSION_RULES, check_name, plant_faults, staging_checks,
                                     version_checks)
from tidewater.plans.registry import register
from tidewater.session import scratch_root
from tidewater.sources import Tables

ALL_CHECK_NAMES = [check_name(rule, column) for rule, column, _ in [*STAGING_RULES.values(), *VERSION_RULES.values()]]

LT = "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2))"


@register("monthly_gmv", f"""
WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS orders,
                  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS gmv
           FROM orders WHERE o_orderstatus <> '{CANCELLED}' GROUP BY 1),
a AS (SELECT *, round(CAST(gmv AS DOUBLE) / orders, 2) AS aov FROM m)
SELECT month, orders, gmv, aov,
       round(100.0 * (aov / lag(aov) OVER (ORDER BY month) - 1), 1) AS aov_mom_pct
FROM a
""")
def monthly_gmv(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.filter(F.col("o_orderstatus") != CANCELLED)
    m = (o.groupBy(month_key("o_orderdate").alias("month"))
          .agg(F.count(F.lit(1)).alias("orders"), F.sum(money("o_totalprice")).cast("decimal(38,2)").alias("gmv")))
    a = m.withColumn("aov", F.round(F.col("gmv").cast("double") / F.col("orders"), 2))
    prev = F.lag("aov").over(Window.orderBy("month"))   # one row per month
    return a.withColumn("aov_mom_pct", F.round((F.try_divide(F.col("aov"), prev) - 1) * 100.0, 1))


@register("region_orders", """
SELECT r.r_name AS region, count(*) AS orders
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey
WHERE o.o_orderdate >= TIMESTAMP '2000-01-01 00:00:00'
GROUP BY 1
""")
def region_orders(spark, sf_dir):
    t = Tables(spark, sf_dir)
    o = t.orders.filter(F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz")).select("o_custkey")
    per_cust = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))   # combine before the join
    geo = (t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
           .select("n_nationkey", "r_name"))                             # 25 rows by definition
    c = t.customer.select("c_custkey", "c_nationkey").join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
    return (per_cust.join(c, F.col("o_custkey") == F.col("c_custkey"))
                    .groupBy(F.col("r_name").alias("region")).agg(F.sum("n").cast("bigint").alias("orders")))


@register("entity_timeline", """
SELECT o_orderkey, 'ordered' AS step, o_orderdate AS at_time, o_orderstatus AS detail, CAST(0 AS INT) AS line
FROM orders
UNION ALL
SELECT l_orderkey, 'shipped', l_shipdate, concat(CAST(CAST(l_quantity AS BIGINT) AS VARCHAR), ' x part ', CAST(l_partkey AS VARCHAR)),
       l_linenumber
FROM lineitem
UNION ALL
SELECT l_orderkey, 'returned', l_shipdate, 'line returned', l_linenumber FROM lineitem WHERE l_returnflag = 'R'
""")
def entity_timeline(spark, sf_dir):
    """One order's life spread over several tables, as one event stream."""
    t = Tables(spark, sf_dir)
    placed = t.orders.select("o_orderkey", F.lit("ordered").alias("step"), F.col("o_orderdate").alias("at_time"),
                             F.col("o_orderstatus").alias("detail"), F.lit(0).alias("line"))
    # one scan of the lines: a line has one step, or two if it came back
    what = F.concat(F.col("l_quantity").cast("bigint").cast("string"), F.lit(" x part "), F.col("l_partkey").cast("string"))
    shipped = F.struct(F.lit("shipped").alias("step"), what.alias("detail"))
    returned = F.struct(F.lit("returned").alias("step"), F.lit("line returned").alias("detail"))
    steps = F.when(F.col("l_returnflag") == "R", F.array(shipped, returned)).otherwise(F.array(shipped))
    moved = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_shipdate").alias("at_time"), F.col("l_linenumber").alias("line"),
                              F.explode(steps).alias("s"))
    return placed.unionByName(moved.select("o_orderkey", "s.step", "at_time", "s.detail", "line"))


@register("top_regions_share", f"""
WITH s AS (SELECT n.n_name AS province, CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS sales
           FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
           WHERE o.o_orderstatus <> '{CANCELLED}' AND o.o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'
             AND o.o_orderdate < TIMESTAMP '1999-01-01 00:00:00'
           GROUP BY 1),
p AS (SELECT province, sales, round(100.0 * CAST(sales AS DOUBLE) / CAST(sum(sales) OVER () AS DOUBLE), 1) AS pct_of_year FROM s)
SELECT * FROM p ORDER BY sales DESC, province LIMIT 5
""")
def top_regions_share(spark, sf_dir):
    t = Tables(spark, sf_dir)
    o = t.orders.filter((F.col("o_orderstatus") != CANCELLED)
                        & (F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
                        & (F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")))
    per_cust = o.groupBy("o_custkey").agg(F.sum(money("o_totalprice")).alias("amt"))
    s = (per_cust.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
                 .join(t.nation.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
                 .groupBy(F.col("n_name").alias("province")).agg(F.sum("amt").cast("decimal(38,2)").alias("sales")))
    total = s.agg(F.sum("sales")).scalar()
    return (s.select("province", "sales", pct(F.col("sales"), total).alias("pct_of_year"))
             .orderBy(F.col("sales").desc(), "province").limit(5))


@register("topn_recent", f"""
WITH mx AS (SELECT max(l_shipdate) AS m FROM lineitem),
b AS (SELECT p.p_type AS category, p.p_brand AS brand, CAST(sum({LT}) AS DECIMAL(38,2)) AS revenue
      FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey AND o.o_orderstatus <> '{CANCELLED}'
      JOIN part p ON p.p_partkey = l.l_partkey
      WHERE l.l_shipdate > (SELECT m FROM mx) - INTERVAL 90 DAY
      GROUP BY 1, 2),
r AS (SELECT *, dense_rank() OVER (PARTITION BY category ORDER BY revenue DESC) AS rnk FROM b)
SELECT category, CAST(rnk AS BIGINT) AS rnk, brand, revenue FROM r WHERE rnk <= 3
""")
def topn_recent(spark, sf_dir):
    """Top 3 brands per category over the last 90 days *of the data* (not of the clock)."""
    t = Tables(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_shipdate", line_total().alias("amt"))
    mx = li.agg(F.max("l_shipdate")).scalar()     # last day of the data, a scalar subquery
    recent = (li.filter(F.col("l_shipdate") > mx - F.expr("INTERVAL 90 DAYS"))
                .join(t.orders.filter(F.col("o_orderstatus") != CANCELLED).select("o_orderkey"),
                      F.col("l_orderkey") == F.col("o_orderkey"), "left_semi"))
    per_part = recent.groupBy("l_partkey").agg(F.sum("amt").alias("amt"))
    b = (per_part.join(t.part.select("p_partkey", "p_type", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
                 .groupBy(F.col("p_type").alias("category"), F.col("p_brand").alias("brand"))
                 .agg(F.sum("amt").cast("decimal(38,2)").alias("revenue")))
    w = Window.partitionBy("category").orderBy(F.col("revenue").desc())
    return (b.withColumn("rnk", F.dense_rank().over(w).cast("bigint")).filter("rnk <= 3")
             .select("category", "rnk", "brand", "revenue"))


@register("delivery_performance", """
WITH d AS (SELECT r.r_name AS region, date_diff('hour', o.o_orderdate, l.l_shipdate) AS hours
           FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
           JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
           JOIN region r ON r.r_regionkey = n.n_regionkey)
SELECT region, count(*) AS shipments, count_if(hours < 0) AS shipped_before_order, round(avg(hours), 2) AS avg_hours,
       round(100.0 * count_if(hours <= 60 * 24) / count(*), 2) AS pct_on_time
FROM d GROUP BY 1
""")
def delivery_performance(spark, sf_dir):
    t = Tables(spark, sf_dir)
    geo = (t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
           .select("n_nationkey", "r_name"))
    cust = t.customer.select("c_custkey", "c_nationkey").join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate").join(cust, F.col("o_custkey") == F.col("c_custkey"))
    li = t.lineitem.select("l_orderkey", "l_shipdate")
    j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    h = F.timestamp_diff("HOUR", F.col("o_orderdate"), F.col("l_shipdate"))
    d = j.select(F.col("r_name").alias("region"), h.alias("hours"))
    return (d.groupBy("region")
             .agg(F.count(F.lit(1)).alias("shipments"), F.count_if(F.col("hours") < 0).alias("shipped_before_order"), F.round(F.avg("hours"), 2).alias("avg_hours"),
                  F.round(F.count_if(F.col("hours") <= 60 * 24) * 100.0 / F.count(F.lit(1)), 2).alias("pct_on_time")))


@register("churn_risk", f"""
WITH mx AS (SELECT max(o_orderdate) AS m FROM orders),
c AS (SELECT o_custkey, count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_spend,
             max(o_orderdate) AS last_order
      FROM orders WHERE o_orderstatus <> '{CANCELLED}' GROUP BY 1
      HAVING count(*) >= 3 AND max(o_orderdate) < (SELECT m FROM mx) - INTERVAL 90 DAY),
SELECT cu.c_name AS customer_code, c.n_orders, c.total_spend, c.last_order, (SELECT count(*) FROM c) AS at_risk
FROM c JOIN customer cu ON cu.c_custkey = c.o_custkey
ORDER BY c.total_spend DESC, cu.c_name LIMIT 10
""")
def churn_risk(spark, sf_dir):
    """>= 3 orders, silent for 90 days before the data's last order: how many, and the top 10."""
    t = Tables(spark, sf_dir)
    o = t.orders.filter(F.col("o_orderstatus") != CANCELLED)
    mx = t.orders.agg(F.max("o_orderdate")).scalar()
    c = (o.groupBy("o_custkey")
          .agg(F.count(F.lit(1)).alias("n_orders"), F.sum(money("o_totalprice")).cast("decimal(38,2)").alias("total_spend"),
               F.max("o_orderdate").alias("last_order"))
          .filter((F.col("n_orders") >= 3) & (F.col("last_order") < mx - F.expr("INTERVAL 90 DAYS"))))
    at_risk = c.agg(F.count(F.lit(1))).scalar()
    top = c.orderBy(F.col("total_spend").desc(), "o_custkey").limit(10)   # top-k is the feature
    return (top.join(t.customer.select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey"))
               .select(F.col("c_name").alias("customer_code"), "n_orders", "total_spend", "last_order",
                       at_risk.alias("at_risk")))


@register("discount_nonmember", f"""
SELECT o.o_orderkey, o.o_custkey FROM orders o
WHERE o.o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_discount >= 0.05)
  AND NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = o.o_custkey)
""")
def discount_nonmember(spark, sf_dir):
    """Orders that got a discount although the customer is not a member (no member activity)."""
    t = Tables(spark, sf_dir)
    # key sets made distinct map-side before the semi/anti joins (a hot key
    # on the right side of such a join cannot be split by AQE)
    disc = t.lineitem.filter(F.col("l_discount") >= 0.05).select("l_orderkey").distinct()
    members = t.events.select("user_id").distinct()
    return (t.orders.select("o_orderkey", "o_custkey")
             .join(disc, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")
             .join(members, F.col("o_custkey") == F.col("user_id"), "left_anti"))


_JOB_SQL = f"""
WITH {SNAPS_SQL},
target AS ({FINAL_TARGET_SQL.replace(f"WITH {SNAPS_SQL}", "")}),
dim AS ({SCD2_SOURCE_SQL.replace(f"WITH {SNAPS_SQL},", "WITH")}),
log AS ({_log_round(1, 's1', None, "TIMESTAMP '1970-01-01 00:00:00'", _M1)}
        UNION ALL {_log_round(2, 's1', 's1', _M1, _M1)}
        UNION ALL {_log_round(3, 's2', 's1', _M1, _M2)}
        UNION ALL {_log_round(4, 's3', 's2', _M2, _M3)})
SELECT 'target' AS part, user_id AS id, tier AS name, src_updated_at AS from_time, first_seen_ts AS to_time, CAST(NULL AS BIGINT) AS n1, CAST(NULL AS BIGINT) AS n2 FROM target
UNION ALL SELECT 'version', user_id, tier, valid_from, valid_to, sk, CAST(is_current AS BIGINT) FROM dim
UNION ALL SELECT 'log', load_id, NULL, wm_from, wm_to, rows_new, rows_changed FROM log
UNION ALL SELECT 'check', run, check_name, NULL, NULL, 0, 1 FROM (VALUES {", ".join(f"('{c}')" for c in ALL_CHECK_NAMES)}) c(check_name), (VALUES (0), (1), (2), (3)) r(run)
"""


@register("incremental_scd2_job", _JOB_SQL)
def incremental_scd2_job(spark, sf_dir):
    """Part A watermark load with lookback, part B SCD2 by source time,
    part C the DQ suite on what both have written, then one commit of target,
    dimension, log and results.  Runs: initial, immediate re-run (no change),
    two advances of the source, and one whose target is damaged before the
    checks: the gate stops it, and nothing of it is visible."""
    t = Tables(spark, sf_dir)
    root = f"{scratch_root(spark)}/job-{uuid.uuid4().hex[:10]}"
    part_a = WatermarkLoad(spark, root, "stg_users", key="user_id", ts_col="src_updated_at",
                           update_cols=UPDATE_COLS, lookback="1 HOUR", dataset="warehouse")
    part_b = Scd2Load(spark, root, "dim_user", "user_id", ["tier"],
                      change_time_col="updated_at", first_time_col="registered_at", dataset="warehouse")
    job = GatedJob(part_a.catalog, "warehouse")

    def run(i, bound, damage=lambda stg: stg):
        # one snapshot per round: both loads and every check read the same rows
        snap = materialize(user_state(t.events, bound))
        stg = snap.select("user_id", "tier", "amount", F.col("updated_at").alias("src_updated_at"), F.col("updated_at").alias("first_seen_ts"))
        job.run([(part_a, stg), (part_b, snap)],
                lambda doc: staging_checks(damage(part_a.target(doc)), snap, t.customer) + version_checks(part_b.read(doc), snap),
                f"2024-02-01 0{i}:00:00")

    for i, bound in enumerate([ROUNDS[0], ROUNDS[0], ROUNDS[1], ROUNDS[2]]):
        run(i, bound)
    try:
        run(4, ROUNDS[2], plant_faults)
    except Q.QualityGateFailed:
        pass
    else:
        raise AssertionError("the gate must stop a damaged target")
    none = F.lit(None)
    shape = lambda df, part, *c: df.select(F.lit(part).alias("part"), *[x.cast(k).alias(n) for x, k, n in zip(
        c, ("bigint", "string", "timestamp_ntz", "timestamp_ntz", "bigint", "bigint"), ("id", "name", "from_time", "to_time", "n1", "n2"))])
    col = F.col
    return (shape(part_a.target(), "target", col("user_id"), col("tier"), col("src_updated_at"), col("first_seen_ts"), none, none)
            .unionByName(shape(part_b.read(), "version", col("user_id"), col("tier"), col("valid_from"), col("valid_to"), col("sk"), col("is_current").cast("int")))
            .unionByName(shape(part_a.log(), "log", col("load_id"), none, col("wm_from"), col("wm_to"), col("rows_new"), col("rows_changed")))
            .unionByName(shape(job.read("dq_results"), "check", F.hour("run_at"), col("check_name"), none, none, col("violations"), col("passed").cast("int"))))


SOLD_OUT_RANK = 100


@register("soldout_bestsellers", f"""
WITH sold AS (SELECT l_partkey, CAST(sum(l_quantity) AS BIGINT) AS units FROM lineitem GROUP BY 1),
best AS (SELECT *, rank() OVER (ORDER BY units DESC) AS place FROM sold QUALIFY place <= {SOLD_OUT_RANK}),
back AS (SELECT DISTINCT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_shipdate >= (SELECT max(l_shipdate) FROM lineitem) - INTERVAL 180 DAY)
SELECT CAST(place AS BIGINT) AS place, p_partkey, p_name, units FROM best JOIN part ON p_partkey = l_partkey
WHERE l_partkey NOT IN (SELECT l_partkey FROM back)
""")
def soldout_bestsellers(spark, sf_dir):
    """Of the best sellers (rank by units, ties share a place) those with
    nothing left: no unit came back to any supplier in the last 180 days."""
    t = Tables(spark, sf_dir)
    li = t.lineitem.select("l_partkey", "l_quantity", "l_returnflag", "l_shipdate")
    last = li.agg(F.max("l_shipdate")).scalar()
    recent = (F.col("l_returnflag") == "R") & (F.col("l_shipdate") >= last - F.expr("INTERVAL 180 DAYS"))
    per_part = li.groupBy("l_partkey").agg(F.sum("l_quantity").cast("bigint").alias("units"), F.max(recent).alias("back"))
    # the units of the last place: a top-k; then the few rows from there up are ranked
    least = per_part.select("units").orderBy(F.col("units").desc()).limit(SOLD_OUT_RANK).agg(F.min("units")).scalar()
    best = per_part.where(F.col("units") >= least).withColumn("place", F.rank().over(Window.orderBy(F.col("units").desc())).cast("bigint"))
    names = t.part.select("p_partkey", "p_name")
    return (best.where(~F.coalesce("back", F.lit(False))).join(names, F.col("l_partkey") == F.col("p_partkey"))
            .select("place", "p_partkey", "p_name", "units"))


@register("argmax_per_group", """
WITH sold AS (SELECT p_type, p_partkey, CAST(sum(l_quantity) AS BIGINT) AS units FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2)
SELECT p_type AS category, p_partkey, units FROM sold s WHERE units = (SELECT max(units) FROM sold x WHERE x.p_type = s.p_type)
""")
def argmax_per_group(spark, sf_dir):
    """G14 per group: the best-selling part of each category, ties kept.  The
    maximum per category is an aggregate, met again by an equi-join."""
    t = Tables(spark, sf_dir)
    units = t.lineitem.groupBy("l_partkey").agg(F.sum("l_quantity").cast("bigint").alias("units"))
    sold = units.join(t.part.select("p_partkey", F.col("p_type").alias("category")), F.col("l_partkey") == F.col("p_partkey"))
    top = sold.groupBy("category").agg(F.max("units").alias("units"))
    return sold.join(top, ["category", "units"]).select("category", "p_partkey", "units")
