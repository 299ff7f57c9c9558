"""Relational keys: projections, filters, joins, aggregations, sort/limit,
set operations and scalar functions (SURVEY sections 2.2-2.7).

Domain mapping onto the driver tables: ``o_orderstatus`` F = completed,
O = open, P = cancelled; ``o_orderpriority`` plays the payment method;
``nation`` is the province and ``region`` its parent; ``part.p_type`` is the
top category; ``events`` with ``user_id = c_custkey`` are payments
(``purchase`` = success, ``error`` = failed).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions import (CANCELLED, COMPLETED, byte_length, day_name, line_total, loosely,
                                 money, month_key, pct)
from tidewater.operators.joins import fanout_report, preagg_join
from tidewater.plans.registry import register
from tidewater.sources import Tables

LINE_TOTAL_SQL = "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2))"


def _total(c):
    """Sum of money; DECIMAL(38,2) so that the total cannot overflow at scale."""
    return F.sum(c).cast("decimal(38,2)")


# ---------------------------------------------------------------- 2.1 sources

@register("scan_count", """
SELECT count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_orders,
       CAST(sum(l_quantity) AS BIGINT) AS units
FROM lineitem
""")
def scan_count(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_quantity")
    return li.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.countDistinct("l_orderkey").alias("n_orders"),
                  F.sum("l_quantity").cast("bigint").alias("units"))


# ------------------------------------------------------- 2.2 projections etc.

@register("project_alias", """
SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
       CAST(p_retailprice AS DECIMAL(18,2)) AS price
FROM part
""")
def project_alias(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    return p.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
                    F.col("p_type").alias("category"), money("p_retailprice").alias("price"))


@register("margin_pct", f"""
SELECT l_orderkey, l_linenumber,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS gross_amount,
       {LINE_TOTAL_SQL} AS net_amount,
       CAST(l_extendedprice AS DECIMAL(18,2)) - {LINE_TOTAL_SQL} AS discount_amount,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) - {LINE_TOTAL_SQL} AS DOUBLE) * 100.0
           / nullif(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE), 0) AS discount_pct
FROM lineitem
""")
def margin_pct(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    gross = money("l_extendedprice")
    net = line_total()
    return li.select(
        "l_orderkey", "l_linenumber",
        gross.alias("gross_amount"), net.alias("net_amount"),
        (gross - net).alias("discount_amount"),
        F.try_divide((gross - net).cast("double") * 100.0, gross.cast("double")).alias("discount_pct"))


@register("filter_compare", f"""
SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount
FROM orders
WHERE o_totalprice >= 300000 AND o_orderstatus <> '{CANCELLED}' AND o_orderpriority = '1-URGENT'
""")
def filter_compare(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return (o.filter((F.col("o_totalprice") >= 300000) & (F.col("o_orderstatus") != CANCELLED)
                     & (F.col("o_orderpriority") == "1-URGENT"))
             .select("o_orderkey", "o_orderstatus", money("o_totalprice").alias("total_amount")))


@register("filter_between", """
SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS quantity, l_shipdate
FROM lineitem
WHERE l_quantity BETWEEN 10 AND 20
  AND l_shipdate BETWEEN TIMESTAMP '1997-01-01 00:00:00' AND TIMESTAMP '1997-03-31 00:00:00'
""")
def filter_between(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return (li.filter(F.col("l_quantity").between(10, 20)
                      & F.col("l_shipdate").between(F.lit("1997-01-01").cast("timestamp_ntz"),
                                                    F.lit("1997-03-31").cast("timestamp_ntz")))
              .select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("bigint").alias("quantity"),
                      "l_shipdate"))


@register("filter_in_null", """
WITH o AS (SELECT nullif(o_orderpriority, '5-LOW') AS method FROM orders)
SELECT count_if(method IN ('1-URGENT', '2-HIGH')) AS n_in,
       count_if(method NOT IN ('1-URGENT', '2-HIGH')) AS n_not_in,
       count_if(method NOT IN ('1-URGENT', '2-HIGH') OR method IS NULL) AS n_not_in_or_null,
       count(*) AS n_rows
FROM o
""")
def filter_in_null(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select(
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("method"))
    m = F.col("method")
    vals = ["1-URGENT", "2-HIGH"]
    return o.agg(F.count_if(m.isin(vals)).alias("n_in"),
                 F.count_if(~m.isin(vals)).alias("n_not_in"),
                 F.count_if(~m.isin(vals) | m.isNull()).alias("n_not_in_or_null"),
                 F.count(F.lit(1)).alias("n_rows"))


@register("filter_like", """
SELECT p_partkey, p_name, p_type FROM part
WHERE p_name LIKE '%ring%' OR p_name LIKE 'r_d %' OR p_type LIKE 'PROM_'
""")
def filter_like(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    return (p.filter(F.col("p_name").like("%ring%") | F.col("p_name").like("r_d %")
                     | F.col("p_type").like("PROM_"))
             .select("p_partkey", "p_name", "p_type"))


@register("filter_and_or", f"""
SELECT count_if(o_orderstatus = '{COMPLETED}' AND o_orderpriority = '1-URGENT' OR o_totalprice > 400000) AS n_default,
       count_if(o_orderstatus = '{COMPLETED}' AND (o_orderpriority = '1-URGENT' OR o_totalprice > 400000)) AS n_bracketed
FROM orders
""")
def filter_and_or(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    a = F.col("o_orderstatus") == COMPLETED
    b = F.col("o_orderpriority") == "1-URGENT"
    c = F.col("o_totalprice") > 400000
    return o.agg(F.count_if((a & b) | c).alias("n_default"),
                 F.count_if(a & (b | c)).alias("n_bracketed"))


@register("filter_null", """
WITH o AS (SELECT nullif(o_orderpriority, '5-LOW') AS method FROM orders)
SELECT count_if(method IS NULL) AS n_is_null,
       count(*) FILTER (WHERE method = NULL) AS n_eq_null,
       count_if(method IS NOT NULL) AS n_is_not_null
FROM o
""")
def filter_null(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select(
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("method"))
    m = F.col("method")
    return o.agg(F.count_if(m.isNull()).alias("n_is_null"),
                 F.count_if(m == F.lit(None).cast("string")).alias("n_eq_null"),
                 F.count_if(m.isNotNull()).alias("n_is_not_null"))


@register("null_logic", f"""
WITH o AS (SELECT nullif(o_orderstatus, '{CANCELLED}') AS status, o_orderpriority FROM orders)
SELECT status = '{COMPLETED}' AS is_completed,
       (status = '{COMPLETED}') IS NULL AS is_unknown,
       NOT (status = '{COMPLETED}') AS not_completed,
       (status = '{COMPLETED}' OR o_orderpriority = '1-URGENT') AS completed_or_urgent,
       (status = '{COMPLETED}' AND o_orderpriority = '1-URGENT') AS completed_and_urgent,
       count(*) AS n
FROM o GROUP BY ALL
""")
def null_logic(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select(
        F.nullif(F.col("o_orderstatus"), F.lit(CANCELLED)).alias("status"), "o_orderpriority")
    p = F.col("status") == COMPLETED
    u = F.col("o_orderpriority") == "1-URGENT"
    return (o.groupBy(p.alias("is_completed"), p.isNull().alias("is_unknown"), (~p).alias("not_completed"),
                      (p | u).alias("completed_or_urgent"), (p & u).alias("completed_and_urgent"))
             .agg(F.count(F.lit(1)).alias("n")))


@register("coalesce_default", """
SELECT coalesce(nullif(o_orderpriority, '5-LOW'), 'unknown') AS payment_method, count(*) AS n
FROM orders GROUP BY 1
""")
def coalesce_default(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return (o.groupBy(F.coalesce(F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")), F.lit("unknown"))
                      .alias("payment_method"))
             .agg(F.count(F.lit(1)).alias("n")))


def _tier_expr():
    # first matching branch wins, so the order of the thresholds matters
    b = F.col("c_acctbal")
    return (F.when(b >= 8000, "platinum").when(b >= 5000, "gold").when(b >= 2000, "silver")
             .when(b >= 0, "bronze").otherwise("in_debt"))


TIER_SQL = """CASE WHEN c_acctbal >= 8000 THEN 'platinum' WHEN c_acctbal >= 5000 THEN 'gold'
                  WHEN c_acctbal >= 2000 THEN 'silver' WHEN c_acctbal >= 0 THEN 'bronze'
                  ELSE 'in_debt' END"""


@register("case_tiers", f"""
SELECT {TIER_SQL} AS tier, count(*) AS customers FROM customer GROUP BY 1
""")
def case_tiers(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    return c.groupBy(_tier_expr().alias("tier")).agg(F.count(F.lit(1)).alias("customers"))


@register("case_bands", """
SELECT CASE WHEN p_retailprice BETWEEN 900 AND 929.99 THEN 'budget'
            WHEN p_retailprice BETWEEN 930 AND 969.99 THEN 'standard'
            WHEN p_retailprice BETWEEN 970 AND 999.99 THEN 'premium'
            ELSE 'other' END AS price_band,
       count(*) AS products
FROM part GROUP BY 1
""")
def case_bands(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    x = F.col("p_retailprice")
    band = (F.when(x.between(900, 929.99), "budget").when(x.between(930, 969.99), "standard")
             .when(x.between(970, 999.99), "premium").otherwise("other"))
    return p.groupBy(band.alias("price_band")).agg(F.count(F.lit(1)).alias("products"))


@register("distinct_cols", """
SELECT DISTINCT l_returnflag, l_linestatus, l_discount >= 0.05 AS is_discounted FROM lineitem
""")
def distinct_cols(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return li.select("l_returnflag", "l_linestatus",
                     (F.col("l_discount") >= 0.05).alias("is_discounted")).distinct()


@register("filter_halfopen", """
SELECT count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS gmv
FROM orders
WHERE o_orderdate >= TIMESTAMP '1997-03-01 00:00:00'
  AND o_orderdate < TIMESTAMP '1997-03-01 00:00:00' + INTERVAL 1 MONTH
""")
def filter_halfopen(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    start = F.lit("1997-03-01").cast("timestamp_ntz")
    # the bare column is compared, so the range reaches the Parquet reader
    return (o.filter((F.col("o_orderdate") >= start)
                     & (F.col("o_orderdate") < start + F.expr("INTERVAL 1 MONTH")))
             .agg(F.count(F.lit(1)).alias("orders"), _total(money("o_totalprice")).alias("gmv")))


# ----------------------------------------------------------------- 2.3 joins

@register("join_inner", f"""
SELECT o.o_orderkey, c.c_name AS customer_code, n.n_name AS province, o.o_orderdate AS ordered_at
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
JOIN nation n ON n.n_nationkey = c.c_nationkey
WHERE o.o_orderstatus = '{COMPLETED}'
""")
def join_inner(spark, sf_dir):
    t = Tables(spark, sf_dir)
    o = t.orders.filter(F.col("o_orderstatus") == COMPLETED)
    c = t.customer.select("c_custkey", "c_name", "c_nationkey")
    n = t.nation.select("n_nationkey", "n_name")
    return (o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == n.n_nationkey)
             .select("o_orderkey", F.col("c_name").alias("customer_code"),
                     F.col("n_name").alias("province"), F.col("o_orderdate").alias("ordered_at")))


@register("join_left", """
SELECT c.c_custkey, o.o_orderkey, o.o_orderstatus
FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey
""")
def join_left(spark, sf_dir):
    t = Tables(spark, sf_dir)
    c = t.customer.select("c_custkey")
    o = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus")
    return c.join(o, c.c_custkey == o.o_custkey, "left").select("c_custkey", "o_orderkey", "o_orderstatus")


@register("join_left_on_pred", """
SELECT c.c_custkey, o.o_orderkey
FROM customer c
LEFT JOIN orders o ON o.o_custkey = c.c_custkey AND o.o_orderdate >= TIMESTAMP '2001-06-01 00:00:00'
""")
def join_left_on_pred(spark, sf_dir):
    t = Tables(spark, sf_dir)
    c = t.customer.select("c_custkey")
    # the right-side condition belongs to the join: filter the right side first
    o = (t.orders.filter(F.col("o_orderdate") >= F.lit("2001-06-01").cast("timestamp_ntz"))
              .select("o_custkey", "o_orderkey"))
    return c.join(o, c.c_custkey == o.o_custkey, "left").select("c_custkey", "o_orderkey")


@register("orders_per_customer", f"""
SELECT c.c_custkey, count(o.o_orderkey) AS n_orders,
       CAST(coalesce(sum(CAST(o.o_totalprice AS DECIMAL(18,2))), 0) AS DECIMAL(38,2)) AS total_spend
FROM customer c
LEFT JOIN orders o ON o.o_custkey = c.c_custkey AND o.o_orderstatus <> '{CANCELLED}'
GROUP BY c.c_custkey
""")
def orders_per_customer(spark, sf_dir):
    t = Tables(spark, sf_dir)
    # aggregate the many side to the customer grain first, then one left join
    per = (t.orders.filter(F.col("o_orderstatus") != CANCELLED)
                   .groupBy("o_custkey")
                   .agg(F.count(F.lit(1)).alias("n_orders"), _total(money("o_totalprice")).alias("total_spend")))
    c = t.customer.select("c_custkey")
    return (c.join(per, c.c_custkey == per.o_custkey, "left")
             .select("c_custkey", F.coalesce("n_orders", F.lit(0).cast("bigint")).alias("n_orders"),
                     F.coalesce("total_spend", F.lit(0).cast("decimal(38,2)")).alias("total_spend")))


@register("anti_left_null", """
SELECT c.c_custkey FROM customer c
LEFT JOIN (SELECT DISTINCT user_id FROM events) e ON e.user_id = c.c_custkey
WHERE e.user_id IS NULL
""")
def anti_left_null(spark, sf_dir):
    t = Tables(spark, sf_dir)
    # LEFT ... IS NULL stays an outer join + filter in Catalyst; say left_anti directly.
    # The key set is made distinct first (combined map-side): AQE cannot split a
    # hot key on the right of a semi/anti join, so a heavy user must not reach it.
    return t.customer.select("c_custkey").join(
        t.events.select("user_id").distinct(), F.col("c_custkey") == F.col("user_id"), "left_anti")


@register("anti_not_exists", f"""
SELECT c.c_custkey FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey
                  AND o.o_orderstatus = '{COMPLETED}' AND o.o_orderdate >= TIMESTAMP '2001-01-01 00:00:00')
""")
def anti_not_exists(spark, sf_dir):
    t = Tables(spark, sf_dir)
    child = t.orders.filter((F.col("o_orderstatus") == COMPLETED)
                            & (F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz")))
    return t.customer.select("c_custkey").join(
        child.select("o_custkey").distinct(), F.col("c_custkey") == F.col("o_custkey"), "left_anti")


@register("semi_in", f"""
SELECT count(*) AS customers FROM customer c
JOIN nation n ON n.n_nationkey = c.c_nationkey
JOIN region r ON r.r_regionkey = n.n_regionkey
WHERE r.r_name = 'ASIA'
  AND c.c_custkey IN (SELECT o.o_custkey FROM orders o
                      JOIN lineitem l ON l.l_orderkey = o.o_orderkey
                      JOIN part p ON p.p_partkey = l.l_partkey
                      WHERE p.p_type = 'PROMO' AND o.o_orderstatus <> '{CANCELLED}')
""")
def semi_in(spark, sf_dir):
    t = Tables(spark, sf_dir)
    buyers = (t.orders.filter(F.col("o_orderstatus") != CANCELLED).select("o_orderkey", "o_custkey")
              .join(t.lineitem.select("l_orderkey", "l_partkey"), F.col("l_orderkey") == F.col("o_orderkey"))
              .join(t.part.filter(F.col("p_type") == "PROMO").select("p_partkey"),
                    F.col("l_partkey") == F.col("p_partkey"), "left_semi")
              .select("o_custkey").distinct())   # one row per buyer before the shuffle
    geo = (t.nation.join(t.region.filter(F.col("r_name") == "ASIA"),
                         F.col("n_regionkey") == F.col("r_regionkey"), "left_semi").select("n_nationkey"))
    c = (t.customer.select("c_custkey", "c_nationkey")
         .join(geo, F.col("c_nationkey") == F.col("n_nationkey"), "left_semi"))
    return (c.join(buyers, F.col("c_custkey") == F.col("o_custkey"), "left_semi")
             .agg(F.count(F.lit(1)).alias("customers")))


@register("semi_exists", f"""
SELECT count(*) AS orders_after_failure FROM orders o
WHERE o.o_orderstatus = '{COMPLETED}'
  AND EXISTS (SELECT 1 FROM events e WHERE e.user_id = o.o_custkey AND e.event_type = 'error')
""")
def semi_exists(spark, sf_dir):
    t = Tables(spark, sf_dir)
    failed = t.events.filter(F.col("event_type") == "error").select("user_id").distinct()
    return (t.orders.filter(F.col("o_orderstatus") == COMPLETED).select("o_custkey")
             .join(failed, F.col("o_custkey") == F.col("user_id"), "left_semi")
             .agg(F.count(F.lit(1)).alias("orders_after_failure")))


@register("category_revenue", f"""
SELECT p.p_type AS category,
       CAST(sum({LINE_TOTAL_SQL}) AS DECIMAL(38,2)) AS revenue,
       CAST(sum(l_quantity) AS BIGINT) AS units
FROM lineitem l
JOIN orders o ON o.o_orderkey = l.l_orderkey AND o.o_orderstatus <> '{CANCELLED}'
JOIN part p ON p.p_partkey = l.l_partkey
GROUP BY p.p_type
""")
def category_revenue(spark, sf_dir):
    """Revenue and units by top category over non-cancelled orders (J9 + G3)."""
    t = Tables(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount")
    o = t.orders.filter(F.col("o_orderstatus") != CANCELLED).select("o_orderkey")
    p = t.part.select("p_partkey", "p_type")
    # the order filter becomes a semi join (no order columns are needed);
    # part is joined after lines are reduced, AQE broadcasts it when small
    lines = li.join(o, li.l_orderkey == o.o_orderkey, "left_semi")
    per_part = (lines.groupBy("l_partkey")
                     .agg(_total(line_total()).alias("revenue"), F.sum("l_quantity").alias("units")))
    return (per_part.join(p, per_part.l_partkey == p.p_partkey)
                    .groupBy(F.col("p_type").alias("category"))
                    .agg(F.sum("revenue").cast("decimal(38,2)").alias("revenue"),
                         F.sum("units").cast("bigint").alias("units")))


@register("hierarchy_join", """
SELECT n.n_nationkey, n.n_name AS province, r.r_name AS region,
       (SELECT count(*) FROM customer c WHERE c.c_nationkey = n.n_nationkey) AS customers
FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey
""")
def hierarchy_join(spark, sf_dir):
    t = Tables(spark, sf_dir)
    per_nation = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"))
    n = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return (n.join(per_nation, F.col("n_nationkey") == F.col("c_nationkey"), "left")
             .select("n_nationkey", F.col("n_name").alias("province"), F.col("r_name").alias("region"),
                     F.coalesce("customers", F.lit(0).cast("bigint")).alias("customers")))


@register("preagg_join", """
WITH items AS (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS items_total
               FROM orders GROUP BY o_custkey),
     paid AS (SELECT user_id, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS paid_total
              FROM events WHERE event_type = 'purchase' GROUP BY user_id),
     failed AS (SELECT user_id, count(*) AS failed_attempts FROM events WHERE event_type = 'error' GROUP BY user_id)
SELECT c.c_custkey, i.items_total,
       coalesce(p.paid_total, CAST(0 AS DECIMAL(38,2))) AS paid_total,
       coalesce(f.failed_attempts, 0) AS failed_attempts
FROM customer c
JOIN items i ON i.o_custkey = c.c_custkey
LEFT JOIN paid p ON p.user_id = c.c_custkey
LEFT JOIN failed f ON f.user_id = c.c_custkey
""")
def preagg_join_q(spark, sf_dir):
    t = Tables(spark, sf_dir)
    good, bad = F.col("event_type") == "purchase", F.col("event_type") == "error"
    payments = t.events.filter(good | bad).select("user_id", "event_type", "value")
    return preagg_join(
        t.customer.select("c_custkey"), "c_custkey",
        {
            "items": (t.orders, "o_custkey", [_total(money("o_totalprice")).alias("items_total")], "inner"),
            # one scan gives both sides of the payments
            "payments": (payments, "user_id", [_total(F.when(good, money("value"))).alias("paid_total"),
                                               F.count_if(bad).alias("failed_attempts")], "left"),
        },
        fill={"paid_total": F.lit(0).cast("decimal(38,2)"), "failed_attempts": F.lit(0).cast("bigint")})


@register("fanout_report", """
WITH o AS (SELECT o_custkey AS k, count(*) AS n_orders,
                  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS right_total
           FROM orders GROUP BY 1),
     e AS (SELECT user_id AS k, count(*) AS n_events FROM events GROUP BY 1)
SELECT o.k AS c_custkey, n_orders, n_events, n_orders * n_events AS joined_rows,
       right_total, CAST(right_total * n_events AS DECIMAL(38,2)) AS fanned_total,
       (n_orders > 1 AND n_events > 1) AS fans_out
FROM o JOIN e ON e.k = o.k
""")
def fanout_report_q(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return fanout_report(t.orders, "o_custkey", t.events, "user_id", amount=money("o_totalprice"),
                         key_name="c_custkey", left_count="n_orders", right_count="n_events")


@register("scalar_subquery", f"""
SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount FROM orders
WHERE o_orderstatus = '{COMPLETED}'
  AND o_totalprice > 1.5 * (SELECT avg(o_totalprice) FROM orders WHERE o_orderstatus = '{COMPLETED}')
ORDER BY o_totalprice DESC, o_orderkey LIMIT 10
""")
def scalar_subquery(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.filter(F.col("o_orderstatus") == COMPLETED)
    avg = o.agg(F.avg("o_totalprice")).scalar()   # uncorrelated scalar subquery, evaluated once
    return (o.filter(F.col("o_totalprice") > avg * 1.5)
             .orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(10)
             .select("o_orderkey", money("o_totalprice").alias("total_amount")))


@register("below_list_price", """
SELECT l.l_orderkey, l.l_linenumber, p.p_partkey,
       p.p_retailprice AS list_price,
       l.l_extendedprice / l.l_quantity AS sold_price,
       p.p_retailprice - l.l_extendedprice / l.l_quantity AS price_gap
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
WHERE l.l_extendedprice / l.l_quantity < p.p_retailprice
""")
def below_list_price(spark, sf_dir):
    t = Tables(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity")
    p = t.part.select("p_partkey", "p_retailprice")
    sold = F.try_divide(F.col("l_extendedprice"), F.col("l_quantity"))
    return (li.join(p, li.l_partkey == p.p_partkey).filter(sold < F.col("p_retailprice"))
              .select("l_orderkey", "l_linenumber", "p_partkey", F.col("p_retailprice").alias("list_price"),
                      sold.alias("sold_price"), (F.col("p_retailprice") - sold).alias("price_gap")))


# ---------------------------------------------------------- 2.4 aggregations

@register("agg_global", f"""
SELECT count(*) AS n_rows,
       count(nullif(o_orderstatus, '{CANCELLED}')) AS n_status,
       count(DISTINCT o_custkey) AS n_customers,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS gmv,
       CAST(avg(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS aov,
       CAST(min(o_totalprice) AS DECIMAL(18,2)) AS min_total,
       CAST(max(o_totalprice) AS DECIMAL(18,2)) AS max_total
FROM orders
""")
def agg_global(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return o.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count(F.nullif(F.col("o_orderstatus"), F.lit(CANCELLED))).alias("n_status"),
                 F.countDistinct("o_custkey").alias("n_customers"),
                 _total(money("o_totalprice")).alias("gmv"),
                 F.avg(money("o_totalprice")).cast("decimal(18,2)").alias("aov"),
                 money(F.min("o_totalprice")).alias("min_total"),
                 money(F.max("o_totalprice")).alias("max_total"))


@register("group_one", f"""
SELECT o_orderpriority AS payment_method,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS gmv, count(*) AS orders
FROM orders WHERE o_orderstatus <> '{CANCELLED}'
GROUP BY 1 ORDER BY gmv DESC
""")
def group_one(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.filter(F.col("o_orderstatus") != CANCELLED)
    return (o.groupBy(F.col("o_orderpriority").alias("payment_method"))
             .agg(_total(money("o_totalprice")).alias("gmv"), F.count(F.lit(1)).alias("orders"))
             .orderBy(F.col("gmv").desc()))


@register("group_many", f"""
SELECT l_returnflag, l_linestatus, count(*) AS lines, CAST(sum(l_quantity) AS BIGINT) AS units,
       CAST(sum({LINE_TOTAL_SQL}) AS DECIMAL(38,2)) AS revenue
FROM lineitem GROUP BY l_returnflag, l_linestatus
""")
def group_many(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return (li.groupBy("l_returnflag", "l_linestatus")
              .agg(F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").cast("bigint").alias("units"),
                   _total(line_total()).alias("revenue")))


# The hours at which a part of the day begins.
DAYPART_STARTS = (0, 11, 14, 18)
_PARTS = [(lo, hi, f"{lo:02d}-{hi - 1:02d}") for lo, hi in zip(DAYPART_STARTS, (*DAYPART_STARTS[1:], 24))]


def daypart(ts):
    """The part of the day, named by its first and last hour."""
    return F.coalesce(*[F.when(F.hour(ts).between(lo, hi - 1), F.lit(name)) for lo, hi, name in _PARTS])


DAYPART_SQL = "CASE " + " ".join(f"WHEN hour(ts) >= {lo} AND hour(ts) < {hi} THEN '{name}'" for lo, hi, name in _PARTS) + " END"


@register("group_daypart", f"""
SELECT {DAYPART_SQL} AS daypart, count(*) AS purchases,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS amount
FROM events WHERE event_type = 'purchase' GROUP BY 1
""")
def group_daypart(spark, sf_dir):
    e = Tables(spark, sf_dir).events.filter(F.col("event_type") == "purchase")
    return (e.groupBy(daypart(F.col("ts")).alias("daypart"))
             .agg(F.count(F.lit(1)).alias("purchases"), _total(money("value")).alias("amount")))


@register("having_units", """
SELECT l_partkey, CAST(sum(l_quantity) AS BIGINT) AS units
FROM lineitem WHERE l_returnflag = 'R'
GROUP BY l_partkey HAVING sum(l_quantity) >= 150
""")
def having_units(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return (li.filter(F.col("l_returnflag") == "R").groupBy("l_partkey")
              .agg(F.sum("l_quantity").alias("units"))
              .filter(F.col("units") >= 150).select("l_partkey", F.col("units").cast("bigint")))


@register("pivot_cond", """
SELECT o_orderpriority AS payment_method,
       CAST(sum(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DECIMAL(38,2)) AS completed,
       CAST(sum(CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DECIMAL(38,2)) AS open,
       CAST(sum(CASE WHEN o_orderstatus = 'P' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DECIMAL(38,2)) AS cancelled
FROM orders GROUP BY 1
""")
def pivot_cond(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderpriority", "o_orderstatus", money("o_totalprice").alias("amt"))
    # fixed pivot values: no extra job to discover them
    pv = (o.groupBy(F.col("o_orderpriority").alias("payment_method"))
           .pivot("o_orderstatus", ["F", "O", "P"]).agg(_total(F.col("amt"))))
    return pv.select("payment_method", F.col("F").alias("completed"), F.col("O").alias("open"),
                     F.col("P").alias("cancelled"))


@register("null_counts", f"""
SELECT count(*) AS n_orders,
       count_if(o_orderkey IS NULL) AS null_orderkey,
       count_if(o_custkey IS NULL) AS null_custkey,
       count_if(o_orderdate IS NULL) AS null_orderdate,
       count_if(nullif(o_orderstatus, '{CANCELLED}') IS NULL) AS null_status_after_cancel,
       count_if(nullif(o_orderpriority, '5-LOW') IS NULL) AS null_method
FROM orders
""")
def null_counts(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return o.agg(F.count(F.lit(1)).alias("n_orders"),
                 F.count_if(F.col("o_orderkey").isNull()).alias("null_orderkey"),
                 F.count_if(F.col("o_custkey").isNull()).alias("null_custkey"),
                 F.count_if(F.col("o_orderdate").isNull()).alias("null_orderdate"),
                 F.count_if(F.nullif(F.col("o_orderstatus"), F.lit(CANCELLED)).isNull())
                  .alias("null_status_after_cancel"),
                 F.count_if(F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).isNull()).alias("null_method"))


@register("pct_true", """
SELECT l_returnflag, round(100 * avg(CAST(l_discount >= 0.05 AS INT)), 1) AS pct_discounted
FROM lineitem GROUP BY 1
""")
def pct_true(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return (li.groupBy("l_returnflag")
              .agg(F.round(F.avg((F.col("l_discount") >= 0.05).cast("int")) * 100, 1).alias("pct_discounted")))


@register("share_of_total", """
SELECT o_orderpriority AS payment_method, count(*) AS n,
       round(100.0 * count(*) / sum(count(*)) OVER (), 1) AS pct
FROM orders GROUP BY 1
""")
def share_of_total(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    g = o.groupBy(F.col("o_orderpriority").alias("payment_method")).agg(F.count(F.lit(1)).alias("n"))
    # the grand total is one row computed from the grouped frame, broadcast back
    tot = g.agg(F.sum("n")).scalar()
    return g.select("payment_method", "n", pct(F.col("n"), tot).alias("pct"))


@register("all_cells_zero", """
WITH mx AS (SELECT max(l_shipdate) AS m FROM lineitem),
cells AS (
  SELECT l_partkey, l_suppkey,
         sum(CASE WHEN l_returnflag = 'R' AND l_shipdate >= (SELECT m FROM mx) - INTERVAL 180 DAY
                  THEN l_quantity ELSE 0 END) AS r_units
  FROM lineitem GROUP BY 1, 2)
SELECT l_partkey AS p_partkey, count(*) AS n_cells
FROM cells GROUP BY 1 HAVING max(r_units) = 0
""")
def all_cells_zero(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.select("l_partkey", "l_suppkey", "l_returnflag", "l_quantity", "l_shipdate")
    mx = li.agg(F.max("l_shipdate")).scalar()
    recent_r = ((F.col("l_returnflag") == "R")
                & (F.col("l_shipdate") >= mx - F.expr("INTERVAL 180 DAYS")))
    cells = (li.groupBy("l_partkey", "l_suppkey")
               .agg(F.sum(F.when(recent_r, F.col("l_quantity")).otherwise(0.0)).alias("r_units")))
    # "for every cell": the part qualifies when no cell has a recent R unit
    return (cells.groupBy(F.col("l_partkey").alias("p_partkey"))
                 .agg(F.count(F.lit(1)).alias("n_cells"), F.bool_and(F.col("r_units") == 0).alias("all_zero"))
                 .filter("all_zero").select("p_partkey", "n_cells"))


@register("rollup_subtotals", """
SELECT l_returnflag, l_linestatus, CAST(GROUPING(l_returnflag, l_linestatus) AS BIGINT) AS grouping_level,
       count(*) AS lines, CAST(sum(l_quantity) AS BIGINT) AS units
FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)
""")
def rollup_subtotals(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return (li.rollup("l_returnflag", "l_linestatus")
              .agg(F.grouping_id().cast("bigint").alias("grouping_level"), F.count(F.lit(1)).alias("lines"),
                   F.sum("l_quantity").cast("bigint").alias("units")))


@register("avg_skips_null", """
WITH r AS (SELECT CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,2)) END AS rating FROM events)
SELECT count(*) AS n_rows, count(rating) AS n_rated,
       CAST(avg(rating) AS DECIMAL(18,4)) AS avg_rated,
       CAST(avg(coalesce(rating, 0)) AS DECIMAL(18,4)) AS avg_zero_filled
FROM r
""")
def avg_skips_null(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    r = F.when(F.col("event_type") == "purchase", money("value"))
    x = e.select(r.alias("rating"))
    return x.agg(F.count(F.lit(1)).alias("n_rows"), F.count("rating").alias("n_rated"),
                 F.avg("rating").cast("decimal(18,4)").alias("avg_rated"),
                 F.avg(F.coalesce("rating", F.lit(0).cast("decimal(18,2)"))).cast("decimal(18,4)")
                  .alias("avg_zero_filled"))


@register("argmax_ties", f"""
WITH s AS (SELECT n.n_name AS province, CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS sales
           FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
           JOIN nation n ON n.n_nationkey = c.c_nationkey
           WHERE o.o_orderstatus = '{COMPLETED}' GROUP BY 1)
SELECT province, sales FROM s WHERE sales = (SELECT max(sales) FROM s)
""")
def argmax_ties(spark, sf_dir):
    t = Tables(spark, sf_dir)
    o = t.orders.filter(F.col("o_orderstatus") == COMPLETED).select("o_custkey", money("o_totalprice").alias("amt"))
    per_cust = o.groupBy("o_custkey").agg(F.sum("amt").alias("amt"))
    c = t.customer.select("c_custkey", "c_nationkey")
    s = (per_cust.join(c, F.col("o_custkey") == F.col("c_custkey"))
                 .groupBy("c_nationkey").agg(F.sum("amt").cast("decimal(38,2)").alias("sales"))
                 .join(t.nation.select("n_nationkey", "n_name"),
                       F.col("c_nationkey") == F.col("n_nationkey"))
                 .select(F.col("n_name").alias("province"), "sales"))
    best = s.agg(F.max("sales")).scalar()
    # compare with the maximum (a scalar subquery): every tied province is kept
    return s.filter(F.col("sales") == best).select("province", "sales")


@register("daily_category_fact", f"""
SELECT CAST(o.o_orderdate AS DATE) AS sales_date, p.p_type AS top_category,
       count(DISTINCT o.o_orderkey) AS orders, CAST(sum(l.l_quantity) AS BIGINT) AS units,
       CAST(sum({LINE_TOTAL_SQL}) AS DECIMAL(38,2)) AS revenue
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
JOIN part p ON p.p_partkey = l.l_partkey
WHERE o.o_orderstatus <> '{CANCELLED}'
GROUP BY 1, 2
""")
def daily_category_fact(spark, sf_dir):
    from tidewater.operators.loads import daily_category_sales
    t = Tables(spark, sf_dir)
    return daily_category_sales(t.orders, t.lineitem, t.part)


# ------------------------------------------------ 2.6 sort, limit, set ops

@register("sort_multi", """
SELECT o_orderkey, o_orderpriority, CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount FROM orders
ORDER BY o_orderpriority ASC, o_totalprice DESC, o_orderkey
""")
def sort_multi(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return (o.orderBy(F.col("o_orderpriority").asc(), F.col("o_totalprice").desc(), "o_orderkey")
             .select("o_orderkey", "o_orderpriority", money("o_totalprice").alias("total_amount")))


@register("topk", """
SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 10
""")
def topk(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    # sort + limit plans as TakeOrderedAndProject: a per-partition top-k, then a merge
    return (o.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(10)
             .select("o_orderkey", money("o_totalprice").alias("total_amount")))


@register("page_offset", """
SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 10 OFFSET 20
""")
def page_offset(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return (o.orderBy(F.col("o_totalprice").desc(), "o_orderkey").offset(20).limit(10)
             .select("o_orderkey", money("o_totalprice").alias("total_amount")))


@register("timeline_union", """
SELECT o_custkey AS c_custkey, 'order' AS event, CAST(o_orderkey AS VARCHAR) AS ref,
       o_orderdate AS at_time, o_orderstatus AS detail
FROM orders
UNION ALL
SELECT user_id, 'payment', CAST(event_id AS VARCHAR), CAST(NULL AS TIMESTAMP),
       concat(event_type, ' ', CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR))
FROM events WHERE event_type IN ('purchase', 'error')
""")
def timeline_union(spark, sf_dir):
    t = Tables(spark, sf_dir)
    orders = t.orders.select(F.col("o_custkey").alias("c_custkey"), F.lit("order").alias("event"),
                             F.col("o_orderkey").cast("string").alias("ref"),
                             F.col("o_orderdate").alias("at_time"), F.col("o_orderstatus").alias("detail"))
    pays = (t.events.filter(F.col("event_type").isin("purchase", "error"))
             .select(F.col("user_id").alias("c_custkey"), F.lit("payment").alias("event"),
                     F.col("event_id").cast("string").alias("ref"),
                     F.concat(F.col("event_type"), F.lit(" "), money("value").cast("string")).alias("detail")))
    # the payment side has no time column: unionByName pads it with NULL
    return orders.unionByName(pays, allowMissingColumns=True)


@register("union_distinct", """
SELECT o_custkey AS c_custkey FROM orders
UNION
SELECT user_id FROM events
""")
def union_distinct(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return (t.orders.select(F.col("o_custkey").alias("c_custkey"))
             .union(t.events.select(F.col("user_id").alias("c_custkey"))).distinct())


# ------------------------------------------------------- 2.7 scalar functions

@register("fn_string", """
SELECT c_custkey, left(c_name, 8) AS name_prefix, upper(c_mktsegment || '-x') AS segment_upper,
       concat(c_name, ' / ', c_mktsegment) AS label,
       CAST(length(c_name) AS INT) AS n_chars, CAST(octet_length(encode(c_name)) AS INT) AS n_bytes,
       trim('  ' || c_mktsegment || '  ') AS trimmed, replace(c_name, 'Customer#', 'CUS-') AS customer_code
FROM customer
""")
def fn_string(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    return c.select("c_custkey", F.left("c_name", F.lit(8)).alias("name_prefix"),
                    F.upper(F.concat("c_mktsegment", F.lit("-x"))).alias("segment_upper"),
                    F.concat("c_name", F.lit(" / "), "c_mktsegment").alias("label"),
                    F.char_length("c_name").cast("int").alias("n_chars"),
                    byte_length("c_name").cast("int").alias("n_bytes"),
                    F.trim(F.concat(F.lit("  "), "c_mktsegment", F.lit("  "))).alias("trimmed"),
                    F.replace("c_name", F.lit("Customer#"), F.lit("CUS-")).alias("customer_code"))


@register("split_key", """
WITH k AS (SELECT p_partkey, p_type || '-' || replace(p_brand, 'Brand#', 'B') || '-' || CAST(p_partkey AS VARCHAR) AS sku
           FROM part)
SELECT p_partkey, sku, split_part(sku, '-', 1) AS sku_category, split_part(sku, '-', 2) AS sku_brand,
       split_part(sku, '-', 3) AS sku_seq
FROM k
""")
def split_key(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    sku = F.concat_ws("-", "p_type", F.replace("p_brand", F.lit("Brand#"), F.lit("B")), F.col("p_partkey").cast("string"))
    k = p.select("p_partkey", sku.alias("sku"))
    return k.select("p_partkey", "sku",
                    F.substring_index("sku", "-", 1).alias("sku_category"),
                    # the middle part: nested SUBSTRING_INDEX, left 2 then right 1
                    F.substring_index(F.substring_index("sku", "-", 2), "-", -1).alias("sku_brand"),
                    F.substring_index("sku", "-", -1).alias("sku_seq"))


@register("fn_math", """
WITH m AS (SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(18,2)) AS amt, l_quantity FROM lineitem)
SELECT l_orderkey, l_linenumber, round(amt, 0) AS amt_round, CAST(floor(amt) AS BIGINT) AS amt_floor,
       CAST(ceil(amt) AS BIGINT) AS amt_ceil, CAST(l_quantity AS BIGINT) % 7 AS qty_mod7,
       abs(amt - 50000) AS dist_50k
FROM m
""")
def fn_math(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    amt = money("l_extendedprice")
    return li.select("l_orderkey", "l_linenumber", F.round(amt, 0).cast("decimal(18,0)").alias("amt_round"),
                     F.floor(amt).cast("bigint").alias("amt_floor"), F.ceil(amt).cast("bigint").alias("amt_ceil"),
                     F.try_mod(F.col("l_quantity").cast("bigint"), F.lit(7).cast("bigint")).alias("qty_mod7"),
                     F.abs(amt - F.lit(50000)).alias("dist_50k"))


@register("fn_date", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS y, CAST(month(o_orderdate) AS INT) AS m,
       strftime(o_orderdate, '%Y-%m') AS ym, dayname(o_orderdate) AS day_name,
       CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS INT) AS days_to_2002,
       CAST(CAST(o_orderdate AS DATE) + INTERVAL 30 DAY AS DATE) AS plus_30d,
       last_day(CAST(o_orderdate AS DATE)) AS month_end,
       CAST(o_orderdate AS DATE) AS order_date,
       o_orderdate + INTERVAL 1 HOUR AS plus_1h
FROM orders
""")
def fn_date(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    d = F.col("o_orderdate")
    return o.select("o_orderkey", F.year(d).alias("y"), F.month(d).alias("m"), month_key(d).alias("ym"),
                    day_name(d).alias("day_name"),
                    F.datediff(F.lit("2002-01-01").cast("date"), d.cast("date")).alias("days_to_2002"),
                    F.date_add(d.cast("date"), 30).alias("plus_30d"), F.last_day(d).alias("month_end"),
                    d.cast("date").alias("order_date"), (d + F.expr("INTERVAL 1 HOUR")).alias("plus_1h"))


@register("decimal_vs_float", """
SELECT count(*) AS n_rows,
       count_if(CAST(l_discount AS DECIMAL(4,2)) + CAST(l_tax AS DECIMAL(4,2))
                = CAST(round(l_discount + l_tax, 2) AS DECIMAL(4,2))) AS n_decimal_exact,
       count_if(l_discount + l_tax = CAST(CAST(round(l_discount + l_tax, 2) AS DECIMAL(4,2)) AS DOUBLE)) AS n_double_exact,
       bool_and(CAST(0.1 AS DECIMAL(4,2)) + CAST(0.2 AS DECIMAL(4,2)) = CAST(0.3 AS DECIMAL(4,2))) AS decimal_sum_equal,
       bool_and(CAST(0.1 AS DOUBLE) + CAST(0.2 AS DOUBLE) = CAST(0.3 AS DOUBLE)) AS double_sum_equal
FROM lineitem
""")
def decimal_vs_float(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    d, x = F.col("l_discount"), F.col("l_tax")
    dec = lambda c: c.cast("decimal(4,2)")
    two = dec(F.round(d + x, 2))
    return li.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count_if(dec(d) + dec(x) == two).alias("n_decimal_exact"),
                  F.count_if((d + x) == two.cast("double")).alias("n_double_exact"),
                  F.bool_and(dec(F.lit(0.1)) + dec(F.lit(0.2)) == dec(F.lit(0.3))).alias("decimal_sum_equal"),
                  F.bool_and(F.lit(0.1).cast("double") + F.lit(0.2).cast("double") == F.lit(0.3).cast("double"))
                   .alias("double_sum_equal"))


@register("filter_loosely", """
SELECT lower(strip_accents(c_mktsegment)) AS segment, count(*) AS customers
FROM customer WHERE lower(strip_accents(c_mktsegment)) IN ('building', 'machinery') GROUP BY 1
""")
def filter_loosely(spark, sf_dir):
    """Comparison without case and accents, by option; the group takes its name in lower case."""
    c = Tables(spark, sf_dir).customer.select("c_mktsegment")
    wanted = (loosely("c_mktsegment") == F.lit("B\u00fcilding")) | (loosely("c_mktsegment") == F.lit("machin\u00c9ry"))
    return (c.filter(wanted).groupBy(loosely("c_mktsegment").alias("s")).agg(F.count(F.lit(1)).alias("customers"))
            .select(F.lower(F.col("s")).cast("string").alias("segment"), "customers"))
