"""Table-maintenance keys and contract keys.

Each statement of the reference (UPDATE, DELETE, cascade, transfer, key
assignment, constraint enforcement) is a rewrite old -> new of a driver table.
"""

from __future__ import annotations

import uuid
from decimal import Decimal

from pyspark.sql import functions as F

from tidewater.functions import CANCELLED, COMPLETED, money
from tidewater.jobs import BalanceTable
from tidewater.operators.contracts import Col, Contract, ForeignKey, conform, evolve, quarantine
from tidewater.operators.rewrite import (Reference, RestrictViolation, TransferRejected, delete_where, delete_with_references, soft_delete,
                                         touch_changed, update_where)
from tidewater.operators.sequence import assign_sk
from tidewater.plans.registry import register
from tidewater.session import scratch_root
from tidewater.sources import Tables

RUN_AT = "2024-02-01 00:00:00"      # the explicit run time of these rewrites
INITIAL_AT = "2024-01-01 00:00:00"  # audit time of the rows before the rewrite


def _customers(t):
    return t.customer.select("c_custkey", "c_name", "c_nationkey", money("c_acctbal").alias("c_acctbal"),
                             "c_mktsegment")


RAISE_SQL = """CASE WHEN c_mktsegment = 'BUILDING'
                THEN CAST(CAST(c_acctbal AS DECIMAL(18,2)) * 1.10 AS DECIMAL(18,2))
                ELSE CAST(c_acctbal AS DECIMAL(18,2)) END"""


def _raised(t):
    return update_where(_customers(t), F.col("c_mktsegment") == "BUILDING",
                        {"c_acctbal": F.col("c_acctbal") * F.lit(Decimal("1.10"))})


@register("update_where", f"""
SELECT c_custkey, c_mktsegment, {RAISE_SQL} AS c_acctbal FROM customer
""")
def update_where_q(spark, sf_dir):
    return _raised(Tables(spark, sf_dir)).select("c_custkey", "c_mktsegment", "c_acctbal")


@register("update_case", f"""
WITH n AS (SELECT o_custkey, count(*) AS k FROM orders WHERE o_orderstatus = '{COMPLETED}' GROUP BY 1)
SELECT c.c_custkey,
       CASE WHEN coalesce(n.k, 0) >= 6 THEN 'gold' WHEN coalesce(n.k, 0) >= 3 THEN 'silver' ELSE 'bronze' END AS tier
FROM customer c LEFT JOIN n ON n.o_custkey = c.c_custkey
""")
def update_case(spark, sf_dir):
    t = Tables(spark, sf_dir)
    n = (t.orders.filter(F.col("o_orderstatus") == COMPLETED).groupBy("o_custkey")
          .agg(F.count(F.lit(1)).alias("k")))
    c = (t.customer.select("c_custkey").join(n, F.col("c_custkey") == F.col("o_custkey"), "left")
          .withColumn("tier", F.lit("bronze")))
    k = F.coalesce(F.col("k"), F.lit(0))
    # full re-classification: one CASE over every row, first match wins
    out = update_where(c, F.lit(True), {"tier": F.when(k >= 6, "gold").when(k >= 3, "silver").otherwise("bronze")})
    return out.select("c_custkey", "tier")


@register("delete_where", f"""
SELECT o_orderkey, o_orderstatus FROM orders
WHERE NOT coalesce(o_orderstatus = '{CANCELLED}' AND o_orderdate < TIMESTAMP '1996-01-01 00:00:00', false)
""")
def delete_where_q(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderstatus", "o_orderdate")
    pred = (F.col("o_orderstatus") == CANCELLED) & (F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz"))
    return delete_where(o, pred).select("o_orderkey", "o_orderstatus")


@register("soft_delete", f"""
SELECT c_custkey,
       CASE WHEN c_acctbal < 0 THEN TIMESTAMP '{RUN_AT}' END AS deleted_at,
       c_acctbal >= 0 AS is_active
FROM customer
""")
def soft_delete_q(spark, sf_dir):
    c = _customers(Tables(spark, sf_dir))
    marked = soft_delete(c, F.col("c_acctbal") < 0, RUN_AT)
    return marked.select("c_custkey", "deleted_at", F.col("deleted_at").isNull().alias("is_active"))


@register("cascade_delete", """
WITH gone AS (SELECT c_custkey FROM customer WHERE c_acctbal < 0),
gone_orders AS (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM gone))
SELECT 'customer' AS level, c_custkey AS id, CAST(NULL AS INT) AS line FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM gone)
UNION ALL
SELECT 'orders', o_orderkey, NULL FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM gone)
UNION ALL
SELECT 'lineitem', l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM gone_orders)
""")
def cascade_delete_q(spark, sf_dir):
    """Customers in debt are deleted; their orders and those orders' lines go with
    them.  Without the cascade the same delete is refused."""
    t = Tables(spark, sf_dir)
    tables = {"customer": t.customer.select("c_custkey", "c_acctbal"), "orders": t.orders.select("o_orderkey", "o_custkey"),
              "lineitem": t.lineitem.select("l_orderkey", "l_linenumber")}
    keys = {"customer": "c_custkey", "orders": "o_orderkey"}
    debt = F.col("c_acctbal") < 0
    try:
        delete_with_references(tables, keys, [Reference("orders", "o_custkey", "customer")], "customer", debt)
        raise AssertionError("orders that stay must refuse the delete")
    except RestrictViolation:
        pass
    kept = delete_with_references(tables, keys, [Reference("orders", "o_custkey", "customer", "cascade"),
                                                 Reference("lineitem", "l_orderkey", "orders", "cascade")], "customer", debt)
    none = F.lit(None).cast("int")
    return (kept["customer"].select(F.lit("customer").alias("level"), F.col("c_custkey").alias("id"), none.alias("line"))
            .unionByName(kept["orders"].select(F.lit("orders").alias("level"), F.col("o_orderkey").alias("id"), none.alias("line")))
            .unionByName(kept["lineitem"].select(F.lit("lineitem").alias("level"), F.col("l_orderkey").alias("id"), F.col("l_linenumber").cast("int").alias("line"))))


@register("apply_deltas", """
WITH src AS (SELECT c_custkey, CAST(c_acctbal AS DECIMAL(18,2)) AS bal FROM customer),
rich AS (SELECT c_custkey FROM src ORDER BY bal DESC, c_custkey LIMIT 1),
poor AS (SELECT c_custkey FROM src ORDER BY bal ASC, c_custkey LIMIT 1)
SELECT c_custkey,
       CAST(bal + CASE WHEN c_custkey = (SELECT c_custkey FROM rich) THEN -100
                       WHEN c_custkey = (SELECT c_custkey FROM poor) THEN 100 ELSE 0 END AS DECIMAL(18,2)) AS c_acctbal
FROM src
""")
def apply_deltas_q(spark, sf_dir):
    """A transfer from the richest to the poorest customer as one publish; one to
    an unknown customer, and one that makes money, are refused."""
    c = _customers(Tables(spark, sf_dir)).select("c_custkey", "c_acctbal")
    table = BalanceTable(spark, f"{scratch_root(spark)}/balances-{uuid.uuid4().hex[:10]}", "accounts", "c_custkey", "c_acctbal")
    table.initialise(c)
    rich = c.orderBy(F.col("c_acctbal").desc(), "c_custkey").limit(1).select("c_custkey", F.lit(-100).alias("delta"))
    poor = c.orderBy(F.col("c_acctbal").asc(), "c_custkey").limit(1).select("c_custkey", F.lit(100).alias("delta"))
    unknown = spark.createDataFrame([(-1, 100)], "c_custkey long, delta int")
    for bad in (rich.unionByName(unknown), poor):
        try:
            table.transfer(bad)
            raise AssertionError("an unbalanced or unknown transfer must be refused")
        except TransferRejected:
            pass
    table.transfer(rich.unionByName(poor))
    return table.read()


@register("assign_sk", """
WITH first_load AS (SELECT DISTINCT p_type, p_brand FROM part WHERE p_retailprice < 950),
dim1 AS (SELECT p_type, p_brand, row_number() OVER (ORDER BY p_type, p_brand) AS sk FROM first_load),
newcomers AS (SELECT DISTINCT p_type, p_brand FROM part
              EXCEPT SELECT p_type, p_brand FROM dim1),
dim2 AS (SELECT p_type, p_brand, (SELECT max(sk) FROM dim1) + row_number() OVER (ORDER BY p_type, p_brand) AS sk
         FROM newcomers)
SELECT p_type, p_brand, CAST(sk AS BIGINT) AS sk FROM dim1
UNION ALL SELECT p_type, p_brand, CAST(sk AS BIGINT) FROM dim2
""")
def assign_sk_q(spark, sf_dir):
    p = Tables(spark, sf_dir).part.select("p_type", "p_brand", "p_retailprice")
    empty = spark.createDataFrame([], "p_type string, p_brand string, sk bigint")
    first = p.filter(F.col("p_retailprice") < 950).select("p_type", "p_brand").distinct()
    dim1 = assign_sk(empty, first, ["p_type", "p_brand"])
    newcomers = p.select("p_type", "p_brand").distinct().join(dim1, ["p_type", "p_brand"], "left_anti")
    dim2 = assign_sk(dim1, newcomers, ["p_type", "p_brand"])
    return dim1.unionByName(dim2)


def customer_contract(t) -> Contract:
    """The segment vocabulary the contract accepts."""
    segments = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
    return Contract(
        name="customer",
        columns=[Col("c_custkey", "bigint", nullable=False), Col("c_name", "string", nullable=False, max_length=18),
                 Col("c_nationkey", "int", nullable=False), Col("c_acctbal", "decimal(18,2)", check="c_acctbal >= 0"),
                 Col("c_mktsegment", "string", accepted=segments)],
        primary_key=["c_custkey"],
        foreign_keys=[ForeignKey("c_nationkey", t.nation, "n_nationkey")])


@register("constraint_quarantine", """
SELECT c.c_custkey,
       CASE WHEN c.c_acctbal < 0 OR n.n_nationkey IS NULL OR length(c.c_name) > 18 THEN 'rejected'
            ELSE 'accepted' END AS status,
       concat_ws('; ',
                 CASE WHEN length(c.c_name) > 18 THEN 'c_name longer than 18' END,
                 CASE WHEN c.c_acctbal < 0 THEN 'check failed: c_acctbal >= 0' END,
                 CASE WHEN n.n_nationkey IS NULL THEN 'c_nationkey has no parent' END) AS reasons
FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
""")
def constraint_quarantine(spark, sf_dir):
    t = Tables(spark, sf_dir)
    checked = quarantine(_customers(t), customer_contract(t))
    return checked.select("c_custkey",
                          F.when(F.size("reasons") == 0, "accepted").otherwise("rejected").alias("status"),
                          F.concat_ws("; ", "reasons").alias("reasons"))


@register("touch_changed", f"""
SELECT c_custkey, {RAISE_SQL} AS c_acctbal,
       CASE WHEN {RAISE_SQL} <> CAST(c_acctbal AS DECIMAL(18,2)) THEN TIMESTAMP '{RUN_AT}'
            ELSE TIMESTAMP '{INITIAL_AT}' END AS updated_at
FROM customer
""")
def touch_changed_q(spark, sf_dir):
    t = Tables(spark, sf_dir)
    old = _customers(t).withColumn("updated_at", F.lit(INITIAL_AT).cast("timestamp_ntz"))
    new = _raised(t)
    return touch_changed(old, new, "c_custkey", ["c_acctbal"], RUN_AT).select("c_custkey", "c_acctbal", "updated_at")


MEMBER_CONTRACT = Contract(
    name="members",
    columns=[Col("member_id", "bigint", nullable=False), Col("member_code", "string", nullable=False, max_length=18),
             Col("name", "string"), Col("province", "string", default="unknown"),
             Col("tier", "string", default="bronze", accepted=("bronze", "silver", "gold")),
             Col("points", "int", default=0, check="points >= 0"), Col("joined_date", "date")],
    primary_key=["member_id"])


@register("conform_defaults", """
SELECT c_custkey AS member_id, c_name AS member_code, replace(c_name, 'Customer#', 'Member ') AS name,
       'unknown' AS province, 'bronze' AS tier, CAST(0 AS INT) AS points, CAST(NULL AS DATE) AS joined_date
FROM customer
""")
def conform_defaults(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    supplied = c.select(F.col("c_custkey").alias("member_id"), F.col("c_name").alias("member_code"),
                        F.replace("c_name", F.lit("Customer#"), F.lit("Member ")).alias("name"))
    return conform(supplied, MEMBER_CONTRACT)


@register("evolve_schema", f"""
SELECT c_custkey, c_name AS customer_code, CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal,
       CAST(NULL AS VARCHAR) AS email, 'v1' AS schema_version
FROM customer
UNION ALL
SELECT o_custkey, NULL, NULL, concat('c', CAST(o_custkey AS VARCHAR), '@example.com'), 'v2'
FROM orders WHERE o_orderstatus = '{COMPLETED}' AND o_orderdate >= TIMESTAMP '2001-07-01 00:00:00'
""")
def evolve_schema(spark, sf_dir):
    t = Tables(spark, sf_dir)
    v1 = evolve(t.customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment"),
                add={"email": ("string", None), "schema_version": ("string", "v1")},
                retype={"c_acctbal": "decimal(18,2)"}, rename={"c_name": "customer_code"}, drop=["c_mktsegment"])
    # a later source batch that already carries the new column and lacks others
    v2 = (t.orders.filter((F.col("o_orderstatus") == COMPLETED)
                          & (F.col("o_orderdate") >= F.lit("2001-07-01").cast("timestamp_ntz")))
           .select(F.col("o_custkey").alias("c_custkey"),
                   F.concat(F.lit("c"), F.col("o_custkey").cast("string"), F.lit("@example.com")).alias("email"),
                   F.lit("v2").alias("schema_version")))
    return v1.unionByName(v2, allowMissingColumns=True)
