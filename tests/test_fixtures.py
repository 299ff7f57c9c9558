"""Goldens of the reference's hand-checkable tables (FIXTURES.md section 2)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tidewater.operators.joins import fanout_report, preagg_join
from tidewater.operators.loads import latest_per_key
from tidewater.operators.rewrite import cascade_delete
from tidewater.operators.scd2 import as_of, empty_dimension, scd2_merge

D = Decimal


def mini_shop(spark):
    customers = spark.createDataFrame(
        [(1, "CUS-0000001"), (2, "CUS-0000002"), (3, "CUS-0000003"), (4, "CUS-0000004"),
         (5, "CUS-0000005"), (6, "CUS-0000006")], "customer_id int, customer_code string")
    orders = spark.createDataFrame(
        [(101, 1, "completed"), (102, 2, "completed"), (103, 1, "cancelled"), (104, 3, "completed"),
         (105, 4, "shipped"), (106, 1, "completed"), (107, 5, "pending_payment")],
        "order_id int, customer_id int, status string")
    items = spark.createDataFrame(
        [(101, 1, 1, 2, D("290")), (101, 2, 4, 3, D("35")), (102, 1, 3, 1, D("259")), (103, 1, 2, 1, D("3990")),
         (104, 1, 5, 2, D("390")), (104, 2, 4, 5, D("35")), (104, 3, 3, 1, D("259")), (105, 1, 2, 1, D("3990")),
         (106, 1, 1, 1, D("290")), (107, 1, 5, 1, D("390"))],
        "order_id int, line_number int, product_id int, quantity int, unit_price decimal(10,2)")
    payments = spark.createDataFrame(
        [(1, 101, D("685"), "success"), (2, 102, D("259"), "success"), (3, 103, D("3990"), "failed"),
         (4, 104, D("1214"), "failed"), (5, 104, D("1214"), "success"), (6, 105, D("3990"), "pending"),
         (7, 106, D("290"), "success")], "payment_id int, order_id int, amount decimal(10,2), status string")
    return customers, orders, items, payments


def test_order_104_preaggregated_totals(spark):
    _, orders, items, payments = mini_shop(spark)
    line = (F.col("quantity") * F.col("unit_price"))
    out = preagg_join(
        orders, "order_id",
        {"i": (items, "order_id", [F.sum(line).alias("items_total")], "inner"),
         "p": (payments.filter("status = 'success'"), "order_id", [F.sum("amount").alias("paid")], "left"),
         "f": (payments.filter("status = 'failed'"), "order_id", [F.count(F.lit(1)).alias("failed")], "left")},
        fill={"failed": F.lit(0).cast("bigint")})
    r = out.filter("order_id = 104").first()
    assert (r.items_total, r.paid, r.failed) == (D("1214"), D("1214"), 1)
    assert out.count() == 7


def test_order_104_fanout_detected(spark):
    _, _, items, payments = mini_shop(spark)
    rep = fanout_report(items, "order_id", payments, "order_id",
                        amount=F.col("quantity") * F.col("unit_price"), key_name="order_id")
    r = rep.filter("order_id = 104").first()
    assert r.joined_rows == 6 and r.right_total == D("1214") and r.fanned_total == D("2428") and r.fans_out


def test_customer_without_orders(spark):
    customers, orders, _, _ = mini_shop(spark)
    never = customers.join(orders, "customer_id", "left_anti").select("customer_code").collect()
    assert [r.customer_code for r in never] == ["CUS-0000006"]


def test_cascade_delete_order_107(spark):
    _, orders, items, payments = mini_shop(spark)
    kept_o, kept = cascade_delete(orders, "order_id", "order_id = 107",
                                  {"items": (items, "order_id"), "payments": (payments, "order_id")})
    assert kept_o.count() == 6
    assert kept["items"].filter("order_id = 107").count() == 0
    assert kept["items"].count() == 9


def test_landing_dedup_by_source_time(spark):
    ts = dt.datetime.fromisoformat
    land = spark.createDataFrame([
        (1, 1001, "pending_payment", ts("2026-09-20 10:00"), ts("2026-09-20 10:05")),
        (2, 1001, "pending_payment", ts("2026-09-20 10:00"), ts("2026-09-20 10:06")),
        (3, 1001, "confirmed", ts("2026-09-20 10:03"), ts("2026-09-20 11:00")),
        (4, 1002, "confirmed", ts("2026-09-20 12:00"), ts("2026-09-20 12:01")),
        (5, 1003, "shipped", ts("2026-09-21 09:00"), ts("2026-09-21 09:30")),
        (6, 1003, "delivered", ts("2026-09-22 14:00"), ts("2026-09-22 14:10")),
        (7, 1003, "shipped", ts("2026-09-21 09:00"), ts("2026-09-22 15:00")),
    ], "ingest_id long, order_id long, status string, updated_at timestamp_ntz, ingested_at timestamp_ntz")
    out = latest_per_key(land, "order_id", ["updated_at", "ingested_at"])
    got = {r.order_id: r.status for r in out.collect()}
    assert got == {1001: "confirmed", 1002: "confirmed", 1003: "delivered"}
    # ordering by ingest time alone would pick the stale re-send
    wrong = latest_per_key(land, "order_id", ["ingested_at"])
    assert {r.order_id: r.status for r in wrong.collect()}[1003] == "shipped"


def test_scd2_rounds_of_machines(spark):
    """Own rows: a machine that moves, one that is refitted, one that stays, one that comes later."""
    cols = "serial string, site string, refit int"
    load = lambda rows: spark.createDataFrame(rows, cols)
    spring, autumn = load([("p7", "north", 0), ("q1", "south", 2), ("x9", "north", 5)]), load([("p7", "quay", 0), ("q1", "south", 3), ("x9", "north", 5), ("z2", "quay", 0)])
    tracked = ["site", "refit"]
    merge = lambda dim, rows, at: scd2_merge(dim, rows, "serial", tracked, sk="machine_sk", load_time=at).checkpoint()
    dim = merge(empty_dimension(spark, spring, "serial", tracked, "machine_sk"), spring, "2025-04-01 00:00:00")
    dim = merge(dim, autumn, "2025-10-01 00:00:00")
    versions = sorted((r.serial, r.site, r.refit, r.is_current) for r in dim.collect())
    assert versions == [("p7", "north", 0, False), ("p7", "quay", 0, True), ("q1", "south", 2, False), ("q1", "south", 3, True),
                        ("x9", "north", 5, True), ("z2", "quay", 0, True)]
    assert sorted(r.machine_sk for r in dim.collect()) == [1, 2, 3, 4, 5, 6]
    assert merge(dim, autumn, "2025-10-01 00:00:00").count() == 6          # the same load again opens nothing
    summer = as_of(dim, "2025-07-01 00:00:00").collect()
    assert {r.serial: r.site for r in summer} == {"p7": "north", "q1": "south", "x9": "north"}
    assert {r.valid_from for r in summer} == {dt.datetime(2025, 4, 1)}


def test_decimal_vs_double(spark):
    r = spark.sql("SELECT CAST(0.1 AS DECIMAL(4,2)) + CAST(0.2 AS DECIMAL(4,2)) = CAST(0.3 AS DECIMAL(4,2)) AS d, "
                  "CAST(0.1 AS DOUBLE) + CAST(0.2 AS DOUBLE) = CAST(0.3 AS DOUBLE) AS f").first()
    assert r.d is True and r.f is False
