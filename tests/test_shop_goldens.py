"""Goldens of the extended mini shop (FIXTURES.md section 2), through the
library's join operators."""

import pytest
from pyspark.sql import functions as F

import fixtures_shop as S
from tidewater.operators.joins import preagg_join


@pytest.fixture(scope="module")
def shop(spark):
    def mk(spec):
        schema, rows = spec
        return spark.createDataFrame(rows, schema)
    o = mk(S.ORDERS).withColumn("ordered_at", F.col("ordered_at").cast("timestamp_ntz"))
    return mk(S.CUSTOMERS), mk(S.PRODUCTS), o, mk(S.ORDER_ITEMS), mk(S.PAYMENTS)


def test_sales_by_category(shop):
    _, p, o, i, _ = shop
    live = o.filter("status <> 'cancelled'").select("order_id")
    lines = i.join(live, "order_id", "left_semi")      # the status condition belongs to the join
    got = {r.category: (r.units, r.amount) for r in lines.join(p, "product_id").groupBy("category")
           .agg(F.sum("quantity").alias("units"), F.sum(F.col("quantity") * F.col("unit_price")).alias("amount"))
           .collect()}
    assert got == {"Electronics": (7, 9230), "Fashion": (4, 1560), "Beauty": (4, 1036), "Food": (8, 280)}


def test_customers_without_completed_order(shop):
    c, _, o, _, _ = shop
    got = c.join(o.filter("status = 'completed'"), "customer_id", "left_anti").select("customer_id")
    assert sorted(r.customer_id for r in got.collect()) == [4, 5, 6, 8]


def test_products_never_sold(shop):
    _, p, o, i, _ = shop
    sold = i.join(o.filter("status <> 'cancelled'"), "order_id", "left_semi")
    assert [r.product_id for r in p.join(sold, "product_id", "left_anti").collect()] == [6]


def test_lines_below_list_price(shop):
    _, p, o, i, _ = shop
    below = i.join(p, "product_id").filter(F.col("unit_price") < F.col("price")).collect()
    assert [(r.order_id, r.price, r.unit_price) for r in below] == [(109, 3990, 3790)]


def test_order_109_without_fanout(shop):
    _, _, o, i, pay = shop
    out = preagg_join(o, "order_id", {
        "items": (i, "order_id", [F.sum(F.col("quantity") * F.col("unit_price")).alias("items_total")], "inner"),
        "paid": (pay.filter("status = 'success'"), "order_id", [F.sum("amount").alias("paid")], "left"),
        "failed": (pay.filter("status = 'failed'"), "order_id", [F.count(F.lit(1)).alias("failed")], "left")},
        fill={"failed": F.lit(0).cast("bigint")})
    r = out.filter("order_id = 109").first()
    assert (r.items_total, r.paid, r.failed) == (4370, 4370, 2)


def test_completed_without_success_payment(shop):
    _, _, o, _, pay = shop
    bad = o.filter("status = 'completed'").join(pay.filter("status = 'success'"), "order_id", "left_anti")
    assert bad.count() == 0


def test_timeline_of_customer_2(shop):
    c, _, o, _, pay = shop
    mine = o.join(c.filter("customer_code = 'CUS-0000002'"), "customer_id", "left_semi")
    orders = mine.select(F.lit("order").alias("event"), F.col("order_number").alias("ref"),
                         F.col("ordered_at").alias("at_time"), F.col("status").alias("detail"))
    pays = (pay.join(mine.select("order_id", "order_number"), "order_id")
               .select(F.lit("payment").alias("event"), F.col("order_number").alias("ref"),
                       F.concat_ws(" ", "method", "status").alias("detail")))
    tl = orders.unionByName(pays, allowMissingColumns=True).collect()
    assert len(tl) == 6 and sum(r.event == "order" for r in tl) == 2


def test_best_province_keeps_ties(shop):
    c, _, o, _, pay = shop
    done = o.filter("status = 'completed'")
    sales = (pay.filter("status = 'success'").join(done, "order_id").join(c, "customer_id")
                .groupBy("province").agg(F.sum("amount").alias("sales")))
    best = sales.agg(F.max("sales").alias("m"))
    got = sales.crossJoin(F.broadcast(best)).filter("sales = m").collect()
    assert [(r.province, r.sales) for r in got] == [("เชียงใหม่", 5537)]
