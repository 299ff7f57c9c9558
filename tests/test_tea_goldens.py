"""Goldens derived from the tea-shop seed (FIXTURES.md section 2), computed
with the library's operators."""

from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fixtures_tea import TEA_ROWS, TEA_SCHEMA
from tidewater.functions import pct
from tidewater.jobs import RangeReload
from tidewater.plans.relational import daypart


@pytest.fixture(scope="module")
def tea(spark):
    df = spark.createDataFrame(TEA_ROWS, TEA_SCHEMA)
    return (df.withColumn("ordered_at", F.col("ordered_at").cast("timestamp_ntz"))
              .withColumn("unit_price", F.col("unit_price").cast("decimal(8,2)"))
              .withColumn("discount", F.col("discount").cast("decimal(8,2)"))
              .withColumn("net", F.col("qty") * F.col("unit_price") - F.col("discount")))


def test_totals(tea):
    r = tea.agg(F.count(F.lit(1)).alias("n"), F.sum("qty").alias("cups"), F.sum("net").alias("net")).first()
    assert (r.n, r.cups, r.net) == (30, 56, Decimal("3210"))


def test_net_by_channel(tea):
    got = {r.channel: r.net for r in tea.groupBy("channel").agg(F.sum("net").alias("net")).collect()}
    assert got == {"grab": Decimal("1235"), "lineman": Decimal("1060"), "walk_in": Decimal("915")}


def test_menus_with_at_least_8_cups(tea):
    got = sorted((r.cups for r in tea.groupBy("menu").agg(F.sum("qty").alias("cups"))
                  .filter("cups >= 8").collect()), reverse=True)
    assert got == [26, 13, 8]


def test_member_share(tea):
    r = tea.agg(F.count(F.lit(1)).alias("n"), F.count("member_id").alias("m")).first()
    assert tea.agg(pct(F.count("member_id"), F.count(F.lit(1)))).first()[0] == 50.0 and r.m == 15


def test_dayparts(tea):
    got = {r.dp: (r.n, r.net) for r in tea.groupBy(daypart(F.col("ordered_at")).alias("dp"))
           .agg(F.count(F.lit(1)).alias("n"), F.sum("net").alias("net")).collect()}
    assert [got[k] for k in sorted(got)] == [(6, Decimal("455")), (12, Decimal("1600")),
                                              (6, Decimal("715")), (6, Decimal("440"))]


def test_ratings_skip_null(tea):
    got = {r.branch: (r.n, round(float(r.avg), 4)) for r in tea.groupBy("branch")
           .agg(F.count("rating").alias("n"), F.avg("rating").alias("avg")).collect()}
    assert got == {"สามย่าน": (13, 4.3077), "บางนา": (10, 3.7)}


def test_discounted_non_members(tea):
    got = sorted(r.order_id for r in tea.filter((F.col("discount") > 0) & F.col("member_id").isNull()).collect())
    assert got == [2, 4, 13, 21, 28]


def test_top5_net(tea):
    top = tea.orderBy(F.col("net").desc(), "order_id").limit(5).collect()
    assert [(r.order_id, r.net) for r in top] == [(28, Decimal("280")), (13, Decimal("230")), (21, Decimal("225")),
                                                  (4, Decimal("180")), (19, Decimal("165"))]


def test_pivot_branch_by_channel(tea):
    pv = tea.groupBy("branch").pivot("channel", ["walk_in", "grab", "lineman"]).agg(F.sum("net"))
    total = pv.agg(sum(F.sum(c) for c in ("walk_in", "grab", "lineman"))).first()[0]
    assert total == Decimal("3210") and pv.count() == 2


def test_daily_channel_summary_rerun_safe(spark, tea, scratch):
    summary = (tea.groupBy(F.col("ordered_at").cast("date").alias("sale_date"), "channel")
                  .agg(F.count(F.lit(1)).alias("orders"), F.sum("qty").alias("cups"), F.sum("net").alias("net_sales")))
    job = RangeReload(spark, scratch, "daily_channel_sales", "sale_date")
    job.run(summary)
    job.run(summary, "2026-09-16", "2026-09-18")   # re-run a range: same rows, no duplicates
    out = job.read()
    assert out.count() == 21
    assert out.groupBy("sale_date", "channel").count().filter("count > 1").count() == 0
    assert out.agg(F.sum("net_sales")).first()[0] == Decimal("3210")


def test_most_ordered_sweetness_per_size(tea):
    g = tea.groupBy("size", "sweetness").agg(F.sum("qty").alias("cups"))
    w = Window.partitionBy("size").orderBy(F.col("cups").desc())
    best = {r.size: (r.sweetness, r.cups) for r in g.withColumn("r", F.rank().over(w)).filter("r = 1").collect()}
    assert best["M"][0] == 50 and best["L"][0] == 50
