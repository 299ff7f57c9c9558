"""Procedural tests of the load patterns: run, re-run (no change), advance, run."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tidewater.jobs import RangeReload, WatermarkLoad
from tidewater.operators.loads import append_new, change_counts, daily_category_sales, upsert

SCHEMA = "id long, status string, amount decimal(12,2), updated_at timestamp_ntz, first_seen timestamp_ntz"


def src(spark, rows):
    ts = dt.datetime.fromisoformat
    return spark.createDataFrame([(i, s, Decimal(a), ts(u), ts(u)) for i, s, a, u in rows], SCHEMA)


def test_watermark_load_procedure(spark, scratch):
    job = WatermarkLoad(spark, scratch, "stg", key="id", ts_col="updated_at",
                        update_cols=["status", "amount", "updated_at"], lookback="1 HOUR", n_buckets=4)
    v1 = [(1, "pending", "10", "2026-09-01 10:00"), (2, "confirmed", "20", "2026-09-01 11:00")]
    r = job.run(src(spark, v1))
    assert (r["rows_new"], r["rows_changed"]) == (2, 0)
    r = job.run(src(spark, v1))                     # immediate re-run: the lookback re-reads, nothing changes
    assert (r["rows_new"], r["rows_changed"]) == (0, 0)
    v2 = [(1, "shipped", "10", "2026-09-02 09:00"), (2, "confirmed", "20", "2026-09-01 11:00"),
          (3, "pending", "5", "2026-09-02 09:30")]
    r = job.run(src(spark, v2))
    assert (r["rows_new"], r["rows_changed"]) == (1, 1)
    t = {x.id: (x.status, x.first_seen) for x in job.target().collect()}
    assert t[1] == ("shipped", dt.datetime(2026, 9, 1, 10))  # first_seen keeps its first value
    assert len(t) == 3
    log = job.log().orderBy("load_id").collect()
    assert [(x.rows_new, x.rows_changed) for x in log] == [(2, 0), (0, 0), (1, 1)]
    assert log[-1].wm_from == dt.datetime(2026, 9, 1, 11) and log[-1].wm_to == dt.datetime(2026, 9, 2, 9, 30)


def test_watermark_empty_source_keeps_mark(spark, scratch):
    job = WatermarkLoad(spark, scratch, "stg", key="id", ts_col="updated_at", update_cols=["status"])
    job.run(src(spark, [(1, "a", "1", "2026-01-01 00:00")]))
    assert job.run(spark.createDataFrame([], SCHEMA)) == {"skipped": True}
    assert job.log().count() == 1


def test_range_reload_equals_rebuild(spark, scratch):
    rows = [(f"2026-09-0{d}", c, d * 10 + len(c)) for d in range(1, 8) for c in ("x", "yy")]
    fact = spark.createDataFrame(rows, "d string, c string, v int").withColumn("d", F.col("d").cast("date"))
    job = RangeReload(spark, scratch, "fct", "d")  # daily grain
    job_m = RangeReload(spark, scratch + "-m", "fct", "d", grain="month")
    changed = fact.filter("d <> DATE'2026-09-03'").withColumn("v", F.col("v") + 1)
    want = fact.filter("d < DATE'2026-09-02' OR d > DATE'2026-09-04'").unionByName(
        changed.filter("d BETWEEN DATE'2026-09-02' AND DATE'2026-09-04'"))
    for j in (job, job_m):
        j.run(fact)
        for _ in range(2):                           # re-run: no duplicates
            j.run(changed, "2026-09-02", "2026-09-04")
        assert sorted(j.read().collect()) == sorted(want.collect())
        assert j.read().filter("d = DATE'2026-09-03'").count() == 0


def test_upsert_first_value_and_counts(spark):
    tgt = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, first string")
    s = spark.createDataFrame([(2, "B", "z"), (3, "c", "w")], "k int, v string, first string")
    out = {r.k: (r.v, r.first) for r in upsert(tgt, s, "k", ["v"]).collect()}
    assert out == {1: ("a", "x"), 2: ("B", "y"), 3: ("c", "w")}
    c = change_counts(tgt, s, "k", ["v"]).first()
    assert (c.rows_new, c.rows_changed, c.rows_unchanged) == (1, 1, 0)


def test_append_by_id_is_idempotent(spark):
    t = spark.range(5).withColumnRenamed("id", "event_id")
    s = spark.range(8).withColumnRenamed("id", "event_id")
    new = append_new(t, s, "event_id")
    assert sorted(r.event_id for r in new.collect()) == [5, 6, 7]
    assert append_new(t.unionByName(new), s, "event_id").count() == 0


def test_watermark_load_keeps_latest_of_duplicate_keys(spark, scratch):
    job = WatermarkLoad(spark, scratch, "stg", key="id", ts_col="updated_at", update_cols=["status", "updated_at"])
    rows = [(1, "pending", "1", "2026-09-01 10:00"), (1, "paid", "1", "2026-09-01 12:00"),
            (1, "packed", "1", "2026-09-01 11:00")]
    r = job.run(src(spark, rows))
    assert r["rows_new"] == 1
    assert [x.status for x in job.target().collect()] == ["paid"]


def test_daily_fact_holds_few_lines_a_task(spark):
    """The shuffles of the lines grow with the lines, not only with the session's number; repeated and null keys count as in SQL"""
    import re

    day = lambda d: dt.datetime(2026, 1, d)
    orders = spark.createDataFrame([(k, "P" if k % 9 == 0 else "F", day(1 + k % 3)) for k in range(400)] + [(5, "F", day(3)), (5, "O", day(3)), (7, "F", day(2)), (None, "F", day(1))],
                                   "o_orderkey long, o_orderstatus string, o_orderdate timestamp_ntz")
    lines = spark.createDataFrame([(k % 401 if k % 50 else None, k % 23, float(k % 6), 10.0 + k % 7, (k % 5) / 100) for k in range(2000)],
                                  "l_orderkey long, l_partkey long, l_quantity double, l_extendedprice double, l_discount double")
    part = spark.createDataFrame([(k, f"t{k % 4}") for k in range(23)] + [(3, "t1"), (4, None)], "p_partkey long, p_type string")
    orders.createOrReplaceTempView("df_o"), lines.createOrReplaceTempView("df_l"), part.createOrReplaceTempView("df_p")
    want = spark.sql("""SELECT CAST(o_orderdate AS DATE) AS sales_date, p_type AS top_category, count(DISTINCT o_orderkey) AS orders, CAST(sum(l_quantity) AS BIGINT) AS units,
        CAST(sum(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS revenue
        FROM df_o JOIN df_l ON l_orderkey = o_orderkey JOIN df_p ON p_partkey = l_partkey WHERE o_orderstatus <> 'P' GROUP BY 1, 2""")
    key = lambda r: (str(r.sales_date), str(r.top_category))
    rows = sorted(want.collect(), key=key)
    for few in (10**6, 100):
        got = daily_category_sales(orders, lines, part, task_rows=few)
        assert got.schema.simpleString() == want.schema.simpleString() and sorted(got.collect(), key=key) == rows
        week = daily_category_sales(orders, lines, part, "2026-01-02", "2026-01-03", task_rows=few)
        assert sorted(week.collect(), key=key) == [r for r in rows if r.sales_date >= dt.date(2026, 1, 2)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert {"20"} <= set(re.findall(r"l_orderkey#\d+L?, (\d+)\), REPARTITION_BY_NUM", plan)) and re.search(r"l_partkey#\d+L?, 20\), REPARTITION_BY_NUM", plan)
