"""Distributed numbering equals the single-partition window functions,
including when one key holds a third of the rows."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.operators.scd2 import check_contiguous
from tidewater.operators.joins import pit_join
from tidewater.operators.sequence import assign_sk, carry_last, global_row_number, in_ranges, lag_within, lead_within, ntile

RANGES = (None, 1, 7, 60)


def skewed(spark, n=3000):
    # key 0 holds a third of all rows
    return (spark.range(n).withColumn("k", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97))
            .withColumn("v", (F.col("id") * 7919) % 1000))


def test_global_row_number_matches_window(spark):
    df = skewed(spark)
    want = df.withColumn("rn2", F.row_number().over(Window.orderBy("k", "v", "id")))
    for n in RANGES:
        got = global_row_number(df, ["k", "v", "id"], name="rn", num_partitions=n)
        j = got.join(want, "id")
        assert j.filter(F.col("rn") != F.col("rn2")).count() == 0
        assert got.count() == 3000


def test_ntile_matches_window(spark):
    for n, k in [(10, 4), (1500, 4), (1003, 7), (3, 5)]:
        df = spark.range(n).withColumn("v", (F.col("id") * 37) % 101)
        want = df.withColumn("b2", F.ntile(k).over(Window.orderBy(F.col("v").desc(), "id")))
        for m in (None, 7):
            got = ntile(df, k, [F.col("v").desc(), "id"], name="b", num_partitions=m)
            assert got.join(want, "id").filter(F.col("b") != F.col("b2")).count() == 0


def test_lag_within_matches_window(spark):
    df = skewed(spark)
    for n, back in [(m, 1) for m in RANGES] + [(60, 3), (7, 40)]:      # 40 rows back: beyond a whole range
        want = df.withColumn("p", F.lag("v", back).over(Window.partitionBy("k").orderBy("v", "id")))
        got = lag_within(df, ["k"], ["v", "id"], ["v"], offset=back, num_partitions=n)
        j = got.join(want.select("id", "p"), "id")
        assert j.filter(~F.col("prev_v").eqNullSafe(F.col("p"))).count() == 0
        assert got.count() == 3000


def test_lead_within_matches_window(spark):
    df = skewed(spark)
    got = lead_within(df, ["k"], ["v", "id"], ["v"])
    want = df.withColumn("n", F.lead("v").over(Window.partitionBy("k").orderBy("v", "id")))
    j = got.join(want.select("id", "n"), "id")
    assert j.filter(~F.col("next_v").eqNullSafe(F.col("n"))).count() == 0
    forced = lead_within(df, ["k"], ["v", "id"], ["v"], num_partitions=60)
    j = forced.join(want.select("id", "n"), "id")
    assert j.filter(~F.col("next_v").eqNullSafe(F.col("n"))).count() == 0


def _history(spark, n_hot=2000):
    # key 0 has a long contiguous history (a hot key), keys 1-3 one or two versions
    hot = (spark.range(n_hot).select(F.lit(0).cast("bigint").alias("k"), (F.col("id") + 1).alias("sk"),
                                     F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("valid_from"),
                                     F.when(F.col("id") < n_hot - 1,
                                            F.timestamp_seconds((F.col("id") + 1) * 60).cast("timestamp_ntz"))
                                      .alias("valid_to"),
                                     (F.col("id") == n_hot - 1).alias("is_current")))
    small = spark.createDataFrame(
        [(1, 90001, "2024-01-01 00:00:00", "2024-01-05 00:00:00", False),
         (1, 90002, "2024-01-05 00:00:00", None, True),
         (2, 90003, "2024-01-02 00:00:00", None, True)],
        "k bigint, sk bigint, valid_from string, valid_to string, is_current boolean")
    small = small.select("k", "sk", F.col("valid_from").cast("timestamp_ntz").alias("valid_from"),
                         F.col("valid_to").cast("timestamp_ntz").alias("valid_to"), "is_current")
    return hot.unionByName(small)


def test_contiguity_check_on_hot_key(spark):
    dim = _history(spark)
    for n in (None, 1, 40):
        assert check_contiguous(dim, "k", num_partitions=n).first()["violations"] == 0
        # a gap inside the hot key's history, and an overlap in key 1
        gap = dim.withColumn("valid_to", F.when(F.col("sk") == 700, F.col("valid_to") - F.expr("INTERVAL 1 SECOND"))
                             .otherwise(F.col("valid_to")))
        overlap = gap.withColumn("valid_to", F.when(F.col("sk") == 90001, F.lit("2024-01-06").cast("timestamp_ntz"))
                                 .otherwise(F.col("valid_to")))
        assert check_contiguous(gap, "k", num_partitions=n).first()["violations"] == 1
        assert check_contiguous(overlap, "k", num_partitions=n).first()["violations"] == 2


def test_no_rows_go_to_one_task(spark):
    """Only frames of one row per range are gathered: the windows over all rows are within a range."""
    df = skewed(spark)
    for out in (global_row_number(df, ["k", "id"], num_partitions=8), ntile(df, 4, ["v", "id"], num_partitions=8),
                lag_within(df, ["k"], ["id"], ["v"], num_partitions=8), carry_last(df, ["k"], ["id"], "v", "c", num_partitions=8)):
        node, lines = out._jdf.queryExecution().optimizedPlan(), []
        todo = [node]
        while todo:
            node = todo.pop()
            if node.nodeName() == "Window" and node.partitionSpec().isEmpty():       # only over what has a row per range
                lines.append(node.child().toString())
                assert "Aggregate [__range" in lines[-1].splitlines()[0] or "Aggregate [__range" in lines[-1].splitlines()[1], lines[-1]
            todo += [node.children().apply(i) for i in range(node.children().size())]
        assert lines
    ranges = in_ranges(df, ["k", "v", "id"], 16)
    sizes = [r["count"] for r in ranges.groupBy("__range").count().collect()]
    assert max(sizes) < 1000 / 2 and sum(sizes) == 3000


def test_carry_last(spark):
    df = skewed(spark).withColumn("s", F.when(F.col("id") % 50 == 7, F.col("id")))
    w = Window.partitionBy("k").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("w", F.last("s", ignorenulls=True).over(w)).select(F.col("id").alias("i"), "w")
    for n in RANGES:
        got = carry_last(df, ["k"], ["id"], "s", "c", num_partitions=n)
        assert got.join(want, F.col("id") == F.col("i")).where(~F.col("c").eqNullSafe(F.col("w"))).count() == 0 and got.count() == 3000


def _timeline(spark, n_versions, n_facts):
    """Key 0: a long history, with one gap, and most facts; keys 1 to 4: short ones; key 9: no version."""
    v = spark.range(n_versions).select(F.lit(0).cast("bigint").alias("k"), (F.col("id") * 10).alias("lo"),
                                       F.when(F.col("id") < n_versions - 1, (F.col("id") + 1) * 10 - F.when(F.col("id") == 3, 4).otherwise(0)).alias("hi"),
                                       F.concat(F.lit("t"), F.col("id")).alias("tier"))
    few = spark.createDataFrame([(1, 5, None, "a"), (2, 0, 7, "b"), (2, 7, 7, "none"), (2, 7, None, "c"), (3, 100, 200, "d"), (None, 0, None, "x")],
                                "k long, lo long, hi long, tier string")
    f = spark.range(n_facts).select(F.when(F.col("id") % 3 < 2, F.lit(0)).when(F.col("id") % 5 == 4, F.lit(9)).otherwise(F.col("id") % 5).alias("fk"),
                                    (F.col("id") * 7919 % (n_versions * 10 + 5)).alias("t"), F.col("id").alias("fid"))
    odd = spark.createDataFrame([(None, 5, -1), (0, None, -2), (1, 4, -3), (1, 5, -4), (2, 7, -5)], "fk long, t long, fid long")
    return v.unionByName(few), f.unionByName(odd)


def test_as_of_join_equals_interval_join(spark):
    versions, facts = _timeline(spark, 60, 900)
    on = (F.col("fk") == F.col("k")) & (F.col("t") >= F.col("lo")) & (F.col("hi").isNull() | (F.col("t") < F.col("hi")))
    for how in ("left", "inner"):
        want = sorted(map(str, facts.join(versions, on, how).drop("k").collect()))
        for n in RANGES:
            got = pit_join(facts, "fk", "t", versions, "k", "lo", "hi", how, num_partitions=n)
            assert got.columns == ["fk", "t", "fid", "lo", "hi", "tier"] and sorted(map(str, got.collect())) == want


def test_as_of_join_of_a_hot_key(spark):
    """100,000 facts and 10,000 versions, most of one key: no join of rows on the key, and no hot task."""
    versions, facts = _timeline(spark, 10_000, 100_000)
    out = pit_join(facts, "fk", "t", versions, "k", "lo", "hi", num_partitions=24)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "Join LeftOuter, (__range" in plan        # the hand-over, one row per range
    assert out.count() == facts.count() and out.where("fk = 0 AND tier IS NULL").count() < 100
    wrong = out.where("tier LIKE 't%' AND NOT (t >= lo AND (hi IS NULL OR t < hi) AND tier = concat('t', lo div 10))")
    assert wrong.count() == 0
    rows = in_ranges(facts, ["fk", "t"], 24).groupBy("__range").count().agg(F.max("count")).first()[0]
    assert rows < 100_000 / 8


def test_assign_sk_continues_from_max(spark):
    existing = spark.createDataFrame([("a", 1), ("b", 2), ("c", 5)], "name string, sk bigint")
    new = spark.createDataFrame([("e",), ("d",)], "name string")
    out = {r.name: r.sk for r in assign_sk(existing, new, ["name"]).collect()}
    assert out == {"d": 6, "e": 7}


def test_hot_key_is_split_across_range_partitions(spark):
    """The numbering never puts a hot key into one task: with a key holding a
    third of the rows, the largest range partition stays far below a third."""
    df = skewed(spark, 30000)
    n = 16
    ranged = df.repartitionByRange(n, "k", "v", "id").withColumn("pid", F.spark_partition_id())
    sizes = [r["count"] for r in ranged.groupBy("pid").count().collect()]
    assert max(sizes) < 30000 / 3 / 2
    hot = ranged.filter("k = 0").select("pid").distinct().count()
    assert hot >= 4
