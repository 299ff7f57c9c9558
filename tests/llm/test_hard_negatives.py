"""Hard negatives against plain Python."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm import hard_negatives as hn
from tidewater.llm import queries

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())])


def moved(i, label):
    return (label + 1) % 10 if i % 7 == 0 else label


def plain(rows):
    live = [(i, [math.floor(256 * float(np.float32(x))) for x in v], moved(i, g)) for i, v, g in rows
            if i is not None and v is not None and g is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v, g in {(i, tuple(v), g) for i, v, g in live}:
        if i % 100:
            continue
        scored = sorted(((sum(a * b for a, b in zip(v, w)), j, h) for j, w, h in live if j != i), key=lambda x: (-x[0], x[1]))
        for s, j, _ in [x for x in scored if x[2] == g][:5]:
            hits = [x for x in scored if x[2] != g and 30 * s <= 100 * x[0] <= 90 * s][:10]
            out += [(i, j, n + 1, k, s, t) for n, (t, k, _) in enumerate(hits)]
    return sorted(out)


def vectors(n, seed, dims=12):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.3) for _ in range(dims)] for _ in range(10)]
    rows = []
    for i in range(n):
        g = rng.randrange(10)
        rows.append((i, [rng.gauss(c, 0.2) for c in centres[g]], g))
    return rows


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    out = hn.mine(df, F.col("id") % 100 == 0, label=F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")), **options)
    return sorted(map(tuple, out.collect()))


@pytest.mark.parametrize("low,high", [(-300, 300), (0, 255), (-5, -5), (-2 ** 23, 2 ** 23)])
def test_packed_products_are_exact(low, high):
    rng = np.random.default_rng(7)
    cells, anchors = rng.integers(low, high + 1, (57, 33)), rng.integers(low, high + 1, (9, 33))
    packed = hn.Packed(cells, int(np.abs(anchors).max()))
    for a in anchors:
        assert packed.scores(a).tolist() == (cells.astype(object) @ a.astype(object)).tolist()


@pytest.mark.parametrize("options", [{}, {"block": 37, "anchors_a_block": 2}])
def test_against_plain_python(spark, options):
    rows = vectors(900, 3)
    assert run(spark, rows, **options) == plain(rows)


def test_ties_nulls_and_odd_vectors(spark):
    rows = vectors(400, 4)
    same = rows[3][1]
    rows += [(1000 + k, same, rows[3][2]) for k in range(30)] + [(2000 + k, same, (rows[3][2] + 1) % 10) for k in range(30)]
    rows += [(100 * k, same, 3) for k in range(30, 34)] + [(3000, same, 3)]
    rows += [(None, same, 1), (5000, None, 1), (5100, same, None), (5200, [None] * 12, 2), (5300, [float("nan")] * 12, 2),
             (5400, [float("inf")] + same[1:], 2), (5500, [], 4), (5600, same[:5], 4), (5700, [1e4] * 12, 4)]
    assert run(spark, rows) == plain(rows)
    assert run(spark, rows, block=11, anchors_a_block=1) == plain(rows)


def test_empty_and_clashing_names(spark):
    assert run(spark, []) == []
    rows = vectors(300, 6)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("id", F.lit(1)).withColumn("a.b", F.lit(2)).withColumn("vector", F.lit("x"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    assert sorted(map(tuple, hn.mine(df, F.col("id") % 100 == 0, label=label).collect())) == plain(rows)


def test_too_large_scores_are_refused(spark):
    with pytest.raises(Exception, match="55 bits|too large"):
        run(spark, [(0, [1e30] * 3, 1), (1, [1e30] * 3, 1)])


def test_registered_query_and_sql(spark, tmp_path):
    rows = vectors(500, 9)
    path = str(tmp_path / "embeddings.parquet")
    spark.createDataFrame(rows, SCHEMA).write.parquet(path)
    out = queries.QUERIES["op12_hard_negatives"](spark, str(tmp_path))
    assert out.dtypes == [("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"),
                          ("positive_score", "bigint"), ("negative_score", "bigint")]
    got = sorted(map(tuple, out.collect()))
    assert got == plain(rows) and len(got)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{path}/*.parquet')")
    assert sorted(con.execute(hn.ORACLE).fetchall()) == got
