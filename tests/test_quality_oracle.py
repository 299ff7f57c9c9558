"""DQ gate behaviour, the entry point, and a sample of keys against DuckDB."""

import datetime as dt
import decimal

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tidewater.operators import quality as Q
from tidewater.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


def test_gate_stops_on_failure(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    res = Q.suite([Q.unique("k_unique", df, "k"), Q.not_null("k_not_null", df, "k")], "2026-01-01 00:00:00")
    with pytest.raises(Q.QualityGateFailed):
        Q.gate(res)
    empty = spark.createDataFrame([], "k int")
    assert Q.not_null("n", empty, "k").first().violations == 0   # count_if, not SUM: 0 on empty


def test_one_pass_equals_separate_checks(spark):
    """The fused suite form gives the same violation counts as one query per check."""
    tgt = spark.createDataFrame(
        [(1, "gold", decimal.Decimal("10.00"), dt.datetime(2024, 1, 1, 0)),
         (1, "gold", decimal.Decimal("5.00"), dt.datetime(2024, 1, 1, 1)),
         (2, None, decimal.Decimal("1.50"), dt.datetime(2024, 1, 2, 0)),
         (3, "tin", decimal.Decimal("2.25"), dt.datetime(2024, 1, 2, 3))],
        "k int, tier string, amount decimal(18,2), ts timestamp_ntz")
    src = spark.createDataFrame(
        [(1, decimal.Decimal("10.00"), dt.datetime(2024, 1, 6, 0)), (2, decimal.Decimal("1.50"), dt.datetime(2024, 1, 5, 0))],
        "k int, amount decimal(18,2), ts timestamp_ntz")
    tiers = ("gold", "silver")
    fused = Q.one_pass(tgt, {
        "rows": Q.rows_differ_from(src.agg(F.count(F.lit(1))).scalar()),
        "sum": Q.sum_differs_from("amount", src.agg(F.sum("amount")).scalar()),
        "unique": Q.duplicate_keys("k"),
        "not_null": Q.null_values("tier"),
        "accepted": Q.values_outside("tier", tiers),
        "fresh": Q.stale_by_hours("ts", src.agg(F.max("ts")).scalar(), 48),
    })
    separate = [Q.row_count_matches("rows", src, tgt), Q.sum_matches("sum", src, tgt, "amount"),
                Q.unique("unique", tgt, "k"), Q.not_null("not_null", tgt, "tier"),
                Q.accepted_values("accepted", tgt, "tier", tiers),
                Q.freshness("fresh", tgt, "ts", src, "ts", 48)]
    want = {r.check_name: r.violations for df in separate for r in df.collect()}
    got = {r.check_name: r.violations for r in fused.collect()}
    assert got == want == {"rows": 2, "sum": 1, "unique": 1, "not_null": 1, "accepted": 1, "fresh": 1}


def test_entry_runs(spark):
    rows = E.entry(spark).collect()
    assert len(rows) > 0 and set(rows[0].asDict()) == {"category", "revenue", "units"}


def _norm(v):
    if isinstance(v, (decimal.Decimal, float)):
        return round(float(v), 6)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


SAMPLE = ["category_revenue", "orders_per_customer", "anti_not_exists", "repurchase_gaps", "ntile_spend",
          "latest_per_key", "topn_per_group", "daily_spike", "upsert", "dedup_landing", "cascade_delete",
          "constraint_quarantine", "rollup_subtotals", "fn_date", "timeline_union"]


@pytest.mark.parametrize("key", SAMPLE)
def test_key_matches_oracle(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[key](spark, SF)
    cur = con.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(ocols, cur.fetchall())
