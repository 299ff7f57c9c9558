"""Rewrites (UPDATE/DELETE/transfer/audit) and contract enforcement."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidewater.operators.contracts import Col, Contract, ForeignKey, conform, quarantine, split_accepted
from tidewater.operators.rewrite import (TransferRejected, apply_deltas, delete_where, preview_delete,
                                         touch_changed, update_where, validate_transfer)


def test_update_where_needs_predicate_and_skips_null(spark):
    df = spark.createDataFrame([(1, "gold", 10), (2, None, 20), (3, "bronze", 30)], "id int, tier string, points int")
    with pytest.raises(ValueError):
        update_where(df, None, {"points": "points + 1"})
    out = {r.id: r.points for r in update_where(df, F.col("tier") == "gold", {"points": "points * 2"}).collect()}
    assert out == {1: 20, 2: 20, 3: 30}   # NULL predicate: row 2 not updated


def test_delete_with_preview(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 50)], "id int, x int")
    assert preview_delete(df, "x > 10").first()[0] == 1
    assert sorted(r.id for r in delete_where(df, "x > 10").collect()) == [1, 2]


def test_transfer_all_or_nothing(spark):
    acc = spark.createDataFrame([(1, Decimal("100.00")), (2, Decimal("50.00"))], "id int, bal decimal(12,2)")
    moves = spark.createDataFrame([(1, -30), (2, 30)], "id int, delta int")
    after = apply_deltas(acc, "id", "bal", moves)
    assert validate_transfer(acc, after, "id", "bal", moves, floor=0)["total_after"] == Decimal("150.00")
    bad = spark.createDataFrame([(1, -130), (2, 130)], "id int, delta int")
    with pytest.raises(TransferRejected):
        validate_transfer(acc, apply_deltas(acc, "id", "bal", bad), "id", "bal", bad, floor=0)
    ghost = spark.createDataFrame([(1, -10), (9, 10)], "id int, delta int")
    with pytest.raises(TransferRejected):
        validate_transfer(acc, apply_deltas(acc, "id", "bal", ghost), "id", "bal", ghost)


def test_touch_changed_moves_only_changed(spark):
    t0 = dt.datetime(2026, 1, 1)
    old = spark.createDataFrame([(1, "a", t0), (2, "b", t0)], "id int, v string, updated_at timestamp_ntz")
    new = spark.createDataFrame([(1, "a"), (2, "B"), (3, "c")], "id int, v string")
    out = {r.id: r.updated_at for r in touch_changed(old, new, "id", ["v"], "2026-02-01 00:00:00").collect()}
    assert out == {1: t0, 2: dt.datetime(2026, 2, 1), 3: dt.datetime(2026, 2, 1)}


def test_member_contract_rejects_invalid_rows(spark):
    provinces = spark.createDataFrame([("Bangkok",), ("Phuket",)], "name string")
    contract = Contract(
        "members",
        [Col("member_id", "int", nullable=False), Col("member_code", "string", nullable=False, max_length=12),
         Col("province", "string", default="Bangkok"), Col("tier", "string", default="bronze",
                                                          accepted=("bronze", "silver", "gold")),
         Col("points", "int", default=0, check="points >= 0")],
        primary_key=["member_id"], unique=[["member_code"]],
        foreign_keys=[ForeignKey("province", provinces, "name")])
    rows = spark.createDataFrame(
        [(1, "MEM-0001", "Bangkok", "gold", 10),
         (2, "MEM-0001", "Phuket", "silver", 0),          # duplicate code
         (3, "MEM-0003", "Bangkok", "platinum", 0),       # tier not accepted
         (4, "MEM-0004", "Bangkok", "bronze", -5),        # CHECK points >= 0
         (5, None, "Atlantis", "bronze", 0)],             # NOT NULL and FK
        "member_id int, member_code string, province string, tier string, points int")
    ok, bad = split_accepted(quarantine(rows, contract))
    assert ok.count() == 0   # row 1 shares its code with row 2: both rejected
    reasons = {r.member_id: r.reasons for r in bad.collect()}
    assert "duplicate unique key (member_code)" in reasons[1] and "duplicate unique key (member_code)" in reasons[2]
    assert reasons[3] == ["tier not accepted"]
    assert reasons[4] == ["check failed: points >= 0"]
    assert set(reasons[5]) == {"member_code is null", "province has no parent"}


def test_conform_keeps_supplied_nulls(spark):
    contract = Contract("t", [Col("id", "int"), Col("points", "int", default=0)], primary_key=["id"])
    out = conform(spark.createDataFrame([(1, None)], "id int, points int"), contract).first()
    assert out["points"] is None


def test_conform_fills_defaults(spark):
    contract = Contract("m", [Col("id", "int", nullable=False), Col("tier", "string", default="bronze"),
                              Col("points", "int", default=0)])
    out = conform(spark.createDataFrame([(1,)], "id int"), contract).first()
    assert (out.id, out.tier, out.points) == (1, "bronze", 0)
