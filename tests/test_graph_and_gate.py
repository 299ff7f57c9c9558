"""Deletes along references, transfers, deletes found by digests, verified blocks, checks that find faults, the gate."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tidewater.jobs import BalanceTable, GatedJob, WatermarkLoad
from tidewater.operators import quality as Q
from tidewater.operators.contracts import Col, Contract
from tidewater.operators.loads import detect_deletes_in_buckets
from tidewater.operators.rewrite import Reference, RestrictViolation, TransferRejected, delete_with_references
from tidewater.sources.buckets import BucketDirectory
from tidewater.sources.publish import Catalog
from tidewater.sources.verified import DigestMismatch, block_digests, root_digest, verified_load, write_with_manifest

SF = "/root/testdata/sf0.001"


def ids(df, col="id"):
    return sorted(r[0] for r in df.select(col).collect())


def tree(spark):
    """Folders in folders (0 - 1 - 2, 0 - 3, 4), files in folders, notes on files."""
    return {"folder": spark.createDataFrame([(0, None), (1, 0), (2, 1), (3, 0), (4, None), (5, 4)], "id int, inside int"),
            "file": spark.createDataFrame([(10, 0), (11, 2), (12, 3), (13, 4), (14, None)], "id int, folder int"),
            "note": spark.createDataFrame([(100, 11), (101, 13), (102, None)], "id int, file int")}


KEYS = {"folder": "id", "file": "id", "note": "id"}


def references(inside="cascade", folder="cascade", file="cascade"):
    return [Reference("folder", "inside", "folder", inside), Reference("file", "folder", "folder", folder), Reference("note", "file", "file", file)]


def test_delete_walks_the_graph(spark):
    t = tree(spark)
    kept = delete_with_references(t, KEYS, references(), "folder", "id = 0")
    assert (ids(kept["folder"]), ids(kept["file"]), ids(kept["note"])) == ([4, 5], [13, 14], [101, 102])
    kept = delete_with_references(t, KEYS, references(), "folder", "id = 5")
    assert len(ids(kept["folder"])) == 5 and len(ids(kept["file"])) == 5
    # a cycle ends
    t["folder"] = spark.createDataFrame([(0, 2), (1, 0), (2, 1), (4, None)], "id int, inside int")
    assert ids(delete_with_references(t, KEYS, references(), "folder", "id = 1")["folder"]) == [4]
    assert ids(delete_with_references(t, KEYS, references(), "folder", "id > 100")["folder"]) == [0, 1, 2, 4]


def test_restrict_is_the_default_and_set_null_keeps_rows(spark):
    t = tree(spark)
    assert Reference("a", "b", "c").on_delete == "restrict"
    with pytest.raises(RestrictViolation, match="1 rows of note refer to rows of file"):
        delete_with_references(t, KEYS, references(file="restrict"), "folder", "id = 0")
    with pytest.raises(RestrictViolation, match="folder"):
        delete_with_references(t, KEYS, references(inside="restrict"), "folder", "id = 1")
    kept = delete_with_references(t, KEYS, references(file="set null"), "folder", "id = 0")
    assert sorted(kept["note"].collect()) == sorted(t["note"].withColumn("file", F.expr("nullif(file, 11)")).collect())
    kept = delete_with_references(t, KEYS, references(folder="set null"), "folder", "id = 0")
    assert [r.folder for r in kept["file"].orderBy("id").collect()] == [None, None, None, 4, None]
    with pytest.raises(ValueError, match="no key"):
        delete_with_references(t, {"folder": "id"}, references(), "folder", "id = 0")


def accounts(spark, scratch, **options):
    table = BalanceTable(spark, scratch, "acc", "id", "bal", floor=0, **options)
    table.initialise(spark.createDataFrame([(i, 100) for i in range(20)], "id long, bal long"))
    return table, lambda *m: spark.createDataFrame(list(m), "id long, delta long")


def test_transfers_are_whole_or_refused(spark, scratch):
    table, moves = accounts(spark, scratch, n_buckets=4)
    for bad in (moves((1, -10), (99, 10)), moves((1, -10), (2, 11)), moves((1, -101), (2, 101))):
        with pytest.raises(TransferRejected):
            table.transfer(bad)
    assert len(table.catalog.history("acc")) == 1
    report = table.transfer(moves((1, -10), (2, 4), (2, 6)))
    assert report["total_before"] == report["total_after"]
    assert {r.id: r.bal for r in table.read().where("bal <> 100").collect()} == {1: 90, 2: 110}
    assert table.transfer(moves()) == {"moved": 0}


def test_racing_transfers_both_take_effect(spark, scratch):
    table, moves = accounts(spark, scratch)
    rival, raced = BalanceTable(spark, scratch, "acc", "id", "bal", floor=0), []

    def race():
        if not raced:
            raced.append(rival.transfer(moves((1, -60), (3, 60))))

    table.transfer(moves((1, -30), (2, 30)), before_commit=race)
    assert {r.id: r.bal for r in table.read().where("bal <> 100").collect()} == {1: 10, 2: 130, 3: 160}
    raced.clear()
    with pytest.raises(TransferRejected):                 # the rival leaves too little
        table.transfer(moves((2, -100), (4, 100)), before_commit=lambda: raced or raced.append(rival.transfer(moves((2, -90), (5, 90)))))
    assert table.read().agg(F.sum("bal")).first()[0] == 2000


def test_equal_buckets_are_not_read_again(spark, scratch):
    cat, directory, reads = Catalog(spark, scratch), BucketDirectory(32), []
    tx = cat.begin("t")
    tx.write_partitions("rows", spark.range(2000).withColumn("__bucket", directory.bucket("id")), "__bucket", replace=lambda v: True)
    tx.commit()

    def target(buckets):
        reads.append(buckets)
        return cat.read("t", "rows", partitions=buckets).drop("__bucket")

    source = spark.range(2000).where("id NOT IN (7, 1234)").unionByName(spark.range(3000, 3001))
    gone, found = detect_deletes_in_buckets(target, source, "id", directory.bucket("id"))
    assert ids(gone) == [7, 1234]
    want = {r[0] for r in spark.createDataFrame([(7,), (1234,), (3000,)], "id long").select(directory.bucket("id")).collect()}
    assert found == want and reads == [None, want]
    gone, found = detect_deletes_in_buckets(target, spark.range(2000), "id", directory.bucket("id"))
    assert found == set() and gone.count() == 0
    gone, found = detect_deletes_in_buckets(target, spark.range(0), "id", directory.bucket("id"))
    assert gone.count() == 2000 and len(found) == 32


def test_blocks_name_the_tampered_rows(spark, scratch):
    rows = spark.range(5000).select("id", F.when(F.col("id") % 7 > 0, F.sha1(F.col("id").cast("string"))).alias("v"), (F.col("id") / 3).alias("x"))
    root = write_with_manifest(rows.coalesce(1), f"{scratch}/d", f"{scratch}/m", blocks=64)
    assert len([f for f in os.listdir(f"{scratch}/d") if f.endswith(".parquet")]) == 1          # one file of 64 blocks
    df, report = verified_load(spark, f"{scratch}/d", f"{scratch}/m", root)
    assert df.count() == 5000 and report["matched"] == 64
    # the same rows in another layout are the same data
    rows.repartition(7).select("x", "v", "id").write.parquet(f"{scratch}/e")
    assert verified_load(spark, f"{scratch}/e", f"{scratch}/m")[1]["matched"] == 64
    block = lambda df: {r.block for r in block_digests(df, 64).collect()}
    changed = rows.withColumn("v", F.when(F.col("id") == 4321, "x").otherwise(F.col("v")))
    for name, bad, where in (("c", changed, block(rows.where("id = 4321")) | block(changed.where("id = 4321"))),
                             ("l", rows.where("id <> 17"), block(rows.where("id = 17"))), ("t", rows.unionByName(rows.where("id = 99")), block(rows.where("id = 99")))):
        bad.write.parquet(f"{scratch}/{name}")
        with pytest.raises(DigestMismatch) as told:
            verified_load(spark, f"{scratch}/{name}", f"{scratch}/m", root)
        assert str(sorted(where)) in str(told.value)
    # a manifest made to fit other rows does not have the root
    other = write_with_manifest(changed, f"{scratch}/f", f"{scratch}/m2", blocks=64)
    assert other != root and root_digest(spark.read.parquet(f"{scratch}/m2")) == other
    with pytest.raises(DigestMismatch, match="root"):
        verified_load(spark, f"{scratch}/f", f"{scratch}/m2", root)
    with pytest.raises(DigestMismatch, match="columns"):
        verified_load(spark, f"{scratch}/d", write_and_name(spark, scratch), None)


def write_and_name(spark, scratch):
    write_with_manifest(spark.range(3), f"{scratch}/g", f"{scratch}/m3")
    return f"{scratch}/m3"


def test_empty_table_of_a_contract(spark):
    c = Contract("t", [Col("id", "bigint", nullable=False), Col("price", "decimal(10,2)", default=0), Col("tags", "array<string>")])
    empty = c.empty(spark)
    assert empty.count() == 0 and empty.dtypes == [("id", "bigint"), ("price", "decimal(10,2)"), ("tags", "array<string>")]
    assert [f.nullable for f in empty.schema] == [False, True, True]


def test_every_check_finds_its_fault(spark):
    report = {r.check_name: (r.violations, r.result) for r in E.queries()["dq_report"](spark, "/root/testdata/sf0.01").collect()}
    assert len(report) == 10 and all(n > 0 and result == "FAIL" for n, result in report.values()), report


def test_failing_check_publishes_nothing(spark, scratch):
    load = WatermarkLoad(spark, scratch, "users", key="id", ts_col="at", update_cols=["tier", "at"], dataset="wh")
    job = GatedJob(load.catalog, "wh")
    rows = lambda *r: spark.createDataFrame(list(r), "id long, tier string, at long").withColumn("at", F.timestamp_seconds("at").cast("timestamp_ntz"))
    checks = lambda doc: [Q.not_null("tier", load.target(doc), "tier")]
    job.run([(load, rows((1, "a", 10), (2, "b", 20)))], checks, "2026-01-01 00:00:00")
    with pytest.raises(Q.QualityGateFailed, match="tier=1"):
        job.run([(load, rows((2, None, 30), (3, "c", 30)))], checks, "2026-01-02 00:00:00")
    assert {(r.id, r.tier) for r in load.target().collect()} == {(1, "a"), (2, "b")}
    assert load.log().count() == 1 and job.read("dq_results").count() == 1
    job.run([(load, rows((2, "z", 30), (3, "c", 30)))], checks, "2026-01-03 00:00:00")     # mended at the source: taken up again
    assert {(r.id, r.tier) for r in load.target().collect()} == {(1, "a"), (2, "z"), (3, "c")}
    assert [(r.load_id, r.rows_new, r.rows_changed) for r in load.log().orderBy("load_id").collect()] == [(1, 2, 0), (2, 1, 1)]
    with pytest.raises(ValueError, match="does not belong"):
        job.run([(WatermarkLoad(spark, scratch, "x", "id", "at", ["at"]), rows())], checks, "2026-01-04 00:00:00")
