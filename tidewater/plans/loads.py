"""Load-pattern keys on the driver tables.

``events`` plays the mutable source: the state of a user at time T is its
latest event with ``ts <= T`` (``event_type`` = tier, ``value`` = amount,
``ts`` = ``updated_at``, first event = ``registered_at``).  Loads run in
rounds at T1, T2 and the end of the data; the oracle states the *final*
table of each load as one SQL query.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidewater.functions import CANCELLED, money
from tidewater.jobs import RangeReload, Scd2Load, WatermarkLoad
from tidewater.operators.joins import pit_join
from tidewater.operators.loads import (append_new, daily_category_sales, detect_deletes_in_buckets,
                                       latest_per_key, upsert as upsert_op)
from tidewater.operators.scd2 import as_of, empty_dimension, scd2_merge
from tidewater.operators.sequence import materialize
from tidewater.operators.rewrite import soft_delete
from tidewater.plans.registry import register
from tidewater.session import scratch_root
from tidewater.sources import Tables
from tidewater.sources.buckets import BucketDirectory
from tidewater.sources.publish import Catalog

# The load rounds over the January 2024 events.
T1 = "2024-01-10 00:00:00"
T2 = "2024-01-20 00:00:00"
T_END_LOAD = "2024-02-01 00:00:00"    # load time of the last SCD2 round
AS_OF = "2024-01-15 00:00:00"         # point-in-time question
ROUNDS = (T1, T2, None)               # None = all data


def _root(spark, tag):
    return f"{scratch_root(spark)}/{tag}-{uuid.uuid4().hex[:10]}"


def user_state(events, as_of_ts=None):
    """Snapshot of the mutable source: one row per user, its latest state at ``as_of_ts``."""
    e = events.select("user_id", "event_id", "ts", "event_type", "value")
    if as_of_ts is not None:
        e = e.filter(F.col("ts") <= F.lit(as_of_ts).cast("timestamp_ntz"))
    # latest row and first time of each user in one pass, combined map-side
    state = e.groupBy("user_id").agg(F.max(F.struct("ts", "event_id", "event_type", "value")).alias("last"),
                                     F.min("ts").alias("registered_at"))
    return state.select("user_id", F.col("last.event_type").alias("tier"), money("last.value").alias("amount"),
                        F.col("last.ts").alias("updated_at"), "registered_at")


def _snap_sql(name, bound):
    where = f"WHERE ts <= TIMESTAMP '{bound}'" if bound else ""
    return f"""{name} AS (
  SELECT user_id, event_type AS tier, CAST(value AS DECIMAL(18,2)) AS amount, ts AS updated_at, registered_at
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn,
               min(ts) OVER (PARTITION BY user_id) AS registered_at
        FROM events {where}) x
  WHERE rn = 1)"""


SNAPS_SQL = ",\n".join([_snap_sql("s1", T1), _snap_sql("s2", T2), _snap_sql("s3", None)])

FINAL_TARGET_SQL = f"""
WITH {SNAPS_SQL}
SELECT s3.user_id, s3.tier, s3.amount, s3.updated_at AS src_updated_at,
       coalesce(s1.updated_at, s2.updated_at, s3.updated_at) AS first_seen_ts
FROM s3 LEFT JOIN s1 ON s1.user_id = s3.user_id LEFT JOIN s2 ON s2.user_id = s3.user_id
"""

UPDATE_COLS = ["tier", "amount", "src_updated_at"]


def _stg_source(events, bound):
    s = user_state(events, bound)
    return s.select("user_id", "tier", "amount", F.col("updated_at").alias("src_updated_at"),
                    F.col("updated_at").alias("first_seen_ts"))


@register("upsert", FINAL_TARGET_SQL)
def upsert_q(spark, sf_dir):
    """Three upserts of the whole source snapshot; ``first_seen_ts`` keeps its first value."""
    ev = Tables(spark, sf_dir).events
    target = spark.createDataFrame([], "user_id bigint, tier string, amount decimal(18,2), "
                                       "src_updated_at timestamp_ntz, first_seen_ts timestamp_ntz")
    for bound in ROUNDS:
        target = upsert_op(target, _stg_source(ev, bound), "user_id", UPDATE_COLS)
    return target


def _watermark_job(spark, sf_dir, lookback=None, rerun=False):
    ev = Tables(spark, sf_dir).events
    job = WatermarkLoad(spark, _root(spark, "stg"), "stg_users", key="user_id", ts_col="src_updated_at",
                        update_cols=UPDATE_COLS, lookback=lookback)
    for bound in ROUNDS:
        job.run(_stg_source(ev, bound))
    if rerun:
        job.run(_stg_source(ev, None))
    return job


@register("incremental_load", FINAL_TARGET_SQL)
def incremental_load(spark, sf_dir):
    """Watermark load per round, published with its log and watermark."""
    return _watermark_job(spark, sf_dir).target()


def _log_round(no, cur, prev, wm_from_sql, wm_to_sql, lookback=True):
    lo = f"({wm_from_sql}) - INTERVAL 1 HOUR" if lookback else f"({wm_from_sql})"
    if prev is None:
        counts = "count(*) AS rows_new, CAST(0 AS BIGINT) AS rows_changed"
        join = ""
    else:
        counts = (f"count_if(p.user_id IS NULL) AS rows_new, "
                  f"count_if(p.user_id IS NOT NULL AND (p.tier IS DISTINCT FROM c.tier OR p.amount IS DISTINCT FROM c.amount "
                  f"OR p.updated_at IS DISTINCT FROM c.updated_at)) AS rows_changed")
        join = f"LEFT JOIN {prev} p ON p.user_id = c.user_id"
    return f"""SELECT CAST({no} AS BIGINT) AS load_id, CAST({wm_from_sql} AS TIMESTAMP) AS wm_from,
       CAST({wm_to_sql} AS TIMESTAMP) AS wm_to, {counts}
FROM {cur} c {join}
WHERE c.updated_at > {lo} AND c.updated_at <= {wm_to_sql}"""


_M1 = "(SELECT max(updated_at) FROM s1)"
_M2 = "(SELECT max(updated_at) FROM s2)"
_M3 = "(SELECT max(updated_at) FROM s3)"

LOOKBACK_LOG_SQL = f"""
WITH {SNAPS_SQL}
{_log_round(1, 's1', None, "TIMESTAMP '1970-01-01 00:00:00'", _M1)}
UNION ALL
{_log_round(2, 's2', 's1', _M1, _M2)}
UNION ALL
{_log_round(3, 's3', 's2', _M2, _M3)}
UNION ALL
{_log_round(4, 's3', 's3', _M3, _M3)}
"""


@register("incremental_lookback", LOOKBACK_LOG_SQL)
def incremental_lookback(spark, sf_dir):
    """1-hour lookback; the log's change counts are true differences, so the
    immediate re-run (load 4) logs 0 / 0 although it re-reads an hour of rows."""
    job = _watermark_job(spark, sf_dir, lookback="1 HOUR", rerun=True)
    return job.log().select("load_id", "wm_from", "wm_to", "rows_new", "rows_changed")


@register("changed_since_last", f"""
WITH {SNAPS_SQL}
SELECT tier, count(*) AS n FROM s3 WHERE updated_at > {_M2} GROUP BY tier
""")
def changed_since_last(spark, sf_dir):
    """What the last run changed: target rows newer than the last log row's ``wm_from``."""
    job = _watermark_job(spark, sf_dir)
    last_from = job.log().agg(F.max_by("wm_from", "load_id")).scalar()   # the last run's lower mark
    t = job.target()
    return (t.filter(F.col("src_updated_at") > last_from)
             .groupBy("tier").agg(F.count(F.lit(1)).alias("n")))


# --------------------------------------------------------------- P1, P2, P3

def dim_product_frame(t):
    """products ⋈ category ⋈ brand, denormalised; the lookups are aggregates of part."""
    p = t.part.select("p_partkey", "p_name", "p_type", "p_brand", "p_retailprice")
    cat = p.groupBy("p_type").agg(F.count(F.lit(1)).alias("category_products"))
    brand = p.groupBy("p_brand").agg(F.count(F.lit(1)).alias("brand_products"))
    sku = F.concat_ws("-", F.upper(F.left("p_type", F.lit(3))),
                      F.concat(F.lit("B"), F.substring_index("p_brand", "#", -1)),
                      F.lpad(F.col("p_partkey").cast("string"), 7, "0"))
    return (p.join(cat, "p_type").join(brand, "p_brand")
             .select(F.col("p_partkey").alias("product_id"), sku.alias("sku"), F.col("p_name").alias("product_name"),
                     F.col("p_type").alias("top_category"), F.col("p_brand").alias("brand_name"),
                     money("p_retailprice").alias("unit_price"), "category_products", "brand_products"))


DIM_PRODUCT_SQL = """
WITH cat AS (SELECT p_type, count(*) AS category_products FROM part GROUP BY 1),
brand AS (SELECT p_brand, count(*) AS brand_products FROM part GROUP BY 1)
SELECT p.p_partkey AS product_id,
       upper(left(p.p_type, 3)) || '-B' || split_part(p.p_brand, '#', 2) || '-' || lpad(CAST(p.p_partkey AS VARCHAR), 7, '0') AS sku,
       p.p_name AS product_name, p.p_type AS top_category, p.p_brand AS brand_name,
       CAST(p.p_retailprice AS DECIMAL(18,2)) AS unit_price, cat.category_products, brand.brand_products
FROM part p JOIN cat ON cat.p_type = p.p_type JOIN brand ON brand.p_brand = p.p_brand
"""


@register("dim_product", DIM_PRODUCT_SQL)
def dim_product(spark, sf_dir):
    return dim_product_frame(Tables(spark, sf_dir))


@register("full_reload_dim", DIM_PRODUCT_SQL)
def full_reload_dim(spark, sf_dir):
    """Build aside, swap atomically, drop the old version; a re-run gives the same table."""
    cat = Catalog(spark, _root(spark, "dim"))
    dim = dim_product_frame(Tables(spark, sf_dir))
    cat.publish("dim_product", {"rows": dim})
    cat.publish("dim_product", {"rows": dim})
    cat.vacuum("dim_product", keep=1)
    return cat.read("dim_product", "rows")


RELOAD_FROM, RELOAD_TO, EMPTIED_DAY = "1998-03-01", "1998-03-07", "1998-03-03"


def _changed_orders(orders):
    """The source after a change: every order of one day was cancelled."""
    day = F.col("o_orderdate").cast("date") == F.lit(EMPTIED_DAY).cast("date")
    return orders.withColumn("o_orderstatus", F.when(day, F.lit(CANCELLED)).otherwise(F.col("o_orderstatus")))


@register("reload_range", f"""
WITH o AS (SELECT o_orderkey, o_orderdate,
                  CASE WHEN CAST(o_orderdate AS DATE) = DATE '{EMPTIED_DAY}' THEN '{CANCELLED}' ELSE o_orderstatus END AS st
           FROM orders)
SELECT CAST(o.o_orderdate AS DATE) AS sales_date, p.p_type AS top_category,
       count(DISTINCT o.o_orderkey) AS orders, CAST(sum(l.l_quantity) AS BIGINT) AS units,
       CAST(sum(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS revenue
FROM o JOIN lineitem l ON l.l_orderkey = o.o_orderkey JOIN part p ON p.p_partkey = l.l_partkey
WHERE o.st <> '{CANCELLED}'
GROUP BY 1, 2
""")
def reload_range(spark, sf_dir):
    """Full load, then the source changes and one week is reloaded; the
    result equals a rebuild, including the day that became empty."""
    t = Tables(spark, sf_dir)
    job = RangeReload(spark, _root(spark, "fct"), "fct_daily_sales", "sales_date", grain="month")
    job.run(daily_category_sales(t.orders, t.lineitem, t.part))
    changed = _changed_orders(t.orders)
    week = daily_category_sales(changed, t.lineitem, t.part, RELOAD_FROM, RELOAD_TO)
    job.run(week, RELOAD_FROM, RELOAD_TO)
    job.run(week, RELOAD_FROM, RELOAD_TO)     # re-run: same rows, no duplicates
    return job.read()


def daily_summary_frame(events, date_from=None, date_to=None):
    e = events
    if date_from is not None:
        e = e.filter((F.col("ts") >= F.lit(date_from).cast("timestamp_ntz"))
                     & (F.col("ts") < F.lit(date_to).cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")))
    return (e.groupBy(F.col("ts").cast("date").alias("sale_date"), F.col("event_type").alias("channel"))
             .agg(F.count(F.lit(1)).alias("events"), F.countDistinct("user_id").alias("users"),
                  F.sum(money("value")).cast("decimal(38,2)").alias("amount")))


@register("daily_summary", """
SELECT CAST(ts AS DATE) AS sale_date, event_type AS channel, count(*) AS events,
       count(DISTINCT user_id) AS users, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS amount
FROM events GROUP BY 1, 2
""")
def daily_summary(spark, sf_dir):
    """Summary table with a unique (day, channel) key, built and rebuilt by range."""
    ev = Tables(spark, sf_dir).events
    job = RangeReload(spark, _root(spark, "summary"), "daily_channel_sales", "sale_date", grain="month")
    job.run(daily_summary_frame(ev))
    job.run(daily_summary_frame(ev, "2024-01-08", "2024-01-14"), "2024-01-08", "2024-01-14")
    return job.read()


# ------------------------------------------------------------ P7, P8, P14

@register("append_by_id", "SELECT event_id, user_id, event_type, ts FROM events")
def append_by_id(spark, sf_dir):
    """Event table: append rows whose id is above the target's maximum; twice."""
    ev = Tables(spark, sf_dir).events.select("event_id", "user_id", "event_type", "ts")
    cat = Catalog(spark, _root(spark, "append"))
    first = ev.filter(F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz"))
    for _ in range(3):   # the third run finds nothing above the maximum
        cur = cat.read("stg_events", "rows")
        tx = cat.begin("stg_events")
        if cur is None:
            new = first
        else:
            new = append_new(cur, ev, "event_id")
        tx.write_partitions("rows", new.withColumn("__batch", F.lit(tx.run_id)), "__batch", replace={tx.run_id})
        tx.commit({"op": "append_by_id"})
    return cat.read("stg_events", "rows").drop("__batch")


def landing(events):
    """Raw landing with retries and late old versions, derived from ``events``:
    every event once (ingest_id = event_id), every purchase re-sent unchanged,
    and every error re-sent a day *older* by source time but ingested last."""
    e = events.select("event_id", "user_id", "event_type", "ts", "value")
    n = events.agg(F.max("event_id") + 1).scalar()
    base = e.withColumn("ingest_id", F.col("event_id"))
    retry = (e.filter(F.col("event_type") == "purchase")
              .withColumn("ingest_id", F.col("event_id") + n))
    stale = (e.filter(F.col("event_type") == "error")
              .withColumn("ingest_id", F.col("event_id") + 2 * n)
              .withColumn("ts", F.col("ts") - F.expr("INTERVAL 1 DAY"))
              .withColumn("event_type", F.lit("stale")))
    return base.unionByName(retry).unionByName(stale)


@register("dedup_landing", """
SELECT user_id, event_id, event_type, ts, CAST(value AS DECIMAL(18,2)) AS value
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) x
WHERE rn = 1
""")
def dedup_landing(spark, sf_dir):
    """Latest version per key by *source* time, then ingest order: exact
    retries and late-arriving old versions cannot win."""
    land = landing(Tables(spark, sf_dir).events)
    latest = latest_per_key(land, "user_id", ["ts", "ingest_id"])
    return latest.select("user_id", "event_id", "event_type", "ts", money("value").alias("value"))


@register("detect_deletes", f"""
SELECT o_orderkey, CASE WHEN o_orderstatus = '{CANCELLED}' THEN TIMESTAMP '{T_END_LOAD}' END AS deleted_at
FROM orders
""")
def detect_deletes_q(spark, sf_dir):
    """Hard deletes are invisible to ``updated_at``: digests of target and source
    keys are compared bucket by bucket, only buckets that differ are read again
    and compared in full, and what vanished is soft-deleted (cancelled orders
    were purged from the source)."""
    o = Tables(spark, sf_dir).orders
    cat, directory = Catalog(spark, _root(spark, "deletes")), BucketDirectory(64)
    tx = cat.begin("orders")
    tx.write_partitions("rows", o.select("o_orderkey").withColumn("__bucket", directory.bucket("o_orderkey")), "__bucket", replace=lambda v: True)
    tx.commit()
    target = lambda buckets: cat.read("orders", "rows", partitions=buckets).drop("__bucket")
    source_keys = o.filter(F.col("o_orderstatus") != CANCELLED).select("o_orderkey")
    gone, _ = detect_deletes_in_buckets(target, source_keys, "o_orderkey", directory.bucket("o_orderkey"))
    marked = target(None).join(gone.withColumn("__gone", F.lit(True)), "o_orderkey", "left")
    return soft_delete(marked, F.col("__gone"), T_END_LOAD).select("o_orderkey", "deleted_at")


# --------------------------------------------------------------- SCD2 keys

SCD2_LOAD_TIMES = (T1, T2, T_END_LOAD)


def _scd2_sql(source_time: bool) -> str:
    first = "registered_at" if source_time else "load_time"
    later = "updated_at" if source_time else "load_time"
    return f"""
WITH {SNAPS_SQL},
snaps AS (SELECT 1 AS snap_no, TIMESTAMP '{T1}' AS load_time, * FROM s1
          UNION ALL SELECT 2, TIMESTAMP '{T2}', * FROM s2
          UNION ALL SELECT 3, TIMESTAMP '{T_END_LOAD}', * FROM s3),
marked AS (SELECT *, lag(tier) OVER (PARTITION BY user_id ORDER BY snap_no) AS prev_tier FROM snaps),
versions AS (SELECT *, CASE WHEN prev_tier IS NULL THEN {first} ELSE {later} END AS vf
             FROM marked WHERE prev_tier IS NULL OR prev_tier <> tier)
SELECT CAST(row_number() OVER (ORDER BY snap_no, user_id) AS BIGINT) AS sk, user_id, tier,
       vf AS valid_from, lead(vf) OVER (PARTITION BY user_id ORDER BY snap_no) AS valid_to,
       lead(vf) OVER (PARTITION BY user_id ORDER BY snap_no) IS NULL AS is_current
FROM versions"""


SCD2_LOAD_SQL = _scd2_sql(False)
SCD2_SOURCE_SQL = _scd2_sql(True)


def scd2_dimension(spark, events, source_time: bool = True, published: bool = False):
    """Three SCD2 loads over the snapshots (plus an idempotent re-run)."""
    snaps = [(user_state(events, b), lt) for b, lt in zip(ROUNDS, SCD2_LOAD_TIMES)]
    kw = dict(change_time_col="updated_at", first_time_col="registered_at") if source_time else {}
    if published:
        job = Scd2Load(spark, _root(spark, "scd2"), "dim_customer_scd2", "user_id", ["tier"], **kw)
        for s, lt in snaps + [snaps[-1]]:
            job.run(s, load_time=lt)
        return job.read()
    dim = empty_dimension(spark, snaps[0][0], "user_id", ["tier"], "sk")
    for s, lt in snaps + [snaps[-1]]:
        dim = scd2_merge(dim, s, "user_id", ["tier"], sk="sk",
                         load_time=None if source_time else lt, **kw)
        # each merge reads the previous dimension several times: cut the
        # lineage so the plan stays linear in the number of loads
        dim = materialize(dim.repartition("user_id"))
    return dim


@register("scd2_load_time", SCD2_LOAD_SQL)
def scd2_load_time(spark, sf_dir):
    """Versions open and close at the load time; re-running a load adds nothing."""
    return scd2_dimension(spark, Tables(spark, sf_dir).events, source_time=False, published=True)


@register("scd2_source_time", SCD2_SOURCE_SQL)
def scd2_source_time(spark, sf_dir):
    """P10: first version from ``registered_at``, later ones from the source's
    ``updated_at``; an ``updated_at`` bump without a tier change opens nothing."""
    return scd2_dimension(spark, Tables(spark, sf_dir).events, source_time=True, published=True)


#: The dimension that all events make as states of their user in source time (ties: the greatest tier).
SCD2_EVENTS_SQL = """
WITH state AS (SELECT user_id, ts, max(event_type) AS tier FROM events GROUP BY user_id, ts),
opening AS (
  SELECT * FROM (SELECT *, lag(tier) OVER (PARTITION BY user_id ORDER BY ts) AS earlier FROM state) x
  WHERE earlier IS DISTINCT FROM tier),
closing AS (SELECT user_id, tier, ts AS valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to FROM opening)
SELECT user_id, tier, valid_from, valid_to, valid_to IS NULL AS is_current FROM closing
"""


@register("scd2_late_states", SCD2_EVENTS_SQL)
def scd2_late_states(spark, sf_dir):
    """P10 on late data: the newest half of the states is loaded first, then a
    mixed third, then the rest with repeats; the dimension equals the one in order."""
    ev = Tables(spark, sf_dir).events.select("user_id", "ts", F.col("event_type").alias("tier"), "event_id")
    job = Scd2Load(spark, _root(spark, "scd2-late"), "dim_user", "user_id", ["tier"], change_time_col="ts")
    late = F.col("ts") < F.lit(AS_OF).cast("timestamp_ntz")
    mixed = F.pmod(F.xxhash64("event_id"), F.lit(3)) == 0
    for part in (ev.where(~late & ~mixed), ev.where(mixed), ev.where(late | mixed), ev.where(mixed)):
        job.run(part)
    return job.read().drop("sk")


@register("pit_snapshot", f"""
WITH d AS ({SCD2_SOURCE_SQL})
SELECT user_id, tier, valid_from FROM d
WHERE valid_from <= TIMESTAMP '{AS_OF}' AND (valid_to IS NULL OR valid_to > TIMESTAMP '{AS_OF}')
""")
def pit_snapshot(spark, sf_dir):
    dim = scd2_dimension(spark, Tables(spark, sf_dir).events)
    return as_of(dim, AS_OF).select("user_id", "tier", "valid_from")


@register("pit_counts", f"""
WITH d AS ({SCD2_SOURCE_SQL})
SELECT tier, count(*) AS members FROM d
WHERE valid_from <= TIMESTAMP '{AS_OF}' AND (valid_to IS NULL OR valid_to > TIMESTAMP '{AS_OF}')
GROUP BY tier
""")
def pit_counts(spark, sf_dir):
    dim = scd2_dimension(spark, Tables(spark, sf_dir).events)
    return as_of(dim, AS_OF).groupBy("tier").agg(F.count(F.lit(1)).alias("members"))


@register("pit_join", f"""
WITH d AS ({SCD2_SOURCE_SQL})
SELECT d.tier AS tier_at_purchase, count(*) AS purchases,
       CAST(sum(CAST(e.value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS amount
FROM events e LEFT JOIN d ON d.user_id = e.user_id AND e.ts >= d.valid_from
                         AND (d.valid_to IS NULL OR e.ts < d.valid_to)
WHERE e.event_type = 'purchase'
GROUP BY 1
""")
def pit_join_q(spark, sf_dir):
    """Sales by the tier the customer had *at the time of the sale*."""
    ev = Tables(spark, sf_dir).events
    dim = scd2_dimension(spark, ev).select("user_id", "tier", "valid_from", "valid_to")
    facts = ev.filter(F.col("event_type") == "purchase").select("user_id", "ts", money("value").alias("amt"))
    j = pit_join(facts, "user_id", "ts", dim, "user_id")
    return (j.groupBy(F.col("tier").alias("tier_at_purchase"))
             .agg(F.count(F.lit(1)).alias("purchases"), F.sum("amt").cast("decimal(38,2)").alias("amount")))


@register("most_versions", f"""
WITH d AS ({SCD2_SOURCE_SQL}),
top AS (SELECT user_id FROM d GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 1)
SELECT sk, user_id, tier, valid_from, valid_to, is_current FROM d WHERE user_id IN (SELECT user_id FROM top)
""")
def most_versions(spark, sf_dir):
    """History of the entity with the most versions (ties: lowest key)."""
    dim = scd2_dimension(spark, Tables(spark, sf_dir).events)
    # most versions first, then the lowest key: max of (n, -user_id), one aggregate
    per_key = dim.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    top = per_key.agg(F.max_by("user_id", F.struct(F.col("n"), -F.col("user_id")))).scalar()
    return dim.filter(F.col("user_id") == top)
