"""Data-quality keys on the loaded tables.

The target is the user table produced by the incremental upserts
(``plans.loads``), the source its final snapshot; the SCD2 checks run on the
source-time dimension.  A check that always found nothing would pass on good
data, so each key runs its check on data with planted faults; ``dq_suite`` runs
all of them on the tables as loaded, ``dq_report`` on the faulty ones.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions import COMPLETED
from tidewater.operators import quality as Q
from tidewater.operators.scd2 import check_contiguous, check_matches_source, check_one_current
from tidewater.operators.sequence import materialize
from tidewater.plans.loads import SCD2_SOURCE_SQL, SNAPS_SQL, scd2_dimension, upsert_q, user_state
from tidewater.plans.registry import register
from tidewater.sources import Tables

RUN_AT = "2024-02-01 06:00:00"
# The tiers the source may hold.
ACCEPTED_TIERS = ("view", "purchase", "error", "signup", "click")
_ACC_SQL = ", ".join(f"'{v}'" for v in ACCEPTED_TIERS)

#: Faults planted into the loaded user table: its rows lost, doubled, moved to an unknown user, or changed.
LOST, DOUBLED, ORPHANED, NO_TIER, ODD_TIER, ODD_AMOUNT = "user_id % 13 = 3", "user_id % 17 = 5", "user_id % 31 = 2", "user_id % 19 = 7", "user_id % 23 = 4", "user_id % 29 = 1"
#: Faults planted into the versions: an old one left current, an interval cut short, a current value changed.
STILL_OPEN, CUT_SHORT, ODD_VERSION = "user_id % 11 = 3 AND NOT is_current", "user_id % 7 = 2 AND valid_to IS NOT NULL", "user_id % 5 = 1 AND is_current"


def check_name(rule: str, column: str) -> str:
    """Rule and column make the name, in the suite and in the expected result."""
    return f"{rule}({column})"


_FAULTY_SQL = f"""loaded AS (SELECT user_id, tier, amount, updated_at AS src_updated_at FROM s3),
faulty AS (
  SELECT CASE WHEN {ORPHANED} THEN user_id + 1000000000 ELSE user_id END AS user_id,
         CASE WHEN {NO_TIER} THEN NULL WHEN {ODD_TIER} THEN '?' ELSE tier END AS tier,
         CASE WHEN {ODD_AMOUNT} THEN amount + 1 ELSE amount END AS amount, src_updated_at - INTERVAL 3 DAY AS src_updated_at
  FROM (SELECT * FROM loaded WHERE NOT ({LOST}) UNION ALL SELECT * FROM loaded WHERE {DOUBLED}) kept)"""

_FAULTY_VERSIONS_SQL = f"""faulty_d AS (
  SELECT sk, user_id, CASE WHEN {ODD_VERSION} THEN '?' ELSE tier END AS tier, valid_from,
         CASE WHEN {CUT_SHORT} THEN valid_to - INTERVAL 1 SECOND ELSE valid_to END AS valid_to, is_current OR ({STILL_OPEN}) AS is_current
  FROM d)"""


def plant_faults(stg):
    """The loaded table as it must not be published."""
    rows = stg.where(~F.expr(LOST)).unionByName(stg.where(F.expr(DOUBLED)))
    return rows.select(F.when(F.expr(ORPHANED), F.col("user_id") + 1000000000).otherwise(F.col("user_id")).alias("user_id"),
                       F.when(F.expr(NO_TIER), F.lit(None)).when(F.expr(ODD_TIER), "?").otherwise(F.col("tier")).alias("tier"),
                       F.when(F.expr(ODD_AMOUNT), F.col("amount") + 1).otherwise(F.col("amount")).alias("amount"),
                       (F.col("src_updated_at") - F.expr("INTERVAL 3 DAYS")).alias("src_updated_at"))


def plant_version_faults(dim):
    return dim.select("sk", "user_id", F.when(F.expr(ODD_VERSION), "?").otherwise(F.col("tier")).alias("tier"), "valid_from",
                      F.when(F.expr(CUT_SHORT), F.col("valid_to") - F.expr("INTERVAL 1 SECOND")).otherwise(F.col("valid_to")).alias("valid_to"),
                      (F.col("is_current") | F.expr(STILL_OPEN)).alias("is_current"))


# key -> (rule, column, violations of table {t} in SQL)
_UPTO = "FROM s3 WHERE updated_at <= (SELECT max(src_updated_at) FROM {t})"
STAGING_RULES = {
    "dq_referential": ("known_customer", "user_id", "SELECT count(*) FROM {t} WHERE user_id NOT IN (SELECT c_custkey FROM customer)"),
    "dq_accepted": ("one_of", "tier", f"SELECT count(*) FROM {{t}} WHERE tier NOT IN ({_ACC_SQL})"),
    "dq_not_null": ("present", "tier", "SELECT count(*) - count(tier) FROM {t}"),
    "dq_unique": ("distinct", "user_id", "SELECT count(*) - count(DISTINCT user_id) FROM {t}"),
    "dq_row_count": ("rows_as_source", "user_id", f"SELECT abs((SELECT count(*) {_UPTO}) - (SELECT count(*) FROM {{t}}))"),
    "dq_sum_match": ("total_as_source", "amount", f"SELECT (SELECT sum(amount) {_UPTO}) IS DISTINCT FROM (SELECT sum(amount) FROM {{t}})"),
    "dq_freshness": ("at_most_48_hours_behind", "src_updated_at",
                     "SELECT date_diff('hour', (SELECT max(src_updated_at) FROM {t}), (SELECT max(updated_at) FROM s3)) > 48"),
}
VERSION_RULES = {
    "dq_scd2_contiguous": ("no_gap_or_overlap", "valid_to", """SELECT count(*) FROM (
      SELECT valid_from, valid_to, lead(valid_from) OVER (PARTITION BY user_id ORDER BY valid_from, sk) AS following FROM {t}) x
      WHERE valid_to IS DISTINCT FROM following OR valid_to <= valid_from"""),
    "dq_scd2_one_current": ("one_current_version", "user_id",
                            "SELECT count(*) FROM (SELECT user_id FROM {t} GROUP BY 1 HAVING sum(CAST(is_current AS INT)) <> 1) x"),
    "dq_scd2_matches_source": ("current_as_source", "tier", """SELECT count(*) FROM (SELECT user_id, tier FROM {t} WHERE is_current) c
      FULL JOIN s3 ON s3.user_id = c.user_id WHERE c.user_id IS NULL OR s3.user_id IS NULL OR c.tier IS DISTINCT FROM s3.tier"""),
}
_DIM_SQL = f"d AS ({SCD2_SOURCE_SQL})"


def _rule_sql(rules, key, table):
    rule, column, count = rules[key]
    return f"SELECT '{check_name(rule, column)}' AS check_name, CAST(({count.format(t=table)}) AS BIGINT) AS violations"


def _frames(spark, sf_dir):
    """The loaded table and the source's present state, computed once."""
    return materialize(upsert_q(spark, sf_dir)), materialize(user_state(Tables(spark, sf_dir).events))


def _staging_check(key, stg, src, customer):
    """The one check of the key."""
    rule, column, _ = STAGING_RULES[key]
    name = check_name(rule, column)
    upto = src.filter(F.col("updated_at") <= stg.agg(F.max("src_updated_at")).scalar())
    if key == "dq_row_count":
        return Q.row_count_matches(name, upto, stg)
    if key == "dq_sum_match":
        return Q.sum_matches(name, upto, stg, column)
    if key == "dq_unique":
        return Q.unique(name, stg, column)
    if key == "dq_not_null":
        return Q.not_null(name, stg, column)
    if key == "dq_referential":
        return Q.referential(name, stg, column, customer, "c_custkey")
    if key == "dq_accepted":
        return Q.accepted_values(name, stg, column, ACCEPTED_TIERS)
    return Q.freshness(name, stg, column, src, "updated_at", 48)


def _version_check(key, dim, src):
    rule, column, _ = VERSION_RULES[key]
    if key == "dq_scd2_one_current":
        found = check_one_current(dim, column)
    elif key == "dq_scd2_contiguous":
        found = check_contiguous(dim, "user_id")
    else:
        found = check_matches_source(dim, src, "user_id", [column])
    return found.select(F.lit(check_name(rule, column)).alias("check_name"), "violations")


def _staging_key(key):
    def q(spark, sf_dir):
        stg, src = _frames(spark, sf_dir)
        return _staging_check(key, plant_faults(stg), src, Tables(spark, sf_dir).customer)
    q.__name__, q.__doc__ = key, "One check on the loaded table with planted faults."
    return q


def _version_key(key):
    def q(spark, sf_dir):
        ev = Tables(spark, sf_dir).events
        return _version_check(key, plant_version_faults(scd2_dimension(spark, ev)), user_state(ev))
    q.__name__, q.__doc__ = key, "One check on the dimension with planted faults."
    return q


for _k in STAGING_RULES:
    register(_k, f"WITH {SNAPS_SQL}, {_FAULTY_SQL}\n{_rule_sql(STAGING_RULES, _k, 'faulty')}")(_staging_key(_k))
for _k in VERSION_RULES:
    register(_k, f"WITH {SNAPS_SQL}, {_DIM_SQL}, {_FAULTY_VERSIONS_SQL}\n{_rule_sql(VERSION_RULES, _k, 'faulty_d')}")(_version_key(_k))


@register("dq_duplicate_keys", f"""
WITH {SNAPS_SQL}, {_FAULTY_SQL}
SELECT user_id, count(*) AS n FROM faulty GROUP BY user_id HAVING count(*) > 1
""")
def dq_duplicate_keys(spark, sf_dir):
    """The business keys that occur more than once, with their rows."""
    stg, _ = _frames(spark, sf_dir)
    return Q.duplicates(plant_faults(stg), "user_id")


def staging_checks(stg, src, customer) -> list:
    """The staging table's checks for a suite: six in one scan of the target
    (the source's count and sum are scalar subqueries over one relation,
    which Spark merges into one scan), plus the orphan anti join."""
    upto = src.filter(F.col("updated_at") <= stg.agg(F.max("src_updated_at")).scalar())
    name = {k: check_name(rule, column) for k, (rule, column, _) in STAGING_RULES.items()}
    fused = Q.one_pass(stg, {
        name["dq_row_count"]: Q.rows_differ_from(upto.agg(F.count(F.lit(1))).scalar()),
        name["dq_sum_match"]: Q.sum_differs_from("amount", upto.agg(F.sum("amount")).scalar()),
        name["dq_unique"]: Q.duplicate_keys("user_id"),
        name["dq_not_null"]: Q.null_values("tier"),
        name["dq_accepted"]: Q.values_outside("tier", ACCEPTED_TIERS),
        name["dq_freshness"]: Q.stale_by_hours("src_updated_at", src.agg(F.max("updated_at")).scalar(), 48),
    })
    return [fused, Q.referential(name["dq_referential"], stg, "user_id", customer, "c_custkey")]


def version_checks(dim, src) -> list:
    return [_version_check(k, dim, src) for k in VERSION_RULES]


def _suite_sql(stg: str, dim: str) -> str:
    parts = [_rule_sql(STAGING_RULES, k, stg) for k in STAGING_RULES] + [_rule_sql(VERSION_RULES, k, dim) for k in VERSION_RULES]
    return f"WITH {SNAPS_SQL}, {_FAULTY_SQL}, {_DIM_SQL}, {_FAULTY_VERSIONS_SQL},\nfound AS ({' UNION ALL '.join(parts)})"


@register("dq_suite", f"""
{_suite_sql('loaded', 'd')}
SELECT TIMESTAMP '{RUN_AT}' AS run_at, check_name, violations, violations = 0 AS passed FROM found
""")
def dq_suite(spark, sf_dir):
    """All checks of the loaded tables in one frame; the gate lets them pass."""
    stg, src = _frames(spark, sf_dir)
    dim = scd2_dimension(spark, Tables(spark, sf_dir).events)
    res = materialize(Q.suite(staging_checks(stg, src, Tables(spark, sf_dir).customer) + version_checks(dim, src), RUN_AT))
    Q.gate(res)
    return res


@register("dq_report", f"""
{_suite_sql('faulty', 'faulty_d')}
SELECT check_name, violations, CASE WHEN violations = 0 THEN 'pass' ELSE 'FAIL' END AS result FROM found
""")
def dq_report(spark, sf_dir):
    """The report on tables with planted faults; the gate stops on them."""
    stg, src = _frames(spark, sf_dir)
    stg = plant_faults(stg)
    dim = plant_version_faults(scd2_dimension(spark, Tables(spark, sf_dir).events))
    res = materialize(Q.suite(staging_checks(stg, src, Tables(spark, sf_dir).customer) + version_checks(dim, src), RUN_AT))
    try:
        Q.gate(res)
    except Q.QualityGateFailed:
        return Q.report(res)
    raise AssertionError("the planted faults must stop the gate")


@register("dq_completed_unpaid", f"""
SELECT o_orderkey FROM orders
WHERE o_orderstatus = '{COMPLETED}' AND o_custkey NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND user_id IS NOT NULL)
""")
def dq_completed_unpaid(spark, sf_dir):
    """Cross-table rule: completed orders of customers without any successful payment (failed ones do not count)."""
    t = Tables(spark, sf_dir)
    done = t.orders.filter(F.col("o_orderstatus") == COMPLETED).select("o_orderkey", "o_custkey")
    paid = t.events.filter(F.col("event_type") == "purchase").select("user_id").distinct()
    return done.join(paid, F.col("o_custkey") == F.col("user_id"), "left_anti").select("o_orderkey")


@register("dq_key_parts", """
WITH coded AS (
  SELECT *, CASE WHEN p_partkey % 25 = 3 THEN 'XXX' ELSE upper(left(p_type, 3)) END AS type_part,
         CASE WHEN p_partkey % 10 = 4 THEN 'B0' ELSE replace(p_brand, 'Brand#', 'B') END AS brand_part,
         CASE WHEN p_partkey % 40 = 7 THEN p_partkey + 1 ELSE p_partkey END AS number_part
  FROM part)
SELECT p_partkey AS product_id, concat_ws('-', type_part, brand_part, lpad(CAST(number_part AS VARCHAR), 7, '0')) AS sku,
       type_part <> upper(left(p_type, 3)) AS wrong_type, brand_part <> replace(p_brand, 'Brand#', 'B') AS wrong_brand,
       number_part <> p_partkey AS wrong_number
FROM coded
WHERE p_partkey % 25 = 3 OR p_partkey % 10 = 4 OR p_partkey % 40 = 7
""")
def dq_key_parts(spark, sf_dir):
    """Coded keys that disagree with the master data, part by part; some were coded wrongly on purpose."""
    from tidewater.plans.loads import dim_product_frame
    t = Tables(spark, sf_dir)
    d = dim_product_frame(t).select("product_id", "sku", "top_category", "brand_name")
    part = lambda i: F.get(F.split("sku", "-"), F.lit(i))
    sku = F.concat_ws("-", F.when(F.col("product_id") % 25 == 3, "XXX").otherwise(part(0)), F.when(F.col("product_id") % 10 == 4, "B0").otherwise(part(1)),
                      F.when(F.col("product_id") % 40 == 7, F.lpad((F.col("product_id") + 1).cast("string"), 7, "0")).otherwise(part(2)))
    d = d.withColumn("sku", sku)
    # the check itself: split the code and compare each part with the master data
    return (d.select("product_id", "sku", (part(0) != F.upper(F.left("top_category", F.lit(3)))).alias("wrong_type"),
                     (part(1) != F.concat(F.lit("B"), F.substring_index("brand_name", "#", -1))).alias("wrong_brand"),
                     (part(2).cast("bigint") != F.col("product_id")).alias("wrong_number"))
             .where("wrong_type OR wrong_brand OR wrong_number"))


@register("profile_range", """
SELECT min(o_orderdate) AS first_order, max(o_orderdate) AS last_order,
       (SELECT max(l_shipdate) FROM lineitem) AS last_change, count(*) AS n_orders
FROM orders
""")
def profile_range(spark, sf_dir):
    t = Tables(spark, sf_dir)
    last_change = t.lineitem.agg(F.max("l_shipdate")).scalar()
    return t.orders.agg(F.min("o_orderdate").alias("first_order"), F.max("o_orderdate").alias("last_order"),
                        last_change.alias("last_change"), F.count(F.lit(1)).alias("n_orders")) \
                   .select("first_order", "last_order", "last_change", "n_orders")
