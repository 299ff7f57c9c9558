"""Data-quality checks as queries.

Every check returns one row ``(check_name, violations)``; 0 violations =
pass.  Checks are plain aggregates (one pass, combined map-side) or anti
joins; the suite unions them into one job, stamps one ``run_at``, stores the
results and can stop the job (the gate) before anything is published.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class QualityGateFailed(RuntimeError):
    pass


def _one(name: str, df: DataFrame, violations: Column) -> DataFrame:
    return df.agg(violations.cast("bigint").alias("violations")).select(
        F.lit(name).alias("check_name"), F.coalesce("violations", F.lit(0).cast("bigint")).alias("violations"))


def row_count_matches(name: str, source: DataFrame, target: DataFrame) -> DataFrame:
    """Completeness: |count(source) - count(target)|."""
    return _one(name, source, rows_differ_from(target.agg(F.count(F.lit(1))).scalar()))


def sum_matches(name: str, source: DataFrame, target: DataFrame, col: str) -> DataFrame:
    """Accuracy: 1 when the DECIMAL totals differ (NULL-safe), else 0."""
    return _one(name, source, sum_differs_from(col, target.agg(F.sum(col)).scalar()))


def unique(name: str, df: DataFrame, key: str) -> DataFrame:
    """Uniqueness: count(*) - count(DISTINCT key)."""
    return _one(name, df, duplicate_keys(key))


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """The duplicated keys themselves (GROUP BY ... HAVING count(*) > 1)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def not_null(name: str, df: DataFrame, col: str) -> DataFrame:
    """count_if, so an empty table gives 0 rather than NULL."""
    return _one(name, df, null_values(col))


def referential(name: str, child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Orphans: child rows whose key has no parent."""
    orphans = child.select(fk).join(parent.select(F.col(pk).alias("__pk")), F.col(fk) == F.col("__pk"), "left_anti")
    return _one(name, orphans, F.count(F.lit(1)))


def accepted_values(name: str, df: DataFrame, col: str, values) -> DataFrame:
    """Validity: values outside the accepted set (NULL is not counted)."""
    return _one(name, df, values_outside(col, values))


def freshness(name: str, target: DataFrame, target_ts: str, source: DataFrame, source_ts: str,
              max_hours: int) -> DataFrame:
    """1 when the target's newest row is more than ``max_hours`` behind the source's."""
    return _one(name, target, stale_by_hours(target_ts, source.agg(F.max(source_ts)).scalar(), max_hours))


# Violation counts as aggregate expressions, so that many checks of one table
# run in a single scan (:func:`one_pass`) instead of one scan per check.

def rows_differ_from(other_count: Column) -> Column:
    """|count(this) - other_count|; ``other_count`` is usually a scalar subquery."""
    return F.abs(F.count(F.lit(1)) - other_count)


def sum_differs_from(col: str, other_sum: Column) -> Column:
    return (~F.sum(col).eqNullSafe(other_sum)).cast("bigint")


def duplicate_keys(key: str) -> Column:
    return F.count(F.lit(1)) - F.countDistinct(key)


def null_values(col: str) -> Column:
    return F.count_if(F.col(col).isNull())


def values_outside(col: str, values) -> Column:
    return F.count_if(~F.col(col).isin(*values))


def stale_by_hours(ts_col: str, source_max: Column, max_hours: int) -> Column:
    lag_h = F.timestamp_diff("HOUR", F.max(ts_col), source_max)
    return F.coalesce((lag_h > max_hours).cast("bigint"), F.lit(1).cast("bigint"))


def one_pass(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Several checks of one table in one aggregate (one scan, combined
    map-side), unpivoted to one ``(check_name, violations)`` row per check."""
    names = list(checks)
    agg = df.agg(*[F.coalesce(checks[n].cast("bigint"), F.lit(0).cast("bigint")).alias(f"__c{i}")
                   for i, n in enumerate(names)])
    pairs = [c for i, n in enumerate(names) for c in (F.lit(n), F.col(f"__c{i}"))]
    return agg.select(F.stack(F.lit(len(names)), *pairs).alias("check_name", "violations"))


def suite(checks: list[DataFrame], run_at) -> DataFrame:
    """All checks in one frame with one ``run_at`` and a ``passed`` flag."""
    u = reduce(lambda a, b: a.unionByName(b), checks)
    return u.select(F.lit(run_at).cast("timestamp_ntz").alias("run_at"), "check_name", "violations",
                    (F.col("violations") == 0).alias("passed"))


def report(results: DataFrame) -> DataFrame:
    return results.select("check_name", "violations",
                          F.when(F.col("passed"), "pass").otherwise("FAIL").alias("result"))


def gate(results: DataFrame) -> list:
    """Stop the job when any check fails; the failing rows are few (one per check)."""
    failed = results.filter(~F.col("passed")).select("check_name", "violations").collect()
    if failed:
        raise QualityGateFailed(", ".join(f"{r.check_name}={r.violations}" for r in failed))
    return failed
