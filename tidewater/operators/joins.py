"""Join operators: fan-out-safe pre-aggregation, the fan-out detector,
point-in-time (as-of) joins and the date spine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.sequence import carry_last


def preagg_join(parent: DataFrame, parent_key: str, children: dict, fill: dict | None = None) -> DataFrame:
    """Aggregate every many-side to the parent key *before* joining.

    ``children`` maps a name to ``(df, key, [agg columns], how)``.  Each child
    becomes one row per key (a partial aggregate map-side, so a hot key is
    combined before the shuffle); the joins are then one-to-one and cannot
    multiply rows.
    """
    out = parent
    for name, spec in children.items():
        df, key, aggs, how = spec
        g = df.groupBy(F.col(key).alias(f"__{name}_key")).agg(*aggs)
        out = out.join(g, out[parent_key] == g[f"__{name}_key"], how).drop(f"__{name}_key")
    for col, default in (fill or {}).items():
        out = out.withColumn(col, F.coalesce(F.col(col), default))
    return out


def fanout_report(left: DataFrame, left_key: str, right: DataFrame, right_key: str, amount: Column,
                  key_name: str = "key", left_count: str = "n_left", right_count: str = "n_right") -> DataFrame:
    """Per key: rows on each many-side, rows a naive join would produce, the
    correct left total and the inflated total the naive join reports."""
    a = left.groupBy(F.col(left_key).alias(key_name)).agg(
        F.count(F.lit(1)).alias(left_count), F.sum(amount).cast("decimal(38,2)").alias("right_total"))
    b = right.groupBy(F.col(right_key).alias(key_name)).agg(F.count(F.lit(1)).alias(right_count))
    j = a.join(b, key_name)
    return j.select(
        key_name, left_count, right_count,
        (F.col(left_count) * F.col(right_count)).alias("joined_rows"), "right_total",
        (F.col("right_total") * F.col(right_count)).cast("decimal(38,2)").alias("fanned_total"),
        ((F.col(left_count) > 1) & (F.col(right_count) > 1)).alias("fans_out"))


def pit_filter(versions: DataFrame, as_of, valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """Versions valid at ``as_of``: from <= t AND (to IS NULL OR to > t)."""
    t = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp_ntz")
    return versions.filter((F.col(valid_from) <= t) & (F.col(valid_to).isNull() | (F.col(valid_to) > t)))


def pit_join(facts: DataFrame, fact_key: str, fact_ts: str, versions: DataFrame, version_key: str,
             valid_from: str = "valid_from", valid_to: str = "valid_to", how: str = "left",
             num_partitions: int | None = None) -> DataFrame:
    """As-of join: each fact meets the version of its key valid at the fact time.

    A sorted merge: facts and versions are one stream of rows by (key, time),
    range-partitioned, and each fact takes the last version before it
    (:func:`carry_last`).  No pair of a fact and a version is ever formed, and
    a key with a third of all facts, or with a long history, fills several
    ranges.  A version that starts at the fact's time counts; one that has
    ended by then does not.  Versions of one key must not overlap (gaps may
    be); of several with one start the last to end counts.  Rows without key
    or time match nothing.
    """
    if how not in ("left", "inner"):
        raise ValueError(how)
    mine = [c for c in versions.columns if c != version_key]
    v = versions.where(F.col(version_key).isNotNull() & F.col(valid_from).isNotNull()).select(
        F.col(version_key).alias("__key"), F.col(valid_from).alias("__at"), F.lit(0).alias("__kind"), F.col(valid_to).alias("__to"),
        F.struct(*[F.col(c) for c in mine]).alias("__version"))
    f = facts.select(F.col(fact_key).alias("__key"), F.col(fact_ts).alias("__at"), F.lit(1).alias("__kind"),
                     F.struct(*[F.col(c) for c in facts.columns]).alias("__fact"))
    rows = v.unionByName(f, allowMissingColumns=True)
    order = [F.col("__at").asc_nulls_first(), "__kind", F.col("__to").asc_nulls_last()]
    met = carry_last(rows, ["__key"], order, "__version", "__last", num_partitions).where("__kind = 1")
    live = F.col("__last").isNotNull() & F.col("__key").isNotNull() & (
        F.col(f"__last.{valid_to}").isNull() | (F.col("__at") < F.col(f"__last.{valid_to}")))
    met = met.withColumn("__last", F.when(live, F.col("__last")))
    if how == "inner":
        met = met.where(F.col("__last").isNotNull())
    return met.select(*[F.col(f"__fact.{c}").alias(c) for c in facts.columns], *[F.col(f"__last.{c}").alias(c) for c in mine])


def date_spine(bounds: DataFrame, start: str = "start", end: str = "end", name: str = "d") -> DataFrame:
    """One row per day from ``start`` to ``end`` (inclusive) of a one-row frame.

    ``sequence`` + ``explode`` instead of a recursive CTE; the spine grows with
    the calendar span, not with the data.
    """
    return bounds.select(F.explode(F.sequence(F.col(start).cast("date"), F.col(end).cast("date"),
                                              F.expr("INTERVAL 1 DAY"))).alias(name))
