"""Slowly changing dimension type 2 (P9, P10) and its checks (Q9-Q11).

Two ways to load.  :func:`scd2_merge` takes snapshots in order: current
versions are joined to the snapshot on the key (one-to-one, a second row of a
key fails the job), changed keys get their current version closed and a new
one opened, new keys a first version; re-running with the same snapshot
changes nothing, and a change older than the version it would close fails.

:func:`splice` takes states of the source in any order.  It works on the set
of states seen of the touched keys: a state opens a version where it differs
from the one before it in source time, so a late state is spliced into the
closed intervals, splits one, or moves a version's start.  As the versions are
a function of that set, any order of arrival gives the same dimension, but for
the numbers of the surrogate keys, which follow arrival.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.loads import any_differs, one_per_key
from tidewater.operators.sequence import PLACE, RANGE, assign_sk, in_ranges, lead_within, materialize, neighbour

SCD_COLS = ["valid_from", "valid_to", "is_current"]


def empty_dimension(spark, snapshot: DataFrame, key: str, attrs: list[str], sk: str) -> DataFrame:
    fields = ", ".join(f"`{c}` {snapshot.schema[c].dataType.simpleString()}" for c in [key] + attrs)
    return spark.createDataFrame(
        [], f"{sk} bigint, {fields}, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean")


def scd2_merge(dim: DataFrame, snapshot: DataFrame, key: str, tracked: list[str], *, sk: str = "sk",
               load_time=None, change_time_col: str | None = None, first_time_col: str | None = None,
               attrs: list[str] | None = None, sk_start: int | None = None) -> DataFrame:
    """Merge one source snapshot into the SCD2 dimension.

    Version times: ``load_time`` (a literal; P9 "by load time") or the
    source's ``change_time_col`` (P10 "by source time", e.g. ``updated_at``),
    with ``first_time_col`` (e.g. ``registered_at``) for a key's first version.
    ``attrs`` are the stored attributes (default: the tracked ones); only the
    tracked ones open a version, so an ``updated_at`` bump alone does nothing.
    ``sk_start`` is the largest surrogate key in use when ``dim`` is only a
    part (some buckets) of the dimension.
    """
    attrs = attrs or list(tracked)
    if (load_time is None) == (change_time_col is None):
        raise ValueError("give exactly one of load_time and change_time_col")
    cols = [sk, key, *attrs, *SCD_COLS]
    cur = dim.filter("is_current").alias("t")
    src = one_per_key(snapshot, key, "snapshot").alias("s")
    j = cur.join(src, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")
    in_t, in_s = F.col(f"t.{key}").isNotNull(), F.col(f"s.{key}").isNotNull()
    changed = in_t & in_s & any_differs(tracked)
    is_new = ~in_t & in_s
    if load_time is not None:
        t_change = t_first = F.lit(load_time).cast("timestamp_ntz")
    else:
        t_change = F.col(f"s.{change_time_col}").cast("timestamp_ntz")
        t_first = F.col(f"s.{first_time_col or change_time_col}").cast("timestamp_ntz")
    j = j.withColumn("__changed", changed).withColumn("__new", is_new).withColumn("__tc", t_change) \
         .withColumn("__tf", t_first)
    late = F.col("__changed") & (F.col("__tc") <= F.col("t.valid_from"))
    j = j.where(F.assert_true(~F.coalesce(late, F.lit(False)), F.lit("a change is older than the version it would close; use splice")).isNull())

    closed = (j.filter("__changed")
               .select(F.col(f"t.{sk}").alias(sk), F.col(f"t.{key}").alias(key),
                       *[F.col(f"t.{a}").alias(a) for a in attrs],
                       F.col("t.valid_from").alias("valid_from"), F.col("__tc").alias("valid_to"),
                       F.lit(False).alias("is_current")))
    opened = (j.filter(F.col("__changed") | F.col("__new"))
               .select(F.col(f"s.{key}").alias(key), *[F.col(f"s.{a}").alias(a) for a in attrs],
                       F.when(F.col("__new"), F.col("__tf")).otherwise(F.col("__tc")).alias("valid_from"),
                       F.lit(None).cast("timestamp_ntz").alias("valid_to"), F.lit(True).alias("is_current")))
    opened = assign_sk(dim, opened, [key], sk=sk, start=sk_start)
    history = dim.filter(~F.col("is_current"))
    kept_current = (j.filter(in_t & ~F.col("__changed"))
                     .select(*[F.col(f"t.{c}").alias(c) for c in cols]))
    return (history.select(*cols).unionByName(kept_current).unionByName(closed.select(*cols))
            .unionByName(opened.select(*cols)))


def states(snapshot: DataFrame, key: str, attrs: list[str], change_time_col: str, first_time_col: str | None = None) -> DataFrame:
    """(key, attributes, ``seen_at``, ``first_at``): what a snapshot or a change feed tells of each key; rows without key or time tell nothing."""
    at = F.col(change_time_col).cast("timestamp_ntz")
    first = F.col(first_time_col).cast("timestamp_ntz") if first_time_col else at
    return (snapshot.select(key, *attrs, at.alias("seen_at"), F.coalesce(F.least(first, at), at).alias("first_at"))
            .where(F.col(key).isNotNull() & F.col("seen_at").isNotNull()).distinct())


def versions_of(seen: DataFrame, key: str, tracked: list[str], attrs: list[str]) -> DataFrame:
    """The versions that a set of states makes: (key, attributes, opened_at, valid_from, valid_to, is_current, last_seen).

    Of several states of one key at one time the greatest counts.  A version
    takes its attributes from the state that opens it; a key's first version
    begins at that state's ``first_at``.
    """
    one = (seen.groupBy(key, "seen_at").agg(F.max(F.struct(*attrs, "first_at")).alias("__s"))
           .select(key, "seen_at", *[F.col(f"__s.{c}").alias(c) for c in [*attrs, "first_at"]], F.lit(True).alias("__any")))
    ranged = in_ranges(one, [key, "seen_at"])                  # once, for the state before and the next opening
    before = neighbour(ranged, [key], ["__any", *tracked], "__prev_")
    same = F.col("__prev___any").isNotNull()
    for c in tracked:
        same = same & F.col(c).eqNullSafe(F.col(f"__prev_{c}"))
    opens = before.where(~same).select(
        key, *attrs, RANGE, PLACE, F.col("seen_at").alias("opened_at"),
        F.when(F.col("__prev___any").isNull(), F.col("first_at")).otherwise(F.col("seen_at")).alias("valid_from"))
    closed = neighbour(opens, [key], ["opened_at"], "__next_", ahead=True)
    last = ranged.groupBy(F.col(key).alias("__k")).agg(F.max("seen_at").alias("last_seen"))
    return (closed.join(last, F.col(key) == F.col("__k"))
            .select(key, *attrs, "opened_at", "valid_from", F.col("__next_opened_at").alias("valid_to"),
                    F.col("__next_opened_at").isNull().alias("is_current"), "last_seen"))


def unknown_states(dim: DataFrame, news: DataFrame, key: str, attrs: list[str]) -> DataFrame:
    """The states that are not just the latest one known of their key."""
    cur = dim.where("is_current").select(F.col(key).alias("__k"), "last_seen", *[F.col(a).alias(f"__{a}") for a in attrs])
    same = F.col("seen_at") == F.col("last_seen")
    for a in attrs:
        same = same & F.col(a).eqNullSafe(F.col(f"__{a}"))
    return news.join(cur, F.col(key) == F.col("__k"), "left").where(~F.coalesce(same, F.lit(False))).select(*news.columns)


def unseen_states(seen: DataFrame, news: DataFrame) -> DataFrame:
    """The states that are not in ``seen`` yet, nulls compared as values."""
    same = F.lit(True)
    for c in news.columns:
        same = same & F.col(f"n.{c}").eqNullSafe(F.col(f"s.{c}"))
    return news.alias("n").join(seen.alias("s"), same, "left_anti")


def splice(dim: DataFrame, seen: DataFrame, news: DataFrame, key: str, tracked: list[str], attrs: list[str],
           sk: str = "sk", sk_start: int = 0) -> tuple[DataFrame, DataFrame]:
    """The dimension and the states seen, after ``news`` (all as parts that hold whole keys).

    ``news`` are distinct states not in ``seen`` (:func:`unseen_states`).  Only keys with news are rebuilt; versions opened by the same state keep
    their surrogate key, others are numbered from ``sk_start`` on.
    """
    touched = news.select(F.col(key).alias("__touched")).distinct()
    on = F.col(key) == F.col("__touched")
    all_seen = seen.select(*news.columns).unionByName(news)
    fresh = versions_of(all_seen.join(touched, on, "left_semi"), key, tracked, attrs)
    old = dim.join(touched, on, "left_semi").select(F.col(key).alias("__k"), F.col("opened_at").alias("__o"), F.col(sk).alias("__sk"))
    fresh = materialize(fresh.join(old, (F.col(key) == F.col("__k")) & (F.col("opened_at") == F.col("__o")), "left").drop("__k", "__o"))
    known = fresh.where(F.col("__sk").isNotNull()).withColumnRenamed("__sk", sk)
    new = assign_sk(None, fresh.where(F.col("__sk").isNull()).drop("__sk"), [key, "opened_at"], sk=sk, start=sk_start)
    cols = [sk, key, *attrs, "opened_at", *SCD_COLS, "last_seen"]
    kept = dim.join(touched, on, "left_anti")
    return kept.select(*cols).unionByName(known.select(*cols)).unionByName(new.select(*cols)), all_seen


def changed_keys(dim: DataFrame, snapshot: DataFrame, key: str, tracked: list[str]) -> DataFrame:
    """Snapshot rows that would open a version: new keys or a tracked change."""
    cur = dim.filter("is_current").select(key, *tracked).alias("t")
    s = snapshot.alias("s")
    j = s.join(cur, F.col(f"s.{key}") == F.col(f"t.{key}"), "left")
    return j.filter(F.col(f"t.{key}").isNull() | any_differs(tracked)).select("s.*")


def as_of(dim: DataFrame, t) -> DataFrame:
    """Versions valid at ``t``: valid_from <= t AND (valid_to IS NULL OR valid_to > t)."""
    ts = t if not isinstance(t, str) else F.lit(t).cast("timestamp_ntz")
    return dim.filter((F.col("valid_from") <= ts) & (F.col("valid_to").isNull() | (F.col("valid_to") > ts)))


def check_one_current(dim: DataFrame, key: str) -> DataFrame:
    """Q9: keys whose number of current versions is not exactly one."""
    per = dim.groupBy(key).agg(F.count_if("is_current").alias("n_current"))
    return per.agg(F.count_if(F.col("n_current") != 1).cast("bigint").alias("violations"))


def check_contiguous(dim: DataFrame, key: str, num_partitions: int | None = None) -> DataFrame:
    """Q10: a version's valid_to must equal the next version's valid_from, and
    only the last version may be open.

    The next version comes from :func:`lead_within`, which splits a very long
    history over many tasks."""
    x = lead_within(dim.select(key, "sk", "valid_from", "valid_to"), [key], ["valid_from", "sk"],
                    ["valid_from"], prefix="__next_", num_partitions=num_partitions)
    nxt = F.col("__next_valid_from")
    bad = (nxt.isNull() & F.col("valid_to").isNotNull()) | (nxt.isNotNull() & ~F.col("valid_to").eqNullSafe(nxt)) \
        | (F.col("valid_to") <= F.col("valid_from"))
    return x.select(bad.alias("bad")).agg(F.count_if("bad").cast("bigint").alias("violations"))


def check_matches_source(dim: DataFrame, source: DataFrame, key: str, attrs: list[str]) -> DataFrame:
    """Q11: current versions equal the source, key by key (missing on either side counts)."""
    cur = dim.filter("is_current").select(key, *attrs).alias("t")
    src = source.select(key, *attrs).alias("s")
    j = cur.join(src, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")
    bad = F.col(f"t.{key}").isNull() | F.col(f"s.{key}").isNull() | any_differs(attrs)
    return j.agg(F.count_if(bad).cast("bigint").alias("violations"))
