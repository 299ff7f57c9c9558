"""UPDATE / DELETE / CASCADE / transfer as DataFrame rewrites.

Parquet tables refuse UPDATE, DELETE and MERGE; each statement becomes a pure
function old -> new, published atomically by ``sources.publish``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.loads import any_differs
from tidewater.operators.sequence import materialize


class TransferRejected(ValueError):
    """An all-or-nothing change failed validation; nothing is published."""


def _pred(pred) -> Column:
    p = F.expr(pred) if isinstance(pred, str) else pred
    # a NULL predicate does not match, as in SQL's WHERE
    return F.coalesce(p, F.lit(False))


def update_where(df: DataFrame, pred, assignments: dict) -> DataFrame:
    """UPDATE df SET col = expr WHERE pred.  Every expression sees the old row.

    An explicit predicate is required: an UPDATE without WHERE is the classic
    accident, so "all rows" must be spelled ``F.lit(True)``.
    """
    if pred is None:
        raise ValueError("update_where needs an explicit predicate")
    hit = _pred(pred)
    cols = []
    for c in df.columns:
        if c in assignments:
            new = assignments[c]
            new = F.expr(new) if isinstance(new, str) else new
            cols.append(F.when(hit, new).otherwise(F.col(c)).cast(df.schema[c].dataType).alias(c))
        else:
            cols.append(F.col(c))
    extra = [(F.when(hit, v).alias(k)) for k, v in assignments.items() if k not in df.columns]
    return df.select(*cols, *extra)


def delete_where(df: DataFrame, pred) -> DataFrame:
    """DELETE FROM df WHERE pred: keep rows where pred is not true."""
    return df.filter(~_pred(pred))


def preview_delete(df: DataFrame, pred) -> DataFrame:
    """The count a DELETE would remove; run it (or the same SELECT) first."""
    return df.agg(F.count_if(_pred(pred)).alias("rows_to_delete"))


def soft_delete(df: DataFrame, pred, run_at, col: str = "deleted_at") -> DataFrame:
    """Mark instead of removing: set ``deleted_at`` once, keep the row."""
    base = df if col in df.columns else df.withColumn(col, F.lit(None).cast("timestamp_ntz"))
    stamp = F.lit(run_at).cast("timestamp_ntz")
    return base.withColumn(col, F.when(_pred(pred) & F.col(col).isNull(), stamp).otherwise(F.col(col)))


def active(df: DataFrame, col: str = "deleted_at") -> DataFrame:
    return df.filter(F.col(col).isNull())


class RestrictViolation(ValueError):
    """Rows that would stay refer to rows to be deleted; nothing is deleted."""


@dataclass(frozen=True)
class Reference:
    """A foreign key: ``child.column`` refers to ``parent`` by its key."""

    child: str
    column: str
    parent: str
    on_delete: str = "restrict"          # or "cascade", "set null"

    def __post_init__(self):
        if self.on_delete not in ("restrict", "cascade", "set null"):
            raise ValueError(self.on_delete)


def delete_with_references(tables: dict[str, DataFrame], keys: dict[str, str], references: list[Reference],
                           start: str, pred) -> dict[str, DataFrame]:
    """DELETE FROM ``start`` WHERE pred, along a graph of foreign keys: what is left of every table.

    Doomed keys spread along cascading references, several levels deep and
    through references of a table to itself, until a round adds none.  Then
    restricting references are tested: a row that stays and refers to a doomed
    one refuses the whole delete (:class:`RestrictViolation`).  ``keys`` names
    the key column of each table that is referred to.  Each round is a semi
    join of the newly doomed keys, made distinct, with the child's key columns.
    """
    need = [start, *[r.parent for r in references], *[r.child for r in references if any(x.parent == r.child for x in references)]]
    missing = [t for t in need if t not in keys]
    if missing:
        raise ValueError(f"no key column for {missing}")
    fresh = {start: materialize(tables[start].where(_pred(pred)).select(F.col(keys[start]).alias("__gone")).where("__gone IS NOT NULL").distinct())}
    doomed = dict(fresh)
    # rows of the first table that match go also if they have no key
    while fresh:
        found: dict[str, DataFrame] = {}
        for r in references:
            if r.on_delete != "cascade" or r.parent not in fresh or r.child not in keys:
                continue
            rows = tables[r.child].select(F.col(keys[r.child]).alias("__key"), F.col(r.column).alias("__ref"))
            hit = rows.join(fresh[r.parent], F.col("__ref") == F.col("__gone"), "left_semi").select(F.col("__key").alias("__gone"))
            found[r.child] = hit if r.child not in found else found[r.child].unionByName(hit)
        fresh = {}
        for name, hit in found.items():
            hit = hit.where("__gone IS NOT NULL").distinct()
            if name in doomed:
                hit = hit.join(doomed[name], "__gone", "left_anti")
            hit = materialize(hit)
            if not hit.isEmpty():
                fresh[name] = hit
                doomed[name] = hit if name not in doomed else materialize(doomed[name].unionByName(hit))
    kept = {}
    for name, df in tables.items():
        if name == start:
            df = delete_where(df, pred)
        if name in doomed:
            df = df.join(doomed[name], F.col(keys[name]) == F.col("__gone"), "left_anti")
        for r in references:
            if r.child == name and r.parent in doomed and r.on_delete == "cascade":
                df = df.join(doomed[r.parent], F.col(r.column) == F.col("__gone"), "left_anti")
        kept[name] = df
    for r in references:
        if r.parent not in doomed or r.on_delete == "cascade":
            continue
        if r.on_delete == "restrict":
            n = kept[r.child].join(doomed[r.parent], F.col(r.column) == F.col("__gone"), "left_semi").count()
            if n:
                raise RestrictViolation(f"{n} rows of {r.child} refer to rows of {r.parent} by {r.column}")
        else:
            gone = F.col("__gone").isNotNull()
            columns = [F.when(~gone, F.col(c)).alias(c) if c == r.column else F.col(c) for c in kept[r.child].columns]
            kept[r.child] = kept[r.child].join(doomed[r.parent], F.col(r.column) == F.col("__gone"), "left").select(*columns)
    return kept


def cascade_delete(parent: DataFrame, parent_key: str, pred, children: dict) -> tuple[DataFrame, dict]:
    """Delete parents matching ``pred`` and every child row referencing them: one level of :func:`delete_with_references`.

    ``children`` maps a name to ``(df, fk)``.
    """
    tables = {"parent": parent} | {f"child {n}": df for n, (df, _) in children.items()}
    references = [Reference(f"child {n}", fk, "parent", "cascade") for n, (_, fk) in children.items()]
    kept = delete_with_references(tables, {"parent": parent_key}, references, "parent", pred)
    return kept["parent"], {n: kept[f"child {n}"] for n in children}


def apply_deltas(df: DataFrame, key: str, col: str, deltas: DataFrame, delta_col: str = "delta") -> DataFrame:
    """Apply signed changes to ``col`` per key (a transfer is -n on one key, +n on another).

    Deltas are summed per key (several moves on one key combine map-side) and
    joined once.  :func:`validate_transfer` must pass before the result is
    published, which makes the change all-or-nothing.
    """
    d = deltas.groupBy(F.col(key).alias("__k")).agg(F.sum(delta_col).alias("__d"))
    j = df.join(d, df[key] == F.col("__k"), "left")
    t = df.schema[col].dataType
    return j.withColumn(col, (F.col(col) + F.coalesce(F.col("__d"), F.lit(0))).cast(t)).drop("__k", "__d")


def validate_transfer(before: DataFrame, after: DataFrame, key: str, col: str, deltas: DataFrame,
                      floor=None) -> dict:
    """Checks of a transfer: every key exists, the total is conserved and no
    balance drops below ``floor``.  Raises :class:`TransferRejected`.

    One pass over each frame: totals and balances below the floor are one
    aggregate, unknown keys an anti join of the deltas' distinct keys.
    """
    missing = deltas.select(key).distinct().join(before.select(key), key, "left_anti").count()
    tb = before.agg(F.sum(col)).first()[0]
    below = F.count_if(F.col(col) < floor) if floor is not None else F.lit(0)
    ta, n_below = after.agg(F.sum(col), below).first()
    res = {"missing_keys": missing, "total_before": tb, "total_after": ta, "below_floor": n_below}
    if missing or tb != ta or n_below:
        raise TransferRejected(str(res))
    return res


def touch_changed(old: DataFrame, new: DataFrame, key: str, tracked: list[str], run_at,
                  ts_col: str = "updated_at") -> DataFrame:
    """``updated_at`` moves only on rows whose tracked values changed (or are new)."""
    o = old.select(key, *tracked, ts_col).alias("t")
    n = new.alias("s")
    j = n.join(o, F.col(f"s.{key}") == F.col(f"t.{key}"), "left")
    changed = F.col(f"t.{key}").isNull() | any_differs(tracked)
    stamp = F.lit(run_at).cast("timestamp_ntz")
    cols = [F.col(f"s.{c}") for c in new.columns if c != ts_col]
    return j.select(*cols, F.when(changed, stamp).otherwise(F.col(f"t.{ts_col}")).alias(ts_col))


def null_safe_all_equal(cols: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}")) for c in cols], F.lit(True))
