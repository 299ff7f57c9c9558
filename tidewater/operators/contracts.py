"""Table contracts: declared columns, defaults, constraints.

Spark's Parquet tables do not enforce NOT NULL, PRIMARY KEY, CHECK or FOREIGN
KEY, so a contract is applied as data: rows are split into accepted and
rejected-with-reasons instead of failing a statement.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string


@dataclass
class Col:
    name: str
    dtype: str
    nullable: bool = True
    default: object = None          # literal used when the column is not supplied
    max_length: int | None = None   # VARCHAR(n)
    check: str | None = None        # SQL boolean expression, NULL passes (as in SQL CHECK)
    accepted: tuple | None = None   # enum by CHECK ... IN


@dataclass
class ForeignKey:
    column: str
    parent: DataFrame
    parent_column: str


@dataclass
class Contract:
    name: str
    columns: list[Col]
    primary_key: list[str] = field(default_factory=list)
    unique: list[list[str]] = field(default_factory=list)
    foreign_keys: list[ForeignKey] = field(default_factory=list)

    def schema(self) -> StructType:
        return StructType([StructField(c.name, _parse_datatype_string(c.dtype), c.nullable) for c in self.columns])

    def empty(self, spark) -> DataFrame:
        """CREATE TABLE ... LIKE: the structure without rows."""
        return spark.createDataFrame([], self.schema())


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """INSERT by column list: supplied columns by name, the rest take their
    default (or NULL), every column cast to its declared type and order."""
    have = set(df.columns)
    out = []
    for c in contract.columns:
        if c.name in have:
            v = F.col(c.name)       # a supplied NULL stays NULL
        else:
            v = F.lit(c.default)
        out.append(v.cast(c.dtype).alias(c.name))
    return df.select(*out)


def evolve(df: DataFrame, add: dict | None = None, retype: dict | None = None,
           rename: dict | None = None, drop: list | None = None) -> DataFrame:
    """ALTER TABLE as a projection: add (NULL or default), retype, rename, drop."""
    out = df
    for name, (dtype, default) in (add or {}).items():
        out = out.withColumn(name, F.lit(default).cast(dtype))
    for name, dtype in (retype or {}).items():
        out = out.withColumn(name, F.col(name).cast(dtype))
    for old, new in (rename or {}).items():
        out = out.withColumnRenamed(old, new)
    if drop:
        out = out.drop(*drop)
    return out


def _reasons(contract: Contract) -> list[Column]:
    rs = []
    for c in contract.columns:
        col = F.col(c.name)
        if not c.nullable:
            rs.append(F.when(col.isNull(), F.lit(f"{c.name} is null")))
        if c.max_length is not None:
            rs.append(F.when(F.char_length(col.cast("string")) > c.max_length,
                             F.lit(f"{c.name} longer than {c.max_length}")))
        if c.check is not None:
            rs.append(F.when(~F.coalesce(F.expr(c.check), F.lit(True)), F.lit(f"check failed: {c.check}")))
        if c.accepted is not None:
            rs.append(F.when(~col.isin(*c.accepted), F.lit(f"{c.name} not accepted")))
    return rs


def quarantine(df: DataFrame, contract: Contract) -> DataFrame:
    """Every input row with ``reasons`` (array, empty = accepted).

    Key checks count rows per key with an aggregate (combined map-side, so a
    hot duplicated key does not land in one task) and join the duplicated
    keys back; foreign keys are a left join to the distinct parent keys.
    """
    out = df
    key_sets = ([contract.primary_key] if contract.primary_key else []) + list(contract.unique)
    flags = []
    for i, ks in enumerate(key_sets):
        dups = (df.groupBy(*ks).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1")
                  .select(*[F.col(k).alias(f"__d{i}_{k}") for k in ks]).withColumn(f"__dup{i}", F.lit(True)))
        cond = None
        for k in ks:
            c = out[k] == dups[f"__d{i}_{k}"]
            cond = c if cond is None else cond & c
        out = out.join(dups, cond, "left").drop(*[f"__d{i}_{k}" for k in ks])
        label = "primary key" if (contract.primary_key and i == 0) else "unique key"
        flags.append(F.when(F.col(f"__dup{i}").isNotNull(), F.lit(f"duplicate {label} ({', '.join(ks)})")))
    for j, fk in enumerate(contract.foreign_keys):
        parent = fk.parent.select(F.col(fk.parent_column).alias(f"__p{j}")).distinct()
        out = out.join(parent, out[fk.column] == F.col(f"__p{j}"), "left")
        flags.append(F.when(F.col(fk.column).isNotNull() & F.col(f"__p{j}").isNull(),
                            F.lit(f"{fk.column} has no parent")))
    reasons = F.array_compact(F.array(*(_reasons(contract) + flags))) if (_reasons(contract) or flags) \
        else F.array().cast("array<string>")
    helper = [c for c in out.columns if c.startswith("__dup") or c.startswith("__p")]
    return out.withColumn("reasons", reasons).drop(*helper)


def split_accepted(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    ok = checked.filter(F.size("reasons") == 0).drop("reasons")
    bad = checked.filter(F.size("reasons") > 0)
    return ok, bad
