"""Key -> (Spark query, oracle SQL) registry.

Each query is ``fn(spark, sf_dir) -> DataFrame``.  The oracle is ANSI SQL over
views named after the driver tables; keys whose result is not expressible as
one SQL statement register no oracle (rows-only check).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def _bigint_count_if(sql: str) -> str:
    """DuckDB types count_if as HUGEINT; Spark's is BIGINT.  Cast every call."""
    out, i, tok = [], 0, "count_if("
    while True:
        j = sql.find(tok, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + len(tok) - 1
        while True:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            if depth == 0:
                break
            k += 1
        out.append(sql[i:j])
        out.append(f"CAST({sql[j:k + 1]} AS BIGINT)")
        i = k + 1


def register(key: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate key {key}")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLE[key] = _bigint_count_if(oracle.strip())
        return fn
    return deco
