"""Query and oracle registry of the corpus operators."""

from __future__ import annotations

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def register(key: str, oracle: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate key {key}")
        QUERIES[key] = fn
        if oracle:
            ORACLE[key] = oracle.strip()
        return fn
    return deco
