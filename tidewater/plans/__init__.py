"""Registered queries.  Importing this package fills the registry."""

from tidewater.plans.registry import ORACLE, QUERIES, register  # noqa: F401
from tidewater.plans import (  # noqa: F401,E402
    relational, windows, maintenance, loads, quality, business, sources, streams,
)
