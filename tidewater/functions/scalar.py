"""Column helpers shared by the plans.

All are built-in Spark expressions (whole-stage codegen); none is a UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "money", "line_total", "unit_price", "pct", "safe_div", "day_name", "byte_length",
    "month_key", "as_ntz", "null_safe_differs", "COMPLETED", "OPEN", "CANCELLED", "loosely",
]

# How the driver's order statuses map onto the shop's vocabulary.
COMPLETED = "F"   # completed
OPEN = "O"        # open / in progress
CANCELLED = "P"   # plays "cancelled"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def money(x) -> Column:
    """Money is DECIMAL(18,2); cast before summing, never sum doubles."""
    return _c(x).cast("decimal(18,2)")


def line_total(price="l_extendedprice", discount="l_discount") -> Column:
    """Net line amount as money, computed in DECIMAL so rounding is exact HALF_UP.

    price * (1 - discount) in DOUBLE lands on x.xx4999.. or x.xx5000.. and
    different engines round those differently; in DECIMAL the product is exact.
    """
    return (money(price) * (F.lit(1) - _c(discount).cast("decimal(4,2)"))).cast("decimal(18,2)")


def unit_price(price="l_extendedprice", qty="l_quantity") -> Column:
    return F.try_divide(_c(price), _c(qty))


def safe_div(a, b) -> Column:
    """MySQL returns NULL on division by zero; ANSI Spark raises, so use try_divide."""
    return F.try_divide(_c(a), _c(b))


def pct(part, whole, digits: int = 1) -> Column:
    """round(100 * part / whole, digits) as DOUBLE; NULL when whole is 0."""
    return F.round(F.try_divide(_c(part).cast("double") * 100.0, _c(whole).cast("double")), digits)


def day_name(d) -> Column:
    """Full English weekday name (MySQL DAYNAME); Spark's dayname gives 'Mon'."""
    return F.date_format(_c(d), "EEEE")


def byte_length(s) -> Column:
    """MySQL LENGTH counts bytes; Spark length counts characters."""
    return F.octet_length(_c(s))


def month_key(ts) -> Column:
    """MySQL DATE_FORMAT(ts, '%Y-%m')."""
    return F.date_format(_c(ts), "yyyy-MM")


def as_ntz(c) -> Column:
    """date_trunc on TIMESTAMP_NTZ returns a zoned timestamp; cast it back."""
    return _c(c).cast("timestamp_ntz")


def null_safe_differs(a, b) -> Column:
    """True when a and b differ, NULL transitions included: NOT (a <=> b)."""
    return ~_c(a).eqNullSafe(_c(b))


def loosely(x) -> Column:
    """Text that compares, sorts and groups without case and accents (an option; plain columns compare by bytes)."""
    return F.collate(_c(x), "UNICODE_CI_AI")
