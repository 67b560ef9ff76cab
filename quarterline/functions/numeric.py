"""Decimal arithmetic with the storage rules of the feature tables.

Everything stored is DECIMAL(10,4).  Intermediates stay unrounded
(Spark's exact decimal arithmetic) and are rounded half-up only when
stored.  A zero denominator gives NULL (``nullif``) rather than the
division error PostgreSQL or ANSI Spark would raise.  A value that does
not fit DECIMAL(10,4) raises, as the store would; only ``overflow="null"``
stores NULL, for callers that report such rows (``quality.overflow_violations``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

STORE_TYPE = DecimalType(10, 4)

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fits_store(value: ColumnOrName) -> Column:
    """Whether a value, rounded to four places, fits DECIMAL(10,4); NULL fits."""
    v = _col(value)
    return v.isNull() | (F.abs(F.round(v, 4)) < F.lit(10**6))


def to_store(value: ColumnOrName, overflow: str = "error") -> Column:
    """Round half-up to DECIMAL(10,4); out-of-range raises (or, opted in, is NULL)."""
    v = _col(value)
    stored = v.try_cast(STORE_TYPE)
    if overflow == "null":
        return stored
    if overflow != "error":
        raise ValueError("overflow must be 'error' or 'null'")
    message = F.concat(F.lit("value does not fit DECIMAL(10,4): "), v.cast("string"))
    return F.when(fits_store(v), stored).otherwise(F.raise_error(message).cast(STORE_TYPE))


def pct_change(current: ColumnOrName, previous: ColumnOrName) -> Column:
    """``((current - previous) / previous) * 100``, unrounded; NULL on zero."""
    prev = _col(previous)
    return ((_col(current) - prev) / F.nullif(prev, F.lit(0))) * F.lit(100)


def ratio(numerator: ColumnOrName, denominator: ColumnOrName, percent: bool = False) -> Column:
    """``numerator / denominator`` (times 100 when ``percent``); NULL on zero."""
    out = _col(numerator) / F.nullif(_col(denominator), F.lit(0))
    return out * F.lit(100) if percent else out
