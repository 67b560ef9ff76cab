"""Fiscal-period text helpers.

A fiscal period is the text ``'Q<n> <yyyy>'`` (for example ``'Q3 2024'``).
All period ordering in the library follows the reference: year text
(last four characters) first, then quarter text (first two characters).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def year_text(period: ColumnOrName) -> Column:
    """``RIGHT(period, 4)``: the year part as text."""
    return F.right(_col(period), F.lit(4))


def quarter_text(period: ColumnOrName) -> Column:
    """``LEFT(period, 2)``: the ``'Qn'`` part as text."""
    return F.left(_col(period), F.lit(2))


def period_order(period: ColumnOrName) -> list[Column]:
    """Sort keys of a period: year text, then quarter text."""
    return [year_text(period), quarter_text(period)]


def period_type(period: ColumnOrName) -> Column:
    """``'Q1'``..``'Q4'`` when the text contains it, else NULL.

    The reference assigns Q1, Q2, Q3, Q4 in turn, so a later match wins;
    the ``when`` chain therefore tests Q4 first.
    """
    p = _col(period)
    out = F.when(p.contains("Q4"), F.lit("Q4"))
    for q in ("Q3", "Q2", "Q1"):
        out = out.when(p.contains(q), F.lit(q))
    return out


def period_parts(period: ColumnOrName, years: tuple[int, int] | None = None) -> tuple[Column, Column]:
    """(year, quarter) integers parsed from ``'Qn yyyy'``.

    Quarter is the single character after ``Q`` and year the second
    space-separated token, as in the reference parser.  Unparsable text
    gives NULL instead of an error.  With ``years=(lo, hi)`` a year outside
    the closed range becomes NULL (the loader only knew a fixed year list).
    """
    p = _col(period)
    year = F.split_part(p, F.lit(" "), F.lit(2)).try_cast("int")
    quarter = F.substring(p, 2, 1).try_cast("int")
    if years is not None:
        lo, hi = years
        year = F.when(year.between(lo, hi), year)
    return year, quarter


def quarter_label(quarter_num: ColumnOrName, year: ColumnOrName) -> Column:
    """``'Q' || n || ' ' || year`` from a quarter number and a year."""
    return F.concat(
        F.lit("Q"), _col(quarter_num).cast("string"), F.lit(" "), _col(year).cast("string")
    )
