"""Same-row ratio features (G6-G13): pure projections, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterline.functions.numeric import ratio, to_store


def ratio_columns() -> dict[str, Column]:
    """The eight ratio features, unrounded; NULL on a zero denominator.

    roe and de_ratio use ``total_assets - total_liabilities`` as equity,
    not the stored total_equity, as the reference does.
    """
    c = F.col
    equity = c("total_assets") - c("total_liabilities")
    return {
        "net_margin": ratio(c("net_income"), c("revenue"), percent=True),
        "gross_margin": ratio(c("gross_profit"), c("revenue"), percent=True),
        "oper_margin": ratio(c("operating_income"), c("revenue"), percent=True),
        "roe": ratio(c("net_income"), equity, percent=True),
        "de_ratio": ratio(c("total_liabilities"), equity),
        "current_ratio": ratio(c("current_assets"), c("current_liabilities")),
        "cash_ratio": ratio(c("cash"), c("current_liabilities")),
        "asset_turn": ratio(c("revenue"), c("total_assets")),
    }


def ratios(statements: DataFrame, ticker: str = "ticker", period: str = "fiscal_period") -> DataFrame:
    """(ticker, fiscal_period, net_margin, ..., asset_turn) as DECIMAL(10,4)."""
    return statements.select(ticker, period, *[to_store(v).alias(k) for k, v in ratio_columns().items()])

