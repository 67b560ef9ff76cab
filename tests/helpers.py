"""Small builders for hand-made rows."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import types as T

D = T.DecimalType(10, 4)

STATEMENT_SCHEMA = T.StructType(
    [T.StructField("ticker", T.StringType()), T.StructField("fiscal_period", T.StringType())]
    + [T.StructField(c, D) for c in (
        "revenue", "gross_profit", "operating_income", "net_income", "eps", "total_assets",
        "total_liabilities", "current_assets", "current_liabilities", "cash")]
)

ESTIMATE_SCHEMA = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("fiscal_period", T.StringType()),
    T.StructField("consensus_eps", D),
    T.StructField("num_analysts", T.IntegerType()),
    T.StructField("eps_high", D),
    T.StructField("eps_low", D),
])


def dec(x):
    return None if x is None else Decimal(str(x))


def statement_row(ticker, period, revenue=100, eps=1, **kw):
    base = dict(gross_profit=50, operating_income=30, net_income=20, total_assets=400, total_liabilities=100,
                current_assets=60, current_liabilities=30, cash=10)
    base.update(kw)
    return (ticker, period, dec(revenue), dec(base["gross_profit"]), dec(base["operating_income"]),
            dec(base["net_income"]), dec(eps), dec(base["total_assets"]), dec(base["total_liabilities"]),
            dec(base["current_assets"]), dec(base["current_liabilities"]), dec(base["cash"]))


def estimate_row(ticker, period, consensus):
    return (ticker, period, dec(consensus), 5, dec(consensus), dec(consensus))


def statements(spark, rows):
    return spark.createDataFrame(rows, STATEMENT_SCHEMA)


def estimates(spark, rows):
    return spark.createDataFrame(rows, ESTIMATE_SCHEMA)


def periods(first_year, n):
    out = []
    for i in range(n):
        out.append(f"Q{i % 4 + 1} {first_year + i // 4}")
    return out
