"""Declared table schemas and a conforming cast (the DDL of the store).

VARCHAR(n) has no Spark equivalent that truncates; lengths are checked by
``operators.quality.domain_violations`` instead.  Decimal columns are
stored as DECIMAL(10,4); ``conform`` rounds half-up and raises on values that
do not fit, as the store does.  ``quality.overflow_violations`` reports them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterline.functions.numeric import to_store

D = T.DecimalType(10, 4)
S = T.StringType()

# The column lists of the four declared tables, in DDL order
# (companies, statement metrics, estimates, features).
COMPANIES = T.StructType(
    [
        T.StructField("ticker", S),
        T.StructField("company_name", S),
        T.StructField("sector", S),
        T.StructField("industry", S),
        T.StructField("market_cap", T.LongType()),
    ]
)

STATEMENT_METRICS = [
    "revenue",
    "cost_of_revenue",
    "gross_profit",
    "operating_expenses",
    "operating_income",
    "net_income",
    "eps",
    "total_assets",
    "total_liabilities",
    "total_equity",
    "current_assets",
    "current_liabilities",
    "cash",
    "total_debt",
    "operating_cash_flow",
    "capex",
    "free_cash_flow",
]

FINANCIAL_STATEMENTS = T.StructType(
    [T.StructField("ticker", S), T.StructField("fiscal_period", S), T.StructField("period_type", S)]
    + [T.StructField(m, D) for m in STATEMENT_METRICS]
)

ANALYST_ESTIMATES = T.StructType(
    [
        T.StructField("ticker", S),
        T.StructField("fiscal_period", S),
        T.StructField("consensus_eps", D),
        T.StructField("num_analysts", T.IntegerType()),
        T.StructField("eps_high", D),
        T.StructField("eps_low", D),
    ]
)

FEATURE_COLUMNS = [
    "qoq_rev",
    "yoy_rev",
    "qoq_eps",
    "yoy_eps",
    "momentum",
    "net_margin",
    "gross_margin",
    "oper_margin",
    "roe",
    "de_ratio",
    "current_ratio",
    "cash_ratio",
    "asset_turn",
]

FEATURES = T.StructType(
    [T.StructField("ticker", S), T.StructField("fiscal_period", S)]
    + [T.StructField(c, D) for c in FEATURE_COLUMNS]
    + [T.StructField("eps_status", S), T.StructField("eps_surprise", D)]
)

# VARCHAR(n) bounds of the declared tables (column -> n).
VARCHAR_LIMITS = {
    "ticker": 10,
    "fiscal_period": 10,
    "period_type": 2,
    "eps_status": 10,
    "company_name": 255,
    "sector": 100,
    "industry": 100,
}

TABLES = {
    "companies": COMPANIES,
    "financial_statements": FINANCIAL_STATEMENTS,
    "analyst_estimates": ANALYST_ESTIMATES,
    "features": FEATURES,
}


def conform(df: DataFrame, schema: T.StructType, keep_extra: bool = False, overflow: str = "error") -> DataFrame:
    """Select the schema's columns in declared order, cast to declared types.

    A declared column missing from ``df`` is an error (AnalysisException),
    as the reference's fixed column selection is.  Decimals are rounded
    half-up; ``overflow`` as in ``to_store``.
    """
    cols = []
    for field in schema.fields:
        c = F.col(field.name)
        cast = to_store(c, overflow) if field.dataType == D else c.cast(field.dataType)
        cols.append(cast.alias(field.name))
    if keep_extra:
        names = set(schema.fieldNames())
        cols += [F.col(c) for c in df.columns if c not in names]
    return df.select(*cols)
