"""The feature chain as SQL over stored tables.

``register_tables`` makes stored tables views; ``FEATURES_SQL`` and ``MATRIX_SQL`` are the statements a SQL user runs
over them (``spark.sql(text, args)``).  They give what ``assemble.features_all`` and ``assemble.feature_matrix`` give,
by the same plan: one window a side, one estimate row a key, one join.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from quarterline.schemas import FEATURE_COLUMNS

# numerator, denominator, whether in percent
RATIOS = {
    "net_margin": ("net_income", "revenue", True),
    "gross_margin": ("gross_profit", "revenue", True),
    "oper_margin": ("operating_income", "revenue", True),
    "roe": ("net_income", "(total_assets - total_liabilities)", True),
    "de_ratio": ("total_liabilities", "(total_assets - total_liabilities)", False),
    "current_ratio": ("current_assets", "current_liabilities", False),
    "cash_ratio": ("cash", "current_liabilities", False),
    "asset_turn": ("revenue", "total_assets", False),
}
TABLES = ("financial_statements", "analyst_estimates", "companies", "features")


def register_tables(spark: SparkSession, tables: Mapping[str, str | DataFrame]) -> None:
    """Views of stored tables, by folder or DataFrame; the names are those of the declared tables."""
    for name, table in tables.items():
        if name not in TABLES:
            raise ValueError(f"no such table: {name}")
        (spark.read.parquet(table) if isinstance(table, str) else table).createOrReplaceTempView(name)


def _pct(now: str, before: str) -> str:
    return f"({now} - {before}) / nullif({before}, 0) * 100"


def _ratio(top: str, bottom: str, percent: bool) -> str:
    return f"{top} / nullif({bottom}, 0)" + (" * 100" if percent else "")


_W = "(PARTITION BY ticker ORDER BY year_text, quarter_text, fiscal_period)"
_RATIO_SQL = ",\n    ".join(f"CAST({_ratio(*r)} AS DECIMAL(10, 4)) AS {name}" for name, r in RATIOS.items())
_OUT = ", ".join(f"{'e' if c in ('qoq_eps', 'yoy_eps') else 's'}.{c}" for c in FEATURE_COLUMNS)

#: Growth and ratios of statements, growth of the consensus, and beat or miss with its surprise. Figures that do not
#: fit DECIMAL(10, 4) raise, divisions by zero give NULL.
FEATURES_SQL = f"""
WITH s0 AS (
  SELECT ticker, fiscal_period, right(fiscal_period, 4) AS year_text, left(fiscal_period, 2) AS quarter_text, eps, revenue,
    {_RATIO_SQL}
  FROM financial_statements),
s1 AS (SELECT *, lag(revenue, 1) OVER {_W} AS r1, lag(revenue, 4) OVER {_W} AS r4 FROM s0),
s2 AS (SELECT *, {_pct('revenue', 'r1')} AS qoq, {_pct('revenue', 'r4')} AS yoy FROM s1),
s AS (
  SELECT *, CAST(qoq AS DECIMAL(10, 4)) AS qoq_rev, CAST(yoy AS DECIMAL(10, 4)) AS yoy_rev,
    CAST(yoy - lag(yoy, 4) OVER {_W} AS DECIMAL(10, 4)) AS momentum
  FROM s2),
e0 AS (SELECT ticker, fiscal_period, right(fiscal_period, 4) AS year_text, left(fiscal_period, 2) AS quarter_text, consensus_eps FROM analyst_estimates),
e1 AS (SELECT *, lag(consensus_eps, 1) OVER {_W} AS c1, lag(consensus_eps, 4) OVER {_W} AS c4 FROM e0),
e2 AS (
  SELECT ticker, fiscal_period, consensus_eps, CAST({_pct('consensus_eps', 'c1')} AS DECIMAL(10, 4)) AS qoq_eps,
    CAST({_pct('consensus_eps', 'c4')} AS DECIMAL(10, 4)) AS yoy_eps
  FROM e1),
e AS (
  SELECT ticker, fiscal_period, first.* FROM (
    SELECT ticker, fiscal_period, min(struct(consensus_eps IS NULL AS no_c, consensus_eps, qoq_eps IS NULL AS no_q, qoq_eps, yoy_eps IS NULL AS no_y, yoy_eps)) AS first
    FROM e2 GROUP BY ticker, fiscal_period))
SELECT s.ticker, s.fiscal_period, {_OUT},
  CASE WHEN e.ticker IS NULL THEN NULL WHEN s.eps > e.consensus_eps THEN 'beat' ELSE 'miss' END AS eps_status,
  CAST({_pct('s.eps', 'e.consensus_eps')} AS DECIMAL(10, 4)) AS eps_surprise
FROM s LEFT JOIN e ON s.ticker = e.ticker AND s.fiscal_period = e.fiscal_period
"""

#: The export: labels as numbers, the sign of the surprise before the text; ``:from_year`` and ``:to_year`` bound it.
MATRIX_SQL = f"""
SELECT ticker, fiscal_period, {', '.join(FEATURE_COLUMNS)},
  CASE WHEN eps_surprise > 0 THEN 1D WHEN eps_surprise < 0 THEN 0D WHEN eps_status = 'beat' THEN 1D WHEN eps_status = 'miss' THEN 0D END AS eps_status,
  eps_surprise
FROM features WHERE CAST(right(fiscal_period, 4) AS INT) BETWEEN :from_year AND :to_year
"""


def features_sql(spark: SparkSession) -> DataFrame:
    """``FEATURES_SQL`` over the registered ``financial_statements`` and ``analyst_estimates``."""
    return spark.sql(FEATURES_SQL)


def matrix_sql(spark: SparkSession, from_year: int, to_year: int) -> DataFrame:
    """``MATRIX_SQL`` over the registered ``features``."""
    return spark.sql(MATRIX_SQL, args={"from_year": from_year, "to_year": to_year})
