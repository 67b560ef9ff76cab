"""The declared constraints as data-quality queries.

Each check returns the violating rows (empty = clean) instead of failing
the load; all are aggregates, anti joins or filters over whole tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterline.functions.numeric import fits_store
from quarterline.operators.growth import quarter_window
from quarterline.schemas import VARCHAR_LIMITS

PERIOD_PATTERN = r"^Q[1-4] [0-9]{4}$"
DECIMAL_LIMIT = 10**6  # DECIMAL(10,4) holds |x| < 10^6


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def fk_orphans(df: DataFrame, parent: DataFrame, key: str = "ticker", parent_key: str = "ticker") -> DataFrame:
    """Rows whose ``key`` has no parent row (C2), as a left-anti join.

    A NULL key refers to nothing and is no orphan, as in a foreign key.
    """
    p = parent.select(F.col(parent_key).alias("__pk")).distinct()
    return df.where(F.col(key).isNotNull()).join(p, F.col(key) == F.col("__pk"), "left_anti")


def domain_violations(df: DataFrame, keys: Sequence[str], varchar_limits: Mapping[str, int] | None = None,
                      decimal_columns: Sequence[str] = ()) -> DataFrame:
    """Cells breaking VARCHAR(n) length or the DECIMAL(10,4) range.

    Output (keys..., column, rule, value): the offending number, or the
    text length for a VARCHAR rule, as double.
    """
    limits = {c: n for c, n in (varchar_limits or VARCHAR_LIMITS).items() if c in df.columns}
    checks = []
    for col, n in limits.items():
        bad = F.length(F.col(col).cast("string")) > n
        checks.append(F.when(bad, F.struct(F.lit(col).alias("column"), F.lit(f"length>{n}").alias("rule"),
                                           F.length(F.col(col).cast("string")).cast("double").alias("value"))))
    for col in decimal_columns:
        bad = F.abs(F.col(col)) >= F.lit(DECIMAL_LIMIT)
        checks.append(F.when(bad, F.struct(F.lit(col).alias("column"), F.lit("decimal(10,4) range").alias("rule"),
                                           F.col(col).cast("double").alias("value"))))
    if not checks:
        raise ValueError("no column to check")
    cells = df.select(*keys, F.explode(F.filter(F.array(*checks), lambda x: x.isNotNull())).alias("v"))
    return cells.select(*keys, "v.column", "v.rule", "v.value")


def overflow_violations(df: DataFrame, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """(keys..., column, value): cells that ``conform`` to ``schema`` would refuse.

    The opt-in way to load such a table: report these, then
    ``conform(..., overflow="null")``.
    """
    checks = [F.when(~fits_store(f.name), F.struct(F.lit(f.name).alias("column"), F.col(f.name).cast("double").alias("value")))
              for f in schema.fields if isinstance(f.dataType, T.DecimalType)]
    cells = df.select(*keys, F.explode(F.filter(F.array(*checks), lambda x: x.isNotNull())).alias("v"))
    return cells.select(*keys, "v.column", "v.value")


def bad_periods(df: DataFrame, period: str = "fiscal_period") -> DataFrame:
    """Rows whose period text is not ``Q1``..``Q4`` + space + four digits (C4)."""
    return df.where(~F.coalesce(F.col(period).rlike(PERIOD_PATTERN), F.lit(False)))


def zero_denominators(statements: DataFrame, estimates: DataFrame | None = None) -> DataFrame:
    """(ticker, fiscal_period, denominator) for every zero a feature divides by.

    Covers the same-row denominators, the lagged revenue (1 and 4 rows
    back) and, with ``estimates``, the consensus and its lags.
    """
    w = quarter_window()
    s = statements.select(
        "ticker", "fiscal_period",
        F.array(
            F.when(F.col("revenue") == 0, F.lit("revenue")),
            F.when(F.col("total_assets") == 0, F.lit("total_assets")),
            F.when(F.col("total_assets") - F.col("total_liabilities") == 0, F.lit("total_assets - total_liabilities")),
            F.when(F.col("current_liabilities") == 0, F.lit("current_liabilities")),
            F.when(F.lag("revenue", 1).over(w) == 0, F.lit("revenue lag 1")),
            F.when(F.lag("revenue", 4).over(w) == 0, F.lit("revenue lag 4")),
        ).alias("d"),
    )
    frames = [s]
    if estimates is not None:
        frames.append(estimates.select(
            "ticker", "fiscal_period",
            F.array(
                F.when(F.col("consensus_eps") == 0, F.lit("consensus_eps")),
                F.when(F.lag("consensus_eps", 1).over(w) == 0, F.lit("consensus_eps lag 1")),
                F.when(F.lag("consensus_eps", 4).over(w) == 0, F.lit("consensus_eps lag 4")),
            ).alias("d"),
        ))
    out = frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])
    return out.select("ticker", "fiscal_period", F.explode(F.filter("d", lambda x: x.isNotNull())).alias("denominator"))
