"""Row-offset growth features over per-ticker quarter windows.

Every window is ``PARTITION BY ticker ORDER BY year text, quarter text``,
so Spark plans one hash exchange on ticker and one sort for all lags:
the sort keys and lags are materialised as columns once, and the nested
momentum window reuses the same attributes (no second sort).
``LAG(x, k)`` means k *rows* earlier, not k calendar quarters: a missing
quarter shifts the comparison, exactly as in the reference.  A ticker has
one row per quarter, so a partition never grows with the fact table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from quarterline.functions.numeric import pct_change, to_store
from quarterline.functions.periods import period_order, period_parts, quarter_text, year_text

_Y, _Q = "__year_text", "__quarter_text"


def quarter_window(ticker: str = "ticker", period: str = "fiscal_period") -> WindowSpec:
    """``PARTITION BY ticker ORDER BY RIGHT(period,4), LEFT(period,2)``."""
    return Window.partitionBy(ticker).orderBy(*period_order(period), F.col(period))


def _keyed_window(df: DataFrame, ticker: str, period: str) -> tuple[DataFrame, WindowSpec]:
    if _Y not in df.columns:
        df = df.withColumns({_Y: year_text(period), _Q: quarter_text(period)})
    return df, Window.partitionBy(ticker).orderBy(_Y, _Q, period)


def lagged(df: DataFrame, column: str, offset: int, alias: str | None = None,
           ticker: str = "ticker", period: str = "fiscal_period") -> DataFrame:
    """Add ``LAG(column, offset)`` over the quarter window."""
    alias = alias or f"{column}_lag{offset}"
    return df.withColumn(alias, F.lag(column, offset).over(quarter_window(ticker, period)))


def with_growth(df: DataFrame, value: str, prefix: str, with_momentum: bool = True,
                ticker: str = "ticker", period: str = "fiscal_period") -> DataFrame:
    """Add unrounded ``qoq_<prefix>``, ``yoy_<prefix>`` (and ``momentum``).

    momentum = YoY(t) - YoY(t-4), from *unrounded* YoY values; it needs
    eight earlier rows.  Helper columns start with ``__`` (drop them or
    select the outputs).
    """
    df, w = _keyed_window(df, ticker, period)
    lag1, lag4 = f"__{value}_lag1", f"__{value}_lag4"
    df = df.withColumns({lag1: F.lag(value, 1).over(w), lag4: F.lag(value, 4).over(w)})
    df = df.withColumns({f"qoq_{prefix}": pct_change(value, lag1), f"yoy_{prefix}": pct_change(value, lag4)})
    if with_momentum:
        df = df.withColumn("momentum", F.col(f"yoy_{prefix}") - F.lag(f"yoy_{prefix}", 4).over(w))
    return df


def revenue_growth(statements: DataFrame, ticker: str = "ticker", period: str = "fiscal_period") -> DataFrame:
    """(ticker, fiscal_period, qoq_rev, yoy_rev, momentum) as DECIMAL(10,4)."""
    g = with_growth(statements.select(ticker, period, "revenue"), "revenue", "rev", True, ticker, period)
    return g.select(ticker, period, *[to_store(c).alias(c) for c in ("qoq_rev", "yoy_rev", "momentum")])


def consensus_growth(estimates: DataFrame, ticker: str = "ticker", period: str = "fiscal_period") -> DataFrame:
    """(ticker, fiscal_period, qoq_eps, yoy_eps) from *consensus* EPS.

    Computed on the estimate table before any join, so a quarter without a
    statement still serves as the lag of the next one.
    """
    g = with_growth(estimates.select(ticker, period, "consensus_eps"), "consensus_eps", "eps", False, ticker, period)
    return g.select(ticker, period, *[to_store(c).alias(c) for c in ("qoq_eps", "yoy_eps")])


def quarter_index(period: str = "fiscal_period") -> Column:
    """Quarters since year 0: consecutive quarters differ by one.  NULL for a period that is no ``Q1``..``Q4``."""
    year, quarter = period_parts(period)
    return F.when(quarter.between(1, 4), year * 4 + quarter - 1)


def calendar_growth(df: DataFrame, value: str, prefix: str, ticker: str = "ticker", period: str = "fiscal_period") -> DataFrame:
    """(ticker, fiscal_period, qoq, yoy, momentum) against the quarters exactly 1, 4 and 8 quarters back.

    The strict form of ``with_growth``: where that quarter is missing the result is NULL, instead of a comparison with
    whichever row lies so many rows back.  The lags are RANGE frames of one quarter over an integer index, so all
    three share one exchange, one sort and one window node; momentum is taken from the values 0, 4, 4 and 8 quarters
    back instead of a second window over YoY.  A quarter reported twice gives no single value: it raises.  A row whose
    period is no quarter has NULLs.
    """
    w = Window.partitionBy(ticker).orderBy("__quarter")

    def back(k: int) -> Column:
        frame = w.rangeBetween(-k, -k)
        twice = F.raise_error(F.concat(F.lit("a quarter comes twice for "), F.col(ticker).cast("string")))
        kind, known = df.schema[value].dataType, F.col("__quarter").isNotNull()
        return F.when(known & (F.count(F.lit(1)).over(frame) > 1), twice.cast(kind)).when(known, F.first(value).over(frame))

    rows = df.select(ticker, period, value, quarter_index(period).alias("__quarter"))
    rows = rows.withColumns({f"__back{k}": back(k) for k in (1, 4, 8)})
    yoy, before = pct_change(value, "__back4"), pct_change("__back4", "__back8")
    return rows.select(ticker, period, to_store(pct_change(value, "__back1")).alias(f"qoq_{prefix}"), to_store(yoy).alias(f"yoy_{prefix}"),
                       to_store(yoy - before).alias("momentum"))
