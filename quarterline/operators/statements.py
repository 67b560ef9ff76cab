"""Statement readers and the ``financial_statements`` table.

Each reader: drop metrics with a NULL period (P2) -> append the picked
derived-sheet row (P3, S4) -> case-insensitive title filter (F1) ->
rename and transpose (P6, R1-R3) -> fixed projection (P7).
``statements_from_sheets`` does all sheets and both joins in one pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterline.functions.numeric import to_store
from quarterline.functions.periods import period_order, period_type
from quarterline.operators.align import sequential_position
from quarterline.operators.reshape import (
    append_by_name,
    by_ticker,
    complete_metric,
    dropna_any,
    metric_columns,
    metric_regex_filter,
    pick_metrics,
    reported_cells,
    require_metrics,
    transpose_statement,
)
from quarterline.schemas import FINANCIAL_STATEMENTS, conform

# Title patterns the reference keeps per sheet, the title ->
# column renames, and the column order of each reader's output.
INCOME_PATTERNS = ["Revenue", "Cost of revenue", "Gross Profit", "Operating Expenses", "Operating Income",
                   "Net Income", "eps"]
INCOME_RENAMES = {
    "Revenue": "revenue",
    "Cost of revenue": "cost_of_revenue",
    "Gross Profit": "gross_profit",
    "Operating Expenses": "operating_expenses",
    "Operating Income (Loss)": "operating_income",
    "Net Income": "net_income",
}
INCOME_COLUMNS = ["revenue", "cost_of_revenue", "gross_profit", "operating_expenses", "operating_income",
                  "net_income", "eps"]

BALANCE_PATTERNS = ["Total Assets", "Total Liabilities", "Total Equity", "Total Current Assets",
                    "Total Current Liabilities", "Cash & Cash Equivalents", "Total Debt"]
BALANCE_RENAMES = {
    "Total Assets": "total_assets",
    "Total Liabilities": "total_liabilities",
    "Total Equity": "total_equity",
    "Total Current Assets": "current_assets",
    "Total Current Liabilities": "current_liabilities",
    "Cash & Cash Equivalents": "cash",
    "Total Debt": "total_debt",
}
BALANCE_COLUMNS = ["total_assets", "total_liabilities", "total_equity", "current_assets", "current_liabilities",
                   "cash", "total_debt"]

CASH_PATTERNS = ["Cash from Operating Activities", "free_cash_flow"]
CASH_RENAMES = {"Cash from Operating Activities": "operating_cash_flow"}
CASH_COLUMNS = ["operating_cash_flow", "capex", "free_cash_flow"]

# Derived-sheet title (our sheets) -> label the reader gives the picked row.
DERIVED_PICKS = {
    "income": {"EPS (Diluted)": "eps"},
    "balance": {"Total Debt": "Total Debt"},
    "cash": {"Free Cash Flow": "free_cash_flow"},
}


# Title -> column of each sheet's reader, title patterns, and the column order.
READERS = {
    "income": (INCOME_PATTERNS, INCOME_RENAMES, INCOME_COLUMNS),
    "balance": (BALANCE_PATTERNS, BALANCE_RENAMES, BALANCE_COLUMNS),
    "cash": (CASH_PATTERNS, CASH_RENAMES, [c for c in CASH_COLUMNS if c != "capex"]),
}


def _reader(sheet_long: DataFrame, derived_long: DataFrame, sheet: str, picks, missing, columns=None,
            constants=None, with_period_type=False) -> DataFrame:
    patterns, renames, own = READERS[sheet]
    kept = dropna_any(sheet_long)
    picked = pick_metrics(derived_long, (picks or DERIVED_PICKS)[sheet])
    filtered = metric_regex_filter(reported_cells(append_by_name(kept, picked)), patterns)
    return transpose_statement(filtered, renames, columns or own, constants, with_period_type, missing)


def income_statement(income_long: DataFrame, derived_long: DataFrame, picks=None, missing: str = "error") -> DataFrame:
    """(ticker, fiscal_period, period_type, revenue ... net_income, eps)."""
    return _reader(income_long, derived_long, "income", picks, missing, with_period_type=True)


def balance_statement(balance_long: DataFrame, derived_long: DataFrame, picks=None, missing: str = "error") -> DataFrame:
    """(ticker, fiscal_period, total_assets ... cash, total_debt)."""
    return _reader(balance_long, derived_long, "balance", picks, missing)


def cash_statement(cash_long: DataFrame, derived_long: DataFrame, picks=None, missing: str = "error") -> DataFrame:
    """(ticker, fiscal_period, operating_cash_flow, capex = 0, free_cash_flow)."""
    return _reader(cash_long, derived_long, "cash", picks, missing, CASH_COLUMNS, constants={"capex": 0})


def statements_from_sheets(income_long: DataFrame, balance_long: DataFrame, cash_long: DataFrame, derived_long: DataFrame,
                           picks: dict[str, dict[str, str]] | None = None, missing: str = "error") -> DataFrame:
    """All four sheets -> ``financial_statements`` in one pass.

    The sheets are tagged and put together, dealt by ticker once, and the
    null-drop windows, the one aggregate over all 17 columns and the check
    for missing metrics all reuse that: one shuffle.  A period stays if each
    of the three sheets has a cell in it, as their inner joins keep it.
    ``picks``: the derived-sheet titles per sheet (``DERIVED_PICKS``).
    """
    picks = picks or DERIVED_PICKS
    tagged = [long.select("ticker", F.lit(s).alias("sheet"), "Metrics", "fiscal_period", "value", F.lit(False).alias("derived"))
              for s, long in (("income", income_long), ("balance", balance_long), ("cash", cash_long))]
    chosen = F.array(*[F.struct(F.lit(s).alias("sheet"), F.lit(t).alias("title"), F.lit(n).alias("label")) for s, p in picks.items() for t, n in p.items()])
    rows = derived_long.withColumn("p", F.explode(F.filter(chosen, lambda p: p["title"] == F.col("Metrics"))))
    tagged.append(rows.select("ticker", F.col("p.sheet").alias("sheet"), F.col("p.label").alias("Metrics"), "fiscal_period", "value", F.lit(True).alias("derived")))
    long = by_ticker(append_by_name(*tagged))
    kept = long.withColumn("full", complete_metric(["sheet", "derived"])).where("derived or full")
    titled = F.lit(False)
    label = F.lit(None).cast("string")
    for sheet, (patterns, renames, _) in READERS.items():
        here = F.col("sheet") == sheet
        titled = titled | (here & F.coalesce(F.col("Metrics").rlike("(?i)" + "|".join(patterns)), F.lit(False)))
        names = F.create_map(*[F.lit(x) for kv in renames.items() for x in kv])
        label = F.when(here, F.coalesce(names[F.col("Metrics")], F.col("Metrics"))).otherwise(label)
    cells = reported_cells(kept).where(titled).withColumn("column", label)
    columns = [c for _, _, own in READERS.values() for c in own]
    present = [F.max(F.col("sheet") == s).alias(f"has_{s}") for s in READERS]
    wide = cells.groupBy("ticker", "fiscal_period").agg(*metric_columns(columns, F.col("column")), *present)
    if missing == "error":
        wide = require_metrics(wide, columns)
    wide = wide.where(" and ".join(f"has_{s}" for s in READERS)).withColumns({c: to_store(c) for c in columns})
    return with_capex(wide.withColumn("period_type", period_type("fiscal_period"))).select(*FINANCIAL_STATEMENTS.fieldNames())


def join_income_balance(income: DataFrame, balance: DataFrame) -> DataFrame:
    """Inner equi-join on (fiscal_period, ticker)."""
    return income.join(balance, ["fiscal_period", "ticker"], "inner")


def with_capex(df: DataFrame) -> DataFrame:
    """``capex = operating_cash_flow - free_cash_flow`` (P11), stored DECIMAL(10,4)."""
    return df.withColumn("capex", to_store(F.col("operating_cash_flow") - F.col("free_cash_flow")))


def financial_statements(income: DataFrame, balance: DataFrame, cash: DataFrame) -> DataFrame:
    """Income x balance x cash (J1, J2), capex derived (P11), DDL column order."""
    joined = join_income_balance(income, balance).join(cash.drop("capex"), ["fiscal_period", "ticker"], "inner")
    out = with_capex(joined)
    return out.select(*[c for c in FINANCIAL_STATEMENTS.fieldNames()])


def ordered_statements(statements: DataFrame, name: str = "load_position", materialize: bool = False,
                       years: Sequence[int] | None = None) -> DataFrame:
    """Statements with their load position: ticker, then year, quarter (O1).

    With ``years`` (the reference's list is 2019 to 2024) only these are
    ordered; rows of other years come after them, as unlisted categories do.

    The reference sorts the whole frame before the insert so the SERIAL
    ids follow that order; here the position is computed per ticker plus
    an offset (no global sort), and callers sort only if they must.
    """
    year, quarter = period_order("fiscal_period")
    listed = F.when(year.isin([str(y) for y in years]), year).asc_nulls_last() if years else year
    order = [listed, quarter]
    return sequential_position(statements, "ticker", ["ticker"],
                               [*order, F.col("fiscal_period")], name=name,
                               materialize=materialize)


def conform_statements(df: DataFrame) -> DataFrame:
    """Cast to the declared statement schema."""
    return conform(df, FINANCIAL_STATEMENTS)
