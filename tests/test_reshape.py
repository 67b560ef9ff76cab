"""Wide sheets -> tidy statements: null dropping, derived rows, round trip, file scan."""

from decimal import Decimal

import pytest

from quarterline.operators import reshape, statements
from quarterline.sources.wide import read_wide_sheets

PERIODS = ["Q1 2020", "Q2 2020", "Q3 2020"]


def wide(spark, rows, periods=PERIODS):
    cols = ", ".join(f"`{p}` double" for p in periods)
    return spark.createDataFrame(rows, f"ticker string, `Unnamed: 0` string, {cols}")


def income_sheet(spark):
    return wide(spark, [
        ("AAA", "Revenue", 10.0, 11.0, 12.0),
        ("AAA", "Cost of revenue", 5.0, 5.0, 5.0),
        ("AAA", "Gross Profit", 5.0, 6.0, 7.0),
        ("AAA", "Operating Expenses", 1.0, 1.0, 1.0),
        ("AAA", "Operating Income (Loss)", 4.0, 5.0, None),   # null in one period: metric dropped
        ("AAA", "Net Income", 3.0, 4.0, 5.0),
        ("AAA", "Revenue Growth", 0.1, 0.1, 0.1),            # matches the filter, not mapped
        ("AAA", "Shares", 7.0, 7.0, 7.0),                    # does not match the filter
    ])


def derived_sheet(spark):
    return wide(spark, [("AAA", "EPS (Diluted)", 0.1, None, 0.3), ("AAA", "Free Cash Flow", 1.0, 1.0, 1.0),
                        ("AAA", "Total Debt", 2.0, 2.0, 2.0)])


def test_scan_names_metric_column_and_keeps_null_cells(spark):
    long = reshape.scan_wide(income_sheet(spark))
    assert long.columns == ["ticker", "Metrics", "fiscal_period", "value"]
    assert long.count() == 8 * 3
    assert long.where("value is null").count() == 1


def test_income_reader(spark):
    with pytest.raises(Exception, match="no metric operating_income for AAA"):
        statements.income_statement(reshape.scan_wide(income_sheet(spark)), reshape.scan_wide(derived_sheet(spark))).collect()
    inc = statements.income_statement(reshape.scan_wide(income_sheet(spark)), reshape.scan_wide(derived_sheet(spark)), missing="null")
    rows = {r.fiscal_period: r for r in inc.collect()}
    assert inc.columns == ["ticker", "fiscal_period", "period_type", *statements.INCOME_COLUMNS]
    assert set(rows) == set(PERIODS)
    assert all(r.operating_income is None for r in rows.values())     # dropped metric -> NULL column
    assert rows["Q2 2020"].eps is None                                  # derived null kept as NULL
    assert rows["Q3 2020"].eps == Decimal("0.3000")
    assert rows["Q1 2020"].period_type == "Q1"


def test_regex_filter_is_substring_case_insensitive(spark):
    long = reshape.scan_wide(income_sheet(spark))
    kept = {r.Metrics for r in reshape.metric_regex_filter(long, ["revenue"]).collect()}
    assert kept == {"Revenue", "Cost of revenue", "Revenue Growth"}


def test_append_by_name_fills_missing(spark):
    a = spark.createDataFrame([("x", 1)], "k string, v int")
    b = spark.createDataFrame([("y", "extra")], "k string, w string")
    rows = sorted(reshape.append_by_name(a, b).collect(), key=lambda r: r.k)
    assert (rows[0].v, rows[0].w, rows[1].v, rows[1].w) == (1, None, None, "extra")


def test_dropna_uses_each_tickers_own_periods(spark):
    # BBB does not report Q3 2020: its empty Q3 cells must not drop its metrics.
    sheet = wide(spark, [("AAA", "Revenue", 1.0, 2.0, 3.0), ("BBB", "Revenue", 1.0, 2.0, None),
                         ("BBB", "Net Income", 1.0, None, None)])
    kept = reshape.dropna_any(reshape.scan_wide(sheet))
    assert {(r.ticker, r.Metrics) for r in kept.collect()} == {("AAA", "Revenue"), ("BBB", "Revenue")}


def test_read_wide_sheets_from_files(spark, tmp_path):
    # One parquet file per company with its own period columns; ticker from the file name.
    wide(spark, [(None, "Revenue", 1.0, 2.0, 3.0)]).drop("ticker").write.parquet(str(tmp_path / "AAA_PL.parquet"))
    wide(spark, [(None, "Revenue", 5.0, 6.0)], ["Q2 2020", "Q3 2020"]).drop("ticker").write.parquet(
        str(tmp_path / "BBB_PL.parquet"))
    long = read_wide_sheets(spark, str(tmp_path / "*_PL.parquet"), ticker_from="path")
    got = {(r.ticker, r.fiscal_period): r.value for r in long.where("value is not null").collect()}
    assert got[("AAA", "Q1 2020")] == Decimal("1.0000")
    assert got[("BBB", "Q3 2020")] == Decimal("6.0000")
    assert ("BBB", "Q1 2020") not in got


def test_statements_round_trip(spark, sf_small):
    from quarterline.plans.queries import tidy_statements
    from quarterline.sources import fixtures as fx
    from quarterline.schemas import FINANCIAL_STATEMENTS

    from quarterline.plans.queries import sheet_of
    built = statements.statements_from_sheets(*[sheet_of(spark, sf_small, s) for s in ("income", "balance", "cash", "derived")])
    joined = statements.financial_statements(*tidy_statements(spark, sf_small))
    assert built.exceptAll(joined).count() == 0 and joined.exceptAll(built).count() == 0
    expected = statements.with_capex(fx.financial_statements(spark, sf_small)).select(*FINANCIAL_STATEMENTS.fieldNames())
    assert built.count() == expected.count() == 280
    assert built.exceptAll(expected).count() == 0 and expected.exceptAll(built).count() == 0


def test_read_wide_sheets_from_csv(spark, tmp_path):
    (tmp_path / "AAA_PL.csv").write_text(",Q1 2020,Q2 2020\nRevenue,10.5,11\nNet Income,1,n/a\n")
    (tmp_path / "BBB_PL.csv").write_text(",Q1 2020,Q2 2020\nRevenue,7,8.25\nNet Income,2,3\n")
    long = read_wide_sheets(spark, str(tmp_path / "*_PL.csv"), fmt="csv", ticker_from="path")
    got = {(r.ticker, r.Metrics, r.fiscal_period): r.value for r in long.collect()}
    assert got[("AAA", "Revenue", "Q1 2020")] == Decimal("10.5000")
    assert got[("BBB", "Revenue", "Q2 2020")] == Decimal("8.2500")
    assert got[("AAA", "Net Income", "Q2 2020")] is None          # an empty cell's text
    kept = {(r.ticker, r.Metrics) for r in reshape.dropna_any(long).collect()}
    assert ("AAA", "Net Income") not in kept and ("BBB", "Net Income") in kept


def test_csv_sheets_by_their_own_headers(spark, tmp_path):
    (tmp_path / "AAA_PL.csv").write_text('"Unnamed: 0",Q1 2020,Q2 2020\nRevenue,10,11.5\n"Cost, all",1,\n')
    (tmp_path / "BBB_PL.csv").write_text("Q3 2020,,Q2 2020\r\n9,Revenue,8\r\n")
    got = {(r.ticker, r.Metrics, r.fiscal_period): r.value for r in read_wide_sheets(spark, str(tmp_path / "*_PL.csv"), "csv", "path").collect()}
    assert got == {("AAA", "Revenue", "Q1 2020"): Decimal(10), ("AAA", "Revenue", "Q2 2020"): Decimal("11.5"), ("AAA", "Cost, all", "Q1 2020"): Decimal(1),
                   ("AAA", "Cost, all", "Q2 2020"): None, ("BBB", "Revenue", "Q3 2020"): Decimal(9), ("BBB", "Revenue", "Q2 2020"): Decimal(8)}
    (tmp_path / "all_x.csv").write_text("ticker,Metrics,Q1 2020\nAAA,Revenue,1\nBBB,Revenue,2\n")
    rows = read_wide_sheets(spark, str(tmp_path / "all_x.csv"), "csv").collect()
    assert sorted((r.ticker, r.Metrics, r.fiscal_period, r.value) for r in rows) == [("AAA", "Revenue", "Q1 2020", 1), ("BBB", "Revenue", "Q1 2020", 2)]


def test_large_and_bad_cells_are_not_lost(spark):
    sheet = wide(spark, [("AAA", "Total Assets", 900000.0, 1100000.0, 1200000.0)])
    kept = reshape.dropna_any(reshape.scan_wide(sheet))
    assert kept.count() == 3  # read in full
    with pytest.raises(Exception, match="does not fit"):
        reshape.transpose_statement(kept, {"Total Assets": "total_assets"}, ["total_assets"]).collect()
    text = spark.createDataFrame([("AAA", "Revenue", "12", "abc")], "ticker string, Metrics string, `Q1 2020` string, `Q2 2020` string")
    with pytest.raises(Exception, match="no number: abc"):
        reshape.scan_wide(text).collect()


def test_two_rows_of_one_title_raise(spark):
    sheet = wide(spark, [("AAA", "Revenue", 1.0, 2.0, 3.0), ("AAA", "Revenue", 1.0, 2.0, 4.0)])
    with pytest.raises(Exception, match="two rows titled Revenue"):
        reshape.dropna_any(reshape.scan_wide(sheet)).collect()
