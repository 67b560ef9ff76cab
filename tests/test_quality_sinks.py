"""Constraint checks on seeded bad rows, and idempotent sinks."""

from decimal import Decimal

from helpers import estimate_row, estimates, statement_row, statements

from quarterline.operators import quality
from quarterline.session import shared_dir
from quarterline.sources import sinks


def test_quality_checks(spark):
    fs = statements(spark, [statement_row("AAA", "Q1 2020"), statement_row("AAA", "Q1 2020"),
                            statement_row("TOOLONGTICKER", "Q1 2020", revenue=0, current_liabilities=0),
                            statement_row("BBB", "Q1 2020")])
    est = estimates(spark, [estimate_row("AAA", "Q1 2020", 0)])
    assert [(r.ticker, r.n_rows) for r in quality.duplicate_keys(fs, ["ticker", "fiscal_period"]).collect()] == [
        ("AAA", 2)]
    parents = spark.createDataFrame([("AAA",)], "ticker string")
    assert {r.ticker for r in quality.fk_orphans(fs, parents).collect()} == {"TOOLONGTICKER", "BBB"}
    wide = fs.selectExpr("ticker", "fiscal_period",
                         "cast(revenue as decimal(20,4)) * case when ticker = 'BBB' then 100000 else 1 end revenue")
    viol = {(r.ticker, r.column, r.rule) for r in
            quality.domain_violations(wide, ["ticker", "fiscal_period"], decimal_columns=["revenue"]).collect()}
    assert viol == {("TOOLONGTICKER", "ticker", "length>10"), ("BBB", "revenue", "decimal(10,4) range")}
    zeros = {(r.ticker, r.denominator) for r in quality.zero_denominators(fs, est).collect()}
    assert ("TOOLONGTICKER", "revenue") in zeros and ("TOOLONGTICKER", "current_liabilities") in zeros
    assert ("AAA", "consensus_eps") in zeros


def test_reload_twice_equals_once(spark):
    path = shared_dir(spark, "test-reload")
    df = statements(spark, [statement_row("AAA", "Q1 2020"), statement_row("BBB", "Q1 2020")])
    sinks.write_table(df, path)
    sinks.write_table(df, path)
    assert spark.read.parquet(path).count() == 2
    sinks.write_table(df, path, mode="append")
    assert spark.read.parquet(path).count() == 4          # the reference's append behaviour


def test_export_order_and_splits(spark):
    from quarterline.sources.wide import read_matrix
    from quarterline.schemas import FEATURE_COLUMNS

    cols = ", ".join(f"{c} double" for c in FEATURE_COLUMNS)
    rows = [(t, p, *([1.0] * len(FEATURE_COLUMNS)), 1.0, 1.0)
            for t, p in [("BBB", "Q1 2020"), (None, None), ("AAA", "Q2 2021"), ("AAA", "Q1 2021")]]
    m = spark.createDataFrame(rows, f"ticker string, fiscal_period string, {cols}, eps_status double, "
                                    "eps_surprise double")
    path = shared_dir(spark, "test-export")
    sinks.export_matrix(m, path)
    back = spark.read.option("header", "true").csv(path).collect()
    assert [(r.ticker, r.fiscal_period) for r in back] == [("AAA", "Q1 2021"), ("AAA", "Q2 2021"),
                                                           ("BBB", "Q1 2020"), (None, None)]
    assert read_matrix(spark, path).count() == 4
    split_path = shared_dir(spark, "test-splits")
    sinks.write_splits(m.where("ticker is not null").selectExpr("*", "'train' as split"), split_path)
    assert spark.read.option("header", "true").csv(split_path).where("split = 'train'").count() == 3


def test_seed_upsert(spark):
    existing = spark.createDataFrame([("AAA", "Alpha")], "ticker string, company_name string")
    seed = spark.createDataFrame([("AAA",), ("BBB",), ("BBB",)], "ticker string")
    got = {r.ticker: r.company_name for r in sinks.seed_upsert_new(existing, seed).collect()}
    assert got == {"AAA": "Alpha", "BBB": None}
    assert Decimal("1") == Decimal("1.0")


def test_shared_dir_uses_session_checkpoint_dir(spark):
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    path = shared_dir(spark, "x", "y")
    assert base and path == base.rstrip("/") + "/x/y" == shared_dir(spark, "x", "y")
