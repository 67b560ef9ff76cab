"""Nothing is lost or guessed: overflow, periods, positions, NULL order, reloads."""

from decimal import Decimal

import pytest
from helpers import estimate_row, estimates, statement_row, statements
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterline.functions.labels import final_label
from quarterline.operators import align, assemble, datasets, quality
from quarterline.operators.estimates import first_per_key, first_snapshot
from quarterline.operators.statements import ordered_statements
from quarterline.plans.flows import bucketed_name
from quarterline.schemas import FINANCIAL_STATEMENTS, conform
from quarterline.session import shared_dir
from quarterline.sources import sinks


def test_conform_raises_on_overflow(spark):
    df = spark.createDataFrame([("AAA", Decimal("1000000"))], "ticker string, revenue decimal(20,4)")
    schema = T.StructType([f for f in FINANCIAL_STATEMENTS.fields if f.name in ("ticker", "revenue")])
    with pytest.raises(Exception, match="does not fit"):
        conform(df, schema).collect()
    assert conform(df, schema, overflow="null").first()["revenue"] is None
    bad = quality.overflow_violations(df, schema, ["ticker"]).collect()
    assert [(r.ticker, r["column"], r.value) for r in bad] == [("AAA", "revenue", 1e6)]
    edge = spark.createDataFrame([("A", Decimal("999999.99994")), ("B", Decimal("999999.99996"))], "ticker string, revenue decimal(20,5)")
    assert [r.ticker for r in quality.overflow_violations(edge, schema, ["ticker"]).collect()] == ["B"]


def test_overflowing_surprise_never_takes_the_text_label(spark):
    s = statements(spark, [statement_row("AAA", "Q1 2020", eps=150)])
    e = estimates(spark, [estimate_row("AAA", "Q1 2020", Decimal("-0.0010"))])
    with pytest.raises(Exception, match="does not fit"):
        assemble.features_all(s, e).collect()
    row = assemble.features_all(s, e, overflow="null").withColumn("label", final_label("eps_status", "eps_surprise")).first()
    assert row["eps_surprise"] is None and row["eps_status"] is None and row["label"] is None


def test_unparsable_period_raises(spark):
    rows = [("AAA", p, *[1.0] * 13, 1.0, 1.0) for p in ("Q1 2020", "Q2 2020", "FY 2020", "Q3 2020")]
    cols = ["ticker", "fiscal_period", *datasets.FEATURE_COLUMNS, "eps_status", "eps_surprise"]
    with pytest.raises(Exception, match="period does not parse: FY 2020"):
        datasets.sequence_windows(spark.createDataFrame(rows, cols), k=2).collect()


def test_positions_with_many_tickers_few_blocks_and_no_exchange_reuse(spark):
    df = spark.range(450_000).select((F.pmod(F.xxhash64("id"), F.lit(300_000))).cast("string").alias("ticker"), F.concat(F.lit("Q1 "), (2000 + F.col("id") % 20).cast("string")).alias("fiscal_period"), "id")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        out = align.sequential_position(df, "ticker", ["ticker"], [F.col("id")], blocks=3)
        got = out.agg(F.countDistinct("position"), F.min("position"), F.max("position"), F.count("*")).first()
        assert tuple(got) == (450_000, 1, 450_000, 450_000)
        assert out.where("position in (1, 450000)").count() == 2
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")


def test_null_tickers_come_last_and_stay(spark):
    df = spark.createDataFrame([(None, "Q1 2020"), ("B", "Q1 2020"), ("A", "Q2 2020"), ("A", "Q1 2020")], "ticker string, fiscal_period string")
    got = {(r.ticker, r.fiscal_period): r.load_position for r in ordered_statements(df).collect()}
    assert got == {("A", "Q1 2020"): 1, ("A", "Q2 2020"): 2, ("B", "Q1 2020"): 3, (None, "Q1 2020"): 4}


def test_years_outside_the_list_load_last(spark):
    df = spark.createDataFrame([("A", "Q1 2018"), ("A", "Q1 2020"), ("A", "Q4 2019")], "ticker string, fiscal_period string")
    got = {r.fiscal_period: r.load_position for r in ordered_statements(df, years=range(2019, 2025)).collect()}
    assert got == {"Q4 2019": 1, "Q1 2020": 2, "Q1 2018": 3}


def test_null_dates_and_values_come_last(spark):
    feed = spark.createDataFrame([("A", "2020-03-31", None, 1.0), ("A", "2020-03-31", "2020-01-02", 2.0), ("B", "2020-03-31", None, 3.0)],
                                 "act_symbol string, period_end_date string, date string, consensus double")
    assert {r.act_symbol: r.consensus for r in first_snapshot(feed).collect()} == {"A": 2.0, "B": 3.0}
    target = spark.createDataFrame([(1,)], "k int")
    source = spark.createDataFrame([(1, None), (1, 7)], "k int, v int")
    assert assemble.update_from(target, source, ["k"], ["v"]).first()["v"] == 7
    assert first_per_key(spark.createDataFrame([(1,), (1,)], "k int"), ["k"], []).count() == 1


def test_foreign_keys_and_seeds_take_nulls_as_sql_does(spark):
    parent = spark.createDataFrame([("A",)], "ticker string")
    child = spark.createDataFrame([("A", 1), ("B", 2), (None, 3)], "ticker string, n int")
    assert [r.n for r in quality.fk_orphans(child, parent).collect()] == [2]
    seed = spark.createDataFrame([(None, "x"), ("B", "second"), ("B", "first")], "ticker string, company_name string")
    existing = spark.createDataFrame([("A", "Alpha")], "ticker string, company_name string")
    got = sorted((r.ticker, r.company_name) for r in sinks.seed_upsert_new(existing, seed).collect())
    assert got == [("A", "Alpha"), ("B", "first")]


def test_doubled_estimates_multiply_nothing(spark):
    s = statements(spark, [statement_row("AAA", "Q1 2020")])
    e = estimates(spark, [estimate_row("AAA", "Q1 2020", 1), estimate_row("AAA", "Q1 2020", 1)])
    assert align.eps_compare_key(s, e).count() == 1


def test_a_later_session_finds_and_overwrites_the_tables(spark, tmp_path):
    path = shared_dir(spark, "tables", tmp_path.name)
    sinks.write_table(spark.range(5), path)
    later = spark.newSession()
    assert shared_dir(later, "tables", tmp_path.name) == path and later.read.parquet(path).count() == 5
    sinks.write_table(later.range(3), path)
    sinks.write_table(later.range(2), path, mode="append")
    assert spark.read.parquet(path).count() == 5
    assert bucketed_name("/a", "x") != bucketed_name("/b", "x") and bucketed_name("/a/", "x") == bucketed_name("/a", "x")
