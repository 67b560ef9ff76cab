"""Snapshot feed -> analyst_estimates: window bounds, first snapshot, numbering."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import types as T

from quarterline.operators.estimates import analyst_estimates, first_per_key
from quarterline.operators.quality import bad_periods

FEED = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("act_symbol", T.StringType()),
    T.StructField("period", T.StringType()),
    T.StructField("period_end_date", T.DateType()),
    T.StructField("consensus", T.DecimalType(10, 4)),
    T.StructField("count", T.IntegerType()),
    T.StructField("high", T.DecimalType(10, 4)),
    T.StructField("low", T.DecimalType(10, 4)),
])


def snap(date, sym, end, consensus, period="Current Quarter"):
    c = Decimal(str(consensus))
    return (dt.date.fromisoformat(date), sym, period, dt.date.fromisoformat(end), c, 3, c, c)


def test_bounds_first_snapshot_and_numbering(spark):
    feed = spark.createDataFrame([
        snap("2018-10-01", "AAA", "2018-12-31", 9.0),        # excluded: bound is open
        snap("2019-01-05", "AAA", "2019-03-31", 1.5),
        snap("2019-01-02", "AAA", "2019-03-31", 1.0),        # earliest snapshot wins
        snap("2019-01-02", "AAA", "2019-03-31", 1.0, period="Next Quarter"),
        snap("2019-04-02", "AAA", "2019-06-30", 2.0),
        snap("2024-12-01", "AAA", "2025-01-31", 7.0),        # excluded: bound is open
        snap("2019-04-02", "BBB", "2019-06-30", 3.0),
    ], FEED)
    rows = {(r.ticker, r.fiscal_period): r for r in analyst_estimates(feed).collect()}
    assert set(rows) == {("AAA", "Q1 2019"), ("AAA", "Q2 2019"), ("BBB", "Q1 2019")}
    assert rows[("AAA", "Q1 2019")].consensus_eps == Decimal("1.0000")
    assert rows[("AAA", "Q1 2019")].num_analysts == 3


def test_universe_restriction(spark):
    feed = spark.createDataFrame([snap("2019-01-02", "AAA", "2019-03-31", 1.0),
                                  snap("2019-01-02", "BBB", "2019-03-31", 1.0)], FEED)
    assert [r.ticker for r in analyst_estimates(feed, universe=["BBB"]).collect()] == ["BBB"]


def test_five_period_ends_make_q5(spark):
    ends = ["2020-01-31", "2020-03-31", "2020-06-30", "2020-09-30", "2020-12-31"]
    feed = spark.createDataFrame([snap("2019-12-01", "AAA", e, 1.0) for e in ends], FEED)
    est = analyst_estimates(feed)
    assert sorted(r.fiscal_period for r in est.collect())[-1] == "Q5 2020"
    assert [r.fiscal_period for r in bad_periods(est).collect()] == ["Q5 2020"]


def test_numbering_by_appearance(spark):
    feed = spark.createDataFrame([
        snap("2019-05-01", "AAA", "2019-03-31", 1.0),
        snap("2019-01-01", "AAA", "2019-06-30", 2.0),   # seen first although it ends later
    ], FEED)
    by_end = {r.consensus_eps: r.fiscal_period for r in analyst_estimates(feed).collect()}
    by_seen = {r.consensus_eps: r.fiscal_period for r in analyst_estimates(feed, numbering="appearance").collect()}
    assert by_end == {Decimal("1.0000"): "Q1 2019", Decimal("2.0000"): "Q2 2019"}
    assert by_seen == {Decimal("1.0000"): "Q2 2019", Decimal("2.0000"): "Q1 2019"}


def test_first_per_key_hot_key(spark):
    # One key holds most rows; the aggregate still returns its first row.
    rows = [("hot", i % 97, i) for i in range(5000)] + [("cold", 5, 1)]
    df = spark.createDataFrame(rows, "k string, o int, v int")
    got = {r.k: (r.o, r.v) for r in first_per_key(df, ["k"], ["o", "v"]).collect()}
    assert got == {"hot": (0, 0), "cold": (5, 1)}


def test_same_date_snapshots_tie_break(spark):
    # Same snapshot date and period end: without other tie-breakers the lower consensus wins,
    # whatever the input order, so reruns give the same table.
    rows = [snap("2019-01-02", "AAA", "2019-03-31", 1.2), snap("2019-01-02", "AAA", "2019-03-31", 1.1)]
    for ordered in (rows, rows[::-1]):
        feed = spark.createDataFrame(ordered, FEED).repartition(2)
        got = [r.consensus_eps for r in analyst_estimates(feed).collect()]
        assert got == [Decimal("1.1000")]


def test_csv_feed_scan(spark, tmp_path):
    from quarterline.sources.wide import read_estimate_feed

    csv = tmp_path / "estimate_snapshots.csv"
    csv.write_text(
        "date,act_symbol,period,period_end_date,consensus,recent,count,high,low,year_ago\n"
        "2019-01-02,AAA,Current Quarter,2019-03-31,1.25,1.2,4,1.5,1.0,0.9\n"
        "2019-01-09,AAA,Current Quarter,2019-03-31,1.30,1.3,5,1.6,1.1,0.9\n"
        "2019-01-02,AAA,Next Quarter,2019-06-30,1.40,1.4,4,1.7,1.2,1.0\n"
        "2019-04-01,AAA,Current Quarter,2019-06-30,1.45,1.4,6,1.8,1.3,1.0\n")
    feed = read_estimate_feed(spark, str(csv))
    assert dict(feed.dtypes)["period_end_date"] == "date" and dict(feed.dtypes)["count"] == "int"
    rows = {r.fiscal_period: r for r in analyst_estimates(feed).collect()}
    assert set(rows) == {"Q1 2019", "Q2 2019"}
    assert (rows["Q1 2019"].consensus_eps, rows["Q1 2019"].num_analysts) == (Decimal("1.2500"), 4)
    assert rows["Q2 2019"].consensus_eps == Decimal("1.4500")
