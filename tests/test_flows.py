"""Load -> features flow over files written from the driver tables."""

import pytest
from pyspark.sql import functions as F

from quarterline.operators.assemble import features_all
from quarterline.plans.flows import SheetPaths, feature_inputs, feature_stage, load_stage
from quarterline.plans.queries import features_of
from quarterline.session import shared_dir
from quarterline.sources import fixtures as fx
from quarterline.sources.sinks import write_table


@pytest.fixture(scope="module")
def inputs(spark, sf_small):
    base = shared_dir(spark, "test-flow")
    for kind in ("income", "balance", "cash", "derived"):
        # One dataset per sheet kind, ticker as a column, period columns as in the sheets.
        write_table(fx.wide_sheet(spark, sf_small, kind).withColumnRenamed("Metrics", "Unnamed: 0"),
                    f"{base}/sheets/{kind}")
    feed = fx.estimate_feed(spark, sf_small).withColumn("act_symbol", F.col("act_symbol").cast("string"))
    write_table(feed, f"{base}/feed")
    sheets = SheetPaths(*(f"{base}/sheets/{k}" for k in ("income", "balance", "cash", "derived")),
                        ticker_from="column")
    return base, sheets


@pytest.mark.parametrize("buckets", [None, 4])
def test_load_and_feature_flow(spark, sf_small, inputs, buckets):
    base, sheets = inputs
    tables = f"{base}/tables-{buckets}"
    load_stage(spark, sheets, f"{base}/feed", tables, feed_fmt="parquet", window=fx.FIXTURE_WINDOW,
               tie_breakers=fx.FIXTURE_TIE_BREAKERS, buckets=buckets)
    feature_stage(spark, tables, bucketed=bool(buckets))
    got = spark.read.parquet(f"{tables}/features")
    exp = features_of(spark, sf_small).withColumn("ticker", F.col("ticker").cast("string"))
    assert got.count() == exp.count() == 280
    assert got.exceptAll(exp.select(*got.columns)).count() == 0
    assert spark.read.option("header", "true").csv(f"{tables}/findata_csv").count() == 280
    if not buckets:
        from quarterline.plans.flows import model_stage, statements_with_capex

        assert statements_with_capex(spark, tables).where("capex <=> operating_cash_flow - free_cash_flow").count() == 280
        from quarterline.plans.queries import TEST_START, VAL_START, YEAR_SPLITS

        acc = model_stage(spark, tables, YEAR_SPLITS, VAL_START, TEST_START, max_iter=10).collect()
        assert {(r.model, r.split) for r in acc} <= {(m, s) for m in ("row", "sequence") for s in ("val", "test")}
        assert {r.model for r in acc} == {"row", "sequence"}
        assert all(0.0 <= r.accuracy <= 100.0 and r.n > 0 for r in acc)
    if buckets:
        # Windows and join run on the bucket layout: no shuffle, even as a sort-merge join.
        old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            df = features_all(*feature_inputs(spark, tables, bucketed=True))
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and "SortMergeJoin" in plan
            assert df.count() == 280
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
