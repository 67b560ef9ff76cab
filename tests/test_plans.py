"""Physical-plan properties the scale design relies on."""

import datetime as dt
import re
from decimal import Decimal

from pyspark.sql import functions as F

from quarterline.operators.estimates import analyst_estimates, estimate_filter
from quarterline.plans.queries import features_of, sheet_of
from quarterline.operators.reshape import dropna_any
from quarterline.session import shared_dir
from quarterline.sources.fixtures import read_table, statement_base
from quarterline.sources.wide import FEED_SCHEMA, read_estimate_feed


def plan(df) -> str:
    """The text ``df.explain("formatted")`` prints."""
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def shuffles(text: str) -> int:
    return len(re.findall(r"Arguments: (?:hash|range)partitioning", text))


def test_feature_plan_shape(spark, sf_small):
    text = plan(features_of(spark, sf_small))
    assert "SinglePartition" not in text                   # nothing funnels through one task
    assert shuffles(text) <= 4                             # aggregate + ticker exchange per input side
    schemas = [line for line in text.splitlines() if line.startswith("ReadSchema: struct<l_")]
    assert schemas and all("l_partkey" not in s for s in schemas)      # column pruning at the scan


def test_feed_predicates_reach_parquet(spark):
    path = shared_dir(spark, "test-feed-pushdown")
    rows = [(dt.date(2020, 1, 2), "AAA", "Current Quarter", dt.date(2020, 3, 31), Decimal("1.0"), None, 3,
             Decimal("1.0"), Decimal("1.0"), None)]
    spark.createDataFrame(rows, FEED_SCHEMA).write.mode("overwrite").parquet(path)
    feed = read_estimate_feed(spark, path, fmt="parquet")
    text = plan(estimate_filter(feed, universe=["AAA", "BBB"]))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", text).group(1)
    assert "EqualTo(period,Current Quarter)" in pushed
    assert "GreaterThan(period_end_date" in pushed and "LessThan(period_end_date" in pushed
    assert "In(act_symbol" in pushed
    est_plan = plan(analyst_estimates(feed))
    read_schema = [line for line in est_plan.splitlines() if line.startswith("ReadSchema:")][0]
    assert "recent" not in read_schema and "year_ago" not in read_schema   # unused feed columns pruned


def test_dropna_is_one_pass(spark, sf_small):
    text = plan(dropna_any(sheet_of(spark, sf_small, "income")))
    assert "Join" not in text


def test_line_items_are_dealt_by_group_before_they_are_summed(spark, sf_small):
    """A scan task would hold nearly every group of the table: suppliers come in no order."""
    base = statement_base(spark, sf_small)
    tree = base._jdf.queryExecution().executedPlan().toString()
    assert tree.count("Exchange hashpartitioning(ticker") == tree.count("Exchange") == 1
    above, below = tree.split("Exchange")
    assert "HashAggregate" in above and "HashAggregate" not in below
    li = read_table(spark, sf_small, "lineitem").groupBy(F.col("l_suppkey").alias("ticker"), F.year("l_shipdate"), F.quarter("l_shipdate"))
    assert base.count() == li.count().count() and base.agg(F.sum("qty")).first()[0] == read_table(spark, sf_small, "lineitem").agg(F.sum(F.col("l_quantity").cast("decimal(9,2)"))).first()[0]


def test_cells_stay_dealt_over_all_shuffle_partitions(spark, sf_small):
    """Cells are tiny as compressed: put together to a size in bytes they would be millions to a task."""
    from quarterline.operators.statements import INCOME_COLUMNS, INCOME_RENAMES
    from quarterline.operators.reshape import transpose_statement

    sheet = sheet_of(spark, sf_small, "income")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    columns = [c for c in INCOME_COLUMNS if c != "eps"]
    for df in (sheet, dropna_any(sheet), transpose_statement(sheet, INCOME_RENAMES, columns)):
        assert parts > 1 and df.rdd.getNumPartitions() == parts


def test_pivot_shuffles_statements_not_cells(spark, sf_small):
    from quarterline.sources import fixtures as fx

    stored = shared_dir(spark, "plan-statements")
    fx.financial_statements(spark, sf_small).write.mode("overwrite").parquet(stored)
    assert shuffles(plan(fx.wide_sheet(spark, sf_small, "income", ["Q1 1996", "Q2 1996"], spark.read.parquet(stored)))) == 1


def test_sheet_files_lie_in_one_folder(spark, sf_small, tmp_path):
    """A CSV per company with its own header, without a folder for each."""
    from quarterline.sources import fixtures as fx

    out = tmp_path / "sheets"
    fx.sheet_files(spark, sf_small, "cash", str(out))
    texts = [p.read_text().strip().split("\n") for p in out.iterdir() if p.name.startswith("part-")]
    periods = {str(r[0]): sorted(r[1], key=lambda p: (p[-4:], p)) for r in fx.financial_statements(spark, sf_small).groupBy("ticker").agg(F.collect_list("fiscal_period")).collect()}
    assert not [p for p in out.iterdir() if p.is_dir()] and len(texts) == len(periods)
    assert {t[1].split(",")[0]: t[0].split(",") for t in texts} == {k: ["ticker", "", *v] for k, v in periods.items()}


def test_statements_are_built_in_one_shuffle(spark, sf_small):
    """With the sheets stored, all windows, the aggregate and the check share one exchange on the ticker."""
    from quarterline.operators.reshape import scan_wide
    from quarterline.operators.statements import statements_from_sheets
    from quarterline.sources import fixtures as fx

    periods, stored = fx.fiscal_periods(spark, sf_small), []
    for sheet in ("income", "balance", "cash", "derived"):
        path = shared_dir(spark, "plan-sheets", sheet)
        fx.wide_sheet(spark, sf_small, sheet, periods).write.mode("overwrite").parquet(path)
        stored.append(scan_wide(spark.read.parquet(path)))
    text = plan(statements_from_sheets(*stored))
    assert shuffles(text) == 1 and "SinglePartition" not in text
    assert len(re.findall(r"Scan parquet", text.split("\n\n")[0])) <= 5


def test_feature_plan_without_broadcasts(spark, sf_small):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert shuffles(plan(features_of(spark, sf_small))) <= 6
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sql_surface_plans_no_more_shuffles(spark, sf_small):
    from quarterline.plans import sql
    from quarterline.plans.queries import estimates_of, statements_of

    sql.register_tables(spark, {"financial_statements": statements_of(spark, sf_small), "analyst_estimates": estimates_of(spark, sf_small)})
    text = plan(sql.features_sql(spark))
    assert shuffles(text) <= shuffles(plan(features_of(spark, sf_small))) and "SinglePartition" not in text
    assert sql.features_sql(spark).exceptAll(features_of(spark, sf_small)).isEmpty()


def test_clustered_feed_skips_what_a_narrow_universe_does_not_need(spark, sf_small, tmp_path):
    from quarterline.plans.queries import feed_of
    from quarterline.sources.sinks import write_clustered_feed

    path, window = str(tmp_path / "feed"), ("1996-12-31", "1998-01-01")
    feed = feed_of(spark, sf_small).crossJoin(spark.range(200).select((F.col("id") * 1000).alias("shift")))  # many symbols: the pruning shows
    feed = feed.withColumn("act_symbol", F.col("act_symbol") + F.col("shift")).drop("shift")
    write_clustered_feed(feed, path, group_bytes=1 << 16)
    narrow = estimate_filter(spark.read.parquet(path), window, [3, 7001, 123005])
    rows = narrow.collect()
    scan = narrow._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    read = scan.metrics().apply("numOutputRows").value()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, estimate_filter(feed, window, [3, 7001, 123005]).select(*narrow.columns).collect()))
    assert 0 < len(rows) and read < feed.count() / 20
