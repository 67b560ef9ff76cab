"""Named queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables under ``sf_dir`` (through the fixture
derivations in ``sources.fixtures``) and runs over them whole.  Fixture
analogues of the reference's calendar: data spans 1995-2001 instead of
2019-2024, so year splits shift by 24 years (train 1997-1998, val 1999,
test 2000; sequence boundaries Q3 1999 and Q1 2000).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterline.functions.labels import predict_from_logit, sigmoid
from quarterline.functions.numeric import to_store
from quarterline.functions.periods import period_parts, period_type, quarter_text, year_text
from quarterline.operators import assemble, datasets, metrics, models, quality, reshape, statements
from quarterline.operators.align import eps_compare_key, eps_compare_position
from quarterline.operators.estimates import (
    analyst_estimates,
    estimate_filter,
    first_snapshot,
    quarter_number,
    universe_semi,
)
from quarterline.operators.growth import calendar_growth, consensus_growth, lagged, quarter_index, revenue_growth
from quarterline.operators.ratios import ratios
from quarterline.plans import sql
from quarterline.schemas import FEATURE_COLUMNS, FINANCIAL_STATEMENTS, conform
from quarterline.session import scratch_dir
from quarterline.sources import fixtures as fx
from quarterline.sources import checked_load, sinks, store
from quarterline.sources.wide import (
    FEED_SCHEMA,
    MATRIX_SCHEMA,
    feed_violations,
    matrix_violations,
    read_estimate_feed,
    read_matrix,
    read_wide_sheets,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Fixture calendar (see module docstring).
YEAR_SPLITS = {"train": [1997, 1998], "val": [1999], "test": [2000]}
VAL_START, TEST_START = (1999, 3), (2000, 1)
SEQ_LEN = 4
# Fixed linear scorer for the metric keys (weights on features, then bias).
SCORER = {"qoq_eps": 0.05, "yoy_rev": 0.01, "momentum": -0.02}
SCORER_BIAS = 0.3


def query(key: str) -> Callable[[Query], Query]:
    def deco(fn: Query) -> Query:
        QUERIES[key] = fn
        return fn

    return deco


# ---------------------------------------------------------------- inputs
def statements_of(spark: SparkSession, d: str) -> DataFrame:
    return fx.financial_statements(spark, d)


def feed_of(spark: SparkSession, d: str) -> DataFrame:
    return fx.estimate_feed(spark, d)


def estimates_of(spark: SparkSession, d: str, **kw) -> DataFrame:
    return analyst_estimates(feed_of(spark, d), window=fx.FIXTURE_WINDOW, tie_breakers=fx.FIXTURE_TIE_BREAKERS, **kw)


def features_of(spark: SparkSession, d: str, **kw) -> DataFrame:
    return assemble.features_all(statements_of(spark, d), estimates_of(spark, d), **kw)


def matrix_file(spark: SparkSession, d: str) -> DataFrame:
    """The matrix as the data sets read it: from its CSV export."""
    path = _scratch(spark, "findata")
    sinks.export_matrix(matrix_of(spark, d), path)
    return read_matrix(spark, path, one_header=True)


def matrix_of(spark: SparkSession, d: str) -> DataFrame:
    return assemble.feature_matrix(features_of(spark, d))


def sheet_of(spark: SparkSession, d: str, sheet: str) -> DataFrame:
    """Scan of one wide sheet kind for all companies, in tidy long form."""
    return _scanned(fx.wide_sheet(spark, d, sheet, fx.fiscal_periods(spark, d)))


def _scanned(sheet: DataFrame) -> DataFrame:
    return reshape.scan_wide(sheet).withColumn("value", to_store("value"))


def sheets_of(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """All sheet kinds, of statements that are derived from the line items and stored once."""
    path = _scratch(spark, "sheet-statements")
    sinks.write_table(statements_of(spark, d), path)
    stored = spark.read.parquet(path)
    periods = sorted((r[0] for r in stored.select("fiscal_period").distinct().collect()), key=lambda p: (p[-4:], p[:2]))
    return {s: _scanned(fx.wide_sheet(spark, d, s, periods, stored)) for s in fx.SHEETS}


def file_scan(spark: SparkSession, d: str, sheet: str) -> DataFrame:
    """One sheet kind through the reader: a CSV file per company, each with its own header."""
    path = fx.sheet_files(spark, d, sheet, _scratch(spark, f"sheets-{sheet}"))
    return read_wide_sheets(spark, path, "csv").withColumn("value", to_store("value"))


def tidy_statements(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    sheets = sheets_of(spark, d)
    return (
        statements.income_statement(sheets["income"], sheets["derived"]),
        statements.balance_statement(sheets["balance"], sheets["derived"]),
        statements.cash_statement(sheets["cash"], sheets["derived"]),
    )


def scored_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = datasets.row_dataset(datasets.split_by_year(matrix_of(spark, d), YEAR_SPLITS))
    logit = metrics.linear_logit(SCORER, SCORER_BIAS)
    return rows.withColumn("logit", logit).withColumn("prediction", predict_from_logit("logit"))


def sequences_of(spark: SparkSession, d: str) -> DataFrame:
    return datasets.sequence_windows(matrix_of(spark, d), k=SEQ_LEN)


def _scratch(spark: SparkSession, name: str) -> str:
    return scratch_dir(spark, "quarterline-sinks", name)


# ---------------------------------------------------------------- 2.1 sources / sinks
@query("scan_wide_income")
def q_scan_wide_income(spark, d):
    return file_scan(spark, d, "income")


@query("scan_wide_balance")
def q_scan_wide_balance(spark, d):
    return file_scan(spark, d, "balance")


@query("scan_wide_cash")
def q_scan_wide_cash(spark, d):
    return file_scan(spark, d, "cash")


@query("derived_metric_pick")
def q_derived_metric_pick(spark, d):
    picks = {k: v for p in statements.DERIVED_PICKS.values() for k, v in p.items()}
    return reshape.pick_metrics(sheet_of(spark, d, "derived"), picks)


@query("scan_estimates")
def q_scan_estimates(spark, d):
    path = _scratch(spark, "feed")
    none = F.lit(None).cast("decimal(10,4)")
    feed = feed_of(spark, d).withColumns({"recent": none, "year_ago": none})
    feed.select(*FEED_SCHEMA.fieldNames()).write.option("header", "true").csv(path)
    return read_estimate_feed(spark, path).drop("recent", "year_ago")


def _written_raw(rows: DataFrame, orders: dict[int, list[str]], path: str) -> list[str]:
    """Rows of text cells as folders of CSV files, one per column order; cells are written as they are, so one may hold
    a comma. Each file begins with its header; every task writes its own, so files grow in number, not in size."""
    parts = []
    raw = {"header": "true", "sep": "\u0001", "quote": "\u0000", "comment": "\u0002", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    for part, columns in orders.items():
        line = F.array_join(F.array(*[F.coalesce(F.col(c), F.lit("")) for c in columns]), ",")
        rows.where(F.col("part") == part).select(line.alias(",".join(columns))).write.options(**raw).csv(f"{path}/{part}")
        parts.append(f"{path}/{part}")
    return parts


def seeded_feed(spark: SparkSession, d: str) -> list[str]:
    """The feed as CSV files with two column orders and bad cells, chosen by the order's number mod 97."""
    feed, k = feed_of(spark, d), F.col("l_orderkey") % 97
    text = feed.select(
        *[F.col(c).cast("string").alias(c) if c in feed.columns else F.lit(None).cast("string").alias(c) for c in FEED_SCHEMA.fieldNames()],
        "l_orderkey", (F.col("l_orderkey") % 2).alias("part"))
    text = text.withColumns({
        "count": F.when(k == 1, F.concat("count", F.lit(".0"))).when(k == 2, F.concat("count", F.lit(".5"))).otherwise(F.col("count")),
        "consensus": F.when(k == 3, F.lit("oops")).when(k == 4, F.lit("1234567.5")).otherwise(F.col("consensus")),
        "period_end_date": F.when(k.isin(4, 5), F.date_format(F.to_date("period_end_date"), "MM/dd/yyyy")).otherwise(F.col("period_end_date")),
        "high": F.when(k == 6, F.lit("n/a")).otherwise(F.col("high")),
        "period": F.when(k == 7, F.concat("period", F.lit(", late"))).otherwise(F.col("period")),
    })
    names = FEED_SCHEMA.fieldNames()
    return _written_raw(text, {0: names, 1: [*reversed(names)]}, _scratch(spark, "seeded-feed"))


@query("feed_accepted")
def q_feed_accepted(spark, d):
    return read_estimate_feed(spark, seeded_feed(spark, d), on_bad="drop").drop("recent", "year_ago")


@query("feed_violations")
def q_feed_violations(spark, d):
    return feed_violations(spark, seeded_feed(spark, d))


@query("matrix_violations")
def q_matrix_violations(spark, d):
    # Ratios lost to a spreadsheet error in one quarter, and an empty and a missing value, which are none.
    m = matrix_of(spark, d)
    quarter = F.left("fiscal_period", F.lit(2))
    text = m.select(*[F.col(c).cast("string").alias(c) for c in MATRIX_SCHEMA.fieldNames()], F.lit(0).alias("part")).withColumns({
        "roe": F.when(quarter == "Q2", F.lit("#DIV/0!")).when(quarter == "Q3", F.lit("NaN")).otherwise(F.col("roe").cast("string")),
        "cash_ratio": F.when(quarter == "Q2", F.lit("1.2.3")).when(quarter == "Q4", F.lit(None)).otherwise(F.col("cash_ratio").cast("string"))})
    names = MATRIX_SCHEMA.fieldNames()
    path = _written_raw(text, {0: [*names[2:], "ticker", "fiscal_period"]}, _scratch(spark, "seeded-matrix"))
    return matrix_violations(spark, path).select(F.split_part("record", F.lit("|"), F.lit(1)).alias("ticker"), F.split_part("record", F.lit("|"), F.lit(2)).alias("fiscal_period"), "column", "rule", "value")


def _in_two_loads(table: DataFrame, path: str) -> DataFrame:
    """Write some companies, append the others (S10, S11), read all."""
    some = F.pmod(F.xxhash64("ticker"), F.lit(2)) == 0
    sinks.write_table(table.where(some), path)
    sinks.write_table(table.where(~some), path, mode="append")
    return table.sparkSession.read.parquet(path)


@query("sink_statements")
def q_sink_statements(spark, d):
    path = _scratch(spark, "financial_statements")
    table = conform(statements.with_capex(statements_of(spark, d)), FINANCIAL_STATEMENTS)
    return _in_two_loads(table, path)


@query("sink_estimates")
def q_sink_estimates(spark, d):
    path = _scratch(spark, "analyst_estimates")
    return _in_two_loads(estimates_of(spark, d), path)


@query("export_matrix")
def q_export_matrix(spark, d):
    return matrix_file(spark, d)


@query("idempotent_reload")
def q_idempotent_reload(spark, d):
    path = _scratch(spark, "reload")
    table = conform(statements.with_capex(statements_of(spark, d)), FINANCIAL_STATEMENTS)
    sinks.write_table(table, path, mode="overwrite")
    sinks.write_table(table, path, mode="overwrite")
    return spark.read.parquet(path)


@query("snapshot_reload")
def q_snapshot_reload(spark, d):
    # Some companies, the others appended, then all reloaded from what the table itself holds.
    root = _scratch(spark, "snapshots")
    table = conform(statements.with_capex(statements_of(spark, d)), FINANCIAL_STATEMENTS)
    some = F.pmod(F.xxhash64("ticker"), F.lit(2)) == 0
    store.publish(table.where(some), root)
    store.append_snapshot(table.where(~some), root)
    store.publish(store.current(spark, root), root)
    return store.current(spark, root)


@query("seed_stored")
def q_seed_stored(spark, d):
    # Two seeds that overlap with the stored companies and with each other: bare tickers, then named suppliers.
    path = _scratch(spark, "companies")
    store.create_keyed(fx.companies(spark, d), path, buckets=8)
    store.insert_new(spark, path, statements_of(spark, d).where("ticker % 2 = 0").select("ticker").distinct(), buckets=8)
    named = fx.read_table(spark, d, "supplier").select(F.col("s_suppkey").alias("ticker"), F.col("s_name").alias("company_name"))
    store.insert_new(spark, path, named, buckets=8)
    return store.keyed(spark, path)


@query("update_stored")
def q_update_stored(spark, d):
    # Restated second quarters of two years, in a features table stored by year.
    path = _scratch(spark, "features-by-year")
    by_year = year_text("fiscal_period").cast("int")
    # features and restatements both read the estimates, which are derived from the line items and stored once
    stored = _scratch(spark, "estimates")
    sinks.write_table(estimates_of(spark, d), stored)
    estimates = spark.read.parquet(stored)
    features = assemble.features_all(statements_of(spark, d), estimates)
    sinks.write_table(features.withColumn("year", by_year), path, partition_by=["year"])
    restated = estimates.withColumn("year", by_year).where(F.col("year").isin(1998, 1999) & (quarter_text("fiscal_period") == "Q2"))
    restated = restated.select("year", "ticker", "fiscal_period", F.lit("restated").alias("eps_status"), F.col("consensus_eps").alias("eps_surprise"))
    store.update_stored(path, restated, ["ticker", "fiscal_period"], ["eps_status", "eps_surprise"], "year")
    return spark.read.parquet(path)


def _seeded_statements(spark: SparkSession, d: str) -> DataFrame:
    """Statements in wide decimals with repeated rows, odd and long periods, figures beyond the store, zero revenues."""
    s, p = statements_of(spark, d), F.col("fiscal_period")
    wide = s.select("ticker", "fiscal_period", "period_type", *[F.col(c).cast("decimal(28,4)").alias(c) for c in fx.STATEMENT_FORMULAS])
    wide = wide.withColumns({
        "revenue": F.when(p == "Q2 1999", F.lit(0).cast("decimal(28,4)")).otherwise(F.col("revenue")),
        "total_debt": F.when(p == "Q4 1999", F.lit(10**6).cast("decimal(28,4)")).otherwise(F.col("total_debt")),
        "fiscal_period": F.when(p.endswith(" 1997"), F.concat(F.lit("FY "), p)).when(p == "Q3 1998", F.concat(p, F.lit(" (a)"))).otherwise(p)})
    return wide.unionByName(wide.where("fiscal_period = 'Q1 1996'"))


@query("load_report")
def q_load_report(spark, d):
    found = checked_load.checked_load(_seeded_statements(spark, d), fx.companies(spark, d), _scratch(spark, "checked"))
    return spark.createDataFrame(list(found.items()), "rule string, n_rows long")


@query("load_quarantine")
def q_load_quarantine(spark, d):
    path = _scratch(spark, "checked")
    checked_load.checked_load(_seeded_statements(spark, d), fx.companies(spark, d), path)
    return checked_load.quarantined(spark, path).select("ticker", "fiscal_period", F.array_join("rules", ",").alias("rules"))


@query("split_by_year")
def q_split_by_year(spark, d):
    path = _scratch(spark, "splits")
    sinks.write_splits(datasets.split_by_year(matrix_of(spark, d), YEAR_SPLITS), path)
    return spark.read.schema(T.StructType([*MATRIX_SCHEMA.fields, T.StructField("split", T.StringType())])).option("header", "true").csv(path)


@query("seed_upsert_new")
def q_seed_upsert_new(spark, d):
    seed = statements_of(spark, d).select("ticker")
    return sinks.seed_upsert_new(fx.companies(spark, d), seed)


@query("feature_skeleton")
def q_feature_skeleton(spark, d):
    return assemble.feature_skeleton(statements_of(spark, d))


@query("schema_conform")
def q_schema_conform(spark, d):
    return statements.conform_statements(statements.with_capex(statements_of(spark, d)))


# ---------------------------------------------------------------- 2.2 quality
@query("dup_keys")
def q_dup_keys(spark, d):
    return quality.duplicate_keys(feed_of(spark, d), ["act_symbol", "period", "period_end_date"])


@query("fk_orphans")
def q_fk_orphans(spark, d):
    # Some statements name no company at all: those are no orphans.
    s = statements_of(spark, d).withColumn("ticker", F.when(F.col("fiscal_period") != "Q1 1996", F.col("ticker")))
    return quality.fk_orphans(s, fx.companies(spark, d)).select("ticker", "fiscal_period")


@query("domain_violations")
def q_domain_violations(spark, d):
    base = fx.statement_base(spark, d)
    return quality.domain_violations(base, ["ticker", "fiscal_period"],
                                     decimal_columns=["rev", "qty", "tax", "dsc", "ext", "opn", "fa", "fn", "fr"])


@query("overflow_violations")
def q_overflow_violations(spark, d):
    # The same statements in units instead of thousands: many figures do not fit the store.
    s = statements_of(spark, d)
    units = s.select("ticker", "fiscal_period", *[(F.col(c) * 1000).alias(c) for c in fx.STATEMENT_FORMULAS])
    schema = T.StructType([f for f in FINANCIAL_STATEMENTS.fields if f.name in fx.STATEMENT_FORMULAS])
    return quality.overflow_violations(units, schema, ["ticker", "fiscal_period"])


@query("bad_periods")
def q_bad_periods(spark, d):
    s = statements_of(spark, d).select(F.lit("financial_statements").alias("source"), "ticker", "fiscal_period")
    e = estimates_of(spark, d).select(F.lit("analyst_estimates").alias("source"), "ticker", "fiscal_period")
    # Statements of one year under malformed labels, and a year of five quarters among the estimates.
    year = F.right("fiscal_period", F.lit(4))
    s = s.withColumn("fiscal_period", F.when(year == "1997", F.concat(F.lit("FY "), year)).otherwise(F.col("fiscal_period")))
    e = e.withColumn("fiscal_period", F.when(F.col("fiscal_period") == "Q4 1998", F.lit("Q5 1998")).otherwise(F.col("fiscal_period")))
    return quality.bad_periods(s.unionByName(e))


@query("zero_denominators")
def q_zero_denominators(spark, d):
    return quality.zero_denominators(statements_of(spark, d), estimates_of(spark, d))


# ---------------------------------------------------------------- 2.3 reshape
@query("dropna_any")
def q_dropna_any(spark, d):
    return reshape.dropna_any(sheet_of(spark, d, "income"))


@query("append_by_name")
def q_append_by_name(spark, d):
    picked = reshape.pick_metrics(sheet_of(spark, d, "derived"), statements.DERIVED_PICKS["income"])
    return reshape.append_by_name(sheet_of(spark, d, "income"), picked.withColumn("sheet", F.lit("derived")))


@query("transpose_income")
def q_transpose_income(spark, d):
    return tidy_statements(spark, d)[0]


@query("transpose_balance")
def q_transpose_balance(spark, d):
    return tidy_statements(spark, d)[1]


@query("transpose_cash")
def q_transpose_cash(spark, d):
    return tidy_statements(spark, d)[2]


@query("metric_rename")
def q_metric_rename(spark, d):
    return reshape.metric_rename(sheet_of(spark, d, "income"), statements.INCOME_RENAMES)


@query("statement_projection")
def q_statement_projection(spark, d):
    return tidy_statements(spark, d)[0]


@query("statement_projection_missing")
def q_statement_projection_missing(spark, d):
    # Every third company's sheet lacks a metric: NULL by request (an error otherwise), and a column order of the caller's.
    sheet = sheet_of(spark, d, "income").where((F.col("Metrics") != "Operating Expenses") | (F.col("ticker") % 3 != 0))
    columns = [c for c in reversed(statements.INCOME_COLUMNS) if c != "eps"]
    return reshape.transpose_statement(reshape.dropna_any(sheet), statements.INCOME_RENAMES, columns, missing="null")


@query("period_type")
def q_period_type(spark, d):
    return statements_of(spark, d).select("ticker", "fiscal_period", period_type("fiscal_period").alias("period_type"))


@query("period_parts")
def q_period_parts(spark, d):
    year, quarter = period_parts("fiscal_period")
    return statements_of(spark, d).select(
        "ticker", "fiscal_period", year_text("fiscal_period").alias("year_text"),
        quarter_text("fiscal_period").alias("quarter_text"), year.alias("year"), quarter.alias("quarter"),
    )


@query("capex")
def q_capex(spark, d):
    return statements.with_capex(statements_of(spark, d)).select("ticker", "fiscal_period", "capex")


# ---------------------------------------------------------------- 2.4 filters
@query("metric_regex_filter")
def q_metric_regex_filter(spark, d):
    return reshape.metric_regex_filter(sheet_of(spark, d, "income"), statements.INCOME_PATTERNS)


@query("estimate_filter")
def q_estimate_filter(spark, d):
    return estimate_filter(feed_of(spark, d), fx.FIXTURE_WINDOW)


@query("estimate_filter_clustered")
def q_estimate_filter_clustered(spark, d):
    # A narrow universe and window over the stored feed, clustered by symbol and period end.
    path = _scratch(spark, "clustered-feed")
    sinks.write_clustered_feed(feed_of(spark, d), path)
    return estimate_filter(spark.read.parquet(path), ("1996-12-31", "1999-01-01"), [1, 2, 3])


@query("universe_semi")
def q_universe_semi(spark, d):
    return universe_semi(statements_of(spark, d), fx.companies(spark, d)).select("ticker", "fiscal_period")


@query("split_by_target")
def q_split_by_target(spark, d):
    seqs = datasets.split_by_target(sequences_of(spark, d), VAL_START, TEST_START)
    return seqs.select("ticker", "target_period", "label", "split")


# ---------------------------------------------------------------- 2.5 joins
@query("join_income_balance")
def q_join_income_balance(spark, d):
    income, balance, _ = tidy_statements(spark, d)
    return statements.join_income_balance(income, balance)


@query("financial_statements")
def q_financial_statements(spark, d):
    sheets = sheets_of(spark, d)
    return statements.statements_from_sheets(*[sheets[s] for s in ("income", "balance", "cash", "derived")])


@query("eps_compare_key")
def q_eps_compare_key(spark, d):
    return eps_compare_key(statements_of(spark, d), estimates_of(spark, d))


@query("eps_compare_position")
def q_eps_compare_position(spark, d):
    # Inputs are plans over line items here, so they are checkpointed once.
    return eps_compare_position(statements_of(spark, d), estimates_of(spark, d), fx.universe(spark, d),
                                materialize=True)


@query("feature_matrix")
def q_feature_matrix(spark, d):
    return matrix_of(spark, d)


@query("feature_matrix_estimate_keys")
def q_feature_matrix_estimate_keys(spark, d):
    # The reference's RIGHT JOIN keeps keys from the estimate side (NULL when unmatched).
    return assemble.feature_matrix(features_of(spark, d), estimates_of(spark, d), keys_from="estimates")


@query("update_from")
def q_update_from(spark, d):
    feed = feed_of(spark, d).select(
        F.col("act_symbol").alias("ticker"),
        F.concat(F.lit("Q"), F.quarter("period_end_date").cast("string"), F.lit(" "),
                 F.year("period_end_date").cast("string")).alias("fiscal_period"),
        "date", "l_orderkey", "l_linenumber", "consensus", "count",
    )
    skeleton = assemble.feature_skeleton(statements_of(spark, d))
    return assemble.update_from(skeleton, feed, ["ticker", "fiscal_period"], ["consensus", "count"],
                                pick_order=["date", "l_orderkey", "l_linenumber"])


@query("features_all")
def q_features_all(spark, d):
    return features_of(spark, d)


@query("features_sql")
def q_features_sql(spark, d):
    sql.register_tables(spark, {"financial_statements": statements_of(spark, d), "analyst_estimates": estimates_of(spark, d)})
    return sql.features_sql(spark)


@query("matrix_sql")
def q_matrix_sql(spark, d):
    # Over a stored features table, the years as parameters of the statement.
    path = _scratch(spark, "features")
    sinks.write_table(features_of(spark, d), path)
    sql.register_tables(spark, {"features": path})
    return sql.matrix_sql(spark, 1997, 1999)


@query("features_position_aligned")
def q_features_position_aligned(spark, d):
    return features_of(spark, d, alignment="position", universe=fx.universe(spark, d), materialize=True)


# ---------------------------------------------------------------- 2.6 aggregations
@query("distinct_tickers")
def q_distinct_tickers(spark, d):
    return datasets.distinct_tickers(matrix_of(spark, d))


@query("first_snapshot")
def q_first_snapshot(spark, d):
    return first_snapshot(estimate_filter(feed_of(spark, d), fx.FIXTURE_WINDOW), fx.FIXTURE_TIE_BREAKERS)


@query("accuracy_by_split")
def q_accuracy_by_split(spark, d):
    out = metrics.accuracy_by_split(scored_rows(spark, d))
    return out.withColumn("accuracy", F.round("accuracy", 6))


@query("bce_by_split")
def q_bce_by_split(spark, d):
    return metrics.bce_by_split(scored_rows(spark, d)).withColumn("bce", F.round("bce", 6))


# ---------------------------------------------------------------- 2.7 windows
@query("lag_revenue_1")
def q_lag_revenue_1(spark, d):
    return lagged(statements_of(spark, d), "revenue", 1, "prev_revenue").select(
        "ticker", "fiscal_period", "revenue", "prev_revenue")


@query("lag_revenue_4")
def q_lag_revenue_4(spark, d):
    return lagged(statements_of(spark, d), "revenue", 4, "revenue_4_back").select(
        "ticker", "fiscal_period", "revenue", "revenue_4_back")


@query("lag_consensus_1")
def q_lag_consensus_1(spark, d):
    return lagged(estimates_of(spark, d), "consensus_eps", 1, "prev_consensus").select(
        "ticker", "fiscal_period", "consensus_eps", "prev_consensus")


@query("lag_consensus_4")
def q_lag_consensus_4(spark, d):
    return lagged(estimates_of(spark, d), "consensus_eps", 4, "consensus_4_back").select(
        "ticker", "fiscal_period", "consensus_eps", "consensus_4_back")


@query("momentum")
def q_momentum(spark, d):
    return revenue_growth(statements_of(spark, d)).select("ticker", "fiscal_period", "momentum")


@query("growth_calendar")
def q_growth_calendar(spark, d):
    # Every eleventh quarter of each company, in a pattern that differs by company, was never reported.
    s = statements_of(spark, d).where((F.col("ticker") * 7 + quarter_index()) % 11 != 0)
    return calendar_growth(s, "revenue", "rev")


@query("quarter_number")
def q_quarter_number(spark, d):
    firsts = first_snapshot(estimate_filter(feed_of(spark, d), fx.FIXTURE_WINDOW), fx.FIXTURE_TIE_BREAKERS)
    return quarter_number(firsts).select(F.col("act_symbol").alias("ticker"), "period_end_date", "year",
                                         "quarter_num")


@query("quarter_number_appearance")
def q_quarter_number_appearance(spark, d):
    firsts = first_snapshot(estimate_filter(feed_of(spark, d), fx.FIXTURE_WINDOW), fx.FIXTURE_TIE_BREAKERS)
    return quarter_number(firsts, numbering="appearance").select(
        F.col("act_symbol").alias("ticker"), "period_end_date", "year", "quarter_num")


@query("sequence_dataset")
def q_sequence_dataset(spark, d):
    return datasets.explode_windows(datasets.sequence_windows(matrix_file(spark, d), k=SEQ_LEN))


@query("sequence_increment")
def q_sequence_increment(spark, d):
    # Windows up to 1999 are stored with a tail; the year 2000 and then the rest arrive later.
    matrix, year = _stored(matrix_of(spark, d), "matrix"), year_text("fiscal_period")
    old = matrix.where(year < "2000")
    tail, windows = _stored(datasets.sequence_tail(old, SEQ_LEN), "tail"), [_stored(datasets.sequence_windows(old, k=SEQ_LEN), "windows")]
    for new in (matrix.where(year == "2000"), matrix.where(year > "2000")):
        more, tail = datasets.sequence_increment(tail, new, SEQ_LEN)
        windows, tail = [*windows, _stored(more, "windows")], _stored(tail, "tail")
    return datasets.explode_windows(reshape.union_all_by_name(*windows))


# ---------------------------------------------------------------- 2.8 sorts
@query("ordered_statements")
def q_ordered_statements(spark, d):
    keys = statements_of(spark, d).select("ticker", "fiscal_period")
    return statements.ordered_statements(keys, materialize=True)


# ---------------------------------------------------------------- 2.9 set operations
@query("union_all_by_name")
def q_union_all_by_name(spark, d):
    frames = [sheet_of(spark, d, s).withColumn("sheet", F.lit(s)) for s in ("income", "balance", "cash")]
    return reshape.union_all_by_name(*frames)


# ---------------------------------------------------------------- 2.10 scalar functions
@query("quarter_label")
def q_quarter_label(spark, d):
    return estimates_of(spark, d, keep_period_end=True).select("ticker", "period_end_date", "fiscal_period")


@query("eps_status")
def q_eps_status(spark, d):
    return features_of(spark, d).select("ticker", "fiscal_period", "eps_status")


@query("eps_surprise")
def q_eps_surprise(spark, d):
    return features_of(spark, d).select("ticker", "fiscal_period", "eps_surprise")


@query("final_label")
def q_final_label(spark, d):
    return matrix_of(spark, d).select("ticker", "fiscal_period", "eps_status")


@query("predict_from_logit")
def q_predict_from_logit(spark, d):
    rows = scored_rows(spark, d)
    return rows.select("ticker", "fiscal_period", "logit", F.round(sigmoid("logit"), 6).alias("probability"),
                       "prediction")


# ---------------------------------------------------------------- 2.11 domain features
@query("analyst_estimates")
def q_analyst_estimates(spark, d):
    return estimates_of(spark, d)


for _name in ("qoq_rev", "yoy_rev"):
    def _growth(spark, d, _name=_name):
        return revenue_growth(statements_of(spark, d)).select("ticker", "fiscal_period", _name)

    QUERIES[_name] = _growth

for _name in ("qoq_eps", "yoy_eps"):
    def _eps_growth(spark, d, _name=_name):
        skeleton = assemble.feature_skeleton(statements_of(spark, d))
        return assemble.update_from(skeleton, consensus_growth(estimates_of(spark, d)),
                                    ["ticker", "fiscal_period"], [_name])

    QUERIES[_name] = _eps_growth

for _name in ("net_margin", "gross_margin", "oper_margin", "roe", "de_ratio", "current_ratio", "cash_ratio",
              "asset_turn"):
    def _ratio(spark, d, _name=_name):
        return ratios(statements_of(spark, d)).select("ticker", "fiscal_period", _name)

    QUERIES[_name] = _ratio


# ---------------------------------------------------------------- 2.12 datasets and models
@query("row_dataset")
def q_row_dataset(spark, d):
    return datasets.row_dataset(datasets.split_by_year(matrix_file(spark, d), YEAR_SPLITS))


@query("row_dataset_float32")
def q_row_dataset_float32(spark, d):
    rows = datasets.row_dataset(datasets.split_by_year(matrix_of(spark, d), YEAR_SPLITS), dtype="float")
    return rows.select("ticker", "fiscal_period", "split", "label", *FEATURE_COLUMNS)


@query("null_feature_rows")
def q_null_feature_rows(spark, d):
    return datasets.null_feature_rows(matrix_of(spark, d))


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Write a training set once, so that scaling, fitting and scoring read files."""
    path = _scratch(df.sparkSession, name)
    sinks.write_table(df, path)
    return df.sparkSession.read.parquet(path)


def _checked(scored: DataFrame, keys: list[str]) -> DataFrame:
    """Scores as what holds of them whatever the weights: in range, and the class the probability says."""
    p = F.col("probability")
    return scored.select(*keys, p.between(0.0, 1.0).alias("in_range"), (F.col("prediction") == (p > 0.5).cast("double")).alias("consistent"))


@query("mlp_predictions")
def q_mlp_predictions(spark, d):
    rows = _stored(datasets.row_dataset(datasets.split_by_year(matrix_of(spark, d), YEAR_SPLITS)), "rows")
    model = models.fit_row_classifier(rows.where(F.col("split") == "train"), max_iter=100)
    keys = ["ticker", "fiscal_period", "split", "label"]
    return _checked(models.score(model, rows.where(F.col("split") != "train"), keys), keys)


@query("sequence_predictions")
def q_sequence_predictions(spark, d):
    seqs = datasets.split_by_target(sequences_of(spark, d), VAL_START, TEST_START)
    seqs = datasets.flatten_windows(seqs).where(F.col("label").isNotNull())
    seqs = _stored(seqs.where(F.forall("seq_features", lambda x: x.isNotNull())), "sequences")
    model = models.fit_sequence_classifier(seqs.where(F.col("split") == "train"), SEQ_LEN * len(FEATURE_COLUMNS),
                                           max_iter=100)
    keys = ["ticker", "target_period", "split", "label"]
    return _checked(models.score(model, seqs.where(F.col("split") != "train"), keys, sequence=True), keys)


def _stored_models(spark: SparkSession, d: str, max_iter: int = 50) -> dict[str, str]:
    """Both classifiers, fitted on their train split and stored with all their rows."""
    matrix = _stored(matrix_of(spark, d), "matrix")
    rows = datasets.row_dataset(datasets.split_by_year(matrix, YEAR_SPLITS))
    seqs = datasets.split_by_target(datasets.sequence_windows(matrix, k=SEQ_LEN), VAL_START, TEST_START)
    seqs = datasets.flatten_windows(seqs).where(F.col("label").isNotNull())
    seqs = seqs.where(F.forall("seq_features", lambda x: x.isNotNull()))
    paths = {m: _scratch(spark, f"model-{m}") for m in ("row", "sequence")}
    rows, seqs = _stored(rows, "rows"), _stored(seqs, "sequences")
    train = F.col("split") == "train"
    models.store_model(models.fit_row_classifier(rows.where(train), max_iter=max_iter), rows, paths["row"])
    models.store_model(models.fit_sequence_classifier(seqs.where(train), SEQ_LEN * len(FEATURE_COLUMNS), max_iter=max_iter), seqs, paths["sequence"])
    return paths


def _stored_scores(spark: SparkSession, d: str) -> DataFrame:
    """Rows of both stored models, scored by what was read back."""
    out = [models.stored_scores(spark, path, ["split", "label"], m == "sequence").withColumn("model", F.lit(m)) for m, path in _stored_models(spark, d).items()]
    return out[0].unionByName(out[1])


@query("model_splits")
def q_model_splits(spark, d):
    return _stored_scores(spark, d).groupBy("model", "split").agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").cast("long").alias("n_beat"), F.count(F.when(F.col("probability").between(0.0, 1.0), 1)).alias("n_scored"))


@query("model_metrics")
def q_model_metrics(spark, d):
    scored, by = _stored(_stored_scores(spark, d), "scores").withColumn("logit", models.probability_logit()), ["model", "split"]
    floor = scored.groupBy(*by).agg((100 * F.greatest(F.avg("label"), 1 - F.avg("label"))).alias("majority"))
    return metrics.accuracy_by_split(scored, by).join(metrics.bce_by_split(scored, by).drop("n"), by).join(floor, by)


@query("parameter_count")
def q_parameter_count(spark, d):
    from pyspark.ml import PipelineModel

    counts = [(m, models.parameter_count(PipelineModel.load(f"{p}/model"))) for m, p in _stored_models(spark, d, 1).items()]
    return spark.createDataFrame(counts, "model string, parameters int")
