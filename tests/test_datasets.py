"""Row / sequence datasets and splits."""

from decimal import Decimal

from pyspark.sql import functions as F

from quarterline.operators import datasets
from quarterline.schemas import FEATURE_COLUMNS


def matrix(spark, rows):
    cols = ", ".join(f"{c} decimal(10,4)" for c in FEATURE_COLUMNS)
    return spark.createDataFrame(rows, f"ticker string, fiscal_period string, {cols}, eps_status double, "
                                       "eps_surprise decimal(10,4)")


def mrow(ticker, period, x, label):
    feats = [Decimal(str(x))] * len(FEATURE_COLUMNS)
    feats[2] = None if x == 2 else feats[2]       # a NULL feature in one row
    return (ticker, period, *feats, label, Decimal("1.0"))


def test_sequences(spark):
    ps = ["Q1 2022", "Q2 2022", "Q3 2022", "Q4 2022", "Q1 2023", "Q2 2023"]
    rows = [mrow("AAA", p, i, float(i % 2)) for i, p in enumerate(ps)]
    rows += [mrow("BBB", p, i, 1.0) for i, p in enumerate(ps[:4])]          # 4 rows, k=4: no sequence
    seqs = datasets.sequence_windows(matrix(spark, rows), k=4).orderBy("target_period").collect()
    assert [(s.ticker, s.target_period, s.label) for s in seqs] == [("AAA", "Q1 2023", 0.0), ("AAA", "Q2 2023", 1.0)]
    first = seqs[0].window
    assert [w.qoq_rev for w in first] == [0.0, 1.0, 2.0, 3.0]                # oldest first
    assert first[2].qoq_eps is None                                           # NULL keeps its slot
    flat = datasets.flatten_windows(datasets.sequence_windows(matrix(spark, rows), k=4)).first().seq_features
    assert len(flat) == 4 * len(FEATURE_COLUMNS)


def test_sequence_order_is_numeric_year_quarter(spark):
    ps = ["Q4 2019", "Q1 2020", "Q2 2020", "Q3 2020"]
    rows = [mrow("AAA", p, i, 1.0) for i, p in enumerate(reversed(ps))]
    seq = datasets.sequence_windows(matrix(spark, rows), k=3).collect()
    assert [s.target_period for s in seq] == ["Q3 2020"]


def test_splits(spark):
    rows = [mrow("AAA", p, 1, 1.0) for p in ["Q1 2021", "Q4 2022", "Q2 2023", "Q3 2023", "Q1 2024", "Q1 2020"]]
    m = matrix(spark, rows)
    by_year = {r.fiscal_period: r.split for r in
               datasets.split_by_year(m, {"train": [2021, 2022], "val": [2023], "test": [2024]}).collect()}
    assert by_year == {"Q1 2021": "train", "Q4 2022": "train", "Q2 2023": "val", "Q3 2023": "val", "Q1 2024": "test"}
    seqs = datasets.with_period_parts(m).withColumnRenamed("fiscal_period", "target_period")
    by_target = {r.target_period: r.split for r in datasets.split_by_target(seqs, (2023, 3), (2024, 1)).collect()}
    assert by_target["Q2 2023"] == "train" and by_target["Q3 2023"] == "val" and by_target["Q1 2024"] == "test"


def test_row_dataset_null_policy(spark):
    rows = [mrow("AAA", "Q1 2021", 1, 1.0), mrow("AAA", "Q2 2021", 2, 1.0), mrow("AAA", "Q3 2021", 3, None)]
    m = matrix(spark, rows)
    assert datasets.row_dataset(m).count() == 1
    assert datasets.row_dataset(m, null_policy="keep").count() == 3
    nulls = {r.fiscal_period: r.n_null_features for r in datasets.null_feature_rows(m).collect()}
    assert nulls == {"Q2 2021": 1}
    assert dict(datasets.row_dataset(m).dtypes)["label"] == "double"
    assert datasets.distinct_tickers(m).count() == 1
    assert m.select(F.lit(1)).count() == 3


def test_sequence_increment_reads_the_tail_and_the_new_quarter(spark, tmp_path):
    from quarterline.operators.datasets import sequence_increment, sequence_tail, sequence_windows
    from quarterline.schemas import FEATURE_COLUMNS

    rows = [(t, f"Q{i % 4 + 1} {2018 + i // 4}", *[float(i * 10 + j) for j in range(len(FEATURE_COLUMNS))], float(i % 2), 0.0)
            for t, n in (("A", 12), ("B", 5), ("C", 3)) for i in range(n)] + [(None, "Q1 2019", *[0.0] * len(FEATURE_COLUMNS), 1.0, 0.0)]
    schema = "ticker string, fiscal_period string, " + ", ".join(f"{c} double" for c in FEATURE_COLUMNS) + ", eps_status double, eps_surprise double"
    whole = spark.createDataFrame(rows, schema)
    old, new = whole.where("right(fiscal_period, 4) < '2019'"), whole.where("right(fiscal_period, 4) = '2019'")
    last = whole.where("right(fiscal_period, 4) > '2019'")
    tail, got = sequence_tail(old, 3), [sequence_windows(old, 3)]
    assert tail.groupBy("ticker").count().where("count > 3").isEmpty()
    for part in (new, last):
        tail.write.parquet(str(tmp_path / f"tail{len(got)}"))
        part.write.parquet(str(tmp_path / f"new{len(got)}"))
        more, tail = sequence_increment(spark.read.parquet(str(tmp_path / f"tail{len(got)}")), spark.read.parquet(str(tmp_path / f"new{len(got)}")), 3)
        plan = more._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 2 and "tail" in plan and "Join" not in plan
        got.append(more)
    key = lambda r: (r.ticker, r.target_period)
    assert sorted((r for g in got for r in g.collect()), key=key) == sorted(sequence_windows(whole, 3).collect(), key=key)
    assert sorted(map(tuple, tail.collect())) == sorted(map(tuple, sequence_tail(whole, 3).collect()))


def test_sequence_increment_refuses_quarters_that_are_stored(spark):
    import pytest

    from quarterline.operators.datasets import sequence_increment
    from quarterline.schemas import FEATURE_COLUMNS

    schema = "ticker string, fiscal_period string, " + ", ".join(f"{c} double" for c in FEATURE_COLUMNS) + ", eps_status double, eps_surprise double"
    row = lambda t, p: (t, p, *[0.0] * (len(FEATURE_COLUMNS) + 2))
    tail = spark.createDataFrame([row("A", "Q1 2020"), row("A", "Q2 2020"), row("B", "Q3 2020")], schema)
    for late in ("Q2 2020", "Q4 2019"):
        with pytest.raises(Exception, match="stored already for A"):
            sequence_increment(tail, spark.createDataFrame([row("A", late)], schema), 1)[0].collect()
    assert sequence_increment(tail, spark.createDataFrame([row("A", "Q3 2020"), row("C", "Q1 2019")], schema), 1)[0].count() == 1
