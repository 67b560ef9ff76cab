import os

import pytest
from pyspark.sql import functions as F

from quarterline.sources import checked_load, store

from helpers import statement_row, statements


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# ---------------------------------------------------------------- snapshots
def test_a_reload_that_dies_leaves_the_old_snapshot(spark, tmp_path):
    root = str(tmp_path / "t")
    assert store.publish(spark.range(5), root) == 1
    broken = spark.range(100).repartition(4).withColumn("id", F.when(F.col("id") == 77, F.raise_error(F.lit("died")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="died"):
        store.publish(broken, root)
    assert store.versions(spark, root) == [1] and rows(store.current(spark, root)) == [(i,) for i in range(5)]
    assert store.publish(store.current(spark, root).where("id > 1"), root) > 1  # it may read itself
    assert rows(store.current(spark, root)) == [(2,), (3,), (4,)] and store.current(spark, root, 1).count() == 5


def test_readers_keep_their_snapshot(spark, tmp_path):
    root = str(tmp_path / "t")
    store.publish(spark.range(3), root)
    before = store.current(spark, root)
    store.append_snapshot(spark.range(10, 12), root)
    assert before.count() == 3 and store.current(spark, root).count() == 5
    with pytest.raises(ValueError, match="no version"):
        store.current(spark, str(tmp_path / "none"))


def test_one_of_two_loads_at_once_fails(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    store.publish(spark.range(3), root)
    monkeypatch.setattr(store, "_numbers", lambda *_: [])  # it has not seen the other's folder
    with pytest.raises(Exception, match="(?i)exists"):
        store.publish(spark.range(4), root)


# ---------------------------------------------------------------- updates
@pytest.fixture
def by_year(spark, tmp_path):
    path = str(tmp_path / "f")
    data = [(y, t, f"Q{q} {y}", 1.0 * q, "x") for y in (2000, 2001, 2002) for t in ("A", "B") for q in (1, 2)] + [(None, "C", "Q1", 9.0, "x")]
    spark.createDataFrame(data, "year int, ticker string, fiscal_period string, v double, s string").write.partitionBy("year").parquet(path)
    return path


def test_update_touches_only_partitions_with_changed_keys(spark, by_year):
    before, old = files(by_year), rows(spark.read.parquet(by_year))
    changes = spark.createDataFrame(
        [(2001, "A", "Q1 2001", 5.0, None), (2001, "A", "Q1 2001", 7.0, "z"), (2002, "A", "Q9 2002", 1.0, "no such key"), (None, "C", "Q1", 0.0, "no")],
        "year int, ticker string, fiscal_period string, v double, s string")
    assert store.update_stored(by_year, changes, ["ticker", "fiscal_period"], ["v", "s"], "year") == 1
    after = files(by_year)
    assert {p for p in before if "year=2001" not in p} == {p for p in after if "year=2001" not in p}
    assert all(after[p] == before[p] for p in before if "year=2001" not in p) and not {p for p in before if "year=2001" in p} & after.keys()
    want = [r if r[:2] != ("A", "Q1 2001") else ("A", "Q1 2001", 5.0, None, 2001) for r in old]
    assert rows(spark.read.parquet(by_year)) == sorted(want, key=str)


def test_update_works_its_changes_out_once(spark, by_year):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def value(v):
        seen.add(1)
        return v

    changes = spark.createDataFrame([(2001, "A", "Q1 2001", 5.0), (2002, "B", "Q2 2002", 6.0)], "year int, ticker string, fiscal_period string, v double")
    assert store.update_stored(by_year, changes.withColumn("v", value.asNondeterministic()("v")), ["ticker", "fiscal_period"], ["v"], "year") == 2
    assert seen.value == 2
    assert sorted(r.v for r in spark.read.parquet(by_year).where("v in (5, 6)").collect()) == [5.0, 6.0]


def test_update_without_changes_and_clearing(spark, by_year):
    before = files(by_year)
    none = spark.createDataFrame([], "year int, ticker string, fiscal_period string, v double")
    assert store.update_stored(by_year, none, ["ticker", "fiscal_period"], ["v"], "year") == 0 and files(by_year) == before
    store.clear_partitions(spark, by_year, "year", [2000])
    assert {r[0] for r in spark.read.parquet(by_year).select("year").distinct().collect()} == {2001, 2002, None}


# ---------------------------------------------------------------- inserts
def test_insert_if_absent_into_a_stored_dimension(spark, tmp_path):
    path = str(tmp_path / "c")
    store.create_keyed(spark.createDataFrame([("A", "a", 1), ("B", "b", 2), (None, "n", 3)], "ticker string, name string, cap long"), path, buckets=4)
    before = files(path)
    seed = spark.createDataFrame([("B", "new b"), ("C", "c2"), ("C", "c1"), (None, "x")], "ticker string, name string")
    for _ in range(2):  # the second seed finds all there
        store.insert_new(spark, path, seed, buckets=4)
    assert rows(store.keyed(spark, path)) == [("A", "a", 1), ("B", "b", 2), ("C", "c1", None)]
    assert before.items() <= files(path).items()
    store.insert_new(spark, path, seed.limit(0), buckets=4)
    assert store.keyed(spark, path).count() == 3


# ---------------------------------------------------------------- checked load
def test_checked_load_in_one_scan(spark, tmp_path):
    good = [statement_row("A", f"Q{q} 2020") for q in (1, 2, 3)]
    bad = [statement_row("A", "Q1 2021", revenue=0), statement_row("A", "Q5 2021"), statement_row("Z", "Q1 2020"), statement_row(None, "Q1 2020"), statement_row("A", "Q4 2020", total_assets=100),
           statement_row("B", "Q1 2020"), statement_row("B", "Q1 2020"), statement_row("B", "Q2 2020 restated")]
    companies = spark.createDataFrame([("A",), ("B",), (None,)], "ticker string")
    path = str(tmp_path / "l")
    found = checked_load.checked_load(statements(spark, good + bad), companies, path)
    want = {("A", "Q1 2021"): "zero denominator", ("A", "Q5 2021"): "bad period,zero denominator", ("Z", "Q1 2020"): "unknown ticker", ("A", "Q4 2020"): "zero denominator",
            ("B", "Q1 2020"): "duplicate key", ("B", "Q2 2020 restated"): "varchar length,bad period"}
    got = {(r["ticker"], r["fiscal_period"]): ",".join(r["rules"]) for r in checked_load.quarantined(spark, path).collect()}
    assert got == want
    assert found == {"rows": 11, "loaded": 4, "duplicate key": 2, "unknown ticker": 1, "varchar length": 1, "decimal range": 0, "bad period": 2, "zero denominator": 3}
    assert checked_load.loaded(spark, path).count() == 4
    again = checked_load.checked_load(statements(spark, good + bad), companies, path, refuse=["unknown ticker"])
    assert again["loaded"] == 10 and again["bad period"] == 2


def test_checked_load_reads_the_source_once(spark, tmp_path, monkeypatch):
    source = str(tmp_path / "s")
    statements(spark, [statement_row("A", "Q1 2020")]).write.parquet(source)
    plan = checked_load.broken_rules(spark.read.parquet(source), spark.createDataFrame([("A",)], "ticker string"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "SinglePartition" not in plan
