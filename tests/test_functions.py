from decimal import Decimal

import pytest

from pyspark.sql import functions as F

from quarterline.functions import (
    beat_miss,
    final_label,
    pct_change,
    period_parts,
    period_type,
    predict_from_logit,
    quarter_label,
    ratio,
    to_store,
)


def test_period_helpers(spark):
    df = spark.createDataFrame([("Q1 2023",), ("Q4 2019",), ("Q5 2020",), ("FY 2020",), (None,)], "p string")
    year, quarter = period_parts("p")
    rows = df.select("p", period_type("p").alias("t"), year.alias("y"), quarter.alias("q"),
                     period_parts("p", years=(2019, 2023))[0].alias("y_in")).collect()
    got = {r.p: (r.t, r.y, r.q, r.y_in) for r in rows}
    assert got["Q1 2023"] == ("Q1", 2023, 1, 2023)
    assert got["Q4 2019"] == ("Q4", 2019, 4, 2019)
    assert got["Q5 2020"] == (None, 2020, 5, 2020)
    assert got["FY 2020"] == (None, 2020, None, 2020)
    assert got[None] == (None, None, None, None)


def test_quarter_label(spark):
    df = spark.createDataFrame([(3, 2024)], "n int, y int")
    assert df.select(quarter_label("n", "y").alias("l")).first().l == "Q3 2024"


def test_division_rules(spark):
    df = spark.createDataFrame(
        [(Decimal("110.0000"), Decimal("100.0000")), (Decimal("5.0000"), Decimal("0.0000")),
         (Decimal("999999.0000"), Decimal("0.0010")), (Decimal("1.0000"), Decimal("3.0000"))],
        "a decimal(10,4), b decimal(10,4)")
    rows = df.select(to_store(pct_change("a", "b"), "null").alias("g"), to_store(ratio("a", "b"), "null").alias("r")).collect()
    assert rows[0].g == Decimal("10.0000") and rows[0].r == Decimal("1.1000")
    assert rows[1].g is None and rows[1].r is None          # zero denominator -> NULL
    assert rows[2].g is None and rows[2].r is None          # does not fit DECIMAL(10,4): NULL if opted in
    with pytest.raises(Exception, match="does not fit"):
        df.select(to_store(ratio("a", "b")).alias("r")).collect()
    assert rows[3].r == Decimal("0.3333")                   # half-up rounding on store


def test_beat_miss_and_final_label(spark):
    df = spark.createDataFrame(
        [(1.0, 0.5, True), (0.5, 0.5, True), (None, 0.5, True), (1.0, None, True), (1.0, 0.5, False)],
        "eps double, c double, m boolean")
    got = [r.s for r in df.select(beat_miss("eps", "c", F.col("m")).alias("s")).collect()]
    assert got == ["beat", "miss", "miss", "miss", None]

    lab = spark.createDataFrame(
        [("miss", 2.0), ("beat", -1.0), ("beat", 0.0), ("miss", 0.0), ("miss", None), (None, None), ("1.0", None)],
        "st string, s double")
    assert [r.y for r in lab.select(final_label("st", "s").alias("y")).collect()] == [1.0, 0.0, 1.0, 0.0, 0.0, None, 1.0]


def test_predict_half_to_even(spark):
    df = spark.createDataFrame([(0.0,), (0.0001,), (-0.0001,), (5.0,)], "z double")
    assert [r.p for r in df.select(predict_from_logit("z").alias("p")).collect()] == [0.0, 1.0, 0.0, 1.0]
