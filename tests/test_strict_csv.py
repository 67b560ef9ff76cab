import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from quarterline.sources.strict_csv import read_csv, violations
from quarterline.sources.wide import FEED_SCHEMA, feed_violations, read_estimate_feed, read_matrix

HEADER = "date,act_symbol,period,period_end_date,consensus,recent,count,high,low,year_ago"


def put(folder, name, *lines):
    (folder / name).write_text("\n".join(lines) + "\n")


def good(symbol="A", count="3"):
    return f"2020-01-02,{symbol},Current Quarter,2020-03-31,1.25,,{count},1.5,1.0,"


def test_a_count_written_as_a_float_and_empty_cells(spark, tmp_path):
    put(tmp_path, "a.csv", HEADER, good(count="3.0"), good("B", "n/a"), "2020-01-02 00:00:00,C,,2020-3-1, 2.00005 ,NaN,,-1e2,,")
    rows = {r["act_symbol"]: r for r in read_estimate_feed(spark, str(tmp_path)).collect()}
    assert rows["A"]["count"] == 3 and rows["B"]["count"] is None and rows["A"]["recent"] is None
    assert rows["C"]["consensus"] == Decimal("2.0001") and rows["C"]["high"] == Decimal(-100) and rows["C"]["period_end_date"] == dt.date(2020, 3, 1)
    assert feed_violations(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("column,text,rule", [
    ("count", "3.5", "whole number"), ("count", "three", "number"), ("count", "3000000000", "int"), ("consensus", "oops", "number"), ("consensus", "1234567.5", "decimal(10,4)"),
    ("period_end_date", "03/31/2020", "date"), ("period_end_date", "2020", "date"), ("date", "2020-13-01", "date"), ("high", "1,5", "cells"),
])
def test_bad_cells_raise_or_are_reported(spark, tmp_path, column, text, rule):
    cells = dict(zip(HEADER.split(","), good().split(",")))
    cells[column] = text
    line = ",".join(cells.values())
    put(tmp_path, "a.csv", HEADER, good("B"), line)
    with pytest.raises(Exception, match="too many or too few" if rule == "cells" else f"column {column}"):
        read_estimate_feed(spark, str(tmp_path)).collect()
    said = [tuple(r) for r in feed_violations(spark, str(tmp_path)).collect()]
    assert said == ([(None, None, "cells", line)] if rule == "cells" else [("|".join(cells.values()), column, rule, text)])
    assert [r["act_symbol"] for r in read_estimate_feed(spark, str(tmp_path), on_bad="drop").collect()] == ["B"]


def test_columns_go_by_name_in_every_file(spark, tmp_path):
    names = HEADER.split(",")
    put(tmp_path, "a.csv", HEADER, good("A"))
    other = [*reversed(names), "remark"]
    put(tmp_path, "b.csv", ",".join(other), ",".join({**dict(zip(names, good("B").split(","))), "remark": "x, y".replace(",", "")}[c] for c in other))
    rows = {r["act_symbol"]: r for r in read_estimate_feed(spark, str(tmp_path)).collect()}
    assert all(rows[s]["low"] == Decimal(1) and rows[s]["high"] == Decimal("1.5") for s in "AB") and len(rows) == 2
    # with one header for all files the other order is refused, not swapped
    assert feed_violations(spark, str(tmp_path), one_header=True).count() > 0


def test_quotes_blank_lines_bom_and_short_lines(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("n", T.LongType())])
    put(tmp_path, "a.csv", '﻿"n",a\r', '1,"x, y"\r', "", "2,\r", "3", "4,z,more")
    assert sorted(map(tuple, read_csv(spark, str(tmp_path), schema, "drop").collect()), key=str) == [("x, y", 1), (None, 2)]
    assert sorted(r["value"] for r in violations(spark, str(tmp_path), schema).collect()) == ["3", "4,z,more"]


def test_headers_that_lack_or_repeat_a_column(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("n", T.LongType())])
    put(tmp_path, "a.csv", "a,b", "1,2")
    with pytest.raises(ValueError, match="no column n"):
        read_csv(spark, str(tmp_path), schema)
    put(tmp_path, "a.csv", "a,n,n", "1,2,3")
    with pytest.raises(ValueError, match="twice"):
        read_csv(spark, str(tmp_path), schema)
    with pytest.raises(ValueError):
        read_csv(spark, str(tmp_path), T.StructType(schema.fields[:1]), "ignore")


def test_only_a_header_and_an_empty_folder(spark, tmp_path):
    put(tmp_path, "a.csv", HEADER)
    assert read_estimate_feed(spark, str(tmp_path)).count() == 0 and feed_violations(spark, str(tmp_path)).columns == ["record", "column", "rule", "value"]
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "b.csv").write_text("")
    out = read_estimate_feed(spark, str(tmp_path / "e"))
    assert out.count() == 0 and out.schema.fieldNames() == FEED_SCHEMA.fieldNames()


def test_large_file_in_many_splits_has_one_header(spark, tmp_path):
    lines = [good(f"S{i}") for i in range(3000)]
    put(tmp_path, "a.csv", HEADER, *lines)
    usual = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        feed = read_estimate_feed(spark, str(tmp_path))
        assert feed.rdd.getNumPartitions() > 5 and feed.select("act_symbol").distinct().count() == feed.count() == 3000
        assert read_estimate_feed(spark, str(tmp_path), one_header=True).count() == 3000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", usual)


def test_matrix_cells(spark, tmp_path):
    from quarterline.sources.wide import MATRIX_SCHEMA, matrix_violations

    names = MATRIX_SCHEMA.fieldNames()
    put(tmp_path, "a.csv", ",".join(names), ",".join(["T", "Q1 2020", *["1.5"] * (len(names) - 3), "#DIV/0!"]))
    with pytest.raises(Exception, match=names[-1]):
        read_matrix(spark, str(tmp_path)).collect()
    assert read_matrix(spark, str(tmp_path)).select("ticker", names[2]).first()[1] == 1.5
    assert [(r["column"], r["value"]) for r in matrix_violations(spark, str(tmp_path)).collect()] == [(names[-1], "#DIV/0!")]


def test_seeded_files_grow_in_number(spark, tmp_path):
    """Each task that has rows writes a file of its own, the header first and once; cells come out as they are."""
    from quarterline.plans.queries import _written_raw

    rows = spark.range(0, 240, 1, 24).selectExpr("cast(id as string) as a", "concat(' \"x\", ', id, ' ') as b", "if(id % 3 = 0, null, '#') as c", "id % 2 as part")
    found = _written_raw(rows, {0: ["a", "b", "c"], 1: ["c", "b", "a"]}, str(tmp_path / "raw"))
    for folder, header, line in zip(found, ("a,b,c", "c,b,a"), ("concat_ws(',', a, b, coalesce(c, ''))", "concat_ws(',', coalesce(c, ''), b, a)"), strict=True):
        texts = [r["value"].rstrip("\n").split("\n") for r in spark.read.text(folder, wholetext=True).collect()]
        assert len(texts) == 24 and all(t[0] == header for t in texts)
        want = [r[0] for r in rows.where(f"part = {found.index(folder)}").selectExpr(line).collect()]
        assert sorted(x for t in texts for x in t[1:]) == sorted(want)
