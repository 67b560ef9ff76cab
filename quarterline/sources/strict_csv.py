"""CSV files by their own headers, with every cell judged.

Spark's CSV reader takes columns by position and turns a cell that does not
parse into NULL.  Here each file's columns are found by the names in its own
header line, whatever their order, and a cell is NULL only if it is empty or
says so (``NA_TEXTS``).  Any other cell that does not hold a value of its
declared type is a violation, and so is a line with more or fewer cells than
its header.  A caller either lets violations raise or takes the rows without
them and the violations as a table.

Lines are read as text, so a record is one line.  Reading is one pass when all
files share one header line (``one_header=True``: the first file's is used,
and another file's header line is then a row full of violations, never data);
otherwise a first pass looks for the header line of each file.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterline.operators.reshape import NA_TEXTS

#: Different header lines that one read may meet (each is parsed by an expression of its own).
MOST_HEADERS = 100
#: Files whose headers may be broadcast: a path and a number each, under a kilobyte.
BROADCAST_FILES = 100_000
VIOLATIONS = "__violations"
VIOLATION_KIND = "array<struct<column:string,rule:string,value:string>>"

_DATE = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([ T]0{1,2}:00(:00(\.0+)?)?)?$"


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    text = spark.read.text(path if isinstance(path, str) else list(path))
    value = F.regexp_replace("value", "^﻿|\r$", "").alias("line")
    about = text.metadataColumn("_metadata")
    return text.select(value, about["file_path"].alias("file"), about["file_block_start"].alias("block")).where(F.trim("line") != "")


def _names(header: str, schema: T.StructType) -> list[str]:
    names = [n.strip() for n in next(csv.reader([header]))]
    missing = [c for c in schema.fieldNames() if c not in names]
    if missing or len(set(names)) < len(names):
        raise ValueError(f"header {header!r}: " + (f"no column {', '.join(missing)}" if missing else "a column comes twice"))
    return names


def header_of_each_file(lines: DataFrame) -> DataFrame:
    """(file, header): the first line of each file."""
    first = lines.where("block = 0").select("file", "line", F.monotonically_increasing_id().alias("at"))
    return first.groupBy("file").agg(F.min_by("line", "at").alias("header"))


def _parsed(names: list[str], schema: T.StructType) -> Column:
    """A line's cells of the declared columns as text; ``bad`` holds the line if it has more or fewer cells than names."""
    cells = T.StructType([*(T.StructField(f"c{i}", T.StringType()) for i in range(len(names))), T.StructField("bad", T.StringType())])
    row = F.from_csv("line", cells.simpleString()[7:-1].replace(":", " "), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad"})
    return F.get(F.transform(F.array(row), lambda r: F.struct(
        *[r[f"c{names.index(c)}"].alias(c) for c in schema.fieldNames()], r["bad"].alias(VIOLATIONS))), 0)


def raw_rows(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, one_header: bool = False) -> DataFrame:
    """Every record's declared cells as text, and ``__violations``: the line where it has not one cell a column."""
    lines = _lines(spark, path)
    if one_header:
        first = lines.where("block = 0").select("line").head(1)
        headers, records = [r["line"] for r in first], lines
    else:
        files = header_of_each_file(lines)
        headers = sorted(r["header"] for r in files.select("header").distinct().limit(MOST_HEADERS + 1).collect())
        if len(headers) > MOST_HEADERS:
            raise ValueError(f"over {MOST_HEADERS} different header lines")
        records = lines
        if len(headers) > 1:
            few = files.count() <= BROADCAST_FILES
            records = lines.join(F.broadcast(files) if few else files, "file").where("line <> header")
    if len(headers) == 1:
        records = records.where(F.col("line") != headers[0]).withColumn("header", F.lit(headers[0]))
    if not headers:
        empty = T.StructType([*(T.StructField(c, T.StringType()) for c in schema.fieldNames()), T.StructField(VIOLATIONS, T.StringType())])
        return spark.createDataFrame([], empty)
    row = F.coalesce(*[F.when(F.col("header") == h, _parsed(_names(h, schema), schema)) for h in headers])
    # a generator, so that a line is parsed once however often its cells are used
    return records.select(F.explode(F.array(row)).alias("row")).select("row.*")


def _empty(text: Column) -> Column:
    return text.isNull() | F.lower(F.trim(text)).isin(NA_TEXTS)


def _judged(text: Column, kind: T.DataType) -> tuple[Column, Column]:
    """(value or NULL, the rule broken where there is no value though the cell is not empty) of a cell's text."""
    if isinstance(kind, T.StringType):
        return F.nullif(text, F.lit("")), F.lit(None).cast("string")
    if isinstance(kind, T.DateType):
        day = F.substring_index(F.substring_index(F.trim(text), " ", 1), "T", 1)
        return F.coalesce(F.when(text.like("____-__-__"), text.try_cast(kind)), F.when(F.trim(text).rlike(_DATE), day.try_cast(kind))), F.lit("date")
    if isinstance(kind, T.DecimalType):  # rounded half up
        return text.try_cast(kind), F.when(text.try_cast(T.DecimalType(38, kind.scale)).isNull(), F.lit("number")).otherwise(F.lit(kind.simpleString()))
    if isinstance(kind, (T.IntegerType, T.LongType)):
        wide = text.try_cast("decimal(38,10)")
        rule = F.when(wide.isNull(), F.lit("number")).when(wide != F.floor(wide), F.lit("whole number")).otherwise(F.lit(kind.simpleString()))
        return F.coalesce(text.try_cast(kind), F.when(wide == F.floor(wide), F.floor(wide).try_cast(kind))), rule
    return F.nanvl(text.try_cast(kind), F.lit(None).cast(kind)), F.lit("number")


def judged_rows(raw: DataFrame, schema: T.StructType, *more: Column) -> DataFrame:
    """``more`` columns of the text rows, the typed columns and ``__violations``: (column, rule, value) of each cell that does not hold its type, or one entry
    without a column for a line of too many or too few cells."""
    judged = {f.name: _judged(F.col(f"`{f.name}`"), f.dataType) for f in schema.fields}
    cells = F.filter(F.array(*[
        F.when(value.isNull() & ~_empty(F.col(f"`{c}`")) & rule.isNotNull(), F.struct(F.lit(c).alias("column"), rule.alias("rule"), F.col(f"`{c}`").alias("value")))
        for c, (value, rule) in judged.items()]).cast(VIOLATION_KIND), lambda v: v.isNotNull())
    line = F.array(F.struct(F.lit(None).cast("string").alias("column"), F.lit("cells").alias("rule"), F.col(VIOLATIONS).alias("value"))).cast(VIOLATION_KIND)
    return raw.select(*more, *[value.alias(c) for c, (value, _) in judged.items()], F.when(F.col(VIOLATIONS).isNotNull(), line).otherwise(cells).alias(VIOLATIONS))


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, on_bad: str = "raise", one_header: bool = False) -> DataFrame:
    """The records of CSV files as ``schema`` declares them.

    ``on_bad="raise"``: reading a violating cell, or a line of too many or too few cells, raises (cells of columns that
    a query does not read are not looked at).  ``"drop"``: only records without any violation come back; take the
    others from ``violations``.  ``"keep"``: all records, with their violations in ``__violations``.
    """
    raw = raw_rows(spark, path, schema, one_header)
    if on_bad == "raise":
        def value(f: T.StructField) -> Column:
            good, rule = _judged(F.col(f"`{f.name}`"), f.dataType)
            said = F.concat(F.lit(f"column {f.name}: not a {f.dataType.simpleString()}: "), F.col(f"`{f.name}`"))
            return F.coalesce(good, F.when(_empty(F.col(f"`{f.name}`")) | rule.isNull(), F.lit(None)).otherwise(F.raise_error(said)).cast(f.dataType)).alias(f.name)

        whole = F.when(F.col(VIOLATIONS).isNull(), True).otherwise(F.raise_error(F.concat(F.lit("line with too many or too few cells: "), VIOLATIONS)).cast("boolean"))
        return raw.where(whole).select(*[value(f) for f in schema.fields])
    rows = judged_rows(raw, schema)
    if on_bad == "drop":
        return rows.where(F.size(VIOLATIONS) == 0).drop(VIOLATIONS)
    if on_bad == "keep":
        return rows
    raise ValueError("on_bad must be 'raise', 'drop' or 'keep'")


def violations(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, one_header: bool = False) -> DataFrame:
    """(record, column, rule, value) of every violation: the record's declared cells joined by ``|`` (NULL for a line
    of too many or too few cells, whose value is the whole line), the column, the rule it breaks and its text."""
    record = F.array_join(F.array(*[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in schema.fieldNames()]), "|")
    record = F.when(F.col(VIOLATIONS).isNull(), record).alias("__record")
    rows = judged_rows(raw_rows(spark, path, schema, one_header), schema, record)
    return rows.select(F.col("__record").alias("record"), F.explode(VIOLATIONS).alias("v")).select("record", "v.*")
