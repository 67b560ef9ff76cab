"""Scanning wide statement sheets and the estimate snapshot feed.

Sheets: one file per company and statement (``<TICKER>_PL``, ``_BS``,
``_CF``, ``_DERIVED`` in the reference, as Excel).  Here they are Parquet
(or CSV) files of the same layout: an unnamed title column and one column
per period.  All companies of a statement kind are read by ONE scan; the
ticker comes from a column or from the file name.  Every CSV file is read
by its own header.  Parquet files may carry different period columns
(``mergeSchema`` unions them by name) if a period has one type; sheets that
mix types land as long tables (ticker, Metrics, fiscal_period, value),
read by ``read_long_sheets``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterline.operators.reshape import cell_value, scan_wide
from quarterline.schemas import FEATURE_COLUMNS
from quarterline.sources.strict_csv import read_csv, violations

# The reference's snapshot feed columns.
FEED_SCHEMA = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("act_symbol", T.StringType()),
        T.StructField("period", T.StringType()),
        T.StructField("period_end_date", T.DateType()),
        T.StructField("consensus", T.DecimalType(10, 4)),
        T.StructField("recent", T.DecimalType(10, 4)),
        T.StructField("count", T.IntegerType()),
        T.StructField("high", T.DecimalType(10, 4)),
        T.StructField("low", T.DecimalType(10, 4)),
        T.StructField("year_ago", T.DecimalType(10, 4)),
    ]
)

MATRIX_SCHEMA = T.StructType(
    [T.StructField("ticker", T.StringType()), T.StructField("fiscal_period", T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in FEATURE_COLUMNS]
    + [T.StructField("eps_status", T.DoubleType()), T.StructField("eps_surprise", T.DoubleType())]
)


def read_wide_sheets(spark: SparkSession, path: str, fmt: str = "parquet", ticker_from: str = "column",
                     ticker_pattern: str = r"([^/_]+)_[A-Z]+(?:\.[A-Za-z]+)?(?:/[^/]*)?$") -> DataFrame:
    """Read every company's sheet of one kind and return the tidy long form.

    ``ticker_from="path"`` takes the ticker from the file name (or, for a
    written dataset folder, the folder name) with ``ticker_pattern`` (first
    group), e.g. ``AAPL_PL.parquet`` -> AAPL.
    """
    if fmt == "csv":
        return _csv_sheets(spark, path, ticker_from, ticker_pattern)
    if fmt != "parquet":
        raise ValueError(f"unsupported sheet format {fmt!r}")
    sheets = spark.read.option("mergeSchema", "true").parquet(path)
    if ticker_from == "path":
        sheets = sheets.withColumn("ticker", F.regexp_extract(F.col("_metadata.file_path"), ticker_pattern, 1))
    elif "ticker" not in sheets.columns:
        raise ValueError("sheets have no ticker column; use ticker_from='path'")
    return scan_wide(sheets)


# A comma outside quotes: an even number of quotes follows on the line.
_COMMA = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def _csv_sheets(spark: SparkSession, path: str, ticker_from: str, ticker_pattern: str) -> DataFrame:
    """Cells of CSV sheets, each file (one company's, so small) by its own header line."""
    files = spark.read.text(path, wholetext=True).withColumn("path", F.col("_metadata.file_path"))

    def fields(line):
        return F.transform(F.split(line, _COMMA), lambda x: F.replace(F.regexp_replace(F.trim(x), '^"|"$', ""), F.lit('""'), F.lit('"')))

    lines = F.filter(F.split("value", r"\r?\n"), lambda x: F.trim(x) != "")
    rows = files.select("path", lines.alias("lines")).select("path", fields(F.get("lines", 0)).alias("header"), F.explode(F.slice("lines", 2, 1 << 30)).alias("line"))
    unnamed = F.array_position(F.transform("header", lambda h: h.rlike("^(Unnamed: 0|_c0|Metrics|)$")), True)
    rows = rows.select("path", "header", fields(F.col("line")).alias("cells"), unnamed.cast("int").alias("title"), F.array_position("header", F.lit("ticker")).cast("int").alias("named"))
    # without an unnamed column the titles are the first that is not the ticker
    title = F.when(F.col("title") > 0, F.col("title")).when(F.col("named") == 1, F.lit(2)).otherwise(F.lit(1)) - 1
    rows = rows.withColumn("title", title)
    if ticker_from == "path":
        ticker = F.regexp_extract("path", ticker_pattern, 1)
    else:
        ticker = F.when(F.col("named") > 0, F.get("cells", F.col("named") - 1)).otherwise(F.raise_error(F.lit("sheets have no ticker column; use ticker_from='path'")))
    cells = rows.select(ticker.alias("ticker"), F.get("cells", F.col("title")).alias("Metrics"), "cells", "title", "named", F.posexplode("header").alias("pos", "fiscal_period"))
    return cells.where("pos <> title and pos <> named - 1").select("ticker", "Metrics", "fiscal_period", cell_value(F.get("cells", F.col("pos"))).alias("value"))


def read_long_sheets(spark: SparkSession, path: str) -> DataFrame:
    """Parquet tables (ticker, Metrics, fiscal_period, value): the landing format of sheets that mix types."""
    return spark.read.parquet(path).select("ticker", "Metrics", "fiscal_period", cell_value("value").alias("value"))


def read_estimate_feed(spark: SparkSession, path: str | Sequence[str], fmt: str = "csv", on_bad: str = "raise", one_header: bool = False) -> DataFrame:
    """The snapshot feed with its declared schema, no inference.

    CSV columns go by the header of each file and every cell is judged (``strict_csv.read_csv``): a bad cell raises,
    or with ``on_bad="drop"`` its record is left to ``feed_violations``.  The never-used ``recent`` and ``year_ago``
    columns are pruned by Catalyst as soon as a query does not select them.
    """
    if fmt == "csv":
        return read_csv(spark, path, FEED_SCHEMA, on_bad, one_header)
    if fmt == "parquet":
        return spark.read.parquet(*([path] if isinstance(path, str) else path))
    raise ValueError(f"unsupported feed format {fmt!r}")


def feed_violations(spark: SparkSession, path: str | Sequence[str], one_header: bool = False) -> DataFrame:
    """(record, column, rule, value) of the feed's cells and lines that ``read_estimate_feed`` refuses."""
    return violations(spark, path, FEED_SCHEMA, one_header)


def read_matrix(spark: SparkSession, path: str | Sequence[str], on_bad: str = "raise", one_header: bool = False) -> DataFrame:
    """A feature-matrix CSV export with its declared schema, judged like the feed."""
    return read_csv(spark, path, MATRIX_SCHEMA, on_bad, one_header)


def matrix_violations(spark: SparkSession, path: str | Sequence[str], one_header: bool = False) -> DataFrame:
    """(record, column, rule, value) of the export's cells and lines that ``read_matrix`` refuses."""
    return violations(spark, path, MATRIX_SCHEMA, one_header)
