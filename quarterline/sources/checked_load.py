"""A load that checks the declared constraints in the pass that writes.

Every row gets the list of rules it breaks.  Rows that break none are written under ``status=loaded``, the others,
with their rules, under ``status=quarantined``; an observation counts rows and rules while they pass, so the report
costs no second look at the source.  One exchange on the ticker serves the key check and the lags.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterline.functions.numeric import fits_store
from quarterline.operators.growth import quarter_window
from quarterline.operators.quality import PERIOD_PATTERN
from quarterline.schemas import VARCHAR_LIMITS

#: rule -> constraint; the order is that of the report.
RULES = ["duplicate key", "unknown ticker", "varchar length", "decimal range", "bad period", "zero denominator"]


def _no(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def broken_rules(statements: DataFrame, companies: DataFrame, keys: Sequence[str] = ("ticker", "fiscal_period")) -> DataFrame:
    """``statements`` with ``rules``: the constraints each row breaks.

    duplicate key: the keys are on more than one row (C1); unknown ticker: not NULL and without a company (C2);
    varchar length and decimal range: a cell beyond its declared type (C3); bad period (C4); zero denominator: a
    figure that a feature divides by, in this row or 1 or 4 rows back, is zero (C5).
    """
    known = companies.select(F.col("ticker").alias("__company")).where("__company is not null").distinct()
    rows = statements.repartition("ticker")
    rows = rows.join(known, F.col("ticker") == F.col("__company"), "left")
    w = quarter_window()
    too_long = [F.length(F.col(c).cast("string")) > n for c, n in VARCHAR_LIMITS.items() if c in statements.columns]
    too_large = [~fits_store(f.name) for f in statements.schema.fields if isinstance(f.dataType, T.DecimalType)]
    zero = [F.col("revenue") == 0, F.col("total_assets") == 0, F.col("total_assets") - F.col("total_liabilities") == 0, F.col("current_liabilities") == 0,
            F.lag("revenue", 1).over(w) == 0, F.lag("revenue", 4).over(w) == 0]

    def any_of(checks: list[Column]) -> Column:
        out = F.lit(False)
        for c in checks:
            out = out | _no(c)
        return out

    broken = [
        F.count(F.lit(1)).over(Window.partitionBy(*keys)) > 1, F.col("ticker").isNotNull() & F.col("__company").isNull(), any_of(too_long), any_of(too_large),
        ~_no(F.col("fiscal_period").rlike(PERIOD_PATTERN)), any_of(zero)]
    listed = F.filter(F.array(*[F.when(b, F.lit(r)) for r, b in zip(RULES, broken, strict=True)]), lambda r: r.isNotNull())
    return rows.select(*statements.columns, listed.alias("rules"))


def checked_load(statements: DataFrame, companies: DataFrame, path: str, refuse: Sequence[str] = RULES) -> dict[str, int]:
    """Write ``statements`` under ``path``, judged; returns rows loaded and quarantined and the rows per rule.

    ``refuse``: the rules that send a row to quarantine; the others are only counted.
    """
    seen = Observation("load")
    judged = broken_rules(statements, companies)
    refused = F.exists("rules", lambda r: r.isin(list(refuse)))
    counts = [F.count(F.when(F.array_contains("rules", r), 1)).alias(r) for r in RULES]
    rows = judged.withColumn("status", F.when(refused, F.lit("quarantined")).otherwise(F.lit("loaded")))
    rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("status") == "loaded", 1)).alias("loaded"), *counts)
    rows.write.mode("overwrite").partitionBy("status").parquet(path)
    return seen.get


def loaded(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).where("status = 'loaded'").drop("status", "rules")


def quarantined(spark: SparkSession, path: str) -> DataFrame:
    """The refused rows with ``rules``."""
    return spark.read.parquet(path).where("status = 'quarantined'").drop("status")
