"""End-to-end flows: load (wide sheets + feed -> tables), features, models.

Each stage reads its inputs, writes its outputs with ``overwrite`` (an
idempotent reload) under a folder on shared storage, and the next stage
reads those tables back.  Writing the stage outputs is also where the
lineage is cut: a lost executor later recomputes from the written tables,
never from the raw sheets.  No stage collects rows to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterline.operators import datasets, metrics, models
from quarterline.operators.assemble import feature_matrix, features_all
from quarterline.operators.estimates import REFERENCE_WINDOW, analyst_estimates
from quarterline.operators.statements import (
    conform_statements,
    statements_from_sheets,
    with_capex,
)
from quarterline.schemas import ANALYST_ESTIMATES, FEATURE_COLUMNS, conform
from quarterline.session import shared_dir
from quarterline.sources.sinks import export_matrix, write_bucketed, write_table
from quarterline.sources.wide import read_estimate_feed, read_wide_sheets

# The reference's year splits for the row model and the
# target-quarter boundaries of the sequence model.
REFERENCE_YEAR_SPLITS = {"train": [2021, 2022], "val": [2023], "test": [2024]}
REFERENCE_VAL_START, REFERENCE_TEST_START = (2023, 3), (2024, 1)


@dataclass(frozen=True)
class SheetPaths:
    """Where the wide sheets of each kind live (globs allowed)."""

    income: str
    balance: str
    cash: str
    derived: str
    fmt: str = "parquet"
    ticker_from: str = "path"


def table_dir(spark: SparkSession, name: str = "tables") -> str:
    """``name`` under ``spark.checkpoint.dir``: where that is set, the same folder in every session."""
    return shared_dir(spark, name)


def bucketed_name(tables: str, name: str) -> str:
    """The catalog name of a bucketed table of the folder ``tables``; folders do not share names."""
    return f"{name}_{hashlib.md5(tables.rstrip('/').encode()).hexdigest()[:12]}"


def load_stage(spark: SparkSession, sheets: SheetPaths, feed_path: str, out_dir: str, feed_fmt: str = "csv",
               window: tuple[str, str] = REFERENCE_WINDOW, universe: DataFrame | Sequence | None = None,
               tie_breakers: Sequence[str] = (), buckets: int | None = None,
               picks: dict[str, dict[str, str]] | None = None) -> dict[str, str]:
    """Wide sheets + snapshot feed -> ``financial_statements`` and ``analyst_estimates``.

    With ``buckets`` both tables are written bucketed and sorted by ticker
    (catalog tables named after the folder, see ``bucketed_name``), so the feature stage runs its windows and its join without
    any exchange.
    """
    def scan(path):
        return read_wide_sheets(spark, path, sheets.fmt, sheets.ticker_from)

    fs = statements_from_sheets(scan(sheets.income), scan(sheets.balance), scan(sheets.cash), scan(sheets.derived), picks)
    paths = {"financial_statements": f"{out_dir}/financial_statements",
             "analyst_estimates": f"{out_dir}/analyst_estimates"}
    feed = read_estimate_feed(spark, feed_path, feed_fmt)
    est = conform(analyst_estimates(feed, window, universe, tie_breakers), ANALYST_ESTIMATES)
    fs = conform_statements(fs)
    for name, df in (("financial_statements", fs), ("analyst_estimates", est)):
        if buckets:
            write_bucketed(df, bucketed_name(out_dir, name), paths[name], buckets)
        else:
            write_table(df, paths[name])
    return paths


def _read_stage_table(spark: SparkSession, tables: str, name: str, bucketed: bool) -> DataFrame:
    """The bucketed catalog table written by ``load_stage(buckets=...)``, or the files."""
    return spark.table(bucketed_name(tables, name)) if bucketed else spark.read.parquet(f"{tables}/{name}")


def feature_inputs(spark: SparkSession, tables: str, bucketed: bool = False) -> tuple[DataFrame, DataFrame]:
    """(statements, estimates) as written by ``load_stage``."""
    return (_read_stage_table(spark, tables, "financial_statements", bucketed),
            _read_stage_table(spark, tables, "analyst_estimates", bucketed))


def feature_stage(spark: SparkSession, tables: str, alignment: str = "key", universe: DataFrame | None = None,
                  export: bool = True, bucketed: bool = False) -> dict[str, str]:
    """Tables -> ``features`` table and the ordered ``findata`` CSV export.

    ``bucketed=True`` reads the bucketed tables of ``load_stage(buckets=...)``:
    the windows and the join then need no exchange.
    """
    fs, est = feature_inputs(spark, tables, bucketed)
    paths = {"features": f"{tables}/features", "findata": f"{tables}/findata_csv"}
    write_table(features_all(fs, est, alignment, universe), paths["features"])
    if export:
        export_matrix(feature_matrix(spark.read.parquet(paths["features"])), paths["findata"])
    return paths


def model_stage(spark: SparkSession, tables: str, year_splits=REFERENCE_YEAR_SPLITS,
                val_start=REFERENCE_VAL_START, test_start=REFERENCE_TEST_START, seq_len: int = 4,
                max_iter: int = 200) -> DataFrame:
    """Feature matrix -> row and sequence classifiers -> accuracy per model and split."""
    matrix = feature_matrix(spark.read.parquet(f"{tables}/features"))
    rows = datasets.row_dataset(datasets.split_by_year(matrix, year_splits))
    row_model = models.fit_row_classifier(rows.where(F.col("split") == "train"), max_iter=max_iter)
    row_scores = models.score(row_model, rows.where(F.col("split") != "train"), ["split", "label"])

    seqs = datasets.split_by_target(datasets.sequence_windows(matrix, k=seq_len), val_start, test_start)
    seqs = datasets.flatten_windows(seqs).where(F.col("label").isNotNull())
    seqs = seqs.where(F.forall("seq_features", lambda x: x.isNotNull()))
    seq_model = models.fit_sequence_classifier(seqs.where(F.col("split") == "train"),
                                               seq_len * len(FEATURE_COLUMNS), max_iter=max_iter)
    seq_scores = models.score(seq_model, seqs.where(F.col("split") != "train"), ["split", "label"], sequence=True)
    return metrics.accuracy_by_split(row_scores.withColumn("model", F.lit("row")), by=["model", "split"]).unionByName(
        metrics.accuracy_by_split(seq_scores.withColumn("model", F.lit("sequence")), by=["model", "split"]))


def statements_with_capex(spark: SparkSession, tables: str) -> DataFrame:
    """The stored statements with capex recomputed from the cash flows."""
    return with_capex(spark.read.parquet(f"{tables}/financial_statements"))
