"""Clean a corpus: language, quality, near-duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each stage's rows to the shared folder
and hands the next stage what it reads from there. All stages but the last return the columns of their input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarterline.llm import language, minhash, packing, quality, secret_scan
from quarterline.llm.common import documents, staged, with_ids


#: The number of a row, beside the columns of documents; decisions are taken by it.
ROW = "pipeline row"


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a number of its own for each row: the number of its file and its place in it.

    Both come from the files, so every job sees the same numbers, also after executors were lost. Rows that do not come
    straight from files are written first.
    """
    def placed(df: DataFrame) -> DataFrame:
        about = df.metadataColumn("_metadata")
        return df.withColumns({"pipeline file": about["file_path"], "pipeline place": about["row_index"]})

    try:
        rows = placed(docs)
    except AnalysisException:
        rows = placed(staged(docs, "pipeline-rows"))
    files = rows.select("pipeline file").distinct().withColumn("n", F.row_number().over(Window.orderBy("pipeline file")))  # a row per file
    files = staged(files, "pipeline-files")
    numbered = rows.join(F.broadcast(files) if files.count() <= BROADCAST_FILES else files, "pipeline file")
    return numbered.select(*(F.col(f"`{c}`") for c in docs.columns), (F.col("n").cast("long") * (1 << 40) + F.col("pipeline place")).alias(ROW))


#: A row of the table of files is a path and a number, under a kilobyte.
BROADCAST_FILES = 100_000


def _only(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``rows`` whose numbers are kept, without these."""
    return with_ids(rows, staged(kept.select(ROW), "pipeline-kept"), ROW).drop(ROW)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the evidence does not tell go."""
    rows = keyed(docs)
    return _only(rows, language.identify(rows, spark.read.parquet(f"{sf_dir}/pages.parquet"), carried=(ROW,)).where("kept"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a rule at its risk-controlled cutoff go, and those mostly of repeated words or without any.

    Shortness alone is no fault here: short documents are among the good labelled ones.
    """
    rows, labels = keyed(docs), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _only(rows, quality.judged(rows, labels, stratum=F.col("lang"), min_words=1, carried=(ROW,)).where("kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays: of those with the smallest id the first. Repeated rows and rows
    without an id are rows like others."""
    rows = keyed(docs)
    groups = minhash.near_duplicates(rows.select(ROW, "doc_id", "text"), id_col=ROW, order_col="doc_id").select(F.col("doc_id").alias(ROW), "component_id")
    ids = rows.select(ROW, "doc_id")
    first = groups.join(ids, ROW).groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", ROW)).alias("first"))
    return _only(rows, first.select(F.col(f"first.`{ROW}`").alias(ROW)))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts; n_chars follows."""
    row = F.struct(*docs.columns).alias("row")  # other columns may have any names
    found = secret_scan.scan(docs.select("doc_id", "text", row))
    found = found.withColumn("masked", secret_scan.redacted(F.col("text"), F.col("spans")))
    clean = F.size("spans") == 0

    def column(name: str, kind: str):
        if name == "text":
            return F.when(clean, F.col("row.text")).otherwise(F.col("masked")).alias(name)
        if name == "n_chars":
            return F.when(clean, F.col("row.n_chars")).otherwise(F.length("masked").cast(kind)).alias(name)
        return F.col(f"row.`{name}`").alias(name)

    return found.select(*[column(*c) for c in docs.dtypes])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language_id", language_id), ("quality_rules", quality_rules), ("near_dedup", near_dedup), ("secret_scans", secret_scans), ("packing", pack)]

#: Learned models and MinHash are not SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
