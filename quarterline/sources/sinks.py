"""Table and file sinks.

The reference appends to PostgreSQL tables, so running a load twice
doubles the facts.  Sinks here default to ``overwrite`` (an idempotent
reload); ``append`` is kept for the reference behaviour.  Paths should be
on shared storage (see ``session.shared_dir``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterline.operators.assemble import ordered_matrix
from quarterline.operators.estimates import first_per_key


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = (),
                fmt: str = "parquet") -> None:
    """Write a table (S10, S11, S18).  ``overwrite`` makes reloads idempotent."""
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_bucketed(df: DataFrame, name: str, path: str, buckets: int, by: str = "ticker",
                   sort_by: Sequence[str] = ("ticker", "fiscal_period")) -> None:
    """Write an external table bucketed and sorted by ``by`` (co-location).

    Tables written this way with the same bucket count join and window on
    ``by`` without a shuffle: the data is laid out once, at load time.  The
    files live at ``path`` (shared storage); ``name`` is registered in the
    session catalog.
    """
    (df.write.mode("overwrite").format("parquet").bucketBy(buckets, by).sortBy(*sort_by)
     .option("path", path).saveAsTable(name))


def write_clustered_feed(feed: DataFrame, path: str, group_bytes: int = 64 << 20) -> None:
    """Store the snapshot feed so that a narrow universe and window read little of it.

    Files are ranges of (symbol, period end), sorted inside, with small row groups: their minima and maxima and a Bloom
    filter on the symbol let the scan skip the groups that hold none of the wanted symbols, and those of other period
    ends.  A symbol with a large share of all rows spreads over several files, as ranges go on by period end and date.
    """
    keys = ["act_symbol", "period_end_date", "date"]
    (feed.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").option("parquet.block.size", group_bytes)
     .option("parquet.bloom.filter.enabled#act_symbol", "true").parquet(path))


def export_matrix(matrix: DataFrame, path: str) -> None:
    """CSV with header, ordered by ticker, year, quarter, NULL keys last.

    The global order is a range shuffle; part files concatenated in name
    order are the sorted export.
    """
    ordered_matrix(matrix).write.mode("overwrite").option("header", "true").csv(path)


def write_splits(df: DataFrame, path: str) -> None:
    """One CSV folder per split value (S13): ``path/split=train`` etc."""
    df.write.mode("overwrite").partitionBy("split").option("header", "true").csv(path)


def seed_upsert_new(existing: DataFrame, seed: DataFrame, key: str = "ticker", order: Sequence[str] = ()) -> DataFrame:
    """``INSERT ... ON CONFLICT (key) DO NOTHING``.

    Returns the table after the insert: existing rows untouched, seed rows
    whose key is new added with missing columns NULL.  Of several seed rows
    of a key the first by ``order`` (default: by its other columns) counts;
    a NULL key is refused, as a primary key refuses it.
    """
    new = seed.where(F.col(key).isNotNull()).join(existing.select(key), key, "left_anti")
    new = first_per_key(new, [key], list(order) or [c for c in seed.columns if c != key])
    return existing.unionByName(new, allowMissingColumns=True)

