"""Pairing actual EPS with consensus EPS (J3a key-aligned, J3b position-aligned).

The reference joins the two tables on their load-order ids, which pairs
the i-th statement row with the i-th estimate row whatever their tickers.
``eps_compare_position`` reproduces that for compatibility; the default
``eps_compare_key`` pairs by (ticker, fiscal_period), which is the intent.

Global load positions are computed without a global sort of the fact:
  1. rows per ticker (aggregate, one row per ticker);
  2. range-partition that per-ticker table by the ticker order into
     blocks, write it, then prefix-sum inside each block (window per
     block) and across block totals (one row per block, broadcast);
  3. ``row_number`` inside each ticker + the ticker's start offset.
Every step is partitioned; nothing is ordered in a single task except the
block totals, whose count is the chosen block number.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterline.functions.periods import period_order
from quarterline.operators.estimates import first_per_key
from quarterline.session import scratch_dir


#: Tickers per block of the prefix sum.
BLOCK_TICKERS = 50_000


def _materialized(df: DataFrame, work_dir: str | None = None) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back.

    Cuts the lineage like a reliable checkpoint, but computes the plan once.
    ``work_dir``: a folder of the caller's, who removes it when done; else the table goes with this process.
    """
    spark = df.sparkSession
    path = f"{work_dir}/{uuid.uuid4().hex}" if work_dir else scratch_dir(spark, "quarterline-materialized", "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ticker_starts(df: DataFrame, ticker: str, ticker_order: Sequence[str],
                  ascending: bool | Sequence[bool] = True, blocks: int | None = None,
                  work_dir: str | None = None) -> DataFrame:
    """(ticker, __start): rows of all tickers before this one in ``ticker_order``, NULLs last.

    ``ticker_order`` are columns of ``df`` constant per ticker (the ticker
    itself, or a joined list position).  The per-ticker counts are written
    with their block, so that both readers see the same blocks whatever
    sampling dealt them; ``blocks`` defaults to one per ``BLOCK_TICKERS``.
    """
    flags = [ascending] * len(ticker_order) if isinstance(ascending, bool) else list(ascending)
    sort_keys = [F.col(c).asc_nulls_last() if a else F.col(c).desc_nulls_last() for c, a in zip(ticker_order, flags, strict=True)]
    if ticker not in ticker_order:
        sort_keys.append(F.col(ticker).asc_nulls_last())
    others = [c for c in dict.fromkeys(ticker_order) if c != ticker]
    counts = _materialized(df.groupBy(ticker, *others).agg(F.count(F.lit(1)).alias("__n")), work_dir)
    blocks = blocks or 1 + counts.count() // BLOCK_TICKERS
    ranged = _materialized(counts.repartitionByRange(blocks, *sort_keys).withColumn("__blk", F.spark_partition_id()), work_dir)
    before = Window.partitionBy("__blk").orderBy(*sort_keys).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("__pre", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    totals = ranged.groupBy("__blk").agg(F.sum("__n").alias("__tot"))
    # One row per block of many tickers: ordering and broadcasting them is cheap.
    earlier = Window.orderBy("__blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__blk", F.coalesce(F.sum("__tot").over(earlier), F.lit(0)).alias("__off"))
    return placed.join(F.broadcast(offsets), "__blk").select(
        ticker, (F.col("__off") + F.col("__pre")).cast("long").alias("__start")
    )


def sequential_position(df: DataFrame, ticker: str, ticker_order: Sequence[str],
                        within_order: Sequence[Column], ascending: bool | Sequence[bool] = True,
                        name: str = "position", blocks: int | None = None,
                        materialize: bool = False, work_dir: str | None = None) -> DataFrame:
    """Add a 1-based, gap-free global position in (ticker order, within order).

    Same numbers as ``row_number() OVER (ORDER BY ticker_order NULLS LAST,
    within)`` (the SERIAL id of an ordered load) without a single-partition
    window; rows without a ticker come last.  ``df`` is read twice (counts,
    rows); with ``materialize=True`` it is written once first.
    """
    if materialize:
        df = _materialized(df, work_dir)
    starts = ticker_starts(df, ticker, ticker_order, ascending, blocks, work_dir).withColumnRenamed(ticker, "__ticker")
    ranked = df.withColumn("__rn", F.row_number().over(Window.partitionBy(ticker).orderBy(*within_order)))
    joined = ranked.join(starts, F.col(ticker).eqNullSafe(F.col("__ticker")))
    return joined.withColumn(name, F.col("__start") + F.col("__rn")).drop("__start", "__rn", "__ticker")


def eps_compare_key(statements: DataFrame, estimates: DataFrame) -> DataFrame:
    """(ticker, fiscal_period, eps, consensus_eps, matched): left join on keys.

    One estimate per key, as in ``features_all``: a doubled load multiplies nothing.
    """
    est = first_per_key(estimates.select("ticker", "fiscal_period", "consensus_eps"), ["ticker", "fiscal_period"], ["consensus_eps"])
    est = est.withColumn("matched", F.lit(True))
    return statements.select("ticker", "fiscal_period", "eps").join(est, ["ticker", "fiscal_period"], "left").select(
        "ticker", "fiscal_period", "eps", "consensus_eps", F.coalesce("matched", F.lit(False)).alias("matched")
    )


def eps_compare_position(statements: DataFrame, estimates: DataFrame, universe: DataFrame | None = None,
                         list_pos: str = "list_pos", blocks: int | None = None,
                         materialize: bool = False, work_dir: str | None = None) -> DataFrame:
    """Inner join of statements and estimates on load position.

    Statements load sorted by ticker, then period.  Estimates load in the
    universe list order (``universe`` with columns ticker, ``list_pos``;
    without it, ticker order) and inside a ticker by period.  Output:
    position, ticker, fiscal_period, eps, est_ticker, est_fiscal_period,
    consensus_eps.

    Positions read each input twice (per-ticker counts, then the rows).  When
    an input is an expensive plan rather than a stored table, pass
    ``materialize=True``: both narrow inputs (one row per ticker-quarter)
    are written once to the shared checkpoint folder and read from there.
    """
    within = [*period_order("fiscal_period"), F.col("fiscal_period")]
    st = statements.select("ticker", "fiscal_period", "eps")
    e = estimates.select("ticker", "fiscal_period", "consensus_eps")
    if materialize:
        st, e = _materialized(st, work_dir), _materialized(e, work_dir)
    s = sequential_position(st, "ticker", ["ticker"], within, blocks=blocks, work_dir=work_dir)
    e_order = ["ticker"]
    if universe is not None:
        e = e.join(universe.select("ticker", list_pos), "ticker")
        e_order = [list_pos]
    e = sequential_position(e, "ticker", e_order, within, blocks=blocks, work_dir=work_dir).select(
        "position", F.col("ticker").alias("est_ticker"), F.col("fiscal_period").alias("est_fiscal_period"),
        "consensus_eps",
    )
    return s.join(e, "position", "inner").select(
        "position", "ticker", "fiscal_period", "eps", "est_ticker", "est_fiscal_period", "consensus_eps"
    )
