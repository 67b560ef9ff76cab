"""Feature table and feature matrix assembly.

The reference builds ``features`` with one INSERT and fifteen full-table
UPDATE ... FROM passes.  Here the statement features are one projection
over one window (no join at all), the estimate features one window over
the estimate table, and everything meets in a single left join on
(ticker, fiscal_period) that reuses both sides' ticker partitioning: one
ticker exchange per input side after its aggregate, however many features
there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterline.functions.labels import beat_miss, final_label
from quarterline.functions.numeric import fits_store, pct_change, to_store
from quarterline.functions.periods import quarter_text, year_text
from quarterline.operators.align import _materialized, eps_compare_position
from quarterline.operators.estimates import first_per_key
from quarterline.operators.growth import with_growth
from quarterline.operators.ratios import ratio_columns
from quarterline.schemas import FEATURE_COLUMNS

KEYS = ["ticker", "fiscal_period"]


def feature_skeleton(statements: DataFrame) -> DataFrame:
    """(ticker, fiscal_period) of every statement row: the rows features get."""
    return statements.select(*KEYS)


def update_from(target: DataFrame, source: DataFrame, keys: Sequence[str], set_columns: Sequence[str],
                pick_order: Sequence[str] | None = None) -> DataFrame:
    """``UPDATE target SET cols = s.cols FROM source s WHERE keys match``.

    Matched target rows take the source values, unmatched ones NULL.  When
    several source rows match one key, PostgreSQL applies an arbitrary
    one; here the first by ``pick_order`` (default: the set columns) wins,
    chosen by an aggregate so duplicates never multiply target rows.
    """
    keys, set_columns = list(keys), list(set_columns)
    src = source.select(*keys, *set_columns, *[c for c in (pick_order or []) if c not in keys + set_columns])
    src = first_per_key(src, keys, list(pick_order or set_columns)).select(*keys, *set_columns)
    kept = [c for c in target.columns if c not in set_columns]
    return target.select(*kept).join(src, keys, "left").select(*kept, *set_columns)


def statement_features(statements: DataFrame, overflow: str = "error") -> DataFrame:
    """Revenue growth, momentum and the eight ratios plus eps, one window."""
    ratio_cols = ratio_columns()
    # Ratios are rounded before the exchange so the shuffle carries 10,4 decimals.
    base = statements.select(*KEYS, "eps", "revenue", *[to_store(v, overflow).alias(k) for k, v in ratio_cols.items()])
    g = with_growth(base, "revenue", "rev")
    growth = ["qoq_rev", "yoy_rev", "momentum"]
    return g.select(*KEYS, "eps", *[to_store(c, overflow).alias(c) for c in growth], *ratio_cols)


def estimate_features(estimates: DataFrame, overflow: str = "error") -> DataFrame:
    """Consensus growth (computed before any join) and the consensus itself."""
    g = with_growth(estimates.select(*KEYS, "consensus_eps"), "consensus_eps", "eps", with_momentum=False)
    return g.select(*KEYS, "consensus_eps", *[to_store(c, overflow).alias(c) for c in ("qoq_eps", "yoy_eps")])


def features_all(statements: DataFrame, estimates: DataFrame, alignment: str = "key",
                 universe: DataFrame | None = None, blocks: int | None = None,
                 materialize: bool = False, overflow: str = "error") -> DataFrame:
    """The ``features`` table: keys, 13 features, eps_status, eps_surprise.

    A feature or surprise that does not fit DECIMAL(10,4) raises; with
    ``overflow="null"`` it is NULL, and a row whose surprise does not fit
    has no status either, so that no text label stands in for its sign.

    ``alignment="key"`` (default) compares each quarter's actual EPS with
    the consensus of the same ticker and quarter.  ``"position"`` pairs by
    load position as the reference does (see ``align``); ``universe``
    (ticker, list_pos) then gives the estimate load order.  Rows whose
    comparison found no partner keep NULL status and surprise.
    ``materialize`` is passed to ``eps_compare_position``.
    """
    if alignment == "position" and materialize:
        # Written once: features and positions read the same two narrow tables.
        statements, estimates, materialize = _materialized(statements), _materialized(estimates), False
    sf = statement_features(statements, overflow)
    # One estimate row per key, as an UPDATE ... FROM applies one match per
    # target row (duplicate keys appear when a load is appended twice).
    ef = first_per_key(estimate_features(estimates, overflow), KEYS, ["consensus_eps", "qoq_eps", "yoy_eps"])
    ef = ef.withColumn("__matched", F.lit(True))
    joined = sf.join(ef, KEYS, "left")
    if alignment == "key":
        matched = F.coalesce(F.col("__matched"), F.lit(False))
        change = pct_change("eps", "consensus_eps")
        status = F.when(fits_store(change), beat_miss("eps", "consensus_eps", matched))
        surprise = to_store(change, overflow)
        return joined.select(*KEYS, *FEATURE_COLUMNS, status.alias("eps_status"), surprise.alias("eps_surprise"))
    if alignment != "position":
        raise ValueError(f"alignment must be 'key' or 'position', not {alignment!r}")
    pairs = eps_compare_position(statements, estimates, universe, blocks=blocks, materialize=materialize).select(
        *KEYS,
        F.when(fits_store(pct_change("eps", "consensus_eps")), beat_miss("eps", "consensus_eps")).alias("eps_status"),
        to_store(pct_change("eps", "consensus_eps"), overflow).alias("eps_surprise"),
    )
    # Duplicate statement keys would make the UPDATE pick one pair; do the same.
    pairs = first_per_key(pairs, KEYS, ["eps_status", "eps_surprise"])
    return joined.select(*KEYS, *FEATURE_COLUMNS).join(pairs, KEYS, "left")


def feature_matrix(features: DataFrame, estimates: DataFrame | None = None, keys_from: str = "features") -> DataFrame:
    """``findata``: keys, 13 features, numeric eps_status, eps_surprise (J4 + L3).

    The reference RIGHT JOINs estimates to features on (year text, quarter
    text, ticker) and selects the keys from the estimate side, so rows
    without an estimate lose ticker and period.  ``keys_from="features"``
    (default) keeps the feature keys; since estimate keys are unique per
    (ticker, quarter), that needs no join.  ``keys_from="estimates"``
    reproduces the reference, NULL keys included.  The label is then the
    sign of the surprise, else the text label mapped to 1.0 / 0.0.
    """
    label = final_label("eps_status", "eps_surprise").alias("eps_status")
    body = [*FEATURE_COLUMNS, label, "eps_surprise"]
    if keys_from == "features":
        return features.select(*KEYS, *body)
    if keys_from != "estimates" or estimates is None:
        raise ValueError("keys_from='estimates' needs the estimates table")
    ae = estimates.select(
        F.col("ticker").alias("__ae_ticker"),
        F.col("fiscal_period").alias("__ae_period"),
        year_text("fiscal_period").alias("__y"),
        quarter_text("fiscal_period").alias("__q"),
    )
    f = features.withColumn("__y", year_text("fiscal_period")).withColumn("__q", quarter_text("fiscal_period"))
    joined = ae.join(f, [ae["__y"] == f["__y"], ae["__q"] == f["__q"], ae["__ae_ticker"] == f["ticker"]], "right")
    return joined.select(F.col("__ae_ticker").alias("ticker"), F.col("__ae_period").alias("fiscal_period"), *body)


def ordered_matrix(matrix: DataFrame) -> DataFrame:
    """Final ORDER BY ticker, year text, quarter text with NULL keys last (O2).

    A global sort (range shuffle): use only where the output file order
    matters, e.g. the CSV export.
    """
    return matrix.orderBy(
        F.col("ticker").asc_nulls_last(),
        year_text("fiscal_period").asc_nulls_last(),
        quarter_text("fiscal_period").asc_nulls_last(),
    )
